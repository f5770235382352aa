"""DataFrame -> DataFrame operators of the churn analytics."""
