"""sellerscope: seller-churn analytics as Spark jobs.

Every public operator takes DataFrames (plus parameters) and returns a
DataFrame; nothing in the data path collects to the driver.
"""

from sellerscope.config import ChurnParams

__all__ = ["ChurnParams"]
__version__ = "0.1.0"
