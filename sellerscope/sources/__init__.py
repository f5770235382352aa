"""Sources (registry, schemas, test-data adapter) and sinks."""

from sellerscope.sources.fixture import funnel_tables  # noqa: F401
from sellerscope.sources.registry import TableRegistry, parse_dates, row_counts, safe_read  # noqa: F401
