"""Column-level helpers: built-in Spark expressions only (no UDFs)."""
from .scalars import (  # noqa: F401
    days_between, epoch_seconds, hour_of, money, parse_event_ts,
    partition_strings, safe_ratio,
)
from .predicates import (  # noqa: F401
    bronze_valid, first_failure, within_days,
)
