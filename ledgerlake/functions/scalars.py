"""Scalar projections (P1-P14) as Spark Column expressions.

All time values are TIMESTAMP_NTZ holding UTC wall-clock time, so results
never depend on ``spark.sql.session.timeZone``.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import MONEY

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_event_ts(c) -> Column:
    """ISO-8601 string -> TIMESTAMP_NTZ (UTC wall clock), NULL when unparseable.

    * ``...+00:00Z`` (tz-aware isoformat plus ``Z``) is normalised to ``...Z``.
    * A string with a zone designator (``Z`` or ``+HH:MM`` / ``-HHMM``) is
      read as an instant and shifted to UTC through epoch microseconds (no
      session zone involved).
    * A string without zone is taken as UTC wall clock as-is.

    The common cases cost a suffix test and one cast; the regular
    expression only runs when a sign sits where an offset would be.
    """
    s = _c(c)
    fixed = F.when(s.endswith("+00:00Z"), F.concat(F.left(s, F.length(s) - 7), F.lit("Z"))) \
        .otherwise(s)
    shifted = F.timestamp_add("MICROSECOND", F.unix_micros(F.try_to_timestamp(fixed)),
                              F.expr(_EPOCH_NTZ))
    signed = F.substring(s, -6, 1).isin("+", "-") | F.substring(s, -5, 1).isin("+", "-")
    offset = signed & s.rlike(r"[T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?[+-]\d{2}:?\d{2}$")
    return (F.when(s.endswith("Z"), shifted).when(offset, shifted)
             .otherwise(s.try_cast("timestamp_ntz")))


def partition_strings(ts) -> list[Column]:
    """Zero-padded year/month/day strings of a timestamp."""
    t = _c(ts)
    return [F.date_format(t, "yyyy").alias("year"),
            F.date_format(t, "MM").alias("month"),
            F.date_format(t, "dd").alias("day")]


def money(c) -> Column:
    """Double -> DECIMAL(18,2), HALF_UP, NULL on overflow or bad input."""
    return _c(c).try_cast(MONEY)


def epoch_seconds(ts) -> Column:
    """Whole seconds since 1970-01-01 of a TIMESTAMP_NTZ (floor)."""
    return F.timestamp_diff("SECOND", F.expr(_EPOCH_NTZ), _c(ts))


def hour_of(ts) -> Column:
    """Truncate a TIMESTAMP_NTZ to the hour, staying NTZ."""
    t = _c(ts)
    return F.make_timestamp_ntz(F.year(t), F.month(t), F.dayofmonth(t), F.hour(t),
                                F.lit(0), F.lit(0))


def safe_ratio(num, den) -> Column:
    """P10: num / den as DOUBLE, 0 when either side is NULL or den is 0."""
    return F.coalesce(F.try_divide(_c(num).cast("double"), _c(den).cast("double")),
                      F.lit(0.0))


def days_between(anchor, d) -> Column:
    """Whole days from ``d`` to ``anchor`` (anchor - d)."""
    return F.datediff(_c(anchor), _c(d))
