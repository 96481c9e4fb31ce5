"""Silver cleanse (C2), deduplication (U1, U2) and set difference."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import first_failure
from ..functions.scalars import money, parse_event_ts
from ..schemas import VALID_CURRENCIES


def cast_and_classify(df: DataFrame, currencies: Sequence[str] = VALID_CURRENCIES) -> DataFrame:
    """Add ``amount_decimal``, ``event_ts`` and ``quarantine_reason``.

    ``quarantine_reason`` is NULL for a valid row, else the first failed
    check in the fixed order of ``schemas.QUARANTINE_REASONS``.  One
    classified frame feeds both outputs, so the input is scanned once and no
    EXCEPT (anti join + distinct shuffle) is needed.
    """
    cast = (df.withColumn("amount_decimal", money("amount"))
              .withColumn("event_ts", parse_event_ts("timestamp")))
    reason = first_failure([
        ("null_amount", F.col("amount_decimal").isNull()),
        ("non_positive_amount", F.col("amount_decimal") <= 0),
        ("null_currency", F.col("currency").isNull()),
        ("invalid_currency", ~F.col("currency").isin(list(currencies))),
        ("invalid_timestamp", F.col("event_ts").isNull()),
        ("null_merchant_id", F.col("merchant_id").isNull()),
        ("null_customer_id", F.col("customer_id").isNull()),
    ])
    return cast.withColumn("quarantine_reason", reason)


def split_classified(classified: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows without the reason column, quarantined rows with it)."""
    ok = F.col("quarantine_reason").isNull()
    return classified.filter(ok).drop("quarantine_reason"), classified.filter(~ok)


def cleanse(df: DataFrame, currencies: Sequence[str] = VALID_CURRENCIES) -> tuple[DataFrame, DataFrame]:
    return split_classified(cast_and_classify(df, currencies))


def dedup_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the greatest by ``order`` then every other column.

    Deterministic (a total order over whole rows) and skew-proof: it is an
    aggregate ``max(struct(order..., rest...))``, so each map task collapses
    its copies of a key before the shuffle and a key holding a third of all
    rows never reaches one task as a group.  NULLs sort lowest, so a non-NULL
    value wins (SQL: ``ORDER BY ... DESC NULLS LAST``).
    """
    keys, order = list(keys), list(order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c) for c in order + rest]).alias("_w")
    return (df.groupBy(*keys).agg(F.max(packed).alias("_w"))
              .select(*keys, "_w.*").select(*df.columns))


def duplicate_stats(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, distinct keys (NULL keys form one group) and duplicates."""
    k = F.struct(*[F.col(c) for c in keys])
    return df.agg(F.count(F.lit(1)).alias("row_count"),
                  F.count_distinct(k).alias("distinct_keys")) \
             .withColumn("duplicates", F.col("row_count") - F.col("distinct_keys"))


def except_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    """SQL ``EXCEPT`` (distinct, NULL-safe). Identical rows collapse.

    The right side is de-duplicated first (a partial aggregate), so many
    copies of one row on either side are reduced map-side before the anti
    join's shuffle."""
    return left.subtract(right.distinct())
