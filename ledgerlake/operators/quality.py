"""Data-quality checks (Q1-Q9) as small aggregate DataFrames.

Every check is one aggregate pass over its input (partial aggregation,
no collect); the result is a tiny frame that can be written as a DQ table.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import within_days


def _unpivot(agg: DataFrame, names: Sequence[str], value_cols: dict[str, str]) -> DataFrame:
    """Turn one wide row into one row per column name."""
    rows = [F.struct(F.lit(n).alias("column_name"),
                     *[F.col(tmpl.format(n)).alias(out) for out, tmpl in value_cols.items()])
            for n in names]
    return agg.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def null_rates(df: DataFrame, columns: Sequence[str], table: str) -> DataFrame:
    """Q1: NULL rate per column (0.0 for an empty table)."""
    agg = df.agg(*[F.coalesce(F.avg(F.col(c).isNull().cast("int")), F.lit(0.0)).alias(f"_r_{c}")
                   for c in columns])
    return _unpivot(agg, columns, {"null_rate": "_r_{}"}).select(
        F.lit(table).alias("table_name"), "column_name", "null_rate")


def not_null_check(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Q2: NULL count per key column and pass flag."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"_n_{c}") for c in columns])
    return _unpivot(agg, columns, {"null_count": "_n_{}"}).withColumn(
        "passed", F.col("null_count") == 0)


def positivity_check(df: DataFrame, column: str) -> DataFrame:
    """Q3: rows whose value is <= 0."""
    return df.agg(F.count(F.lit(1)).alias("checked_rows"),
                  F.count_if(F.col(column) <= 0).alias("non_positive_rows")) \
             .withColumn("passed", F.col("non_positive_rows") == 0)


def recency_check(df: DataFrame, day_col: str, anchor, days: int = 90) -> DataFrame:
    """Q4 (+F7): rows whose date lies in [anchor - days, anchor]."""
    a = F.lit(anchor).cast("date")
    inside = within_days(F.col(day_col), a, days)
    return df.agg(F.count(F.lit(1)).alias("checked_rows"),
                  F.count_if(inside).alias("recent_rows"),
                  F.count_if(~F.coalesce(inside, F.lit(False))).alias("stale_rows"))


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose key has no parent (left anti join, hot keys salted)."""
    from .reconcile import parent_lookup
    p = parent.select(F.col(parent_key).alias("_pk")).distinct()
    return parent_lookup(child, p, child_key, "_pk", "left_anti")


def referential_integrity(child: DataFrame, parent: DataFrame, child_key: str,
                          parent_key: str) -> DataFrame:
    """Q5: distinct child keys checked and how many have no parent (one pass
    over a left join of distinct keys)."""
    keys = child.select(F.col(child_key).alias("_k")).filter(F.col("_k").isNotNull()).distinct()
    p = parent.select(F.col(parent_key).alias("_pk")).distinct()
    j = keys.join(p, keys["_k"] == p["_pk"], "left")
    return (j.agg(F.count(F.lit(1)).alias("checked_keys"),
                  F.count_if(F.col("_pk").isNull()).alias("orphan_keys"))
             .withColumn("passed", F.col("orphan_keys") == 0))


def reason_breakdown(df: DataFrame, reason_col: str, total: DataFrame | None = None) -> DataFrame:
    """Q7/Q9: rows per reason and their share of all rows of ``df``.

    Both numbers come from one grouped aggregate plus a window over the
    (few) reason groups, so the input is scanned once.
    """
    from pyspark.sql import Window
    g = df.groupBy(F.col(reason_col).alias("reason")).agg(F.count(F.lit(1)).alias("row_count"))
    all_rows = F.sum("row_count").over(Window.partitionBy())
    return g.withColumn("row_share", F.col("row_count").cast("double") / all_rows.cast("double"))
