"""Hot-key salting for joins whose many-side may hold one key with a large
share of all rows (independent of AQE's run-time skew handling)."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key with at least this share of the rows is hot, so at most 1 / HOT_SHARE are.
HOT_SHARE = 0.001


def hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE) -> DataFrame:
    """Keys with at least ``share`` of all rows: a partial aggregate with at
    most ``1 / share`` rows at any size of ``df``, so it may be broadcast."""
    total = df.select(F.count(F.lit(1))).scalar()
    return (df.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_hot_key"))
              .agg(F.count(F.lit(1)).alias("_n"))
              .filter(F.col("_n") >= F.lit(share) * total).select("_hot_key"))


def salted_join(many: DataFrame, one: DataFrame, many_key: str, one_key: str, how: str = "left",
                salts: int = 32, share: float = HOT_SHARE,
                salt_cols: Sequence[str] | None = None) -> DataFrame:
    """``many.join(one, many_key == one_key, how)`` with hot keys split.

    Rows of a hot key on the many side get a salt in ``[0, salts)`` from a
    hash of ``salt_cols`` (default: all columns), so the split is
    deterministic and recomputes identically after executor loss; the
    matching rows of ``one`` are replicated once per salt (at most
    ``salts / share`` rows).  Rows without a key match nothing, so they do
    not enter the join at all.  ``how`` is ``inner``, ``left``, ``left_semi``
    or ``left_anti`` (the many side is the left side).  Nothing runs while
    the plan is built.
    """
    if how not in ("inner", "left", "left_outer", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how!r}")
    hk = F.broadcast(hot_keys(many, many_key, share))        # bounded: 1 / share keys
    cols = list(salt_cols) if salt_cols else many.columns
    keyed = many.filter(F.col(many_key).isNotNull())
    m = (keyed.join(hk, keyed[many_key] == hk["_hot_key"], "left")
              .withColumn("_salt", F.when(F.col("_hot_key").isNotNull(),
                                          F.pmod(F.xxhash64(*[F.col(c) for c in cols]), F.lit(salts)))
                                   .otherwise(F.lit(0)))
              .drop("_hot_key"))
    o = (one.join(hk, one[one_key] == hk["_hot_key"], "left")
            .withColumn("_o_salt", F.explode(F.when(F.col("_hot_key").isNotNull(),
                                                    F.sequence(F.lit(0), F.lit(salts - 1)))
                                              .otherwise(F.array(F.lit(0)))))
            .drop("_hot_key"))
    cond = (F.col(f"m.{many_key}") == F.col(f"o.{one_key}")) & (F.col("_salt") == F.col("_o_salt"))
    joined = m.alias("m").join(o.alias("o"), cond, how).drop("_salt", "_o_salt")
    if how in ("inner", "left_semi"):
        return joined
    return joined.unionByName(many.filter(F.col(many_key).isNull()), allowMissingColumns=True)
