"""Key-based upsert (W4) as a full outer join."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert_frames(target: DataFrame, source: DataFrame, keys: Sequence[str],
                  update_columns: Sequence[str] | None = None, null_safe: bool = False) -> DataFrame:
    """Merge ``source`` into ``target`` on ``keys``.

    * matched: columns in ``update_columns`` (all source columns when None)
      take the source value, the rest keep the target value;
    * source only: inserted (target-only columns NULL);
    * target only: kept unchanged.
    NULL keys never match (as in SQL MERGE), so such source rows insert;
    with ``null_safe`` (keys of an aggregate) NULL equals NULL.
    Output columns: target columns, then new source columns.

    One sort-merge (or shuffled hash) join on the key; both sides shuffle by
    key once.  The caller restricts ``target`` to the partitions the source
    touches (see ``Lake.upsert``) so untouched data is neither read nor
    rewritten.
    """
    keys = list(keys)
    upd = set(source.columns if update_columns is None else update_columns) - set(keys)
    cols = list(target.columns) + [c for c in source.columns if c not in target.columns]
    t = target.withColumn("_t_hit", F.lit(True)).alias("t")
    s = source.withColumn("_s_hit", F.lit(True)).alias("s")
    cond = [F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) if null_safe
            else F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]
    j = t.join(s, cond, "full_outer")
    s_hit = F.col("s._s_hit").isNotNull()
    t_hit = F.col("t._t_hit").isNotNull()
    out = []
    for c in cols:
        in_t, in_s = c in target.columns, c in source.columns
        if c in keys:
            e = F.when(s_hit, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}"))
        elif in_t and in_s:
            src_wins = s_hit & (~t_hit | F.lit(c in upd))
            e = F.when(src_wins, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}"))
        elif in_t:
            e = F.col(f"t.{c}")
        else:
            e = F.when(~t_hit | F.lit(c in upd), F.col(f"s.{c}"))
        out.append(e.alias(c))
    return j.select(*out)


def duplicate_keys(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once in ``source`` (MERGE would be ambiguous)."""
    return source.groupBy(*keys).count().filter(F.col("count") > 1)
