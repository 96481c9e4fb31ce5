"""Rolling features (N1-N4) and as-of-anchor totals (A10).

Per-event rolling windows use a RANGE frame of ``N * 86400`` seconds over
whole epoch seconds, inclusive of the lower bound and of every event in
the same second (peers).

Two exact methods:

``window``    ``Window.partitionBy(entity).orderBy(epoch).rangeBetween``.
              One shuffle, but one task holds an entity's whole history:
              a merchant with a third of all payments is a third of the data
              in one task.

``bucketed``  (default for per-event output) skew-safe.  (1) rows
              collapse to one point per (entity, second) by a partial
              aggregate; (2) a running sum
              P(t) = sum of points at or before t is split into the total of
              earlier time buckets (a per-entity cumulative over at most
              span/bucket rows) plus a running sum inside the
              (entity, bucket) partition; (3) the window value is
              P(t) - P(t - N*86400 - 1), the second term read by a probe
              row placed at t - N*86400 - 1.  No task ever holds more than
              one entity-bucket of points, whatever the skew.  Any bucket
              size is exact; it only trades task size against the length
              of the per-entity bucket series.

Entity features (N3/N4) only need the windows that end at each entity's
last event; ``windows_at_latest`` computes exactly those from two partial
aggregates and a join, with no per-event windows at all.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import epoch_seconds
from ..schemas import DEFAULT_WINDOWS, MONEY

DAY = 86400


def _names(prefix_sum, prefix_cnt, prefix_avg, n):
    return (f"{prefix_sum}_{n}d", f"{prefix_cnt}_{n}d", f"{prefix_avg}_{n}d" if prefix_avg else None)


def rolling_features(df: DataFrame, entity: str, ts: str = "event_ts", value: str = "amount_decimal",
                     id_col: str = "transaction_id", windows: Sequence[int] = DEFAULT_WINDOWS,
                     prefix_sum: str = "spend", prefix_cnt: str = "tx_count",
                     prefix_avg: str | None = None, method: str = "bucketed",
                     bucket_seconds: int = 3600) -> DataFrame:
    """Add ``{prefix_sum}_{N}d`` (DECIMAL(18,2)), ``{prefix_cnt}_{N}d``
    (count of non-NULL ``id_col``) and optionally ``{prefix_avg}_{N}d``
    (DOUBLE, sum / non-NULL values) to every row of ``df``."""
    windows = list(windows)
    if method == "window":
        return _direct(df, entity, ts, value, id_col, windows, prefix_sum, prefix_cnt, prefix_avg)
    if method != "bucketed":
        raise ValueError(f"unknown method {method!r}")
    feats = _bucketed_points(df, entity, ts, value, id_col, windows, bucket_seconds,
                             prefix_sum, prefix_cnt, prefix_avg)
    keyed = df.withColumn("_e", epoch_seconds(ts))
    return keyed.join(feats, [entity, "_e"], "left").drop("_e")


def _direct(df, entity, ts, value, id_col, windows, ps, pc, pa):
    out = df.withColumn("_e", epoch_seconds(ts))
    for n in windows:
        w = Window.partitionBy(entity).orderBy("_e").rangeBetween(-n * DAY, 0)
        s_name, c_name, a_name = _names(ps, pc, pa, n)
        out = out.withColumn(s_name, F.sum(value).over(w).cast(MONEY))
        out = out.withColumn(c_name, F.count(id_col).over(w))
        if a_name:
            out = out.withColumn(a_name, F.try_divide(F.sum(value).over(w).cast("double"),
                                                      F.count(value).over(w).cast("double")))
    return out.drop("_e")


def _points(df, entity, ts, value, id_col) -> DataFrame:
    """One point per (entity, second): value sum, id count, non-NULL value
    count.  A partial aggregate, so a hot entity is collapsed map-side to
    at most one row per active second before any shuffle."""
    return (df.withColumn("_e", epoch_seconds(ts)).filter(F.col("_e").isNotNull())
              .groupBy(entity, "_e")
              .agg(F.coalesce(F.sum(value), F.lit(0)).alias("_s"),
                   F.count(id_col).alias("_c"), F.count(value).alias("_nn")))


def _bucketed_points(df, entity, ts, value, id_col, windows, bucket, ps, pc, pa) -> DataFrame:
    pts = _points(df, entity, ts, value, id_col)
    zero_s = F.lit(0).cast(pts.schema["_s"].dataType)
    zero_n = F.lit(0).cast("bigint")
    # (2) each point once as itself (kind -1) and once per window as a probe
    # at t - N*86400 - 1 carrying zeros: one pass, no union of two scans.
    kinds = F.explode(F.array(F.lit(-1), *[F.lit(n) for n in windows])).alias("_kind")
    real = F.col("_kind") == -1
    u = (pts.select(entity, "_e", "_s", "_c", "_nn", kinds)
            .select(entity, F.col("_e").alias("_owner"), "_kind",
                    F.when(real, F.col("_e")).otherwise(F.col("_e") - F.col("_kind") * DAY - 1).alias("_t"),
                    F.when(real, F.col("_s")).otherwise(zero_s).alias("_s"),
                    F.when(real, F.col("_c")).otherwise(zero_n).alias("_c"),
                    F.when(real, F.col("_nn")).otherwise(zero_n).alias("_nn"))
            .withColumn("_b", F.floor(F.col("_t") / bucket)))
    # running sums inside (entity, bucket) -- peers at the same second
    # included -- and the bucket totals, both over the same partitioning.
    wb = (Window.partitionBy(entity, "_b").orderBy("_t")
                .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    wall = Window.partitionBy(entity, "_b")
    run = u.select(entity, "_b", "_owner", "_kind",
                   F.sum("_s").over(wb).alias("_rs"), F.sum("_c").over(wb).alias("_rc"),
                   F.sum("_nn").over(wb).alias("_rn"),
                   F.sum("_s").over(wall).alias("_ts"), F.sum("_c").over(wall).alias("_tc"),
                   F.sum("_nn").over(wall).alias("_tn"))
    tot = run.groupBy(entity, "_b").agg(F.max("_ts").alias("_ts"), F.max("_tc").alias("_tc"),
                                        F.max("_tn").alias("_tn"))
    # totals of all earlier buckets: a per-entity window over at most
    # span / bucket rows, whatever the number of events.
    we = (Window.partitionBy(entity).orderBy("_b")
                .rowsBetween(Window.unboundedPreceding, -1))
    before = tot.select(entity, "_b",
                        F.coalesce(F.sum("_ts").over(we), zero_s).alias("_bs"),
                        F.coalesce(F.sum("_tc").over(we), zero_n).alias("_bc"),
                        F.coalesce(F.sum("_tn").over(we), zero_n).alias("_bn"))
    pref = run.join(before, [entity, "_b"]).select(
        entity, "_owner", "_kind", (F.col("_bs") + F.col("_rs")).alias("_ps"),
        (F.col("_bc") + F.col("_rc")).alias("_pc"), (F.col("_bn") + F.col("_rn")).alias("_pn"))

    # (3) window = P(t) - P(t - N*86400 - 1), gathered per point.
    def at(kind, col):
        return F.max(F.when(F.col("_kind") == kind, F.col(col)))
    aggs = []
    for n in windows:
        s_name, c_name, a_name = _names(ps, pc, pa, n)
        w_s = at(-1, "_ps") - at(n, "_ps")
        w_n = at(-1, "_pn") - at(n, "_pn")
        aggs.append(F.when(w_n > 0, w_s).cast(MONEY).alias(s_name))
        aggs.append((at(-1, "_pc") - at(n, "_pc")).alias(c_name))
        if a_name:
            aggs.append(F.try_divide(F.when(w_n > 0, w_s).cast("double"),
                                     w_n.cast("double")).alias(a_name))
    return pref.groupBy(entity, F.col("_owner").alias("_e")).agg(*aggs)


def windows_at_latest(df: DataFrame, entity: str, ts: str = "event_ts", value: str = "amount_decimal",
                      id_col: str = "transaction_id", windows: Sequence[int] = DEFAULT_WINDOWS,
                      prefix_sum: str = "spend", prefix_cnt: str = "tx_count",
                      prefix_avg: str | None = None) -> DataFrame:
    """N1/N2 + N3 without per-event windows: the RANGE-frame values of each
    entity's latest event, i.e. sums over points with
    ``e >= e_last - N*86400`` (every point is <= e_last).

    Both inputs are partial aggregates (points per second, latest second
    per entity), so a hot entity never reaches one task as raw rows; the
    join's partitions hold one row per entity and second, and Spark may
    split one of them, the other side being unique.
    """
    pts = _points(df, entity, ts, value, id_col)
    last = df.groupBy(F.col(entity).alias("_le")).agg(epoch_seconds(F.max(ts)).alias("_last"))
    j = pts.join(last, pts[entity] == last["_le"])
    aggs = []
    for n in windows:
        s_name, c_name, a_name = _names(prefix_sum, prefix_cnt, prefix_avg, n)
        inside = F.col("_e") >= F.col("_last") - n * DAY
        w_s = F.sum(F.when(inside, F.col("_s")))
        w_n = F.sum(F.when(inside, F.col("_nn")))
        aggs.append(F.when(w_n > 0, w_s).cast(MONEY).alias(s_name))
        aggs.append(F.coalesce(F.sum(F.when(inside, F.col("_c"))), F.lit(0).cast("bigint")).alias(c_name))
        if a_name:
            aggs.append(F.try_divide(F.when(w_n > 0, w_s).cast("double"), w_n.cast("double")).alias(a_name))
    return j.groupBy(entity).agg(*aggs)


def latest_per_entity(df: DataFrame, entity: str, order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` tuple per entity (D15 tie-break).

    ``max_by`` is a partial aggregate: a hot entity is reduced map-side.
    """
    rest = [c for c in df.columns if c != entity]
    return (df.groupBy(entity)
              .agg(F.max_by(F.struct(*rest), F.struct(*[F.col(c) for c in order])).alias("_l"))
              .select(entity, "_l.*"))


def customer_features(payments: DataFrame, windows: Sequence[int] = DEFAULT_WINDOWS,
                      method: str = "latest", feature_ts: Column | None = None) -> DataFrame:
    """N1 + N3: spend and count windows at each customer's last payment.

    ``latest`` (default) computes only the windows that end at the last
    event; ``window`` / ``bucketed`` compute per-event windows and keep the
    last row (D15 tie-break on ``transaction_id``).  All give equal results.
    """
    cols = [c for n in windows for c in (f"spend_{n}d", f"tx_count_{n}d")]
    src = payments.select("customer_id", "transaction_id", "event_ts", "amount_decimal")
    if method == "latest":
        out = windows_at_latest(src, "customer_id", windows=windows).select("customer_id", *cols)
    else:
        r = rolling_features(src, "customer_id", windows=windows, method=method)
        out = latest_per_entity(r, "customer_id", ["event_ts", "transaction_id"]) \
            .select("customer_id", *cols)
    return out if feature_ts is None else out.withColumn("feature_ts", feature_ts)


def merchant_features(payments: DataFrame, windows: Sequence[int] = DEFAULT_WINDOWS,
                      method: str = "latest", feature_ts: Column | None = None) -> DataFrame:
    """N2 + N3: GMV, average ticket and count windows at each merchant's last payment."""
    cols = [c for n in windows for c in (f"gmv_{n}d", f"avg_ticket_{n}d", f"tx_count_{n}d")]
    src = payments.select("merchant_id", "transaction_id", "event_ts", "amount_decimal")
    kw = dict(windows=windows, prefix_sum="gmv", prefix_cnt="tx_count", prefix_avg="avg_ticket")
    if method == "latest":
        out = windows_at_latest(src, "merchant_id", **kw).select("merchant_id", *cols)
    else:
        r = rolling_features(src, "merchant_id", method=method, **kw)
        out = latest_per_entity(r, "merchant_id", ["event_ts", "transaction_id"]) \
            .select("merchant_id", *cols)
    return out if feature_ts is None else out.withColumn("feature_ts", feature_ts)


def asof_totals(df: DataFrame, entity: str, day: Column | str, amount: str, anchor,
                windows: Sequence[int] = DEFAULT_WINDOWS, prefix: str = "total") -> DataFrame:
    """A10: per entity, sum of ``amount`` over days d with 0 <= anchor - d <= N."""
    d = F.col(day) if isinstance(day, str) else day
    gap = F.datediff(F.lit(anchor).cast("date"), d)
    return df.groupBy(entity).agg(*[
        F.sum(F.when(gap.between(0, n), F.col(amount))).cast(MONEY).alias(f"{prefix}_{n}d")
        for n in windows])


def entity_days(payments: DataFrame, entity: str) -> DataFrame:
    """N4 partials: per (entity, ``day``) the sums that windows are made of
    and the last second.  They merge by addition, so a day is redone alone."""
    return payments.groupBy(entity, F.to_date("event_ts").alias("day")).agg(
        F.sum("amount_decimal").alias("_s"), F.count("transaction_id").alias("_c"),
        F.count("amount_decimal").alias("_nn"), epoch_seconds(F.max("event_ts")).alias("_last"))


def _day_of_epoch(e: Column) -> Column:
    return F.date_from_unix_date(F.floor(e / DAY).cast("int"))


def boundary_days(days: DataFrame, entity: str, windows: Sequence[int]) -> DataFrame:
    """(entity, day, _n, _from): the day in which each entity's window of
    ``_n`` days begins, where it has events that day, and the first second
    inside; only these days are needed by the second."""
    last = days.groupBy(entity).agg(F.max("_last").alias("_end"))
    begins = last.select(entity, F.explode(F.array(*[F.lit(n) for n in windows])).alias("_n"), "_end") \
        .withColumn("_from", F.col("_end") - F.col("_n") * DAY).withColumn("day", _day_of_epoch(F.col("_from")))
    return begins.join(days.select(entity, "day"), [entity, "day"], "left_semi").select(entity, "day", "_n", "_from")


def windows_from_days(days: DataFrame, begins: DataFrame, on_begin_days: DataFrame, entity: str,
                      windows: Sequence[int] = DEFAULT_WINDOWS, prefix_sum: str = "spend",
                      prefix_cnt: str = "tx_count", prefix_avg: str | None = None) -> DataFrame:
    """``windows_at_latest`` from day partials: whole days after a window's
    first day, plus that day's events from the window's first second on
    (``on_begin_days``: payments of the days in ``begins``)."""
    last = days.groupBy(F.col(entity).alias("_le")).agg(F.max("_last").alias("_end"))
    whole = days.join(last, days[entity] == last["_le"]) \
        .withColumn("_n", F.explode(F.array(*[F.lit(n) for n in windows]))) \
        .filter(F.col("day") > _day_of_epoch(F.col("_end") - F.col("_n") * DAY)) \
        .select(entity, "_n", "_s", "_c", "_nn")
    points = on_begin_days.select(F.col(entity), F.to_date("event_ts").alias("day"), epoch_seconds("event_ts").alias("_e"),
                                  "amount_decimal", "transaction_id")
    part = points.join(begins, [entity, "day"]).filter(F.col("_e") >= F.col("_from")).groupBy(entity, "_n").agg(
        F.sum("amount_decimal").alias("_s"), F.count("transaction_id").alias("_c"),
        F.count("amount_decimal").alias("_nn"))
    parts = whole.unionByName(part)
    aggs = []
    for n in windows:
        s_name, c_name, a_name = _names(prefix_sum, prefix_cnt, prefix_avg, n)
        here = F.col("_n") == n
        w_s, w_n = F.sum(F.when(here, F.col("_s"))), F.sum(F.when(here, F.col("_nn")))
        aggs.append(F.when(w_n > 0, w_s).cast(MONEY).alias(s_name))
        aggs.append(F.coalesce(F.sum(F.when(here, F.col("_c"))), F.lit(0).cast("bigint")).alias(c_name))
        if a_name:
            aggs.append(F.try_divide(F.when(w_n > 0, w_s).cast("double"), w_n.cast("double")).alias(a_name))
    return parts.groupBy(entity).agg(*aggs)
