"""The nightly run (R1), the Gold run for one date (R2), Bronze batch ingest
(S3 with its write) and the slow-versus-optimised comparison (R4).

A run reads the Bronze partitions of ``report_date`` and those that arrived
since for days reported before (``plans.changes``).  The Silver merge returns
the *dirty* days, those that gained or lost a row, and ledger, Gold and
reports are redone for them.  Each output is written once (counts come from
``observe`` on that write) and replaces whole date partitions, so a rerun of
the same date is idempotent.
"""
from __future__ import annotations

import time
from collections.abc import Sequence
from datetime import date

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..lake import Lake
from ..operators import cleanse as cl
from ..operators import features as fe
from ..operators import gold as go
from ..operators import maintenance as mt
from ..operators import reconcile as rc
from ..operators.ingest import bronze_record, conform, decode_events, ingest_frame
from ..operators.keyindex import KeyIndex
from ..schemas import (BRONZE_TABLE, CHARGEBACK, DEFAULT_TOLERANCE, DEFAULT_WINDOWS, LEDGER_SCHEMA,
                       MERCHANT_SCHEMA, MONEY, PAYMENT, REFUND, SETTLEMENT, SETTLEMENT_SCHEMA,
                       SILVER_PAYMENT_SCHEMA, TOTAL, UNION_SCHEMA)
from ..streaming.ingest import BRONZE_PARTITIONS
from . import changes as ch

# Tables the maintenance job compacts: clustering and partition columns (M5).
TABLES = (
    ("silver", "cleansed_transactions", ("merchant_id", "customer_id"), ("payment_date",)),
    ("silver", "reconciliation_ledger", ("merchant_id",), ("payment_date",)),
    ("gold", "daily_merchant_summary", ("merchant_id",), ("report_date",)),
    ("gold", "hourly_transaction_volume", ("hour",), ("report_date",)),
    ("gold", "customer_days", ("customer_id",), ("day",)),
    ("gold", "merchant_days", ("merchant_id",), ("day",)),
    ("gold", "ml_feature_store_customers", ("customer_id",), ()),
    ("gold", "ml_feature_store_merchants", ("merchant_id",), ()),
)
#: Quarantine partition of events without a usable time, which no day owns.
NO_DAY = "no_event_time"


def default_report_date(today: date | None = None) -> str:
    """R2's default: yesterday (of ``today``, injectable for tests)."""
    from datetime import timedelta
    return str((today or date.today()) - timedelta(days=1))


def ingest_batch(lake: Lake, events: DataFrame, batch_id: int, raw_json: bool = False,
                 ingest_ts: Column | None = None, source: str = "batch",
                 dedup_keys: Sequence[str] | None = None) -> dict:
    """S3: validate, route and write one batch of events to Bronze in one
    pass (single scan, one partitioned write); replaying ``batch_id`` of the
    same ``source`` replaces its partitions, other sources' stay.
    ``dedup_keys`` (optional) keeps one event per key of the batch (D1)."""
    df = decode_events(events) if raw_json else conform(events, UNION_SCHEMA)
    if dedup_keys:
        df = df.dropDuplicates(list(dedup_keys))
    routed = bronze_record(ingest_frame(df, ingest_ts), batch_id, source)
    obs = Observation()
    counted = routed.observe(obs, *[F.count_if(F.col("target_table") == t).alias(t)
                                    for t in list(BRONZE_TABLE.values()) + ["dead_letter"]],
                             ch.observed_days().alias("days"))
    lake.replace_partitions(counted, "bronze", "events", BRONZE_PARTITIONS)
    got = obs.get
    ch.record_commits(lake, got.pop("days") or [], source, batch_id)
    return {k: int(v) for k, v in got.items()}


def bronze(lake: Lake, kind: str, report_date: str | None = None) -> DataFrame:
    """One Bronze table (a ``target_table`` partition), optionally one day."""
    from ..schemas import BRONZE_SCHEMA
    df = lake.read("bronze", "events", BRONZE_SCHEMA).filter(F.col("target_table") == BRONZE_TABLE[kind])
    if report_date:
        y, m, d = str(report_date).split("-")
        df = df.filter((F.col("year") == y) & (F.col("month") == m) & (F.col("day") == d))
    return df


def silver_payments(lake: Lake) -> DataFrame:
    return lake.read("silver", "cleansed_transactions", SILVER_PAYMENT_SCHEMA)


def payment_index(lake: Lake) -> KeyIndex:
    return KeyIndex(lake, "transaction_id", "payment_date", ["event_ts", "ingest_timestamp"])


def _bronze_due(lake: Lake, kind: str, report_date: str | None, late: DataFrame | None) -> DataFrame:
    """Bronze rows of the report date, and of the partitions of ``late``
    (commits of other days): the days prune the scan, then source and batch."""
    if report_date is None or late is None:
        return bronze(lake, kind, report_date)
    y, m, d = report_date.split("-")
    today = (F.col("year") == y) & (F.col("month") == m) & (F.col("day") == d)
    days = [x for x in ch.days_of(late, BRONZE_TABLE[kind]) if x != report_date]
    if not days:
        return bronze(lake, kind).filter(today)
    parts = [x.split("-") for x in days]
    other = [F.col(c).isin(sorted({p[i] for p in parts})) for i, c in enumerate(("year", "month", "day"))]
    keys = ["event_day", "ingest_source", "ingest_batch"]
    wanted = late.filter((F.col("target_table") == BRONZE_TABLE[kind]) & F.col("event_day").isin(days)) \
        .select(*keys).distinct()
    rows = bronze(lake, kind).filter(other[0] & other[1] & other[2]).withColumn("event_day", ch.day_of_partition())
    return bronze(lake, kind).filter(today).unionByName(rows.join(wanted, keys, "left_semi").drop("event_day"))


def run_silver_cleanse(lake: Lake, report_date: str | None, run_id: str, late: DataFrame | None = None) -> dict:
    """Bronze payments of the date (and ``late`` commits of other days) ->
    C2 -> U1 -> merge into Silver; W6 quarantine.

    A ``transaction_id`` has one Silver row, its latest event's, whichever
    day that falls on, so runs by day and a catch-up agree; ``dirty_days``
    are the days whose rows changed.  Quarantine is partitioned by the day
    processed and the run; events without a usable time belong to no day and
    are quarantined (as a whole) by every run.
    """
    columns = ["event_type", "transaction_id", "merchant_id", "customer_id", "amount", "currency",
               "gateway", "region", "timestamp", "ingest_timestamp"]
    classified = cl.cast_and_classify(_bronze_due(lake, PAYMENT, report_date, late).select(*columns))
    # one day feeds two outputs: cache it once.  A catch-up over the whole
    # history is scanned twice instead of being cached whole.
    cached = report_date is not None
    if cached:
        classified = classified.persist(StorageLevel.MEMORY_AND_DISK)
    valid, quarantined = cl.split_classified(classified)
    o_in, o_out = Observation(), Observation()
    valid = valid.observe(o_in, F.count(F.lit(1)).alias("n"))
    silver = cl.dedup_latest(valid, ["transaction_id"], ["event_ts", "ingest_timestamp"]) \
        .withColumn("payment_date", F.to_date("event_ts")) \
        .observe(o_out, F.count(F.lit(1)).alias("n"))
    dirty = merge_silver(lake, conform(silver, SILVER_PAYMENT_SCHEMA))
    day = F.when(F.col("event_ts").isNull(), F.lit(NO_DAY)).otherwise(F.lit(report_date or "all"))
    run = F.when(F.col("event_ts").isNull(), F.lit(NO_DAY)).otherwise(F.lit(run_id))
    if cached:
        undated = cl.cast_and_classify(bronze(lake, PAYMENT).filter(F.col("year").isNull()).select(*columns))
        quarantined = quarantined.unionByName(undated.filter(F.col("quarantine_reason").isNotNull()))
    q = lake.replace_partitions(quarantined.withColumn("quarantine_date", day).withColumn("run_id", run),
                                "silver", "quarantine_payments", ["quarantine_date", "run_id"])
    if cached:
        classified.unpersist()
    before, after = int(o_in.get["n"]), int(o_out.get["n"])
    return {"records_processed": after, "duplicates_removed": before - after, "quarantined": q, "dirty_days": dirty}


def merge_silver(lake: Lake, incoming: DataFrame) -> list[str]:
    """Merge ``incoming`` (one row per id) so that every id keeps its latest
    event over all days; returns the days that gained or lost a row.

    The key index names the day of the ids that Silver holds, so only days
    with rows to replace or add are read and rewritten, in one swap.  A row
    that is not newer than Silver's changes nothing.  The index follows the
    swap: a run that fails in between merges the same rows again.
    """
    table, key = ("silver", "cleansed_transactions"), "transaction_id"
    index, version = payment_index(lake), ["event_ts", "ingest_timestamp"]
    with lake.staged(incoming) as new:
        if not lake.exists(*table):
            index.clear()
            days = _days(new, "payment_date")
            ch.mark_dirty(lake, days)
            lake.overwrite(new, *table, partition_by=["payment_date"])
            index.add(new)
            return days
        if not index.exists():
            index.add(silver_payments(lake))
        old = index.lookup(new).select(F.col(key).alias("_id"), F.col("payment_date").alias("_day"),
                                       F.struct(*version).alias("_version"))
        newer = new.join(old, F.col(key) == F.col("_id"), "left").filter(
            F.col("_id").isNull() | (F.struct(*version) > F.col("_version"))).drop("_id", "_version")
        with lake.staged(newer) as winners:
            days = _days(winners.select("payment_date").unionByName(
                winners.select(F.col("_day").alias("payment_date")).filter("payment_date IS NOT NULL")), "payment_date")
            if not days:
                return []
            kept = silver_payments(lake).filter(F.col("payment_date").isin([_as_date(d) for d in days])) \
                .join(winners.select(key), key, "left_anti")
            ch.mark_dirty(lake, days)
            rows = winners.drop("_day")
            with lake.staged(kept.select(*rows.columns).unionByName(rows)) as merged:
                lake.replace_values(merged, *table, "payment_date", days)
            index.add(rows)
            return days


def _as_date(day: str) -> date:
    return date.fromisoformat(day)


def _days(df: DataFrame, col: str) -> list[str]:
    """Distinct days of ``col``: as many as the calendar has, whatever the rows."""
    return sorted(str(r[0]) for r in df.select(col).distinct().collect() if r[0] is not None)


Days = str | date | Sequence[str] | None


def _day_list(days: Days) -> list[str] | None:
    """None (every day), one day or several -> list of ``yyyy-MM-dd``."""
    if days is None:
        return None
    return [str(days)] if isinstance(days, str | date) else sorted(str(d) for d in days)


def _dated(df: DataFrame, col: str, days: list[str] | None) -> DataFrame:
    return df if days is None else df.filter(F.col(col).isin([_as_date(d) for d in days]))


def _bronze_days(lake: Lake, kind: str, days: list[str] | None) -> DataFrame:
    """Bronze rows of one kind on the days given: partition filters."""
    df = bronze(lake, kind)
    if days is None:
        return df
    parts = [d.split("-") for d in days]
    for i, c in enumerate(("year", "month", "day")):
        df = df.filter(F.col(c).isin(sorted({p[i] for p in parts})))
    return df.filter(ch.day_of_partition().isin(days))


def run_reconciliation(lake: Lake, report_date: Days, tolerance: str = DEFAULT_TOLERANCE,
                       clock: Column | None = None) -> dict:
    """A5 for one date, several, or every date when ``report_date`` is None ->
    replace those dates of the ledger; A6 counts come from the write."""
    days = _day_list(report_date)
    pay = _dated(silver_payments(lake), "payment_date", days)
    if lake.exists("bronze", "events"):
        st = _bronze_days(lake, SETTLEMENT, days)
    else:
        st = lake.spark.createDataFrame([], SETTLEMENT_SCHEMA)
    led = rc.reconcile(pay, st, tolerance).withColumn(
        "reconciled_at", clock if clock is not None else F.current_timestamp())
    obs = Observation()
    s = F.col("reconciliation_status")
    led = led.observe(obs, F.count(F.lit(1)).alias("rows"),
                      F.count_if(s == "discrepancy_flagged").alias("discrepancies"),
                      F.count_if(s == "awaiting_settlement").alias("awaiting_settlement"))
    if days is None:
        lake.replace_partitions(led, "silver", "reconciliation_ledger", ["payment_date"])
    else:
        lake.replace_values(led, "silver", "reconciliation_ledger", "payment_date", days)
    m = {k: int(v) for k, v in obs.get.items()}
    return {"reconciled": m["rows"] - m["discrepancies"] - m["awaiting_settlement"],
            "discrepancies": m["discrepancies"], "awaiting_settlement": m["awaiting_settlement"]}


def run_gold(lake: Lake, report_date: Days, optimize: bool = False) -> dict:
    """R2: (optionally compact Silver first) then A1 and A2 for the date or
    dates, or for every date when ``report_date`` is None (catch-up)."""
    days = _day_list(report_date)
    if optimize:
        # compact (and cluster) only the Silver partitions the run reads
        for where in [None] if days is None else [{"payment_date": d} for d in days]:
            mt.optimize_table(lake, "silver", "cleansed_transactions", ["merchant_id", "customer_id"],
                              partition_by=["payment_date"], schema=SILVER_PAYMENT_SCHEMA, where=where)
    pay = _dated(silver_payments(lake), "payment_date", days)
    merchants = lake.read("bronze", "merchant_reference", MERCHANT_SCHEMA) \
        if lake.exists("bronze", "merchant_reference") else None
    daily = go.daily_merchant_summary(pay, merchants)
    hourly = go.hourly_volume(pay).withColumn("report_date", F.to_date("hour"))
    if days is None:
        n1 = lake.replace_partitions(daily, "gold", "daily_merchant_summary", ["report_date"])
        n2 = lake.replace_partitions(hourly, "gold", "hourly_transaction_volume", ["report_date"])
    else:   # the dates end up holding exactly the recomputed rows, even none
        n1 = lake.replace_values(daily, "gold", "daily_merchant_summary", "report_date", days)
        n2 = lake.replace_values(hourly, "gold", "hourly_transaction_volume", "report_date", days)
    shown = None if days is None else days[0] if len(days) == 1 else days
    return {"merchant_summary_records": n1, "hourly_volume_records": n2, "report_date": shown}


def settlements(lake: Lake) -> DataFrame:
    if lake.exists("bronze", "events"):
        return bronze(lake, SETTLEMENT)
    return lake.spark.createDataFrame([], SETTLEMENT_SCHEMA)


#: Entity-day partials (N4): table and key column.
ENTITY_DAYS = (("customer_days", "customer_id"), ("merchant_days", "merchant_id"))


def _have_partials(lake: Lake) -> bool:
    return all(lake.exists("gold", t) for t, _ in ENTITY_DAYS)


def run_partials(lake: Lake, days: Days = None) -> dict:
    """Redo the entity-day partials of ``days`` (None: every day) from
    those days of Silver alone, and note whose sums changed."""
    days = _day_list(days) if _have_partials(lake) else None
    pay = _dated(silver_payments(lake), "payment_date", days)
    out = {}
    for table, entity in ENTITY_DAYS:
        fresh = fe.entity_days(pay, entity)
        if days is None:
            out[table] = lake.overwrite(fresh, "gold", table, partition_by=["day"])
            lake._delete(lake.path("gold", f"{table}_changed"))
            continue
        before = lake.read("gold", table).filter(F.col("day").isin([_as_date(d) for d in days]))
        lake.overwrite(before.select(entity).unionByName(fresh.select(entity)).distinct(), "gold", f"{table}_changed")
        out[table] = lake.replace_values(fresh, "gold", table, "day", days)
    return out


def run_merchant_analytics(lake: Lake, clock: Column | None = None) -> dict:
    """A9 with the settlement lag (A11) of each merchant; payments come from
    the merchant-day partials where they exist, else from all of Silver."""
    if _have_partials(lake):
        per_day = lake.read("gold", "merchant_days")
        totals = per_day.groupBy("merchant_id").agg(F.sum("_c").alias("total_transactions"),
                                                    F.sum("_s").cast(TOTAL).alias("total_gmv"))
        daily = per_day.select("merchant_id", F.col("day").alias("payment_date"),
                               F.col("_s").cast(MONEY).alias("payment_amount"))
    else:
        pay = silver_payments(lake)
        totals, daily = go.merchant_payments(pay), rc.daily_payments(pay)
    out = go.merchant_ratios(totals, bronze(lake, REFUND), bronze(lake, CHARGEBACK),
                             clock if clock is not None else F.current_timestamp())
    lag = rc.settlement_lag(daily, rc.daily_settlements(settlements(lake)))
    return {"records": lake.overwrite(out.join(lag, "merchant_id", "left"), "gold", "merchant_analytics")}


def _payments_of(lake: Lake, disputes: DataFrame) -> DataFrame:
    """Silver rows of the payments that ``disputes`` name: the key index gives
    their days, and only those are read."""
    ids = disputes.select(F.col("original_tx_id").alias("transaction_id")).filter("transaction_id IS NOT NULL") \
        .distinct()
    asked = ids.withColumns({"payment_date": F.lit(None).cast("date"), "event_ts": F.lit(None).cast("timestamp_ntz"),
                             "ingest_timestamp": F.lit(None).cast("timestamp")})
    found = payment_index(lake).lookup(asked)
    days = _days(found, "payment_date")
    return _dated(silver_payments(lake), "payment_date", days).join(found.select("transaction_id"),
                                                                    "transaction_id", "left_semi")


def run_reports(lake: Lake, days: Days = None, due: DataFrame | None = None) -> dict:
    """The dispute registry and the reconciliation report.

    With ``days`` (changed) and ``due`` commits the report is redone for those
    days alone, and the registry for new disputes and for disputes whose
    payment lies on a changed day, so an orphan meets a payment that arrives
    later; without, or the first time, both are made from everything."""
    ledger = lake.read("silver", "reconciliation_ledger", LEDGER_SCHEMA)
    report, registry = ("gold", "reconciliation_report"), ("silver", "dispute_registry")
    days = _day_list(days)
    if days is None or not lake.exists(*report):
        n = lake.overwrite(rc.reconciliation_report(ledger), *report, partition_by=["payment_date"])
    else:
        n = lake.replace_values(rc.reconciliation_report(_dated(ledger, "payment_date", days)), *report,
                                "payment_date", days)
    if days is None or due is None or not lake.exists(*registry) or not payment_index(lake).exists():
        full = rc.dispute_registry(bronze(lake, CHARGEBACK), silver_payments(lake))
        return {"disputes": lake.overwrite(full, *registry), "report_rows": n}
    known = lake.read(*registry)
    moved = _dated(silver_payments(lake), "payment_date", days).select(F.col("transaction_id").alias("original_tx_id"))
    new = _bronze_commits(lake, CHARGEBACK, due)
    touched = new.select("dispute_id").unionByName(
        known.join(moved, "original_tx_id", "left_semi").select("dispute_id")).distinct()
    with lake.staged(touched) as ids:
        same = F.col("a.dispute_id").eqNullSafe(F.col("b.dispute_id"))
        again = bronze(lake, CHARGEBACK).alias("a").join(ids.alias("b"), same, "left_semi")
        with lake.staged(rc.dispute_registry(again, _payments_of(lake, again))) as fresh:
            kept = known.alias("a").join(ids.alias("b"), same, "left_anti")
            with lake.staged(kept.select(*fresh.columns).unionByName(fresh)) as merged:
                return {"disputes": lake.overwrite(merged, *registry), "report_rows": n}


def _bronze_commits(lake: Lake, kind: str, due: DataFrame) -> DataFrame:
    """Bronze rows of one kind in the partitions that commits name."""
    mine = due.filter(F.col("target_table") == BRONZE_TABLE[kind]).select("event_day", "ingest_source", "ingest_batch") \
        .distinct()
    rows = bronze(lake, kind).withColumn("event_day", ch.day_of_partition())
    same = [F.nullif(F.col("r.event_day"), F.lit("")).eqNullSafe(F.col("m.event_day")),
            F.col("r.ingest_source") == F.col("m.ingest_source"), F.col("r.ingest_batch") == F.col("m.ingest_batch")]
    return rows.alias("r").join(mine.alias("m"), same, "left_semi").drop("event_day")


FEATURES = (("ml_feature_store_customers", "customer_days", "customer_id", fe.customer_features, {}),
            ("ml_feature_store_merchants", "merchant_days", "merchant_id", fe.merchant_features,
             {"prefix_sum": "gmv", "prefix_avg": "avg_ticket"}))


def run_feature_store(lake: Lake, windows: Sequence[int] = DEFAULT_WINDOWS, method: str = "latest",
                      clock: Column | None = None, incremental: bool = False) -> dict:
    """Customer and merchant features.

    ``incremental`` redoes the entities noted by ``run_partials``: their
    windows are sums of day partials, plus the events of the day in which a
    window begins; rows of other entities stay as they are, with the time they
    were computed at."""
    pay = silver_payments(lake)
    ts = clock if clock is not None else F.current_timestamp()
    out = []
    for table, partials, entity, whole, names in FEATURES:
        changed = f"{partials}_changed"
        if not (incremental and lake.exists("gold", table) and lake.exists("gold", changed)):
            out.append(lake.overwrite(whole(pay, windows, method, ts), "gold", table))
            continue
        ids = lake.read("gold", changed)
        same = F.col(f"a.{entity}").eqNullSafe(F.col(f"b.{entity}"))
        with lake.staged(lake.read("gold", partials).alias("a").join(ids.alias("b"), same, "left_semi")) as days, \
                lake.staged(fe.boundary_days(days, entity, windows)) as begins:
            on_days = _dated(pay, "payment_date", _days(begins, "day"))
            fresh = fe.windows_from_days(days, begins, on_days, entity, windows, **names).withColumn("feature_ts", ts)
            old = lake.read("gold", table)
            kept = old.alias("a").join(ids.alias("b"), same, "left_anti")
            with lake.staged(kept.unionByName(fresh.select(*old.columns))) as merged:
                out.append(lake.overwrite(merged, "gold", table))
    return {"customer_features": out[0], "merchant_features": out[1]}


def run_nightly(lake: Lake, report_date: str | date | None, run_id: str = "manual",
                clock: Column | None = None, tolerance: str = DEFAULT_TOLERANCE,
                optimize: bool = False, feature_method: str = "latest") -> dict:
    """Cleanse -> reconcile -> gold -> entity-day partials -> merchant
    analytics -> reports -> features.

    A run for a date also takes the events that have arrived since for days
    processed before, and redoes every day that gained or lost a row
    (``redone_days``), so nightly runs end where a catch-up does.
    ``report_date=None`` is catch-up mode: every stage processes all dates
    in one job (no driver loop over days).  Fails fast (an exception stops
    the run, and its input stays pending); returns per-stage results and seconds.
    """
    rd = None if report_date is None else str(report_date)
    out, timings = {}, {}
    with lake.staged(ch.due(lake, rd)) as due:
        days: list[str] | None = None

        def silver():
            nonlocal days
            done = run_silver_cleanse(lake, rd, run_id or "catchup", due)
            if rd is not None:
                days = sorted({rd, *ch.dirty_days(lake), *ch.days_of(due, BRONZE_TABLE[SETTLEMENT])})
            return done

        for name, fn in (
            ("silver_cleanse", silver),
            ("reconciliation", lambda: run_reconciliation(lake, days, tolerance, clock)),
            ("gold_aggregation", lambda: run_gold(lake, days, optimize)),
            ("entity_days", lambda: run_partials(lake, days)),
            ("merchant_analytics", lambda: run_merchant_analytics(lake, clock)),
            ("reports", lambda: run_reports(lake, days, due)),
            ("feature_store", lambda: run_feature_store(lake, method=feature_method, clock=clock,
                                                        incremental=rd is not None)),
        ):
            t0 = time.time()
            out[name] = fn()
            timings[name] = time.time() - t0
        opened = ch.dirty_days(lake) if rd is None else [rd]
        ch.mark_consumed(lake, due, opened)
        ch.clear_dirty(lake)
    out["redone_days"] = days
    out["timings_s"] = timings
    return out


def sla_comparison(timings: DataFrame) -> DataFrame:
    """``timings(stage, variant in {slow, optimized}, seconds)`` -> per stage
    and TOTAL: slow_s, optimized_s, improvement_pct = (1 - opt/slow) * 100."""
    per = timings.groupBy("stage").agg(
        F.sum(F.when(F.col("variant") == "slow", F.col("seconds"))).alias("slow_s"),
        F.sum(F.when(F.col("variant") == "optimized", F.col("seconds"))).alias("optimized_s"))
    tot = per.agg(F.lit("TOTAL").alias("stage"), F.sum("slow_s").alias("slow_s"),
                  F.sum("optimized_s").alias("optimized_s"))
    both = per.unionByName(tot)
    return both.withColumn("improvement_pct", F.when(
        F.col("slow_s") > 0, (F.lit(1.0) - F.col("optimized_s") / F.col("slow_s")) * 100).otherwise(0.0))
