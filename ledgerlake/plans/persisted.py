"""Registered queries over a persisted lake: each writes through the stages
and reads the tables back, so a green row means that the lake is right.

Settlements are derived from the payments of ``events``: two of three are
settled on their day, the ninth ones a cent short.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import maintenance as mt
from ..operators.ingest import conform
from ..schemas import CHARGEBACK, LEDGER_SCHEMA, PAYMENT, SETTLEMENT, UNION_SCHEMA
from ..sources import fixtures as fx
from . import nightly as ni
from .catalog import (ORACLE, PAY_CTES, REPORT_DATE, SQL_LEDGER, SQL_ROUTED, SQL_V_CHARGEBACKS, SQL_V_EVENTS,
                      SQL_WIRE, _scratch_lake, _snapshots, _sql, register, wire_events, wire_from)

NEXT_DATE = "2024-01-16"
CLOCK = "2024-02-01 00:00:00"


def _clock():
    return F.lit(CLOCK).cast("timestamp")


@register("w6_quarantine_two_days", _sql(f"""
SELECT CASE WHEN event_ts IS NULL THEN 'no_event_time' ELSE strftime(event_ts, '%Y-%m-%d') END AS quarantine_date,
       quarantine_reason, count(*) AS row_count
FROM v_classified
WHERE quarantine_reason IS NOT NULL AND transaction_id IS NOT NULL AND merchant_id IS NOT NULL AND amount > 0
  AND (event_ts IS NULL OR cast(event_ts AS date) IN (DATE '{REPORT_DATE}', DATE '{NEXT_DATE}'))
GROUP BY 1, 2""", *PAY_CTES))
def w6(spark, sf):
    """Two days cleansed under one run id: both stay, and so do rows without a time."""
    lake = _scratch_lake(spark, "w6")
    ni.ingest_batch(lake, wire_events(spark, sf), 1, raw_json=True)
    for day in (REPORT_DATE, NEXT_DATE):
        ni.run_silver_cleanse(lake, day, "nightly")
    return lake.read("silver", "quarantine_payments").groupBy(
        F.col("quarantine_date").cast("string").alias("quarantine_date"), "quarantine_reason") \
        .agg(F.count(F.lit(1)).alias("row_count"))


@register("s3_two_sources_same_batch", _sql("""
SELECT CASE WHEN event_type = 'payment_created' THEN 'payments' ELSE 'others' END AS ingest_source,
       target_table, count(*) AS row_count
FROM routed GROUP BY 1, 2""", SQL_V_EVENTS, SQL_WIRE, SQL_ROUTED))
def s3_two_sources(spark, sf):
    """Two sources share a batch number, and one of them is replayed."""
    lake, v = _scratch_lake(spark, "s3"), fx.v_events(spark, sf)
    is_payment = F.col("event_type") == PAYMENT
    for _ in range(2):
        ni.ingest_batch(lake, wire_from(v.filter(is_payment)), 1, raw_json=True, source="payments")
        ni.ingest_batch(lake, wire_from(v.filter(~is_payment)), 1, raw_json=True, source="others")
    return lake.read("bronze", "events").groupBy("ingest_source", "target_table").agg(
        F.count(F.lit(1)).alias("row_count"))


@register("r1_after_rewrite", ORACLE["r1_nightly_gold"].replace(
    f"= DATE '{REPORT_DATE}'", f"IN (DATE '{REPORT_DATE}', DATE '{NEXT_DATE}')"))
def r1_after_rewrite(spark, sf):
    """A nightly run, a rewrite of every table, the next night: both dates are there."""
    lake = _scratch_lake(spark, "r1rw")
    lake.overwrite(fx.v_merchants(spark, sf), "bronze", "merchant_reference")
    ni.ingest_batch(lake, wire_events(spark, sf), 1, raw_json=True)
    for day in (REPORT_DATE, NEXT_DATE):
        ni.run_silver_cleanse(lake, day, "r1")
        ni.run_gold(lake, day)
        if day == REPORT_DATE:
            mt.optimize_tables(lake, ni.TABLES)
    return lake.read("gold", "daily_merchant_summary")


@register("c3_by_day_equals_catchup", _sql(f"""
SELECT transaction_id, amount_decimal, DATE '{NEXT_DATE}' AS payment_date, TIMESTAMP '{NEXT_DATE} 10:00:00' AS event_ts
FROM v_clean WHERE cast(event_ts AS date) = DATE '{REPORT_DATE}' AND amount > 50
UNION ALL
SELECT transaction_id, amount_decimal, cast(event_ts AS date) AS payment_date, event_ts
FROM v_clean WHERE cast(event_ts AS date) = DATE '{NEXT_DATE}'
   OR cast(event_ts AS date) = DATE '{REPORT_DATE}' AND NOT amount > 50""", *PAY_CTES))
def c3_by_day(spark, sf):
    """Ids seen on two days, the later day run first: one Silver row each, as
    in a catch-up, whichever mode ran."""
    v = fx.v_events(spark, sf).filter(F.col("event_type") == PAYMENT)
    day = F.to_date(F.try_to_timestamp("timestamp"))
    again = v.filter((day == F.lit(REPORT_DATE).cast("date")) & (F.col("amount") > 50)) \
             .withColumn("timestamp", F.lit(f"{NEXT_DATE} 10:00:00"))
    out = []
    for days in ([NEXT_DATE, REPORT_DATE], [None]):
        lake = _scratch_lake(spark, "c3")
        ni.ingest_batch(lake, wire_from(v), 1, raw_json=True, source="first")
        ni.ingest_batch(lake, wire_from(again), 1, raw_json=True, source="again")
        for d in days:
            ni.run_silver_cleanse(lake, d, "c3")
        out.append(ni.silver_payments(lake).filter(F.col("payment_date").isin(REPORT_DATE, NEXT_DATE))
                   .select("transaction_id", "amount_decimal", "payment_date", "event_ts"))
    by_day, catchup = out
    # a row that only one of them has would be doubled or missing here
    return by_day.intersectAll(catchup).unionByName(by_day.exceptAll(catchup)).unionByName(catchup.exceptAll(by_day))


# ---------------------------------------------------- settlements through Bronze
def _settlements(spark, sf) -> DataFrame:
    nr = F.substring("transaction_id", 5, 20).cast("long")
    short = F.when(nr % 9 == 1, F.lit(0.01)).otherwise(F.lit(0.0))
    return fx.v_payments(spark, sf).filter(nr % 3 != 0).select(
        F.lit(SETTLEMENT).alias("event_type"), F.concat(F.lit("st_"), "transaction_id").alias("batch_id"), "merchant_id",
        F.round(F.col("amount").cast("decimal(18,2)").cast("double") - short, 2).alias("gross_amount"), "timestamp")


SQL_EVENT_LEDGER = ("""
pay_daily AS (
  SELECT merchant_id, cast(event_ts AS date) AS payment_date, cast(sum(amount_decimal) AS decimal(18,2)) AS payment_amount
  FROM v_clean GROUP BY 1, 2
)""", """
ev_settlements AS (
  SELECT merchant_id, cast(try_cast(timestamp AS timestamp) AS date) AS settlement_date,
         cast(round(cast(cast(amount AS decimal(18,2)) AS double)
              - CASE WHEN cast(substr(transaction_id, 5) AS bigint) % 9 = 1 THEN 0.01 ELSE 0 END, 2) AS decimal(18,2)) AS gross
  FROM v_payments WHERE cast(substr(transaction_id, 5) AS bigint) % 3 <> 0
)""", """
settle_daily AS (
  SELECT merchant_id, settlement_date, cast(sum(gross) AS decimal(18,2)) AS settled_amount
  FROM ev_settlements WHERE gross > 0 AND merchant_id IS NOT NULL GROUP BY 1, 2
)""")


def _settled_lake(spark, sf, tag: str):
    """Events and settlements through Bronze, then a catch-up of Silver and the ledger."""
    lake = _scratch_lake(spark, tag)
    ni.ingest_batch(lake, wire_events(spark, sf), 1, raw_json=True)
    ni.ingest_batch(lake, conform(_settlements(spark, sf), UNION_SCHEMA), 1, source="settlements")
    ni.run_silver_cleanse(lake, None, "catchup")
    ni.run_reconciliation(lake, None, clock=_clock())
    return lake


@register("r1_ledger", _sql("SELECT * FROM ledger_st", *PAY_CTES, *SQL_EVENT_LEDGER, SQL_LEDGER))
def r1_ledger(spark, sf):
    return _settled_lake(spark, sf, "r1l").read("silver", "reconciliation_ledger", LEDGER_SCHEMA).drop("reconciled_at")


A13 = ORACLE["a13_reconciliation_report"]


@register("a13_report_table", _sql(A13[A13.rindex("SELECT payment_date, reconciliation_status, count"):],
                                   *PAY_CTES, *SQL_EVENT_LEDGER, SQL_LEDGER))
def a13_table(spark, sf):
    lake = _settled_lake(spark, sf, "a13")
    ni.run_reports(lake)
    return lake.read("gold", "reconciliation_report")


@register("a12_registry_table", _sql("""
SELECT c.dispute_id, c.original_tx_id, c.merchant_id, cast(c.dispute_amount AS decimal(18,2)) AS dispute_amount,
       try_cast(c.timestamp AS timestamp) AS filed_ts, p.amount_decimal AS payment_amount,
       p.merchant_id AS payment_merchant_id, p.transaction_id IS NOT NULL AS payment_found,
       CASE WHEN p.transaction_id IS NULL THEN 'orphan'
            WHEN NOT coalesce(cast(c.dispute_amount AS decimal(18,2)) = p.amount_decimal, false) THEN 'amount_mismatch'
            ELSE 'matched' END AS registry_status
FROM v_chargebacks c LEFT JOIN v_clean p ON c.original_tx_id = p.transaction_id
WHERE c.dispute_id IS NOT NULL AND c.merchant_id IS NOT NULL AND c.dispute_amount > 0""", *PAY_CTES, SQL_V_CHARGEBACKS))
def a12_table(spark, sf):
    """Every dispute is filed twice, the first time for another amount: the latest counts."""
    lake = _settled_lake(spark, sf, "a12")
    v = fx.v_events(spark, sf).filter((F.col("event_type") == CHARGEBACK)
                                      & F.try_to_timestamp("timestamp").isNotNull())
    first = v.withColumn("amount", F.lit(1.0)).withColumn("timestamp", F.lit("2023-12-01 00:00:00"))
    ni.ingest_batch(lake, wire_from(first), 1, raw_json=True, source="first_filing")
    ni.run_reports(lake)
    latest = lake.read("silver", "dispute_registry")
    return latest.filter(F.col("filed_ts").isNull() | (F.col("filed_ts") > F.lit("2023-12-02").cast("timestamp_ntz")))


# ------------------------------------------- events that move or arrive late
_DAILY = """
SELECT 'daily' AS table_name, cast(event_ts AS date) AS day, merchant_id AS key_1, CAST(NULL AS varchar) AS key_2,
       count(*) AS row_count, count(DISTINCT customer_id) AS customers,
       cast(sum(amount_decimal) AS decimal(18,2)) AS amount
FROM {src} GROUP BY 2, 3
UNION ALL
SELECT 'hourly', cast(event_ts AS date), strftime(date_trunc('hour', event_ts), '%Y-%m-%d %H'),
       currency || ' ' || region, count(*), 0, cast(sum(amount_decimal) AS decimal(18,2))
FROM {src} GROUP BY 2, 3, 4"""


def _reported(lake) -> DataFrame:
    """Daily summary and hourly volume of a lake in the columns of ``_DAILY``."""
    daily = lake.read("gold", "daily_merchant_summary").select(
        F.lit("daily").alias("table_name"), F.col("report_date").alias("day"), F.col("merchant_id").alias("key_1"),
        F.lit(None).cast("string").alias("key_2"), F.col("transaction_count").alias("row_count"),
        F.col("unique_customers").alias("customers"), F.col("total_amount").alias("amount"))
    hourly = lake.read("gold", "hourly_transaction_volume").select(
        F.lit("hourly"), F.col("report_date"), F.date_format("hour", "yyyy-MM-dd HH"),
        F.concat_ws(" ", "currency", "region"), F.col("transaction_count"), F.lit(0).cast("long"),
        F.col("total_volume"))
    return daily.union(hourly)


def _ledger_rows(lake) -> DataFrame:
    return lake.read("silver", "reconciliation_ledger", LEDGER_SCHEMA).select(
        F.lit("ledger").alias("table_name"), F.col("payment_date").alias("day"), F.col("merchant_id").alias("key_1"),
        F.col("reconciliation_status").alias("key_2"), F.lit(1).cast("long").alias("row_count"),
        F.lit(0).cast("long").alias("customers"), F.col("payment_amount").alias("amount"))


SQL_MOVED = f"""
moved AS (
  SELECT * REPLACE (TIMESTAMP '{NEXT_DATE} 10:00:00' AS event_ts) FROM v_clean
  WHERE cast(event_ts AS date) = DATE '{REPORT_DATE}' AND amount > 50
  UNION ALL
  SELECT * FROM v_clean WHERE cast(event_ts AS date) = DATE '{NEXT_DATE}'
     OR cast(event_ts AS date) = DATE '{REPORT_DATE}' AND NOT amount > 50
)"""


def moved_lakes(spark, sf, modes, where=None):
    """Lakes of the payments (``where`` holds) in which payments of the report date come again on the next day,
    after the first night's run ('nightly') or before the only one ('catchup')."""
    v = fx.v_events(spark, sf).filter(F.col("event_type") == PAYMENT)
    day = F.to_date(F.try_to_timestamp("timestamp"))
    v = v if where is None else v.filter(where(day))
    again = v.filter((day == F.lit(REPORT_DATE).cast("date")) & (F.col("amount") > 50)) \
             .withColumn("timestamp", F.lit(f"{NEXT_DATE} 10:00:00"))
    for mode in modes:
        lake = _scratch_lake(spark, f"moved-{mode}")
        ni.ingest_batch(lake, wire_from(v), 1, raw_json=True, source="first")
        if mode == "nightly":
            ni.run_nightly(lake, REPORT_DATE, "first", clock=_clock())
        ni.ingest_batch(lake, wire_from(again), 1, raw_json=True, source="again")
        ni.run_nightly(lake, NEXT_DATE if mode == "nightly" else None, "second", clock=_clock())
        yield lake


@register("r1_moved_id", _sql(_DAILY.format(src="moved") + """
UNION ALL
SELECT 'ledger', cast(event_ts AS date), merchant_id, 'awaiting_settlement', 1, 0,
       cast(sum(amount_decimal) AS decimal(18,2)) FROM moved GROUP BY 2, 3""", *PAY_CTES, SQL_MOVED))
def r1_moved_id(spark, sf):
    """Ids reported on one day come again on the next: the second night takes
    them out of the first day's Gold and ledger too."""
    lake, = moved_lakes(spark, sf, ["nightly"])
    return _reported(lake).union(_ledger_rows(lake))


@register("m2_late_arrivals", _sql("SELECT * FROM (" + _DAILY.format(src="v_clean") + """
UNION ALL
SELECT 'ledger', payment_date, merchant_id, reconciliation_status, 1, 0, payment_amount FROM ledger_st) a
""" + f"WHERE day IN (DATE '{REPORT_DATE}', DATE '{NEXT_DATE}')", *PAY_CTES, *SQL_EVENT_LEDGER, SQL_LEDGER))
def m2_late(spark, sf):
    """A fifth of the first day's payments, and all settlements, arrive after
    the first night: the second night redoes the first day as well."""
    lake = _scratch_lake(spark, "m2late")
    v = fx.v_events(spark, sf).filter(F.col("event_type") == PAYMENT)
    late = (F.to_date(F.try_to_timestamp("timestamp")) == F.lit(REPORT_DATE).cast("date")) & \
        (F.substring("event_key", 5, 20).cast("long") % 5 == 0)
    late = F.coalesce(late, F.lit(False))
    ni.ingest_batch(lake, wire_from(v.filter(~late)), 1, raw_json=True)
    ni.run_nightly(lake, REPORT_DATE, "first", clock=_clock())
    ni.ingest_batch(lake, wire_from(v.filter(late)), 2, raw_json=True)
    ni.ingest_batch(lake, conform(_settlements(spark, sf), UNION_SCHEMA), 1, source="settlements")
    ni.run_nightly(lake, NEXT_DATE, "second", clock=_clock())
    return _reported(lake).union(_ledger_rows(lake))


def _corrected_lake(spark, sf, tag: str):
    """A catch-up without a fifth of the report date's payments; these arrive
    later, and a night for the next day takes them in."""
    lake = _scratch_lake(spark, tag)
    v = fx.v_events(spark, sf)
    late = (F.col("event_type") == PAYMENT) & (F.substring("event_key", 5, 20).cast("long") % 5 == 0) & \
        (F.to_date(F.try_to_timestamp("timestamp")) == F.lit(REPORT_DATE).cast("date"))
    late = F.coalesce(late, F.lit(False))
    ni.ingest_batch(lake, wire_from(v.filter(~late)), 1, raw_json=True)
    ni.ingest_batch(lake, conform(_settlements(spark, sf), UNION_SCHEMA), 1, source="settlements")
    ni.run_nightly(lake, None, "catchup", clock=_clock())
    ni.ingest_batch(lake, wire_from(v.filter(late)), 2, raw_json=True)
    ni.run_nightly(lake, NEXT_DATE, "night", clock=_clock())
    return lake


@register("n4_incremental", f"""
SELECT 'merchant' AS kind, merchant_id AS id, gmv_7d AS total_7d, gmv_30d AS total_30d, gmv_90d AS total_90d,
       tx_count_7d, tx_count_30d, tx_count_90d, avg_ticket_7d, avg_ticket_30d, avg_ticket_90d
FROM ({ORACLE["n4_merchant_features"]}) m
UNION ALL
SELECT 'customer', customer_id, spend_7d, spend_30d, spend_90d, tx_count_7d, tx_count_30d, tx_count_90d, NULL, NULL, NULL
FROM ({ORACLE["n3_customer_features"]}) c""")
def n4_incremental(spark, sf):
    """Features redone from entity-day partials for the entities of the
    corrected days, equal to a refresh of all entities over all history."""
    lake = _corrected_lake(spark, sf, "n4")
    shown = lambda kind, key, total, avg: lake.read("gold", f"ml_feature_store_{kind}s").select(
        F.lit(kind).alias("kind"), F.col(key).alias("id"),
        *[F.col(f"{total}_{n}d").alias(f"total_{n}d") for n in (7, 30, 90)],
        *[F.col(f"tx_count_{n}d") for n in (7, 30, 90)],
        *[(F.col(f"{avg}_{n}d") if avg else F.lit(None).cast("double")).alias(f"avg_ticket_{n}d") for n in (7, 30, 90)])
    return shown("merchant", "merchant_id", "gmv", "avg_ticket").unionByName(
        shown("customer", "customer_id", "spend", None))


@register("a12_incremental", ORACLE["a12_registry_table"])
def a12_incremental(spark, sf):
    """Disputes whose payment arrives after them turn from orphans to matches."""
    return _corrected_lake(spark, sf, "a12i").read("silver", "dispute_registry")


@register("a13_after_correction", ORACLE["a13_report_table"])
def a13_after_correction(spark, sf):
    """The report of corrected days, redone from those days of the ledger."""
    return _corrected_lake(spark, sf, "a13c").read("gold", "reconciliation_report")


@register("m4_digest_feed", ORACLE["m4_change_feed"])
def m4_digest_feed(spark, sf):
    """The change feed of two stored snapshots, through their digest trees."""
    from ..operators import digest as di
    lake = _scratch_lake(spark, "m4")
    s0, _, s2 = _snapshots(spark, sf)
    for name, snapshot in (("before", s0), ("after", s2)):
        di.write_snapshot(lake, snapshot, "silver", name, ["o_orderkey"], buckets=32)
    return di.snapshot_feed(lake, "silver", "before", "after", ["o_orderkey"])
