"""Registered queries: one Spark plan per operator plus its DuckDB oracle SQL.

Every query reads the driver's tables in full (through the fixture views of
``sources.fixtures``); none caps, samples or sub-selects ids.  The SQL is
the independent statement of the same result for DuckDB.

  gold ............ a1, a2, a7-a10, a14, a15
  reconciliation .. a3-a6, a11-a13 (lineitem payments vs settlements)
  cleanse/bronze .. c1-c4, s2, s3, f3, f4, s4, s7, s8
  joins ........... j4, j5, j7
  features ........ n1-n4
  quality ......... q1-q9
  dedup / sets .... u1, u3, u4
  upsert/history .. w4, m3, m4, l2
  maintenance ..... m1, m2
  synthetic ....... s9-s11 (rows-only: hash-generated values)
  streaming ....... t1, t3, t5
  scalars ......... p_scalar_projections
  writes .......... w1, w3, w7 (scratch lake in the checkpoint folder)
  nightly ......... r1_nightly_gold, r1_catchup_gold, r2_gold_with_optimize
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cleanse as cl
from ..operators import features as fe
from ..operators import gold as go
from ..operators import history as hi
from ..operators import ingest as ig
from ..operators import quality as qa
from ..operators import reconcile as rc
from ..operators.upsert import upsert_frames
from ..schemas import CHARGEBACK, MONEY, PAYMENT, REFUND, SETTLEMENT_SCHEMA, TOTAL
from ..sources import fixtures as fx
from ..sources.fixtures import (SQL_LI_PAYMENTS, SQL_LI_SETTLEMENTS, SQL_V_CHARGEBACKS,
                                SQL_V_CLEANSED, SQL_V_EVENTS, SQL_V_MERCHANTS, SQL_V_PAYMENTS,
                                SQL_V_REFUNDS, with_ctes)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

ANCHOR = "2024-01-31"        # as-of date for A10 / Q4 (end of the events month)
REPORT_DATE = "2024-01-15"   # report date for F4


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def _clean(spark, sf):
    valid, _ = cl.cleanse(fx.v_payments(spark, sf))
    return valid


PAY_CTES = (SQL_V_EVENTS, SQL_V_PAYMENTS, SQL_V_CLEANSED)
# Averages of money round HALF_UP on the exact decimal quotient (Spark's
# decimal avg); the oracle states that with integer cents, since DuckDB's
# avg() goes through DOUBLE and rounds 133.045 down.


def _sql(body: str, *ctes: str) -> str:
    return with_ctes(*ctes, body=body)


# ------------------------------------------------------------------ gold
@register("a1_daily_merchant_summary", _sql("""
SELECT d.*, m.merchant_name, m.category, m.country, m.risk_tier
FROM (SELECT merchant_id, cast(event_ts AS date) AS report_date,
             count(transaction_id) AS transaction_count,
             cast(sum(amount_decimal) AS decimal(18,2)) AS total_amount,
             cast(cast((2 * cast(sum(amount_decimal) * 100 AS bigint) + count(amount_decimal))
                       // (2 * count(amount_decimal)) AS double) / 100 AS decimal(18,2)) AS avg_amount,
             count(DISTINCT customer_id) AS unique_customers
      FROM v_clean GROUP BY 1, 2) d
LEFT JOIN v_merchants m ON d.merchant_id = m.merchant_id""", *PAY_CTES, SQL_V_MERCHANTS))
def a1(spark, sf):
    return go.daily_merchant_summary(_clean(spark, sf), fx.v_merchants(spark, sf))


@register("a2_hourly_volume", _sql("""
SELECT date_trunc('hour', event_ts) AS hour, currency, region,
       count(transaction_id) AS transaction_count,
       cast(sum(amount_decimal) AS decimal(18,2)) AS total_volume
FROM v_clean GROUP BY 1, 2, 3""", *PAY_CTES))
def a2(spark, sf):
    return go.hourly_volume(_clean(spark, sf))


SQL_PAY_DAILY = """
pay_daily AS (
  SELECT merchant_id, cast(event_ts AS date) AS payment_date,
         cast(sum(amount_decimal) AS decimal(18,2)) AS payment_amount
  FROM li_payments GROUP BY 1, 2
)"""
SQL_SETTLE_DAILY = """
settle_daily AS (
  SELECT merchant_id, settlement_date, cast(sum(gross_decimal) AS decimal(18,2)) AS settled_amount
  FROM li_settlements GROUP BY 1, 2
)"""
SQL_LEDGER = """
ledger AS (
  SELECT p.merchant_id, p.payment_date, p.payment_amount, s.settled_amount,
         cast(abs(p.payment_amount - coalesce(s.settled_amount, cast(0 AS decimal(18,2))))
              AS decimal(18,2)) AS discrepancy_amount
  FROM pay_daily p LEFT JOIN settle_daily s
    ON p.merchant_id = s.merchant_id AND p.payment_date = s.settlement_date
),
ledger_st AS (
  SELECT *, CASE WHEN settled_amount IS NULL THEN 'awaiting_settlement'
                 WHEN discrepancy_amount = 0 THEN 'reconciled'
                 WHEN discrepancy_amount <= cast(0.01 AS decimal(18,2)) THEN 'reconciled_within_tolerance'
                 ELSE 'discrepancy_flagged' END AS reconciliation_status
  FROM ledger
)"""
LEDGER_CTES = (SQL_LI_PAYMENTS, SQL_LI_SETTLEMENTS, SQL_PAY_DAILY, SQL_SETTLE_DAILY, SQL_LEDGER)


def _ledger(spark, sf):
    return rc.reconcile(fx.li_payments(spark, sf), fx.li_settlements(spark, sf))


@register("a3_daily_payments", _sql("SELECT * FROM pay_daily", SQL_LI_PAYMENTS, SQL_PAY_DAILY))
def a3(spark, sf):
    return rc.daily_payments(fx.li_payments(spark, sf))


@register("a4_daily_settlements",
          _sql("SELECT * FROM settle_daily", SQL_LI_SETTLEMENTS, SQL_SETTLE_DAILY))
def a4(spark, sf):
    return rc.daily_settlements(fx.li_settlements(spark, sf))


@register("a5_reconciliation_ledger", _sql("SELECT * FROM ledger_st", *LEDGER_CTES))
def a5(spark, sf):
    return _ledger(spark, sf)


@register("a6_reconciliation_counts", _sql("""
SELECT count(*) AS ledger_rows,
       count(*) FILTER (WHERE reconciliation_status IN ('reconciled', 'reconciled_within_tolerance')) AS reconciled,
       count(*) FILTER (WHERE reconciliation_status = 'reconciled') AS reconciled_exact,
       count(*) FILTER (WHERE reconciliation_status = 'reconciled_within_tolerance') AS reconciled_within_tolerance,
       count(*) FILTER (WHERE reconciliation_status = 'discrepancy_flagged') AS discrepancies,
       count(*) FILTER (WHERE reconciliation_status = 'awaiting_settlement') AS awaiting_settlement
FROM ledger_st""", *LEDGER_CTES))
def a6(spark, sf):
    return rc.ledger_counts(_ledger(spark, sf))


@register("a7_merchant_payments", _sql("""
SELECT merchant_id, count(transaction_id) AS total_transactions,
       cast(sum(amount_decimal) AS decimal(28,2)) AS total_gmv
FROM v_clean GROUP BY 1""", *PAY_CTES))
def a7(spark, sf):
    return go.merchant_payments(_clean(spark, sf))


@register("a8_merchant_refund_chargeback_counts", _sql("""
SELECT coalesce(r.merchant_id, c.merchant_id) AS merchant_id,
       coalesce(r.refund_count, 0) AS refund_count, coalesce(c.chargeback_count, 0) AS chargeback_count
FROM (SELECT merchant_id, count(refund_id) AS refund_count FROM v_refunds GROUP BY 1) r
FULL OUTER JOIN (SELECT merchant_id, count(dispute_id) AS chargeback_count FROM v_chargebacks GROUP BY 1) c
  ON r.merchant_id = c.merchant_id""", SQL_V_EVENTS, SQL_V_REFUNDS, SQL_V_CHARGEBACKS))
def a8(spark, sf):
    r = go.count_by_merchant(fx.v_refunds(spark, sf), "refund_id", "refund_count")
    c = go.count_by_merchant(fx.v_chargebacks(spark, sf), "dispute_id", "chargeback_count")
    return r.join(c, "merchant_id", "full_outer").fillna(0, subset=["refund_count", "chargeback_count"])


@register("a9_merchant_analytics", _sql("""
SELECT p.merchant_id, p.total_transactions, p.total_gmv,
       coalesce(r.refund_count, 0) AS refund_count, coalesce(c.chargeback_count, 0) AS chargeback_count,
       coalesce(cast(r.refund_count AS double) / cast(p.total_transactions AS double), 0.0) AS refund_ratio,
       coalesce(cast(c.chargeback_count AS double) / cast(p.total_transactions AS double), 0.0) AS chargeback_rate
FROM (SELECT merchant_id, count(transaction_id) AS total_transactions,
             cast(sum(amount_decimal) AS decimal(28,2)) AS total_gmv FROM v_clean GROUP BY 1) p
LEFT JOIN (SELECT merchant_id, count(refund_id) AS refund_count FROM v_refunds GROUP BY 1) r
  ON p.merchant_id = r.merchant_id
LEFT JOIN (SELECT merchant_id, count(dispute_id) AS chargeback_count FROM v_chargebacks GROUP BY 1) c
  ON p.merchant_id = c.merchant_id""", *PAY_CTES, SQL_V_REFUNDS, SQL_V_CHARGEBACKS))
def a9(spark, sf):
    return go.merchant_analytics(_clean(spark, sf), fx.v_refunds(spark, sf),
                                 fx.v_chargebacks(spark, sf))


@register("a10_asof_rolling_totals", _sql(f"""
SELECT customer_id,
       cast(sum(CASE WHEN date_diff('day', cast(event_ts AS date), DATE '{ANCHOR}') BETWEEN 0 AND 7
                     THEN amount_decimal END) AS decimal(18,2)) AS total_7d,
       cast(sum(CASE WHEN date_diff('day', cast(event_ts AS date), DATE '{ANCHOR}') BETWEEN 0 AND 30
                     THEN amount_decimal END) AS decimal(18,2)) AS total_30d,
       cast(sum(CASE WHEN date_diff('day', cast(event_ts AS date), DATE '{ANCHOR}') BETWEEN 0 AND 90
                     THEN amount_decimal END) AS decimal(18,2)) AS total_90d
FROM v_clean GROUP BY 1""", *PAY_CTES))
def a10(spark, sf):
    return fe.asof_totals(_clean(spark, sf), "customer_id", F.to_date("event_ts"),
                          "amount_decimal", ANCHOR)


@register("a11_settlement_lag", _sql("""
SELECT merchant_id, count(*) AS payment_days, count(*) FILTER (WHERE nxt IS NULL) AS unsettled_days,
       cast(max(date_diff('day', d, nxt)) AS bigint) AS max_lag_days,
       cast(sum(date_diff('day', d, nxt)) AS bigint) AS total_lag_days,
       avg(date_diff('day', d, nxt)) AS avg_lag_days
FROM (SELECT merchant_id, d, kind,
             min(CASE WHEN kind = 1 THEN d END) OVER (PARTITION BY merchant_id ORDER BY d, kind
                 ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nxt
      FROM (SELECT merchant_id, payment_date AS d, 0 AS kind FROM pay_daily
            UNION ALL SELECT merchant_id, settlement_date AS d, 1 AS kind FROM settle_daily) u) x
WHERE kind = 0 GROUP BY 1""", SQL_LI_PAYMENTS, SQL_LI_SETTLEMENTS, SQL_PAY_DAILY, SQL_SETTLE_DAILY))
def a11(spark, sf):
    return rc.settlement_lag(rc.daily_payments(fx.li_payments(spark, sf)),
                             rc.daily_settlements(fx.li_settlements(spark, sf)))


@register("a12_dispute_registry", _sql("""
SELECT c.dispute_id, c.original_tx_id, c.merchant_id,
       try_cast(c.dispute_amount AS decimal(18,2)) AS dispute_amount,
       try_cast(c.timestamp AS timestamp) AS filed_ts,
       try_cast(p.amount AS decimal(18,2)) AS payment_amount, p.merchant_id AS payment_merchant_id,
       p.transaction_id IS NOT NULL AS payment_found,
       CASE WHEN p.transaction_id IS NULL THEN 'orphan'
            WHEN NOT coalesce(try_cast(c.dispute_amount AS decimal(18,2))
                              = try_cast(p.amount AS decimal(18,2)), false) THEN 'amount_mismatch'
            ELSE 'matched' END AS registry_status
FROM v_chargebacks c LEFT JOIN v_payments p ON c.original_tx_id = p.transaction_id""",
    SQL_V_EVENTS, SQL_V_PAYMENTS, SQL_V_CHARGEBACKS))
def a12(spark, sf):
    return rc.dispute_registry(fx.v_chargebacks(spark, sf), fx.v_payments(spark, sf))


@register("a13_reconciliation_report", _sql("""
SELECT payment_date, reconciliation_status, count(*) AS merchant_days,
       cast(sum(payment_amount) AS decimal(28,2)) AS payment_total,
       cast(sum(settled_amount) AS decimal(28,2)) AS settled_total,
       cast(sum(discrepancy_amount) AS decimal(28,2)) AS discrepancy_total,
       coalesce(cast(cast(sum(discrepancy_amount) AS decimal(28,2)) AS double)
                / cast(cast(sum(payment_amount) AS decimal(28,2)) AS double), 0.0) AS discrepancy_share
FROM ledger_st GROUP BY 1, 2""", *LEDGER_CTES))
def a13(spark, sf):
    return rc.reconciliation_report(_ledger(spark, sf))


@register("a14_daily_summary_top_currency", _sql("""
SELECT b.*, t.top_currency
FROM (SELECT merchant_id, cast(event_ts AS date) AS report_date,
             count(transaction_id) AS transaction_count,
             cast(sum(amount_decimal) AS decimal(18,2)) AS total_amount,
             cast(cast((2 * cast(sum(amount_decimal) * 100 AS bigint) + count(amount_decimal))
                       // (2 * count(amount_decimal)) AS double) / 100 AS decimal(18,2)) AS avg_amount,
             count(DISTINCT customer_id) AS unique_customers
      FROM v_clean GROUP BY 1, 2) b
LEFT JOIN (SELECT merchant_id, report_date, currency AS top_currency
           FROM (SELECT merchant_id, cast(event_ts AS date) AS report_date, currency,
                        row_number() OVER (PARTITION BY merchant_id, cast(event_ts AS date)
                                           ORDER BY count(*) DESC, currency) AS rn
                 FROM v_clean GROUP BY merchant_id, cast(event_ts AS date), currency) z
           WHERE rn = 1) t
  ON b.merchant_id = t.merchant_id AND b.report_date = t.report_date""", *PAY_CTES))
def a14(spark, sf):
    return go.daily_summary_top_currency(_clean(spark, sf))


@register("a15_global_scalars", _sql("""
SELECT count(*) AS row_count, cast(sum(amount_decimal) AS decimal(28,2)) AS total_amount,
       min(event_ts) AS first_event_ts, max(event_ts) AS last_event_ts
FROM v_clean""", *PAY_CTES))
def a15(spark, sf):
    return _clean(spark, sf).agg(F.count(F.lit(1)).alias("row_count"),
                                 F.sum("amount_decimal").cast(TOTAL).alias("total_amount"),
                                 F.min("event_ts").alias("first_event_ts"),
                                 F.max("event_ts").alias("last_event_ts"))


# ------------------------------------------------------- cleanse / bronze
@register("c1_bronze_validate", _sql("""
SELECT transaction_id, coalesce(transaction_id IS NOT NULL AND merchant_id IS NOT NULL
                                AND amount IS NOT NULL AND amount > 0, false) AS is_valid
FROM v_payments""", SQL_V_EVENTS, SQL_V_PAYMENTS))
def c1(spark, sf):
    p = fx.v_payments(spark, sf)
    valid, invalid = ig.validate_payments(p)
    return (valid.select("transaction_id", F.lit(True).alias("is_valid"))
            .unionByName(invalid.select("transaction_id", F.lit(False).alias("is_valid"))))


@register("c2_silver_cleanse", _sql("""
SELECT transaction_id, amount_decimal, event_ts, quarantine_reason FROM v_classified""", *PAY_CTES))
def c2(spark, sf):
    return cl.cast_and_classify(fx.v_payments(spark, sf)).select(
        "transaction_id", "amount_decimal", "event_ts", "quarantine_reason")


@register("c3_silver_rows", _sql("""
SELECT transaction_id, merchant_id, customer_id, amount_decimal, currency, region, event_ts
FROM (SELECT *, row_number() OVER (PARTITION BY transaction_id
        ORDER BY event_ts DESC NULLS LAST, event_type DESC NULLS LAST, merchant_id DESC NULLS LAST,
                 customer_id DESC NULLS LAST, amount DESC NULLS LAST, currency DESC NULLS LAST,
                 region DESC NULLS LAST, timestamp DESC NULLS LAST,
                 amount_decimal DESC NULLS LAST) AS rn FROM v_clean) x
WHERE rn = 1""", *PAY_CTES))
def c3(spark, sf):
    silver = cl.dedup_latest(_clean(spark, sf), ["transaction_id"], ["event_ts"])
    return silver.select("transaction_id", "merchant_id", "customer_id", "amount_decimal",
                         "currency", "region", "event_ts")


@register("c4_partition_columns", _sql("""
SELECT event_key, try_cast(timestamp AS timestamp) AS event_ts,
       strftime(try_cast(timestamp AS timestamp), '%Y') AS year,
       strftime(try_cast(timestamp AS timestamp), '%m') AS month,
       strftime(try_cast(timestamp AS timestamp), '%d') AS day
FROM v_events""", SQL_V_EVENTS))
def c4(spark, sf):
    return ig.add_partition_columns(fx.v_events(spark, sf), F.lit(None).cast("timestamp")) \
        .select("event_key", "event_ts", "year", "month", "day")


def wire_events(spark, sf) -> DataFrame:
    """v_events rendered as JSON wire messages (the Kafka ``value`` column)."""
    return wire_from(fx.v_events(spark, sf))


def wire_from(v: DataFrame) -> DataFrame:
    k = F.col("event_type")
    body = F.struct(
        "event_type",
        F.when(k == PAYMENT, F.col("event_key")).alias("transaction_id"),
        F.when(k == REFUND, F.col("event_key")).alias("refund_id"),
        F.when(k == CHARGEBACK, F.col("event_key")).alias("dispute_id"),
        F.when(k != PAYMENT, F.col("original_tx_id")).alias("original_tx_id"),
        "merchant_id", "customer_id",
        F.when(k == PAYMENT, F.col("amount")).alias("amount"),
        F.when(k == REFUND, F.col("amount")).alias("refund_amount"),
        F.when(k == CHARGEBACK, F.col("amount")).alias("dispute_amount"),
        "currency", "region", "timestamp")
    return v.select(F.to_json(body).alias("value"))


SQL_WIRE = """
wire AS (
  SELECT event_type,
         CASE WHEN event_type = 'payment_created' THEN event_key END AS transaction_id,
         CASE WHEN event_type = 'refund_initiated' THEN event_key END AS refund_id,
         CASE WHEN event_type = 'chargeback_filed' THEN event_key END AS dispute_id,
         CASE WHEN event_type <> 'payment_created' THEN original_tx_id END AS original_tx_id,
         merchant_id, customer_id,
         CASE WHEN event_type = 'payment_created' THEN amount END AS amount,
         CASE WHEN event_type = 'refund_initiated' THEN amount END AS refund_amount,
         CASE WHEN event_type = 'chargeback_filed' THEN amount END AS dispute_amount,
         currency, region, timestamp
  FROM v_events
)"""
SQL_ROUTED = """
routed AS (
  SELECT *, CASE WHEN reject_reason IS NOT NULL THEN 'dead_letter'
                 WHEN event_type = 'payment_created' THEN 'raw_payments'
                 WHEN event_type = 'refund_initiated' THEN 'raw_refunds'
                 WHEN event_type = 'chargeback_filed' THEN 'raw_chargebacks'
                 WHEN event_type = 'settlement_processed' THEN 'raw_settlements' END AS target_table
  FROM (SELECT *, CASE
          WHEN NOT coalesce(event_type IN ('payment_created','refund_initiated','chargeback_filed',
                                           'settlement_processed'), false) THEN 'unknown_event_type'
          WHEN coalesce(transaction_id, refund_id, dispute_id) IS NULL THEN 'null_event_key'
          WHEN merchant_id IS NULL THEN 'null_merchant_id'
          WHEN coalesce(amount, refund_amount, dispute_amount) IS NULL THEN 'null_amount'
          WHEN coalesce(amount, refund_amount, dispute_amount) <= 0 THEN 'non_positive_amount'
          END AS reject_reason FROM wire) w
)"""


@register("s2_decode_events", _sql("""
SELECT *, CAST(NULL AS varchar) AS decode_error FROM wire""", SQL_V_EVENTS, SQL_WIRE))
def s2(spark, sf):
    d = ig.decode_events(wire_events(spark, sf))
    return d.select("event_type", "transaction_id", "refund_id", "dispute_id", "original_tx_id",
                    "merchant_id", "customer_id", "amount", "refund_amount", "dispute_amount",
                    "currency", "region", "timestamp", "decode_error")


@register("s3_ingest_batch", _sql("""
SELECT event_type, coalesce(transaction_id, refund_id, dispute_id) AS event_key, target_table,
       reject_reason, try_cast(timestamp AS timestamp) AS event_ts,
       strftime(try_cast(timestamp AS timestamp), '%Y') AS year,
       strftime(try_cast(timestamp AS timestamp), '%m') AS month,
       strftime(try_cast(timestamp AS timestamp), '%d') AS day
FROM routed""", SQL_V_EVENTS, SQL_WIRE, SQL_ROUTED))
def s3(spark, sf):
    r = ig.ingest_frame(ig.decode_events(wire_events(spark, sf)), F.lit(None).cast("timestamp"))
    return r.select("event_type", F.coalesce("transaction_id", "refund_id", "dispute_id").alias("event_key"),
                    "target_table", "reject_reason", "event_ts", "year", "month", "day")


@register("f3_route_counts", _sql("""
SELECT target_table, reject_reason, count(*) AS event_count FROM routed GROUP BY 1, 2""",
    SQL_V_EVENTS, SQL_WIRE, SQL_ROUTED))
def f3(spark, sf):
    r = ig.ingest_frame(ig.decode_events(wire_events(spark, sf)), F.lit(None).cast("timestamp"))
    return r.groupBy("target_table", "reject_reason").agg(F.count(F.lit(1)).alias("event_count"))


@register("f4_report_date_rows", _sql(f"""
SELECT transaction_id, merchant_id, amount_decimal, event_ts FROM v_clean
WHERE cast(event_ts AS date) = DATE '{REPORT_DATE}'""", *PAY_CTES))
def f4(spark, sf):
    return _clean(spark, sf).filter(F.to_date("event_ts") == F.lit(REPORT_DATE).cast("date")) \
        .select("transaction_id", "merchant_id", "amount_decimal", "event_ts")


@register("s4_layer_scan", """
SELECT l_orderkey, l_suppkey, l_extendedprice, l_shipdate FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1998-01-01 00:00:00' AND l_returnflag = 'N'""")
def s4(spark, sf):
    from ..lake import scan
    return scan(spark, f"{sf}/lineitem.parquet",
                columns=["l_orderkey", "l_suppkey", "l_extendedprice", "l_shipdate"],
                where=(F.col("l_shipdate") >= F.lit("1998-01-01 00:00:00").cast("timestamp_ntz"))
                & (F.col("l_returnflag") == "N"))


@register("s7_empty_settlements", _sql("""
SELECT merchant_id, payment_date, payment_amount, CAST(NULL AS decimal(18,2)) AS settled_amount,
       payment_amount AS discrepancy_amount, 'awaiting_settlement' AS reconciliation_status
FROM pay_daily""", SQL_LI_PAYMENTS, SQL_PAY_DAILY))
def s7(spark, sf):
    empty = spark.createDataFrame([], SETTLEMENT_SCHEMA)
    return rc.reconcile(fx.li_payments(spark, sf), empty)


@register("s8_merchant_reference", _sql("SELECT * FROM v_merchants", SQL_V_MERCHANTS))
def s8(spark, sf):
    return fx.v_merchants(spark, sf)


# ----------------------------------------------------------------- joins
@register("j4_matched_days", _sql("""
SELECT p.merchant_id, p.payment_date, p.payment_amount, s.settled_amount
FROM pay_daily p JOIN settle_daily s
  ON p.merchant_id = s.merchant_id AND p.payment_date = s.settlement_date""",
    SQL_LI_PAYMENTS, SQL_LI_SETTLEMENTS, SQL_PAY_DAILY, SQL_SETTLE_DAILY))
def j4(spark, sf):
    p = rc.daily_payments(fx.li_payments(spark, sf))
    s = rc.daily_settlements(fx.li_settlements(spark, sf)).withColumnRenamed("merchant_id", "s_m")
    return p.join(s, (p.merchant_id == s.s_m) & (p.payment_date == s.settlement_date), "inner") \
        .select("merchant_id", "payment_date", "payment_amount", "settled_amount")


@register("j5_orphan_refunds", _sql("""
SELECT r.refund_id, r.original_tx_id, r.merchant_id FROM v_refunds r
WHERE NOT EXISTS (SELECT 1 FROM v_payments p WHERE p.transaction_id = r.original_tx_id)""",
    SQL_V_EVENTS, SQL_V_PAYMENTS, SQL_V_REFUNDS))
def j5(spark, sf):
    return qa.orphans(fx.v_refunds(spark, sf), fx.v_payments(spark, sf), "original_tx_id",
                      "transaction_id").select("refund_id", "original_tx_id", "merchant_id")


@register("j7_parent_lookup", _sql("""
SELECT r.refund_id, r.original_tx_id, p.merchant_id AS payment_merchant_id,
       try_cast(p.amount AS decimal(18,2)) AS payment_amount,
       try_cast(r.refund_amount AS decimal(18,2)) AS refund_amount,
       p.transaction_id IS NOT NULL AS parent_found
FROM v_refunds r LEFT JOIN v_payments p ON r.original_tx_id = p.transaction_id""",
    SQL_V_EVENTS, SQL_V_PAYMENTS, SQL_V_REFUNDS))
def j7(spark, sf):
    from ..functions.scalars import money
    r = fx.v_refunds(spark, sf)
    p = fx.v_payments(spark, sf).select(F.col("transaction_id").alias("p_tx"),
                                        F.col("merchant_id").alias("payment_merchant_id"),
                                        money("amount").alias("payment_amount"))
    return rc.parent_lookup(r, p, "original_tx_id", "p_tx", "left").select(
        "refund_id", "original_tx_id", "payment_merchant_id", "payment_amount",
        money("refund_amount").alias("refund_amount"), F.col("p_tx").isNotNull().alias("parent_found"))


# -------------------------------------------------------------- features
def _epoch_sql():
    return "cast(floor(epoch(event_ts)) AS bigint)"


def _rolling_sql(entity, sums, cnt, avg=None, windows=(7, 30, 90)):
    cols = []
    for n in windows:
        w = f"OVER (PARTITION BY {entity} ORDER BY e RANGE BETWEEN {n * 86400} PRECEDING AND CURRENT ROW)"
        cols.append(f"cast(sum(amount_decimal) {w} AS decimal(18,2)) AS {sums}_{n}d")
        if avg:
            cols.append(f"cast(sum(amount_decimal) {w} AS double) / cast(count(amount_decimal) {w} AS double)"
                        f" AS {avg}_{n}d")
        cols.append(f"count(transaction_id) {w} AS {cnt}_{n}d")
    return ",\n       ".join(cols)


SQL_CUST_ROLL = f"""
cust_roll AS (
  SELECT transaction_id, customer_id, event_ts,
       {_rolling_sql('customer_id', 'spend', 'tx_count')}
  FROM (SELECT *, {_epoch_sql()} AS e FROM v_clean) x
)"""
SQL_MERCH_ROLL = f"""
merch_roll AS (
  SELECT transaction_id, merchant_id, event_ts,
       {_rolling_sql('merchant_id', 'gmv', 'tx_count', 'avg_ticket')}
  FROM (SELECT *, {_epoch_sql()} AS e FROM v_clean) x
)"""
CUST_COLS = ["spend_7d", "tx_count_7d", "spend_30d", "tx_count_30d", "spend_90d", "tx_count_90d"]
MERCH_COLS = ["gmv_7d", "avg_ticket_7d", "tx_count_7d", "gmv_30d", "avg_ticket_30d", "tx_count_30d",
              "gmv_90d", "avg_ticket_90d", "tx_count_90d"]


@register("n1_customer_rolling", _sql("SELECT * FROM cust_roll", *PAY_CTES, SQL_CUST_ROLL))
def n1(spark, sf):
    p = _clean(spark, sf).select("transaction_id", "customer_id", "event_ts", "amount_decimal")
    return fe.rolling_features(p, "customer_id").select("transaction_id", "customer_id", "event_ts",
                                                        *CUST_COLS)


@register("n2_merchant_rolling", _sql("SELECT * FROM merch_roll", *PAY_CTES, SQL_MERCH_ROLL))
def n2(spark, sf):
    p = _clean(spark, sf).select("transaction_id", "merchant_id", "event_ts", "amount_decimal")
    return fe.rolling_features(p, "merchant_id", prefix_sum="gmv", prefix_avg="avg_ticket") \
        .select("transaction_id", "merchant_id", "event_ts", *MERCH_COLS)


@register("n3_customer_features", _sql(f"""
SELECT customer_id, {', '.join(CUST_COLS)} FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY event_ts DESC, transaction_id DESC) AS rn
  FROM cust_roll) x WHERE rn = 1""", *PAY_CTES, SQL_CUST_ROLL))
def n3(spark, sf):
    return fe.customer_features(_clean(spark, sf))


@register("n4_merchant_features", _sql(f"""
SELECT merchant_id, {', '.join(MERCH_COLS)} FROM (
  SELECT *, row_number() OVER (PARTITION BY merchant_id ORDER BY event_ts DESC, transaction_id DESC) AS rn
  FROM merch_roll) x WHERE rn = 1""", *PAY_CTES, SQL_MERCH_ROLL))
def n4(spark, sf):
    return fe.merchant_features(_clean(spark, sf))


# --------------------------------------------------------------- quality
@register("q1_null_rates", _sql("""
SELECT table_name, column_name, null_rate FROM (
  SELECT 'v_payments' AS table_name, 'merchant_id' AS column_name, coalesce(avg(CASE WHEN merchant_id IS NULL THEN 1 ELSE 0 END), 0.0) AS null_rate FROM v_payments
  UNION ALL SELECT 'v_payments', 'customer_id', coalesce(avg(CASE WHEN customer_id IS NULL THEN 1 ELSE 0 END), 0.0) FROM v_payments
  UNION ALL SELECT 'v_payments', 'amount', coalesce(avg(CASE WHEN amount IS NULL THEN 1 ELSE 0 END), 0.0) FROM v_payments
  UNION ALL SELECT 'v_payments', 'currency', coalesce(avg(CASE WHEN currency IS NULL THEN 1 ELSE 0 END), 0.0) FROM v_payments
  UNION ALL SELECT 'silver', 'merchant_id', coalesce(avg(CASE WHEN merchant_id IS NULL THEN 1 ELSE 0 END), 0.0) FROM v_clean
  UNION ALL SELECT 'silver', 'customer_id', coalesce(avg(CASE WHEN customer_id IS NULL THEN 1 ELSE 0 END), 0.0) FROM v_clean
  UNION ALL SELECT 'silver', 'amount_decimal', coalesce(avg(CASE WHEN amount_decimal IS NULL THEN 1 ELSE 0 END), 0.0) FROM v_clean
  UNION ALL SELECT 'silver', 'currency', coalesce(avg(CASE WHEN currency IS NULL THEN 1 ELSE 0 END), 0.0) FROM v_clean
) x""", *PAY_CTES))
def q1(spark, sf):
    """Q1 on the cleanse input and on its output (the output rates are the
    DQ gate: 0 by construction)."""
    p = fx.v_payments(spark, sf)
    valid, _ = cl.cleanse(p)
    return (qa.null_rates(p, ["merchant_id", "customer_id", "amount", "currency"], "v_payments")
            .unionByName(qa.null_rates(valid, ["merchant_id", "customer_id", "amount_decimal", "currency"],
                                       "silver")))


@register("q2_not_null_check", _sql("""
SELECT column_name, null_count, null_count = 0 AS passed FROM (
  SELECT 'transaction_id' AS column_name, count(*) FILTER (WHERE transaction_id IS NULL) AS null_count FROM v_payments
  UNION ALL SELECT 'merchant_id', count(*) FILTER (WHERE merchant_id IS NULL) FROM v_payments
  UNION ALL SELECT 'customer_id', count(*) FILTER (WHERE customer_id IS NULL) FROM v_payments
  UNION ALL SELECT 'amount', count(*) FILTER (WHERE amount IS NULL) FROM v_payments
) x""", SQL_V_EVENTS, SQL_V_PAYMENTS))
def q2(spark, sf):
    return qa.not_null_check(fx.v_payments(spark, sf),
                             ["transaction_id", "merchant_id", "customer_id", "amount"])


@register("q3_positivity_check", _sql("""
SELECT count(*) AS checked_rows, count(*) FILTER (WHERE amount <= 0) AS non_positive_rows,
       count(*) FILTER (WHERE amount <= 0) = 0 AS passed
FROM v_payments""", SQL_V_EVENTS, SQL_V_PAYMENTS))
def q3(spark, sf):
    return qa.positivity_check(fx.v_payments(spark, sf), "amount")


@register("q4_recency_check", _sql(f"""
SELECT count(*) AS checked_rows,
       count(*) FILTER (WHERE payment_date BETWEEN DATE '{ANCHOR}' - INTERVAL 90 DAY AND DATE '{ANCHOR}') AS recent_rows,
       count(*) FILTER (WHERE NOT coalesce(payment_date BETWEEN DATE '{ANCHOR}' - INTERVAL 90 DAY
                                           AND DATE '{ANCHOR}', false)) AS stale_rows
FROM (SELECT cast(event_ts AS date) AS payment_date FROM v_clean) x""", *PAY_CTES))
def q4(spark, sf):
    return qa.recency_check(_clean(spark, sf).select(F.to_date("event_ts").alias("payment_date")),
                            "payment_date", ANCHOR, 90)


@register("q5_referential_integrity", _sql("""
SELECT count(*) AS checked_keys, count(*) FILTER (WHERE m.merchant_id IS NULL) AS orphan_keys,
       count(*) FILTER (WHERE m.merchant_id IS NULL) = 0 AS passed
FROM (SELECT DISTINCT merchant_id FROM v_clean WHERE merchant_id IS NOT NULL) k
LEFT JOIN (SELECT DISTINCT merchant_id FROM v_merchants) m ON k.merchant_id = m.merchant_id""",
    *PAY_CTES, SQL_V_MERCHANTS))
def q5(spark, sf):
    gold = go.daily_merchant_summary(_clean(spark, sf))
    return qa.referential_integrity(gold, fx.v_merchants(spark, sf), "merchant_id", "merchant_id")


@register("q6_duplicate_count", """
SELECT count(*) AS row_count, count(DISTINCT (l_orderkey, l_linenumber)) AS distinct_keys,
       count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS duplicates
FROM lineitem""")
def q6(spark, sf):
    return cl.duplicate_stats(fx.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("q7_dead_letter_reasons", _sql("""
SELECT reject_reason AS reason, count(*) AS row_count,
       cast(count(*) AS double) / cast(sum(count(*)) OVER () AS double) AS row_share
FROM routed WHERE target_table = 'dead_letter' GROUP BY 1""", SQL_V_EVENTS, SQL_WIRE, SQL_ROUTED))
def q7(spark, sf):
    r = ig.ingest_frame(ig.decode_events(wire_events(spark, sf)), F.lit(None).cast("timestamp"))
    return qa.reason_breakdown(r.filter(F.col("target_table") == "dead_letter"), "reject_reason")


@register("q8_discrepancy_counts", _sql("""
SELECT 'amount_mismatch' AS discrepancy_type,
       count(*) FILTER (WHERE reconciliation_status = 'discrepancy_flagged') AS discrepancy_count FROM ledger_st
UNION ALL
SELECT 'missing_settlement', count(*) FILTER (WHERE reconciliation_status = 'awaiting_settlement') FROM ledger_st""",
    *LEDGER_CTES))
def q8(spark, sf):
    return rc.discrepancy_counts(_ledger(spark, sf))


@register("q9_quarantine_breakdown", _sql("""
SELECT quarantine_reason AS reason, count(*) AS row_count,
       cast(count(*) AS double) / cast(sum(count(*)) OVER () AS double) AS row_share
FROM v_classified WHERE quarantine_reason IS NOT NULL GROUP BY 1""", *PAY_CTES))
def q9(spark, sf):
    _, quarantined = cl.cleanse(fx.v_payments(spark, sf))
    return qa.reason_breakdown(quarantined, "quarantine_reason")


# ------------------------------------------------------ dedup / set ops
LI_REST = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
           "l_returnflag", "l_linestatus"]


@register("u1_dedup_lineitem", f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_shipdate DESC NULLS LAST, {', '.join(c + ' DESC NULLS LAST' for c in LI_REST)}) AS rn
  FROM lineitem) x
WHERE rn = 1""")
def u1(spark, sf):
    return cl.dedup_latest(fx.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"],
                           ["l_shipdate"])


@register("u3_unsettled_keys", """
SELECT l_orderkey, l_linenumber FROM lineitem
EXCEPT
SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag <> 'R'""")
def u3(spark, sf):
    li = fx.table(spark, sf, "lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    return cl.except_distinct(li.select(*keys), li.filter(F.col("l_returnflag") != "R").select(*keys))


@register("u4_subtract_invalid", _sql("""
SELECT merchant_id, amount, currency, region FROM v_payments
EXCEPT
SELECT merchant_id, amount, currency, region FROM v_payments
WHERE coalesce(transaction_id IS NOT NULL AND merchant_id IS NOT NULL AND amount IS NOT NULL
               AND amount > 0, false)""", SQL_V_EVENTS, SQL_V_PAYMENTS))
def u4(spark, sf):
    p = fx.v_payments(spark, sf)
    cols = ["merchant_id", "amount", "currency", "region"]
    valid, _ = ig.validate_payments(p)
    return cl.except_distinct(p.select(*cols), valid.select(*cols))


# ----------------------------------------------------- upsert / history
def _orders_snapshot(spark, sf):
    o = fx.table(spark, sf, "orders")
    return o.select("o_orderkey", "o_custkey", "o_orderstatus",
                    F.col("o_totalprice").cast(MONEY).alias("o_totalprice"),
                    F.col("o_orderdate"))


def _order_updates(spark, sf):
    li = fx.table(spark, sf, "lineitem")
    return li.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum(F.col("l_extendedprice").cast(MONEY)).cast(MONEY).alias("o_totalprice"),
        F.max("l_shipdate").alias("last_shipdate"))


SQL_ORDERS = """
s0 AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, cast(o_totalprice AS decimal(18,2)) AS o_totalprice,
         o_orderdate FROM orders
),
upd AS (
  SELECT l_orderkey AS o_orderkey,
         cast(sum(cast(l_extendedprice AS decimal(18,2))) AS decimal(18,2)) AS o_totalprice,
         max(l_shipdate) AS last_shipdate
  FROM lineitem GROUP BY 1
),
s1 AS (
  SELECT coalesce(u.o_orderkey, t.o_orderkey) AS o_orderkey, t.o_custkey, t.o_orderstatus,
         CASE WHEN u.o_orderkey IS NOT NULL THEN u.o_totalprice ELSE t.o_totalprice END AS o_totalprice,
         t.o_orderdate, u.last_shipdate
  FROM s0 t FULL OUTER JOIN upd u ON t.o_orderkey = u.o_orderkey
),
s2 AS (
  SELECT * FROM s1 WHERE coalesce(o_orderstatus, '') <> 'P'
)"""


def _snapshots(spark, sf):
    s0 = _orders_snapshot(spark, sf).withColumn("last_shipdate", F.lit(None).cast("timestamp_ntz"))
    s1 = upsert_frames(s0, _order_updates(spark, sf), ["o_orderkey"], ["o_totalprice", "last_shipdate"])
    s2 = s1.filter(F.coalesce(F.col("o_orderstatus"), F.lit("")) != "P")
    return s0, s1, s2


@register("w4_upsert", _sql("SELECT * FROM s1", SQL_ORDERS))
def w4(spark, sf):
    return upsert_frames(_orders_snapshot(spark, sf), _order_updates(spark, sf), ["o_orderkey"],
                         ["o_totalprice", "last_shipdate"])


def _log(spark, sf):
    return hi.log_from_snapshots(list(_snapshots(spark, sf)), ["o_orderkey"])


@register("m3_as_of_version", _sql("SELECT * FROM s1", SQL_ORDERS))
def m3(spark, sf):
    return hi.as_of(_log(spark, sf), ["o_orderkey"], 1)


SQL_FEED = """
feed AS (
  SELECT coalesce(n.o_orderkey, o.o_orderkey) AS o_orderkey,
         CASE WHEN o.o_orderkey IS NULL THEN 'insert' WHEN n.o_orderkey IS NULL THEN 'delete'
              WHEN o.o_custkey IS DISTINCT FROM n.o_custkey OR o.o_orderstatus IS DISTINCT FROM n.o_orderstatus
                OR o.o_totalprice IS DISTINCT FROM n.o_totalprice OR o.o_orderdate IS DISTINCT FROM n.o_orderdate
                OR o.last_shipdate IS DISTINCT FROM n.last_shipdate THEN 'update' END AS change_type,
         o.o_custkey AS old_o_custkey, o.o_orderstatus AS old_o_orderstatus,
         o.o_totalprice AS old_o_totalprice, o.o_orderdate AS old_o_orderdate,
         o.last_shipdate AS old_last_shipdate,
         n.o_custkey AS new_o_custkey, n.o_orderstatus AS new_o_orderstatus,
         n.o_totalprice AS new_o_totalprice, n.o_orderdate AS new_o_orderdate,
         n.last_shipdate AS new_last_shipdate
  FROM (SELECT *, CAST(NULL AS timestamp) AS last_shipdate FROM s0) o
  FULL OUTER JOIN s2 n ON o.o_orderkey = n.o_orderkey
)"""


@register("m4_change_feed", _sql("SELECT * FROM feed WHERE change_type IS NOT NULL",
                                 SQL_ORDERS, SQL_FEED))
def m4(spark, sf):
    s0, _, s2 = _snapshots(spark, sf)
    return hi.change_feed(s0, s2, ["o_orderkey"])


@register("l2_history", _sql("""
SELECT version, count(*) FILTER (WHERE op = 'insert') AS inserted,
       count(*) FILTER (WHERE op = 'update') AS updated,
       count(*) FILTER (WHERE op = 'delete') AS deleted
FROM (SELECT CAST(0 AS BIGINT) AS version, 'insert' AS op FROM s0
      UNION ALL
      SELECT CAST(1 AS BIGINT), CASE WHEN o.o_orderkey IS NULL THEN 'insert' WHEN n.o_orderkey IS NULL THEN 'delete'
                     ELSE 'update' END
      FROM (SELECT *, CAST(NULL AS timestamp) AS last_shipdate FROM s0) o
      FULL OUTER JOIN s1 n ON o.o_orderkey = n.o_orderkey
      WHERE o.o_orderkey IS NULL OR n.o_orderkey IS NULL
         OR o.o_totalprice IS DISTINCT FROM n.o_totalprice
         OR o.last_shipdate IS DISTINCT FROM n.last_shipdate
      UNION ALL
      SELECT CAST(2 AS BIGINT), 'delete' FROM s1 WHERE coalesce(o_orderstatus, '') = 'P') x
GROUP BY 1 ORDER BY 1 DESC LIMIT 10""", SQL_ORDERS))
def l2(spark, sf):
    return hi.history(_log(spark, sf), 10)


# ----------------------------------------------------------- maintenance
@register("m1_cluster_rows", "SELECT * FROM lineitem")
def m1(spark, sf):
    from ..operators.maintenance import cluster
    li = fx.table(spark, sf, "lineitem")
    return cluster(li, ["l_suppkey", "l_shipdate"], num_files=spark.sparkContext.defaultParallelism)


@register("m2_incremental_gold", _sql("""
SELECT merchant_id, cast(event_ts AS date) AS report_date, count(transaction_id) AS transaction_count,
       cast(sum(amount_decimal) AS decimal(18,2)) AS total_amount,
       cast(cast((2 * cast(sum(amount_decimal) * 100 AS bigint) + count(amount_decimal))
                 // (2 * count(amount_decimal)) AS double) / 100 AS decimal(18,2)) AS avg_amount,
       count(DISTINCT customer_id) AS unique_customers
FROM li_payments GROUP BY 1, 2""", SQL_LI_PAYMENTS))
def m2(spark, sf):
    from .incremental import changed_dates, refresh_daily_summary
    pay = fx.li_payments(spark, sf)
    first = pay.filter(F.col("linestatus") == "F")      # batch already summarised
    late = pay.filter(F.col("linestatus") != "F")       # rows arriving afterwards
    old = go.daily_merchant_summary(first)
    return refresh_daily_summary(old, pay, changed_dates(late))


# ------------------------------------------------------------- synthetic
def _synthetic(spark, sf, **kw):
    from ..sources.synthetic import synthetic_events
    return synthetic_events(fx.table(spark, sf, "events"), "event_id", ANCHOR, **kw)


@register("s9_synthetic_events")
def s9(spark, sf):
    return _synthetic(spark, sf)


@register("s10_settlement_discrepancies")
def s10(spark, sf):
    ev = _synthetic(spark, sf, discrepancy_rate=0.05)
    return ev.filter(F.col("event_type") == "settlement_processed")


@register("s11_backdated_days")
def s11(spark, sf):
    from ..functions.scalars import parse_event_ts
    ev = _synthetic(spark, sf, days_back=30)
    return ev.groupBy(F.to_date(parse_event_ts("timestamp")).alias("event_date"), "event_type") \
        .agg(F.count(F.lit(1)).alias("event_count"))


# ------------------------------------------------------------- streaming
def _run_stream(spark, sf):
    import uuid

    from ..lake import Lake
    from ..session import checkpoint_dir
    from ..streaming.ingest import start_bronze_stream, stream_source
    root = f"{checkpoint_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    lake = Lake(spark, root)
    schema = fx.table(spark, sf, "events").schema
    src = stream_source(spark, "parquet", sf, schema, pathGlobFilter="events.parquet",
                        maxFilesPerTrigger="1")
    q = start_bronze_stream(lake, src, f"{root}/_checkpoint/bronze_events",
                            prepare=lambda b: wire_from(fx.events_as_payments(b)))
    q.awaitTermination()
    return lake


@register("t1_stream_ingest", ORACLE["f3_route_counts"])
def t1(spark, sf):
    from ..schemas import BRONZE_SCHEMA
    lake = _run_stream(spark, sf)
    return lake.read("bronze", "events", BRONZE_SCHEMA).groupBy("target_table", "reject_reason") \
        .agg(F.count(F.lit(1)).alias("event_count"))


@register("t3_stream_batch_counters", _sql("""
SELECT count(*) AS consumed, count(*) FILTER (WHERE target_table <> 'dead_letter') AS valid,
       count(*) FILTER (WHERE target_table = 'dead_letter') AS invalid
FROM routed""", SQL_V_EVENTS, SQL_WIRE, SQL_ROUTED))
def t3(spark, sf):
    lake = _run_stream(spark, sf)
    return lake.read("bronze", "ingest_audit").agg(
        F.sum("consumed").alias("consumed"), F.sum("valid").alias("valid"),
        F.sum("invalid").alias("invalid"))


# ------------------------------------------------------ scalar functions
@register("p_scalar_projections", _sql(f"""
SELECT event_key, try_cast(timestamp AS timestamp) AS event_ts,
       strftime(try_cast(timestamp AS timestamp), '%Y') AS year,
       try_cast(amount AS decimal(18,2)) AS amount_decimal,
       cast(try_cast(timestamp AS timestamp) AS date) AS event_date,
       date_trunc('hour', try_cast(timestamp AS timestamp)) AS event_hour,
       cast(floor(epoch(try_cast(timestamp AS timestamp))) AS bigint) AS epoch_s,
       date_diff('day', cast(try_cast(timestamp AS timestamp) AS date), DATE '{ANCHOR}') AS days_to_anchor,
       currency IN ('USD','EUR','GBP','SGD','JPY','AUD','CAD','CHF') AS currency_valid,
       cast(abs(try_cast(amount AS decimal(18,2)) - coalesce(try_cast(amount AS decimal(18,2)),
                cast(0 AS decimal(18,2)))) AS decimal(18,2)) AS self_gap
FROM v_events""", SQL_V_EVENTS))
def p_scalars(spark, sf):
    from ..functions import scalars as sc
    from ..schemas import VALID_CURRENCIES
    v = fx.v_events(spark, sf).withColumn("event_ts", sc.parse_event_ts("timestamp")) \
        .withColumn("amount_decimal", sc.money("amount"))
    return v.select(
        "event_key", "event_ts", sc.partition_strings("event_ts")[0], "amount_decimal",
        F.to_date("event_ts").alias("event_date"), sc.hour_of("event_ts").alias("event_hour"),
        sc.epoch_seconds("event_ts").alias("epoch_s"),
        sc.days_between(F.lit(ANCHOR).cast("date"), F.to_date("event_ts")).cast("bigint")
          .alias("days_to_anchor"),
        F.col("currency").isin(list(VALID_CURRENCIES)).alias("currency_valid"),
        F.abs(F.col("amount_decimal") - F.coalesce("amount_decimal", F.lit(0).cast(MONEY)))
         .cast(MONEY).alias("self_gap"))


# ---------------------------------------------------------------- writes
def _scratch_lake(spark, tag):
    import uuid

    from ..lake import Lake
    from ..session import checkpoint_dir
    return Lake(spark, f"{checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}")


def _monthly(led):
    from .incremental import payment_month
    return led.withColumn("payment_month", payment_month("payment_date"))


@register("w1_append_read_back", _sql("""
SELECT event_type, event_key, merchant_id, amount, timestamp,
       strftime(try_cast(timestamp AS timestamp), '%Y') AS year,
       strftime(try_cast(timestamp AS timestamp), '%m') AS month,
       strftime(try_cast(timestamp AS timestamp), '%d') AS day
FROM v_events""", SQL_V_EVENTS))
def w1(spark, sf):
    from pyspark.sql.types import StringType, StructField, StructType
    lake = _scratch_lake(spark, "w1")
    v = ig.add_partition_columns(fx.v_events(spark, sf), F.lit(None).cast("timestamp")) \
        .select("event_type", "event_key", "merchant_id", "amount", "timestamp", "year", "month", "day")
    half = v.filter(F.col("event_type") == PAYMENT)
    rest = v.filter(F.col("event_type") != PAYMENT).withColumn("note", F.lit("late"))
    lake.append(half, "bronze", "events", ["year", "month", "day"])
    lake.append(rest, "bronze", "events", ["year", "month", "day"])   # new column: schema evolves
    schema = StructType([f for f in v.schema.fields] + [StructField("note", StringType())])
    return lake.read("bronze", "events", schema).drop("note")


@register("w3_replace_partitions", _sql("SELECT * FROM ledger_st", *LEDGER_CTES))
def w3(spark, sf):
    """Ledger first written before any settlement (all awaiting), then the
    dates that received settlements are recomputed and replaced."""
    from .incremental import changed_ledger_dates, refresh_ledger
    lake = _scratch_lake(spark, "w3")
    pay = fx.li_payments(spark, sf)
    st = fx.li_settlements(spark, sf)
    empty = spark.createDataFrame([], SETTLEMENT_SCHEMA)
    lake.overwrite(_monthly(rc.reconcile(pay, empty)), "silver", "ledger", ["payment_month"])
    no_new_payments = spark.createDataFrame([], pay.schema)
    refresh_ledger(lake, pay, st, changed_ledger_dates(no_new_payments, st), table=("silver", "ledger"), monthly=True)
    return lake.read("silver", "ledger").drop("payment_month")


@register("w7_delete_rows", _sql("""
SELECT * FROM ledger_st
WHERE NOT (year(payment_date) = 1995 OR reconciliation_status = 'awaiting_settlement')""", *LEDGER_CTES))
def w7(spark, sf):
    lake = _scratch_lake(spark, "w7")
    lake.overwrite(_monthly(_ledger(spark, sf)), "silver", "ledger", ["payment_month"])
    lake.delete_where("silver", "ledger", F.year("payment_date") == 1995, ["payment_month"])
    lake.delete_where("silver", "ledger", F.col("reconciliation_status") == "awaiting_settlement",
                      ["payment_month"])
    return lake.read("silver", "ledger").drop("payment_month")


# ------------------------------------------------------------- nightly run
@register("r1_nightly_gold", _sql(f"""
SELECT d.*, m.merchant_name, m.category, m.country, m.risk_tier
FROM (SELECT merchant_id, cast(event_ts AS date) AS report_date,
             count(transaction_id) AS transaction_count,
             cast(sum(amount_decimal) AS decimal(18,2)) AS total_amount,
             cast(cast((2 * cast(sum(amount_decimal) * 100 AS bigint) + count(amount_decimal))
                       // (2 * count(amount_decimal)) AS double) / 100 AS decimal(18,2)) AS avg_amount,
             count(DISTINCT customer_id) AS unique_customers
      FROM v_clean WHERE cast(event_ts AS date) = DATE '{REPORT_DATE}' GROUP BY 1, 2) d
LEFT JOIN v_merchants m ON d.merchant_id = m.merchant_id""", *PAY_CTES, SQL_V_MERCHANTS))
def r1(spark, sf):
    """Wire events -> Bronze -> nightly run for the report date -> Gold."""
    from .nightly import ingest_batch, run_nightly
    lake = _scratch_lake(spark, "r1")
    lake.overwrite(fx.v_merchants(spark, sf), "bronze", "merchant_reference")
    ingest_batch(lake, wire_events(spark, sf), batch_id=1, raw_json=True)
    run_nightly(lake, REPORT_DATE, "r1", clock=F.lit("2024-02-01 00:00:00").cast("timestamp"))
    return lake.read("gold", "daily_merchant_summary")


@register("r1_catchup_gold", _sql("""
SELECT d.*, m.merchant_name, m.category, m.country, m.risk_tier
FROM (SELECT merchant_id, cast(event_ts AS date) AS report_date,
             count(transaction_id) AS transaction_count,
             cast(sum(amount_decimal) AS decimal(18,2)) AS total_amount,
             cast(cast((2 * cast(sum(amount_decimal) * 100 AS bigint) + count(amount_decimal))
                       // (2 * count(amount_decimal)) AS double) / 100 AS decimal(18,2)) AS avg_amount,
             count(DISTINCT customer_id) AS unique_customers
      FROM v_clean GROUP BY 1, 2) d
LEFT JOIN v_merchants m ON d.merchant_id = m.merchant_id""", *PAY_CTES, SQL_V_MERCHANTS))
def r1_catchup(spark, sf):
    """Wire events -> Bronze -> catch-up run over every date -> Gold."""
    from .nightly import ingest_batch, run_nightly
    lake = _scratch_lake(spark, "r1c")
    lake.overwrite(fx.v_merchants(spark, sf), "bronze", "merchant_reference")
    ingest_batch(lake, wire_events(spark, sf), batch_id=1, raw_json=True)
    run_nightly(lake, None, "catchup", clock=F.lit("2024-02-01 00:00:00").cast("timestamp"))
    return lake.read("gold", "daily_merchant_summary")


@register("t5_hourly_stream", ORACLE["a2_hourly_volume"])
def t5(spark, sf):
    """Events as a file stream -> cleanse -> watermarked hourly windows with
    replay de-duplication -> update-mode upsert -> the live hourly table."""
    from ..streaming.ingest import start_hourly_stream, stream_source
    lake = _scratch_lake(spark, "t5")
    schema = fx.table(spark, sf, "events").schema
    src = stream_source(spark, "parquet", sf, schema, pathGlobFilter="events.parquet",
                        maxFilesPerTrigger="1")
    valid = cl.cast_and_classify(fx.events_as_payments(src).filter(F.col("event_type") == PAYMENT)
                                 .withColumnRenamed("event_key", "transaction_id")) \
        .filter(F.col("quarantine_reason").isNull())
    start_hourly_stream(lake, valid, f"{lake.root}/_checkpoint/hourly",
                        state_partitions=spark.sparkContext.defaultParallelism).awaitTermination()
    return lake.read("gold", "hourly_volume_live").drop("day")


@register("r2_gold_with_optimize", ORACLE["r1_nightly_gold"])
def r2(spark, sf):
    """R2: Silver for every date, then compact + cluster the report date's
    Silver partition and compute that date's Gold from the new layout."""
    from .nightly import ingest_batch, run_gold, run_silver_cleanse
    lake = _scratch_lake(spark, "r2")
    lake.overwrite(fx.v_merchants(spark, sf), "bronze", "merchant_reference")
    ingest_batch(lake, wire_events(spark, sf), batch_id=1, raw_json=True)
    run_silver_cleanse(lake, None, "r2")
    run_gold(lake, REPORT_DATE, optimize=True)
    return lake.read("gold", "daily_merchant_summary")
