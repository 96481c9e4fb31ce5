"""Payment-domain views over the driver's test tables.

Each view exists twice: as a DataFrame built with the DataFrame API (used by
the queries) and as SQL text for the DuckDB oracle.  They are plain
projections of whole tables, so their size grows with the tables.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import CHARGEBACK, PAYMENT, REFUND, SETTLEMENT


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---------------------------------------------------------------- v_events
def v_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tagged union of the four event kinds with injected defects."""
    return events_as_payments(table(spark, sf_dir, "events"))


def events_as_payments(e: DataFrame) -> DataFrame:
    """The ``v_events`` projection of any frame with the ``events`` columns
    (batch or streaming)."""
    eid = F.col("event_id")
    kind = (F.when(F.col("event_type") == "signup", F.lit(REFUND))
             .when(F.col("event_type") == "error", F.lit(CHARGEBACK))
             .otherwise(F.lit(PAYMENT)))
    cur = F.when(eid % 11 == 0, "USD")
    for i, code in enumerate(["EUR", "GBP", "SGD", "JPY", "AUD", "CAD", "CHF", "XYZ"], start=1):
        cur = cur.when(eid % 11 == i, code)
    cur = cur.when(eid % 11 == 9, F.lit(None).cast("string")).otherwise("USD")
    region = (F.when(eid % 4 == 0, "us-east").when(eid % 4 == 1, "us-west")
               .when(eid % 4 == 2, "eu-west").otherwise("ap-south"))
    return e.select(
        kind.alias("event_type"),
        F.concat(F.lit("txn_"), eid.cast("string")).alias("event_key"),
        F.concat(F.lit("txn_"), (eid - 1).cast("string")).alias("original_tx_id"),
        F.concat(F.lit("merch_"), F.get_json_object("props", "$.k")).alias("merchant_id"),
        F.when(eid % 103 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("cust_"), F.col("user_id").cast("string"))).alias("customer_id"),
        F.when(eid % 97 == 0, F.lit(None).cast("double"))
         .when(eid % 89 == 0, -F.col("value")).otherwise(F.col("value")).alias("amount"),
        cur.alias("currency"),
        region.alias("region"),
        F.when(eid % 101 == 0, F.lit("not-a-time"))
         .otherwise(F.col("ts").cast("string")).alias("timestamp"),
    )


def _kind(spark, sf_dir, source_pred) -> DataFrame:
    """``v_events`` rows of one kind, filtered on the *source* column so the
    predicate reaches the Parquet scan (``PushedFilters``) instead of being
    evaluated on the derived CASE column."""
    return events_as_payments(table(spark, sf_dir, "events").filter(source_pred))


def v_payments(spark, sf_dir) -> DataFrame:
    # NULL source types map to payments in v_events, so keep them here too
    src = F.col("event_type").isNull() | ~F.col("event_type").isin("signup", "error")
    return (_kind(spark, sf_dir, src).filter(F.col("event_type") == PAYMENT)
            .withColumnRenamed("event_key", "transaction_id").drop("original_tx_id"))


def v_refunds(spark, sf_dir) -> DataFrame:
    return (_kind(spark, sf_dir, F.col("event_type") == "signup")
            .withColumnRenamed("event_key", "refund_id")
            .withColumnRenamed("amount", "refund_amount"))


def v_chargebacks(spark, sf_dir) -> DataFrame:
    return (_kind(spark, sf_dir, F.col("event_type") == "error")
            .withColumnRenamed("event_key", "dispute_id")
            .withColumnRenamed("amount", "dispute_amount"))


def v_merchants(spark, sf_dir) -> DataFrame:
    """Merchant dimension from supplier x nation x region."""
    s, n, r = (table(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    return (s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
            .select(F.concat(F.lit("merch_"), F.col("s_suppkey").cast("string")).alias("merchant_id"),
                    F.col("s_name").alias("merchant_name"), F.col("r_name").alias("category"),
                    F.col("n_name").alias("country"),
                    F.when(F.col("s_acctbal") < 0, "high").when(F.col("s_acctbal") < 5000, "medium")
                     .otherwise("low").alias("risk_tier")))


def li_payments(spark, sf_dir) -> DataFrame:
    """Silver-shaped payments from lineitem: every row is a payment."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.concat_ws("_", F.lit("li"), F.col("l_orderkey").cast("string"),
                    F.col("l_linenumber").cast("string")).alias("transaction_id"),
        F.concat(F.lit("merch_"), F.col("l_suppkey").cast("string")).alias("merchant_id"),
        F.concat(F.lit("cust_"), F.col("l_partkey").cast("string")).alias("customer_id"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("amount_decimal"),
        F.col("l_shipdate").alias("event_ts"),
        F.col("l_linestatus").alias("linestatus"),
    )


def li_settlements(spark, sf_dir) -> DataFrame:
    """Settlement events from lineitem: rows not returned; line 7 short by 0.01."""
    li = table(spark, sf_dir, "lineitem")
    return li.filter(F.col("l_returnflag") != "R").select(
        F.lit(SETTLEMENT).alias("event_type"),
        F.concat_ws("_", F.lit("st"), F.col("l_orderkey").cast("string"),
                    F.col("l_linenumber").cast("string")).alias("batch_id"),
        F.concat(F.lit("merch_"), F.col("l_suppkey").cast("string")).alias("merchant_id"),
        (F.col("l_extendedprice").cast("decimal(18,2)")
         - F.when(F.col("l_linenumber") == 7, F.lit(0.01).cast("decimal(18,2)"))
            .otherwise(F.lit(0).cast("decimal(18,2)"))).cast("double").alias("gross_amount"),
        F.col("l_shipdate").cast("string").alias("timestamp"),
    )


# ------------------------------------------------------------ SQL (DuckDB)
SQL_V_EVENTS = """
v_events AS (
  SELECT CASE event_type WHEN 'signup' THEN 'refund_initiated' WHEN 'error' THEN 'chargeback_filed'
              ELSE 'payment_created' END AS event_type,
         concat('txn_', cast(event_id AS varchar)) AS event_key,
         concat('txn_', cast(event_id - 1 AS varchar)) AS original_tx_id,
         concat('merch_', json_extract_string(props, '$.k')) AS merchant_id,
         CASE WHEN event_id % 103 = 0 THEN NULL ELSE concat('cust_', cast(user_id AS varchar)) END AS customer_id,
         CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 89 = 0 THEN -value ELSE value END AS amount,
         CASE event_id % 11 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'GBP' WHEN 3 THEN 'SGD'
              WHEN 4 THEN 'JPY' WHEN 5 THEN 'AUD' WHEN 6 THEN 'CAD' WHEN 7 THEN 'CHF' WHEN 8 THEN 'XYZ'
              WHEN 9 THEN NULL ELSE 'USD' END AS currency,
         CASE event_id % 4 WHEN 0 THEN 'us-east' WHEN 1 THEN 'us-west' WHEN 2 THEN 'eu-west'
              ELSE 'ap-south' END AS region,
         CASE WHEN event_id % 101 = 0 THEN 'not-a-time' ELSE cast(ts AS varchar) END AS timestamp,
         ts AS src_ts
  FROM events
)"""

SQL_V_PAYMENTS = """
v_payments AS (
  SELECT event_type, event_key AS transaction_id, merchant_id, customer_id, amount, currency,
         region, timestamp
  FROM v_events WHERE event_type = 'payment_created'
)"""

SQL_V_REFUNDS = """
v_refunds AS (
  SELECT event_type, event_key AS refund_id, original_tx_id, merchant_id, customer_id,
         amount AS refund_amount, currency, region, timestamp
  FROM v_events WHERE event_type = 'refund_initiated'
)"""

SQL_V_CHARGEBACKS = """
v_chargebacks AS (
  SELECT event_type, event_key AS dispute_id, original_tx_id, merchant_id, customer_id,
         amount AS dispute_amount, currency, region, timestamp
  FROM v_events WHERE event_type = 'chargeback_filed'
)"""

SQL_V_MERCHANTS = """
v_merchants AS (
  SELECT concat('merch_', cast(s_suppkey AS varchar)) AS merchant_id, s_name AS merchant_name,
         r_name AS category, n_name AS country,
         CASE WHEN s_acctbal < 0 THEN 'high' WHEN s_acctbal < 5000 THEN 'medium' ELSE 'low' END AS risk_tier
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""

# Silver cleanse of v_payments (C2) in SQL: typed columns plus the reason.
SQL_V_CLEANSED = """
v_cast AS (
  SELECT *, try_cast(amount AS decimal(18,2)) AS amount_decimal,
         try_cast(timestamp AS timestamp) AS event_ts
  FROM v_payments
),
v_classified AS (
  SELECT *,
         CASE WHEN amount_decimal IS NULL THEN 'null_amount'
              WHEN amount_decimal <= 0 THEN 'non_positive_amount'
              WHEN currency IS NULL THEN 'null_currency'
              WHEN currency NOT IN ('USD','EUR','GBP','SGD','JPY','AUD','CAD','CHF') THEN 'invalid_currency'
              WHEN event_ts IS NULL THEN 'invalid_timestamp'
              WHEN merchant_id IS NULL THEN 'null_merchant_id'
              WHEN customer_id IS NULL THEN 'null_customer_id'
              ELSE NULL END AS quarantine_reason
  FROM v_cast
),
v_clean AS (
  SELECT * FROM v_classified WHERE quarantine_reason IS NULL
)"""

SQL_LI_PAYMENTS = """
li_payments AS (
  SELECT concat_ws('_', 'li', cast(l_orderkey AS varchar), cast(l_linenumber AS varchar)) AS transaction_id,
         concat('merch_', cast(l_suppkey AS varchar)) AS merchant_id,
         concat('cust_', cast(l_partkey AS varchar)) AS customer_id,
         cast(l_extendedprice AS decimal(18,2)) AS amount_decimal,
         l_shipdate AS event_ts, l_linestatus AS linestatus
  FROM lineitem
)"""

SQL_LI_SETTLEMENTS = """
li_settlements AS (
  SELECT concat('merch_', cast(l_suppkey AS varchar)) AS merchant_id,
         cast(l_shipdate AS date) AS settlement_date,
         cast(cast(cast(l_extendedprice AS decimal(18,2))
              - CASE WHEN l_linenumber = 7 THEN cast(0.01 AS decimal(18,2))
                     ELSE cast(0 AS decimal(18,2)) END AS double) AS decimal(18,2)) AS gross_decimal
  FROM lineitem WHERE l_returnflag <> 'R'
)"""


def with_ctes(*ctes: str, body: str) -> str:
    """Assemble ``WITH a AS (...), b AS (...) body``."""
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n" + body
