"""Plan assertions: the physical shapes the design relies on."""
import tempfile

from pyspark.sql import functions as F

import __spark_entry__ as E
from tests.conftest import SF01


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_broadcasts_dimension(spark):
    assert "BroadcastHashJoin" in _plan(E.queries()["a1_daily_merchant_summary"](spark, SF01))


def test_scan_pushes_filters_and_prunes_columns(spark):
    p = _plan(E.queries()["s4_layer_scan"](spark, SF01))
    assert "GreaterThanOrEqual(l_shipdate" in p.split("PushedFilters:")[1]
    read = p.split("ReadSchema: ")[1]
    assert read.startswith("struct<l_orderkey:bigint,l_suppkey:bigint,l_extendedprice:double,"
                           "l_returnflag:string,l_shipdate")          # 5 of 11 columns read


def test_date_filter_prunes_partitions(spark):
    from ledgerlake.lake import Lake
    from ledgerlake.plans.catalog import _ledger
    lake = Lake(spark, tempfile.mkdtemp(prefix="ll-lake-", dir="/tmp"))
    led = _ledger(spark, SF01).filter(F.year("payment_date") == 1998)
    lake.overwrite(led, "silver", "ledger", ["payment_date"])
    q = lake.read("silver", "ledger").filter(F.col("payment_date") == F.lit("1998-06-15").cast("date"))
    p = _plan(q)
    assert "PartitionFilters: [isnotnull(payment_date" in p and "= 1998-06-15" in p


def test_dedup_and_latest_are_partial_aggregates(spark):
    for name, token in (("u1_dedup_lineitem", "partial_max"), ("m3_as_of_version", "partial_max_by")):
        assert token in _plan(E.queries()[name](spark, SF01)), name


def test_ledger_join_adds_no_exchange_beyond_the_aggregates(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = _plan(E.queries()["a5_reconciliation_ledger"](spark, SF01))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in p
    assert p.count("Exchange hashpartitioning") == 2        # one per aggregate, none for the join


def test_rolling_reuses_the_point_shuffle(spark):
    df = E.queries()["n1_customer_rolling"](spark, SF01)
    df.write.format("noop").mode("overwrite").save()
    assert "Cartesian" not in _plan(df) and "NestedLoop" not in _plan(df)


def test_declared_schemas_reach_the_nightly_reads(spark):
    """Silver is read with its declared schema: no footers, no schema merge."""
    from ledgerlake.lake import Lake
    from ledgerlake.plans import nightly as ni
    from ledgerlake.schemas import SILVER_PAYMENT_SCHEMA
    from ledgerlake.sources.synthetic import synthetic_events
    lake = Lake(spark, tempfile.mkdtemp(prefix="ll-lake-", dir="/tmp"))
    ni.ingest_batch(lake, synthetic_events(spark.range(50), "id", "2026-01-31", days_back=1), 1)
    ni.run_silver_cleanse(lake, None, "x")
    df = ni.silver_payments(lake)
    assert sorted(df.columns) == sorted(SILVER_PAYMENT_SCHEMA.names)
    assert "mergeSchema" not in df._jdf.queryExecution().logical().toString()


def test_results_equal_with_aqe_off(spark):
    q = E.queries()
    names = ["a1_daily_merchant_summary", "a5_reconciliation_ledger", "n2_merchant_rolling",
             "u1_dedup_lineitem", "a11_settlement_lag"]
    on = {n: q[n](spark, SF01).collect() for n in names}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for n in names:
            assert sorted(map(tuple, q[n](spark, SF01).collect())) == sorted(map(tuple, on[n])), n
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
