"""Literal-row tests: the payment-domain cases of FIXTURES.md section A.2."""
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlake.functions.scalars import epoch_seconds, hour_of, parse_event_ts
from ledgerlake.operators import cleanse as cl
from ledgerlake.operators import features as fe
from ledgerlake.operators import gold as go
from ledgerlake.operators import ingest as ig
from ledgerlake.operators import quality as qa
from ledgerlake.operators import reconcile as rc
from ledgerlake.schemas import PAYMENT_SCHEMA, SETTLEMENT_SCHEMA, UNION_SCHEMA


def pay(spark, rows):
    return spark.createDataFrame(rows, PAYMENT_SCHEMA.simpleString().replace(" NOT NULL", ""))


def P(tx="t1", m="m1", c="c1", amt=100.0, cur="USD", ts="2026-03-15T10:00:00Z"):
    return ("payment_created", tx, m, c, amt, cur, "stripe", "us-east", ts)


# ---------------------------------------------------------------- bronze
def test_reject_null_id(spark):
    v, i = ig.validate_payments(pay(spark, [P(tx=None)]))
    assert (v.count(), i.count()) == (0, 1)


def test_reject_negative_amount(spark):
    v, i = ig.validate_payments(pay(spark, [P(amt=-10.0)]))
    assert (v.count(), i.count()) == (0, 1)


def test_valid_passes(spark):
    v, i = ig.validate_payments(pay(spark, [P()]))
    assert (v.count(), i.count()) == (1, 0)


def test_duplicates_land_in_bronze(spark):
    routed = ig.ingest_frame(ig.conform(pay(spark, [P(), P()]), UNION_SCHEMA))
    assert routed.filter(F.col("target_table") == "raw_payments").count() == 2


def test_partition_strings(spark):
    r = ig.add_partition_columns(pay(spark, [P()])).first()
    assert (r.year, r.month, r.day) == ("2026", "03", "15")
    assert r.event_ts == datetime(2026, 3, 15, 10, 0, 0)


def test_timestamp_forms(spark):
    df = spark.createDataFrame([("2026-03-15T10:00:00+00:00Z",), ("2026-03-15T12:00:00+02:00",),
                                ("2026-03-15 10:00:00",), ("not-a-time",), (None,)], "s string")
    got = [r[0] for r in df.select(parse_event_ts("s")).collect()]
    ten = datetime(2026, 3, 15, 10, 0, 0)
    assert got == [ten, ten, ten, None, None]


def test_timestamp_parse_ignores_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([("2026-03-15T10:00:00Z",), ("2026-03-15 10:00:00",)], "s string")
        assert {r[0] for r in df.select(parse_event_ts("s")).collect()} == {datetime(2026, 3, 15, 10)}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_malformed_json_kept_and_not_collapsed(spark):
    raw = spark.createDataFrame([("{not json",), ("{not json",), ('{"event_type": "x"}',),
                                 ('{"event_type":"payment_created","transaction_id":"t","merchant_id":"m",'
                                  '"amount":5.0,"timestamp":"2026-01-01T00:00:00Z"}',)], "value string")
    r = ig.route_events(ig.decode_events(raw)).select("raw_value", "reject_reason", "target_table")
    rows = r.collect()
    bad = [x for x in rows if x.raw_value == "{not json"]
    assert len(bad) == 2 and {x.reject_reason for x in bad} == {"malformed_json"}
    assert {x.target_table for x in bad} == {"dead_letter"}
    by = {x.raw_value[:20]: x for x in rows}
    assert by['{"event_type": "x"}'].reject_reason == "unknown_event_type"
    assert by['{"event_type":"payme'].target_table == "raw_payments"


def test_every_kind_routes(spark):
    df = spark.createDataFrame([
        ("payment_created", "t1", None, None, "m", 1.0, None, None, None),
        ("refund_initiated", None, "r1", None, "m", None, 1.0, None, None),
        ("chargeback_filed", None, None, "d1", "m", None, None, 1.0, None),
        ("settlement_processed", None, None, None, "m", None, None, None, 1.0),
    ], "event_type string, transaction_id string, refund_id string, dispute_id string, merchant_id string,"
       " amount double, refund_amount double, dispute_amount double, gross_amount double") \
        .withColumn("batch_id", F.lit("b1")).withColumn("timestamp", F.lit("2026-01-01T00:00:00Z"))
    got = {r.event_type: r.target_table for r in ig.route_events(ig.conform(df, UNION_SCHEMA)).collect()}
    assert got == {"payment_created": "raw_payments", "refund_initiated": "raw_refunds",
                   "chargeback_filed": "raw_chargebacks", "settlement_processed": "raw_settlements"}


# ---------------------------------------------------------------- silver
def test_decimal_cast(spark):
    valid, _ = cl.cleanse(pay(spark, [P(amt=123.45)]))
    assert abs(float(valid.first().amount_decimal) - 123.45) < 0.001


def test_half_up_and_overflow(spark):
    from ledgerlake.functions.scalars import money
    df = spark.createDataFrame([(0.005,), (0.004,), (1e20,)], "x double")
    assert [r[0] for r in df.select(money("x")).collect()] == [Decimal("0.01"), Decimal("0.00"), None]


def test_bad_currency_reason(spark):
    _, q = cl.cleanse(pay(spark, [P(cur="XYZ")]))
    assert q.first().quarantine_reason == "invalid_currency"


def test_null_amount_quarantined(spark):
    _, q = cl.cleanse(pay(spark, [P(amt=None)]))
    assert q.first().quarantine_reason == "null_amount"


def test_valid_plus_quarantine_is_input(spark):
    from tests.conftest import SF01
    from ledgerlake.sources import fixtures as fx
    p = fx.v_payments(spark, SF01)
    v, q = cl.cleanse(p)
    assert v.count() + q.count() == p.count()
    cols = p.columns
    assert v.select(cols).unionAll(q.select(cols)).exceptAll(p).count() == 0


def test_dedup_hot_key_is_partial_aggregate(spark):
    df = spark.range(10000).select(F.lit("hot").alias("k"), F.col("id").alias("v"))
    out = cl.dedup_latest(df, ["k"], ["v"])
    assert out.first().v == 9999
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan


def test_duplicate_stats_null_key_is_one_group(spark):
    df = spark.createDataFrame([(None,), (None,), ("a",)], "k string")
    r = cl.duplicate_stats(df, ["k"]).first()
    assert (r.row_count, r.distinct_keys, r.duplicates) == (3, 2, 1)


# -------------------------------------------------------- reconciliation
def _pays(spark, rows):
    return spark.createDataFrame(
        [(m, datetime.fromisoformat(ts), Decimal(str(a))) for m, ts, a in rows],
        "merchant_id string, event_ts timestamp_ntz, amount_decimal decimal(18,2)")


def _settles(spark, rows):
    return spark.createDataFrame([("settlement_processed", f"b{i}", m, g, 0.0, g, ts)
                                  for i, (m, ts, g) in enumerate(rows)], SETTLEMENT_SCHEMA)


def test_matched_and_awaiting(spark):
    p = _pays(spark, [("merch_1", "2026-01-01 10:00:00", 100), ("merch_1", "2026-01-01 11:00:00", 200),
                      ("merch_2", "2026-01-01 12:00:00", 50)])
    s = _settles(spark, [("merch_1", "2026-01-01T18:00:00Z", 300.0)])
    got = {r.merchant_id: r.reconciliation_status for r in rc.reconcile(p, s).collect()}
    assert got == {"merch_1": "reconciled", "merch_2": "awaiting_settlement"}


def test_four_statuses(spark):
    p = _pays(spark, [(f"m{i}", "2026-01-01 10:00:00", 100) for i in range(4)])
    s = _settles(spark, [("m0", "2026-01-01T00:00:00Z", 100.0), ("m1", "2026-01-01T00:00:00Z", 100.005),
                         ("m2", "2026-01-01T00:00:00Z", 99.0)])
    got = {r.merchant_id: r.reconciliation_status for r in rc.reconcile(p, s).collect()}
    assert got == {"m0": "reconciled", "m1": "reconciled_within_tolerance",
                   "m2": "discrepancy_flagged", "m3": "awaiting_settlement"}


def test_decimal_tolerance_is_exact(spark):
    p = _pays(spark, [("m", "2026-01-01 10:00:00", "100.00")])
    s = _settles(spark, [("m", "2026-01-01T00:00:00Z", 99.99)])
    assert rc.reconcile(p, s).first().reconciliation_status == "reconciled_within_tolerance"


def test_settlement_lag(spark):
    p = rc.daily_payments(_pays(spark, [("m", "2026-01-01 10:00:00", 1), ("m", "2026-01-03 10:00:00", 1),
                                        ("m", "2026-01-09 10:00:00", 1)]))
    s = rc.daily_settlements(_settles(spark, [("m", "2026-01-03T00:00:00Z", 1.0),
                                              ("m", "2026-01-05T00:00:00Z", 1.0)]))
    r = rc.settlement_lag(p, s).first()
    assert (r.payment_days, r.unsettled_days, r.max_lag_days, r.total_lag_days) == (3, 1, 2, 2)


# ------------------------------------------------------------------ gold
def test_daily_summary(spark):
    df = spark.createDataFrame(
        [("t1", "m1", "c1", Decimal("100"), datetime(2026, 1, 1, 1)),
         ("t2", "m1", "c2", Decimal("200"), datetime(2026, 1, 1, 2)),
         ("t3", "m2", "c1", Decimal("50"), datetime(2026, 1, 1, 3))],
        "transaction_id string, merchant_id string, customer_id string, amount_decimal decimal(18,2),"
        " event_ts timestamp_ntz")
    got = {r.merchant_id: (float(r.total_amount), r.transaction_count, r.unique_customers)
           for r in go.daily_merchant_summary(df).collect()}
    assert got == {"m1": (300.0, 2, 2), "m2": (50.0, 1, 1)}


def test_building_plans_runs_no_job(spark):
    """Joins are planned without probing their inputs."""
    from ledgerlake.operators import reconcile as rc
    sc = spark.sparkContext
    kids = spark.range(50).selectExpr("cast(id % 5 AS string) AS ref", "id AS row")
    parents = spark.range(5).selectExpr("cast(id AS string) AS tx", "id AS v")
    pay = spark.createDataFrame([("t", "m", "c", Decimal("1.00"), datetime(2026, 3, 15))],
                                "transaction_id string, merchant_id string, customer_id string,"
                                " amount_decimal decimal(18,2), event_ts timestamp_ntz")
    sc.setJobGroup("plan-only", "plan-only")
    try:
        rc.parent_lookup(kids, parents, "ref", "tx")
        go.daily_merchant_summary(pay, spark.range(3).selectExpr("cast(id AS string) AS merchant_id", "id AS x"))
        fe.customer_features(pay)
        assert list(sc.statusTracker().getJobIdsForGroup("plan-only")) == []
    finally:
        sc._jsc.clearJobGroup()


def test_hour_boundary(spark):
    df = spark.createDataFrame([(datetime(2026, 1, 1, 0, 59, 59),), (datetime(2026, 1, 1, 1, 0, 0),)],
                               "ts timestamp_ntz")
    hours = sorted(r[0] for r in df.select(hour_of("ts")).collect())
    assert hours == [datetime(2026, 1, 1, 0), datetime(2026, 1, 1, 1)]


def test_top_currency_tie_goes_to_smallest(spark):
    df = spark.createDataFrame(
        [(f"t{i}", "m", f"c{i}", Decimal("1"), "USD" if i < 2 else "EUR", datetime(2026, 1, 1, i))
         for i in range(4)],
        "transaction_id string, merchant_id string, customer_id string, amount_decimal decimal(18,2),"
        " currency string, event_ts timestamp_ntz")
    assert go.daily_summary_top_currency(df).first().top_currency == "EUR"


# -------------------------------------------------------------- features
def _amounts(spark, rows):
    return spark.createDataFrame([(f"t{i}", "c", d, Decimal(str(a))) for i, (d, a) in enumerate(rows)],
                                 "transaction_id string, customer_id string, d date, amount decimal(18,2)")


def test_seven_day_exclusion(spark):
    df = _amounts(spark, [(date(2026, 1, 1), 100), (date(2025, 12, 24), 999)])
    r = fe.asof_totals(df, "customer_id", "d", "amount", "2026-01-01", [7]).first()
    assert float(r.total_7d) == 100.0


def test_sparse_ninety_days(spark):
    df = _amounts(spark, [(date(2026, 1, 1), 10), (date(2025, 12, 1), 20)])
    r = fe.asof_totals(df, "customer_id", "d", "amount", "2026-01-01", [90]).first()
    assert float(r.total_90d) == 30.0


def test_rolling_range_frame_inclusive(spark):
    base = datetime(2026, 1, 10, 12, 0, 0)
    from datetime import timedelta
    rows = [("a", "c", base - timedelta(days=7), Decimal("1")),          # exactly 7 days before: in
            ("b", "c", base - timedelta(days=7, seconds=1), Decimal("2")),  # one second more: out
            ("c", "c", base, Decimal("4")), ("d", "c", base, Decimal("8"))]  # peers in the same second
    df = spark.createDataFrame(rows, "transaction_id string, customer_id string, event_ts timestamp_ntz,"
                                     " amount_decimal decimal(18,2)")
    for method in ("window", "bucketed"):
        got = {r.transaction_id: (float(r.spend_7d), r.tx_count_7d)
               for r in fe.rolling_features(df, "customer_id", windows=[7], method=method).collect()}
        assert got["c"] == (13.0, 3) and got["d"] == (13.0, 3), method
        assert got["b"] == (2.0, 1), method


def test_bucketed_equals_window(spark):
    from tests.conftest import SF01
    from ledgerlake.sources import fixtures as fx
    valid, _ = cl.cleanse(fx.v_payments(spark, SF01))
    p = valid.select("transaction_id", "merchant_id", "customer_id", "event_ts", "amount_decimal")
    hot = p.withColumn("merchant_id", F.lit("hot"))      # every row on one key
    for df, key in ((p, "customer_id"), (hot, "merchant_id")):
        a = fe.rolling_features(df, key, method="window", prefix_avg="avg")
        for bucket in (3600, 86400, 7 * 3600 + 13):
            b = fe.rolling_features(df, key, method="bucketed", bucket_seconds=bucket, prefix_avg="avg")
            assert a.exceptAll(b.select(a.columns)).count() == 0
            assert b.count() == a.count()


def test_epoch_seconds(spark):
    df = spark.createDataFrame([(datetime(1970, 1, 2, 0, 0, 1, 500000),)], "ts timestamp_ntz")
    assert df.select(epoch_seconds("ts")).first()[0] == 86401


# --------------------------------------------------------------- quality
def test_referential_integrity_no_orphans(spark):
    gold = spark.createDataFrame([("m1",), ("m2",)], "merchant_id string")
    ref = spark.createDataFrame([("m1",), ("m2",), ("m3",)], "merchant_id string")
    r = qa.referential_integrity(gold, ref, "merchant_id", "merchant_id").first()
    assert (r.checked_keys, r.orphan_keys, r.passed) == (2, 0, True)


def test_null_rate_empty_table_is_zero(spark):
    df = spark.createDataFrame([], "a string")
    assert qa.null_rates(df, ["a"], "t").first().null_rate == 0.0


def test_sla_comparison(spark):
    from ledgerlake.plans.nightly import sla_comparison
    t = spark.createDataFrame([("a", "slow", 10.0), ("a", "optimized", 4.0), ("b", "slow", 10.0),
                               ("b", "optimized", 6.0)], "stage string, variant string, seconds double")
    got = {r.stage: round(r.improvement_pct, 6) for r in sla_comparison(t).collect()}
    assert got == {"a": 60.0, "b": 40.0, "TOTAL": 50.0}


def test_latest_features_equal_per_event_methods(spark):
    from tests.conftest import SF01
    from ledgerlake.sources import fixtures as fx
    valid, _ = cl.cleanse(fx.v_payments(spark, SF01))
    hot = valid.withColumn("merchant_id", F.lit("hot"))
    for fn, df in ((fe.customer_features, valid), (fe.merchant_features, valid),
                   (fe.merchant_features, hot)):
        a = fn(df, method="latest")
        for m in ("window", "bucketed"):
            b = fn(df, method=m)
            assert a.count() == b.count()
            assert a.exceptAll(b.select(a.columns)).count() == 0, m


def test_timestamp_offset_forms(spark):
    df = spark.createDataFrame([("2026-03-15T08:00:00-0200",), ("2026-03-15T12:30:00.5+02:30",),
                                ("2026-03-15",), ("2026-03-15T10:00:00",)], "s string")
    got = [r[0] for r in df.select(parse_event_ts("s")).collect()]
    assert got == [datetime(2026, 3, 15, 10), datetime(2026, 3, 15, 10, 0, 0, 500000),
                   datetime(2026, 3, 15), datetime(2026, 3, 15, 10)]


def test_default_report_date_and_checkpoint_path():
    from ledgerlake.plans.nightly import default_report_date
    from ledgerlake.streaming import checkpoint_path

    class L:
        root = "s3a://lake"
    assert default_report_date(date(2026, 3, 1)) == "2026-02-28"
    assert checkpoint_path(L, "kafka_payments", "bronze_events") == "s3a://lake/_checkpoints/kafka_payments__bronze_events"


def test_synthetic_daily_spread_and_references(spark):
    from ledgerlake.sources.synthetic import day_weights, synthetic_events
    cum = day_weights(30, 42)
    shares = [b - a for a, b in zip([0.0] + cum[:-1], cum)]
    assert abs(cum[-1] - 1.0) < 1e-12
    assert 0.8 / 30 / 1.01 < min(shares) and max(shares) < 1.2 / 30 * 1.01 and max(shares) / min(shares) > 1.2
    ev = synthetic_events(spark.range(60000), "id", "2026-01-31", days_back=30)
    pay = ev.filter(F.col("event_type") == "payment_created")
    per_day = [r[1] for r in pay.groupBy(F.substring("timestamp", 1, 10)).count().collect()]
    assert len(per_day) == 30 and max(per_day) / min(per_day) > 1.15
    kids = ev.filter(F.col("original_tx_id").isNotNull()).select("original_tx_id")
    parents = pay.select(F.col("transaction_id").alias("parent_tx"))
    assert kids.join(parents, kids.original_tx_id == parents.parent_tx, "left_anti").count() == 0
    mix = {r[0]: r[1] for r in ev.groupBy("event_type").count().collect()}
    total = sum(mix.values())
    assert abs(mix["payment_created"] / total - 0.80) < 0.01
    assert abs(mix["refund_initiated"] / total - 0.10) < 0.01
    assert abs(mix["chargeback_filed"] / total - 0.02) < 0.005
    assert abs(mix["settlement_processed"] / total - 0.08) < 0.01


def test_synthetic_isoformat_z_suffix_ingests(spark):
    from ledgerlake.sources.synthetic import synthetic_events
    ev = synthetic_events(spark.range(500), "id", "2026-01-31", days_back=3, ts_suffix="+00:00Z")
    assert ev.first().timestamp.endswith("+00:00Z")
    routed = ig.ingest_frame(ev)
    assert routed.filter(F.col("event_ts").isNull()).count() == 0
    assert routed.filter(F.col("target_table") == "dead_letter").count() == 0


@pytest.mark.parametrize("aqe", ["true", "false"])
def test_salted_join_equals_plain_join_with_hot_and_null_keys(spark, aqe):
    from ledgerlake.functions.skew import hot_keys, salted_join
    many = spark.range(4000).select(
        F.when(F.col("id") % 4 == 0, F.lit("hot")).when(F.col("id") % 4 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 997).cast("string"))).alias("ref"), F.col("id").alias("row"))
    one = spark.createDataFrame([("hot", 1), (None, 9)] + [(f"k{i}", i) for i in range(0, 997, 2)], "key string, v int")
    spark.conf.set("spark.sql.adaptive.enabled", aqe)
    try:
        assert [r[0] for r in hot_keys(many, "ref", 0.01).collect()] == ["hot"]
        for how in ("left", "inner", "left_anti", "left_semi"):
            plain = many.join(one, many.ref == one.key, how)
            salted = salted_join(many, one, "ref", "key", how, salts=8, share=0.01)
            assert salted.columns == plain.columns
            key = lambda r: str(tuple(r))
            assert sorted(map(key, salted.collect())) == sorted(map(key, plain.collect())), how
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_salting_spreads_a_hot_key(spark):
    """With AQE off and no broadcast join, no task holds much more than its share."""
    from ledgerlake.functions.skew import salted_join
    many = spark.range(40_000).select(F.when(F.col("id") % 2 == 0, F.lit("hot")).when(F.col("id") % 8 == 1, F.lit(None))
                                      .otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("ref"),
                                      F.col("id").alias("row"))
    one = spark.range(40_000).selectExpr("concat('k', id) AS key", "id AS v").unionByName(
        spark.createDataFrame([("hot", 1)], "key string, v long"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = salted_join(many, one, "ref", "key", "inner")
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) < 2 * sum(sizes) / len(sizes) and len(sizes) == 8
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
