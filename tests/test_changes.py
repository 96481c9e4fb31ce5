"""Change propagation between nights and the key-to-day index."""
import os

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators.keyindex import KeyIndex
from ledgerlake.plans import changes as ch
from ledgerlake.plans import nightly as ni
from ledgerlake.plans import persisted as pe
from tests.conftest import SF001

TABLES = [("silver", "cleansed_transactions"), ("silver", "reconciliation_ledger"), ("silver", "dispute_registry"),
          ("gold", "daily_merchant_summary"), ("gold", "hourly_transaction_volume"), ("gold", "merchant_analytics"),
          ("gold", "reconciliation_report"), ("gold", "ml_feature_store_customers"),
          ("gold", "ml_feature_store_merchants")]


def _rows(lake, layer, table):
    df = lake.read(layer, table).drop("ingest_timestamp")
    return sorted(str([str(v) for v in r]) for r in df.select(*sorted(df.columns)).collect())


def test_nights_end_where_a_catch_up_does(spark):
    two_days = lambda day: day.isin(pe.REPORT_DATE, pe.NEXT_DATE)
    nightly, catchup = pe.moved_lakes(spark, SF001, ["nightly", "catchup"], two_days)
    for layer, table in TABLES:
        got = _rows(nightly, layer, table)
        assert got == _rows(catchup, layer, table), table
    assert ch.pending(nightly).count() == 0
    # nothing new: a rerun of either night changes no Silver row
    again = ni.run_nightly(nightly, pe.REPORT_DATE, "third", clock=pe._clock())
    assert again["silver_cleanse"]["dirty_days"] == [] and again["redone_days"] == [pe.REPORT_DATE]
    assert _rows(nightly, *TABLES[3]) == _rows(catchup, *TABLES[3])


def _payments(spark, rows):
    return spark.createDataFrame([("payment_created", i, "m1", "c1", 10.0, "USD", "us-east", t) for i, t in rows],
                                 "event_type string, transaction_id string, merchant_id string, customer_id string, "
                                 "amount double, currency string, region string, timestamp string")


def test_merge_reads_only_days_that_hold_its_keys(spark, lake):
    """The file of a day without a common key is overwritten with garbage:
    a merge that read it would fail."""
    ni.ingest_batch(lake, _payments(spark, [(f"a{i}", f"2024-01-1{i % 5} 08:00:00") for i in range(50)]), 1)
    assert ni.run_silver_cleanse(lake, None, "all")["dirty_days"] == [f"2024-01-1{i}" for i in range(5)]
    for day in ("2024-01-10", "2024-01-13"):
        folder = f"{lake.path('silver', 'cleansed_transactions')}/payment_date={day}"
        for f in os.listdir(folder):
            if f.endswith(".parquet"):
                os.chmod(f"{folder}/{f}", 0o644)
                with open(f"{folder}/{f}", "wb") as out:
                    out.write(b"not parquet")
    # a1 and a2 move to the 20th, z is new there; a11 (11th) only repeats an old time
    ni.ingest_batch(lake, _payments(spark, [("a1", "2024-01-20 01:00:00"), ("a2", "2024-01-20 01:00:00"),
                                            ("z", "2024-01-20 01:00:00"), ("a4", "2024-01-20 01:00:00")]), 2)
    done = ni.run_silver_cleanse(lake, "2024-01-20", "late")
    assert done["dirty_days"] == ["2024-01-11", "2024-01-12", "2024-01-14", "2024-01-20"]
    days = ni.silver_payments(lake).filter(F.col("payment_date").isin(
        *[F.lit(d).cast("date") for d in done["dirty_days"]]))
    got = {r[0]: (r[1], r[2]) for r in days.groupBy(F.col("payment_date").cast("string")).agg(
        F.count(F.lit(1)), F.count_distinct("transaction_id")).collect()}
    assert got == {"2024-01-11": (9, 9), "2024-01-12": (9, 9), "2024-01-14": (9, 9), "2024-01-20": (4, 4)}


def test_an_older_event_does_not_replace_a_newer_one(spark, lake):
    ni.ingest_batch(lake, _payments(spark, [("a", "2024-01-11 08:00:00"), ("b", "2024-01-11 08:00:00")]), 1)
    ni.run_nightly(lake, "2024-01-11", "n1", clock=pe._clock())
    ni.ingest_batch(lake, _payments(spark, [("a", "2024-01-10 08:00:00"), ("b", "2024-01-12 08:00:00")]), 2)
    out = ni.run_nightly(lake, "2024-01-10", "n2", clock=pe._clock())
    assert out["silver_cleanse"]["dirty_days"] == [] and out["redone_days"] == ["2024-01-10"]
    out = ni.run_nightly(lake, "2024-01-12", "n3", clock=pe._clock())
    assert out["redone_days"] == ["2024-01-11", "2024-01-12"]
    got = {(r.transaction_id, str(r.payment_date)) for r in ni.silver_payments(lake).collect()}
    assert got == {("a", "2024-01-11"), ("b", "2024-01-12")}


def test_a_failed_night_leaves_its_input_pending(spark, lake, monkeypatch):
    ni.ingest_batch(lake, _payments(spark, [("a", "2024-01-11 08:00:00")]), 1)
    monkeypatch.setattr(ni, "run_gold", lambda *a: 1 / 0)
    try:
        ni.run_nightly(lake, "2024-01-11", "n1")
    except ZeroDivisionError:
        pass
    assert ch.pending(lake).count() == 1 and ch.open_days(lake).count() == 0
    monkeypatch.undo()
    ni.run_nightly(lake, "2024-01-11", "n1")
    assert ch.pending(lake).count() == 0 and [r[0] for r in ch.open_days(lake).collect()] == ["2024-01-11"]
    assert lake.read("gold", "daily_merchant_summary").count() == 1


def test_key_index_finds_every_key_and_little_else(spark, lake):
    index = KeyIndex(lake, "k", "d", ["v"])
    rows = spark.range(4000).select(F.concat(F.lit("k"), "id").alias("k"),
                                    F.date_add(F.lit("2024-01-01"), (F.col("id") % 9).cast("int")).alias("d"),
                                    F.col("id").alias("v"))
    empty = index.lookup(rows)
    assert empty.count() == 0 and empty.columns == ["k", "d", "v"]
    index.add(rows)
    index.add(rows.limit(0))                                    # an empty run is not written
    newer = rows.filter("v < 100").withColumn("v", F.col("v") + 5000).withColumn("d", F.lit("2024-03-01").cast("date"))
    index.add(newer)
    index.add(rows.filter("v < 50"))                            # added again: older than what it holds
    asks = spark.range(20000).select(F.concat(F.lit("k"), F.col("id") + 2000).alias("k"), F.lit(None).cast("date").alias("d"),
                                     F.lit(0).cast("long").alias("v")).unionByName(rows.filter("v < 10"))
    asks = asks.unionByName(spark.createDataFrame([(None, None, 1)], "k string, d date, v long"))
    got = {r.k: (str(r.d), r.v) for r in index.lookup(asks).collect()}
    want = {r.k: (str(r.d), r.v) for r in rows.filter("v >= 2000").unionByName(newer.filter("v < 5010")).collect()}
    assert got == want
    maybe = index.candidates(asks).count()
    assert maybe <= 2000 + 20 + 0.02 * 3 * 20000                # held keys, and few false positives of three runs
    for _ in range(8):                                          # merged into one run, nothing lost
        index.add(rows.filter("v < 5"))
    assert len(index.runs()) <= 8
    assert {r.k: (str(r.d), r.v) for r in index.lookup(asks).collect()} == want


def test_key_index_reads_only_buckets_that_may_hold_a_key(spark, lake, monkeypatch):
    from ledgerlake.operators import keyindex
    monkeypatch.setattr(keyindex, "BUCKET_ROWS", 50)
    index = KeyIndex(lake, "k", "d", ["v"])
    rows = spark.range(2000).select(F.concat(F.lit("k"), "id").alias("k"), F.lit("2024-01-01").cast("date").alias("d"),
                                    F.col("id").alias("v"))
    index.add(rows)
    assert index.runs()[0].buckets == 40
    read = index.read_buckets(index.candidates(rows.filter("v = 7")))
    assert read.select("run", "bucket").distinct().count() == 1
    assert "PartitionFilters" in read._jdf.queryExecution().executedPlan().toString()


def test_windows_from_day_partials_equal_plain_windows(spark):
    """Events up to, on and just before the second a window begins at."""
    from ledgerlake.operators import features as fe
    secs = [0, 1, 7 * 86400 - 1, 7 * 86400, 7 * 86400 + 1, 30 * 86400, 30 * 86400 + 1, 90 * 86400, 90 * 86400 + 1,
            90 * 86400 - 3600, 12345, 86399, 86400]
    rows = [(f"t{e}-{s}", f"c{e}", "m", s * 7 + e * 3601, (s % 50) + 1) for e in range(5) for s in secs]
    rows += [("t-null", "c9", "m", 5, None)]
    pay = spark.createDataFrame(rows, "transaction_id string, customer_id string, merchant_id string, back long, a int") \
        .select("transaction_id", "customer_id", "merchant_id", F.col("a").cast("decimal(18,2)").alias("amount_decimal"),
                F.timestamp_add("SECOND", -F.col("back"), F.expr("TIMESTAMP_NTZ'2024-06-30 13:00:07'")).alias("event_ts"))
    pay = pay.unionByName(pay.withColumn("transaction_id", F.concat("transaction_id", F.lit("x")))
                             .withColumn("event_ts", F.timestamp_add("SECOND", F.lit(-7 * 86400 + 5), F.col("event_ts"))))
    kw = dict(prefix_sum="gmv", prefix_cnt="tx_count", prefix_avg="avg_ticket")
    for entity in ("customer_id", "merchant_id"):
        days = fe.entity_days(pay, entity)
        begins = fe.boundary_days(days, entity, (7, 30, 90))
        got = fe.windows_from_days(days, begins, pay, entity, (7, 30, 90), **kw)
        want = fe.windows_at_latest(pay, entity, windows=(7, 30, 90), **kw)
        assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))


def test_an_orphan_dispute_meets_its_late_payment(spark, lake):
    cb = spark.createDataFrame([("chargeback_filed", f"d{i}", f"a{i}", "m1", 10.0, "2024-01-11 09:00:00") for i in range(3)]
                               + [("chargeback_filed", "d9", None, "m1", 10.0, None)],
                               "event_type string, dispute_id string, original_tx_id string, merchant_id string, "
                               "dispute_amount double, timestamp string")
    ni.ingest_batch(lake, _payments(spark, [("a0", "2024-01-11 08:00:00")]), 1)
    ni.ingest_batch(lake, cb.filter("dispute_id <> 'd2'"), 1, source="disputes")
    ni.run_nightly(lake, "2024-01-11", "n1", clock=pe._clock())
    status = lambda: {r.dispute_id: r.registry_status for r in lake.read("silver", "dispute_registry").collect()}
    assert status() == {"d0": "matched", "d1": "orphan", "d9": "orphan"}
    ni.ingest_batch(lake, _payments(spark, [("a1", "2024-01-11 08:00:00"), ("a2", "2024-01-12 08:00:00")]), 2)
    ni.ingest_batch(lake, cb.filter("dispute_id = 'd2'"), 2, source="disputes")
    ni.run_nightly(lake, "2024-01-12", "n2", clock=pe._clock())
    assert status() == {"d0": "matched", "d1": "matched", "d2": "matched", "d9": "orphan"}
    report = {(str(r.payment_date), r.payment_total) for r in lake.read("gold", "reconciliation_report").collect()}
    assert {(d, float(a)) for d, a in report} == {("2024-01-11", 20.0), ("2024-01-12", 10.0)}


def test_dirty_days_outlive_a_failed_night(spark, lake, monkeypatch):
    ni.ingest_batch(lake, _payments(spark, [("a", "2024-01-11 08:00:00"), ("b", "2024-01-11 09:00:00")]), 1)
    ni.run_nightly(lake, "2024-01-11", "n1", clock=pe._clock())
    ni.ingest_batch(lake, _payments(spark, [("a", "2024-01-12 08:00:00")]), 2)
    monkeypatch.setattr(ni, "run_reconciliation", lambda *a: 1 / 0)
    try:
        ni.run_nightly(lake, "2024-01-12", "n2", clock=pe._clock())
    except ZeroDivisionError:
        pass
    monkeypatch.undo()
    again = ni.run_nightly(lake, "2024-01-12", "n2", clock=pe._clock())    # Silver has changed already
    assert again["silver_cleanse"]["dirty_days"] == [] and again["redone_days"] == ["2024-01-11", "2024-01-12"]
    got = {(str(r.report_date), r.transaction_count) for r in lake.read("gold", "daily_merchant_summary").collect()}
    assert got == {("2024-01-11", 1), ("2024-01-12", 1)}


def test_digest_feed_reads_only_differing_buckets(spark, lake):
    """All files of equal buckets are overwritten with garbage first."""
    from ledgerlake.operators import digest as di
    old = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("a"), F.lit(None).cast("string").alias("b"))
    new = old.filter("k <> 17").withColumn("a", F.when(F.col("k") == 400, 99).otherwise(F.col("a"))) \
        .unionByName(spark.createDataFrame([(9000, 1, "x")], old.schema))
    for name, df in (("old", old), ("new", new), ("same", old.repartition(3).orderBy(F.desc("k")))):
        di.write_snapshot(lake, df, "silver", name, ["k"], buckets=300)
    assert di.differing(lake, "silver", "old", "same") == []
    assert di.snapshot_feed(lake, "silver", "old", "same", ["k"]).count() == 0
    touched = {r[0] for r in spark.createDataFrame([(17,), (400,), (9000,)], "k long")
               .select(di.bucket_of(["k"], 300)).collect()}
    assert set(di.differing(lake, "silver", "old", "new")) == touched
    for name in ("old", "new"):
        for part in os.listdir(lake.path("silver", name)):
            if part.startswith("bucket=") and int(part[7:]) not in touched:
                for f in os.listdir(f"{lake.path('silver', name)}/{part}"):
                    if f.endswith(".parquet"):
                        with open(f"{lake.path('silver', name)}/{part}/{f}", "wb") as out:
                            out.write(b"not parquet")
    lake.read = lambda layer, table, schema=None, read=lake.read: read(
        layer, table, schema or (None if "digests" in table else "k long, a long, b string, bucket int"))
    feed = {r.k: (r.change_type, r.old_a, r.new_a) for r in di.snapshot_feed(lake, "silver", "old", "new", ["k"]).collect()}
    assert feed == {17: ("delete", 3, None), 400: ("update", 1, 99), 9000: ("insert", None, 1)}
    di.write_snapshot(lake, old, "silver", "wide", ["k"], buckets=8)
    with pytest.raises(ValueError):
        di.differing(lake, "silver", "old", "wide")


def test_changed_days_are_broadcast_and_settlements_parsed_once(spark):
    """Rows of the changed days are found without shuffling the payments or
    settlements by day, and a settlement's timestamp is parsed once."""
    from pyspark.sql import functions as F

    from ledgerlake.plans import incremental

    written = []

    class Lake:
        def replace_partitions(self, df, *a, **k):
            written.append(df)
            return 0

    pay = spark.createDataFrame([("m", "2024-01-05 10:00:00")] * 3 + [(None, None)], "merchant_id string, t string") \
        .select("merchant_id", F.col("t").cast("timestamp_ntz").alias("event_ts"),
                F.lit(5).cast("decimal(18,2)").alias("amount_decimal"))
    st = spark.createDataFrame([("m", "2024-01-05T11:00:00Z", 15.0), ("m", "never", 1.0), ("m", "2024-02-05T11:00:00Z", 1.0)],
                               "merchant_id string, timestamp string, gross_amount double")
    days = spark.createDataFrame([("2024-01-20",), (None,)], "d string").select(F.to_date("d").alias("payment_date"))
    incremental.refresh_ledger(Lake(), pay, st, days, monthly=True)
    plan = written[0]._jdf.queryExecution().executedPlan().toString()
    joins = [x for x in plan.split("\n") if "LeftSemi" in x]
    assert joins and all("BroadcastHashJoin" in x for x in joins)
    optimized = written[0]._jdf.queryExecution().optimizedPlan().toString()
    assert sum("endswith(timestamp" in x.lower() for x in optimized.split("\n") if "Project" in x or "Aggregate" in x) == 1
    assert [(r.merchant_id, str(r.payment_date), str(r.settled_amount), r.reconciliation_status)
            for r in written[0].collect()] == [("m", "2024-01-05", "15.00", "reconciled")]
