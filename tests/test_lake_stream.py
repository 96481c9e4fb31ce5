"""Writes (W1-W4, W7), streaming (T1-T5), maintenance (M1, M5), e2e."""
import os
import tempfile
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import maintenance as mt
from ledgerlake.operators.upsert import upsert_frames
from tests.conftest import SF01, SF001


def _rows(spark, n, start=0, extra=False):
    df = spark.range(start, start + n).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"),
                                              F.lit("2026-01-01").cast("date").alias("d"))
    return df.withColumn("extra_col", F.lit("x")) if extra else df


def test_append_with_new_column(spark, lake):
    lake.append(_rows(spark, 1), "bronze", "t")
    lake.append(_rows(spark, 1, 1, extra=True), "bronze", "t")
    df = lake.read("bronze", "t", merge_schema=True)
    assert "extra_col" in df.columns and df.count() == 2


def test_two_writers(spark, lake):
    for n, s in ((1, 0), (10, 1), (10, 11)):
        lake.append(_rows(spark, n, s), "bronze", "t")
    assert lake.read("bronze", "t").count() == 21


def test_replace_partitions_keeps_others(spark, lake):
    a = _rows(spark, 5)
    b = _rows(spark, 3, 100).withColumn("d", F.lit("2026-01-02").cast("date"))
    lake.overwrite(a.unionByName(b), "gold", "t", ["d"])
    lake.replace_partitions(_rows(spark, 2, 500), "gold", "t", ["d"])
    got = {str(r.d): r["count"] for r in lake.read("gold", "t").groupBy("d").count().collect()}
    assert got == {"2026-01-01": 2, "2026-01-02": 3}


def test_upsert_insert_update_and_idempotent(spark, lake):
    lake.upsert(_rows(spark, 5), "silver", "t", ["k"], partition_by=["d"])
    src = _rows(spark, 4, 3).withColumn("v", F.col("v") + 1)
    lake.upsert(src, "silver", "t", ["k"], partition_by=["d"])
    once = sorted(map(tuple, lake.read("silver", "t").select("k", "v").collect()))
    lake.upsert(src, "silver", "t", ["k"], partition_by=["d"])
    twice = sorted(map(tuple, lake.read("silver", "t").select("k", "v").collect()))
    assert once == twice == [(0, 0), (1, 10), (2, 20), (3, 31), (4, 41), (5, 51), (6, 61)]


def test_upsert_rejects_duplicate_source_keys(spark, lake):
    lake.upsert(_rows(spark, 2), "silver", "t", ["k"])
    with pytest.raises(ValueError):
        lake.upsert(_rows(spark, 2).unionByName(_rows(spark, 2)), "silver", "t", ["k"])


def test_upsert_update_subset_of_columns(spark):
    t = spark.createDataFrame([(1, "a", 10)], "k int, s string, v int")
    s = spark.createDataFrame([(1, "b", 20), (2, "c", 30)], "k int, s string, v int")
    got = sorted(map(tuple, upsert_frames(t, s, ["k"], ["v"]).collect()))
    assert got == [(1, "a", 20), (2, "c", 30)]


def test_delete_where(spark, lake):
    a = _rows(spark, 5)
    b = _rows(spark, 3, 100).withColumn("d", F.lit("2026-01-02").cast("date"))
    lake.overwrite(a.unionByName(b), "gold", "t", ["d"])
    assert lake.delete_where("gold", "t", F.col("d") == F.lit("2026-01-02").cast("date"), ["d"]) == 3
    assert lake.delete_where("gold", "t", F.col("k") < 2, ["d"]) == 2
    assert sorted(r.k for r in lake.read("gold", "t").collect()) == [2, 3, 4]


def test_read_or_empty(spark, lake):
    from ledgerlake.schemas import SETTLEMENT_SCHEMA
    df = lake.read_or_empty("bronze", "missing", SETTLEMENT_SCHEMA)
    assert df.count() == 0 and df.schema == SETTLEMENT_SCHEMA


def test_compaction_fewer_files_same_rows(spark, lake):
    for i in range(5):
        lake.append(_rows(spark, 1, i), "silver", "t")
    before = lake.file_count("silver", "t")
    r = mt.optimize_table(lake, "silver", "t", ["k"])
    assert r["after"] <= before and r["rows"] == 5
    r2 = mt.optimize_table(lake, "silver", "t")
    assert r2["rows"] == 5 and lake.read("silver", "t").count() == 5


def test_optimize_registry_skips_missing(spark, lake):
    lake.append(_rows(spark, 3), "gold", "a")
    out = mt.optimize_tables(lake, [("gold", "a", ("k",), ()), ("gold", "missing", (), ())])
    assert list(out) == ["gold.a"]


def test_clustering_improves_file_skipping(spark):
    """Files whose (min, max) of a key covers a probe value: fewer after clustering."""
    li = spark.read.parquet(f"{SF01}/lineitem.parquet")
    def spans(df):
        per = df.withColumn("p", F.spark_partition_id()).groupBy("p").agg(
            F.min("l_suppkey").alias("lo"), F.max("l_suppkey").alias("hi")).collect()
        return sum(1 for r in per if r.lo <= 50 <= r.hi)
    shuffled = li.repartition(16)
    clustered = mt.cluster(li, ["l_suppkey", "l_orderkey"], 16)
    assert spans(clustered) < spans(shuffled)


def test_clustering_cuts_text_keys_and_a_hot_key(spark):
    rows = spark.range(20_000).select(F.when(F.col("id") % 2 == 0, F.lit("merch_hot"))
                                      .otherwise(F.concat(F.lit("merch_"), F.col("id") % 300)).alias("m"), "id")
    per = mt.cluster(rows, ["m"], 16).groupBy(F.spark_partition_id()).agg(
        F.count(F.lit(1)).alias("n"), F.min("m").alias("lo"), F.max("m").alias("hi")).collect()
    assert max(r.n for r in per) < 3 * 20_000 / 16
    assert sum(r.lo <= "merch_17" <= r.hi for r in per) <= 2


def test_optimize_keeps_partitions(spark, lake):
    a = _rows(spark, 40)
    lake.overwrite(a.unionByName(a.withColumn("d", F.lit("2026-01-02").cast("date"))), "gold", "t", ["d"])
    mt.optimize_tables(lake, [("gold", "t", ("k",), ("d",))])
    lake.replace_partitions(a.withColumn("d", F.lit("2026-01-03").cast("date")), "gold", "t", ["d"])
    assert {str(r.d): r["count"] for r in lake.read("gold", "t").groupBy("d").count().collect()} == {
        "2026-01-01": 40, "2026-01-02": 40, "2026-01-03": 40}


def test_staged_folders_go_and_emptied_partitions_too(spark, lake):
    a = _rows(spark, 4)
    lake.overwrite(a, "silver", "t", ["d"])
    moved = a.filter("k < 4").withColumn("d", F.lit("2026-01-02").cast("date"))
    both = moved.unionByName(a.limit(0))
    lake.upsert(both, "silver", "t", ["k"], partition_by=["d"])      # the old day is not touched by the source
    keys = a.select("k", "d")
    assert lake.delete_keys("silver", "t", keys, ["d"]) == 4
    assert lake.delete_keys("silver", "t", keys, ["d"]) == 0
    assert {str(r.d) for r in lake.read("silver", "t").select("d").distinct().collect()} == {"2026-01-02"}
    from ledgerlake.session import checkpoint_dir
    fs, p = lake._fs(checkpoint_dir(spark))
    left = [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []
    assert not [n for n in left if n.startswith("stage-")]


def test_upsert_null_safe_keys(spark):
    t = spark.createDataFrame([(None, 1), ("a", 2)], "k string, v int")
    s = spark.createDataFrame([(None, 5)], "k string, v int")
    assert sorted(map(str, upsert_frames(t, s, ["k"], null_safe=True).collect())) == [
        "Row(k='a', v=2)", "Row(k=None, v=5)"]
    assert upsert_frames(t, s, ["k"]).count() == 3


def test_stream_restart_does_not_duplicate(spark):
    from ledgerlake.lake import Lake
    from ledgerlake.plans.catalog import wire_from
    from ledgerlake.sources import fixtures as fx
    from ledgerlake.streaming import start_bronze_stream, stream_source
    src_dir = tempfile.mkdtemp(prefix="ll-src-", dir="/tmp")
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    ev.repartition(3).write.mode("overwrite").parquet(src_dir)
    lake = Lake(spark, tempfile.mkdtemp(prefix="ll-lake-", dir="/tmp"))
    ckpt = f"{lake.root}/_checkpoints/bronze_events"
    def run():
        src = stream_source(spark, "parquet", src_dir, ev.schema, maxFilesPerTrigger="1")
        start_bronze_stream(lake, src, ckpt,
                            prepare=lambda b: wire_from(fx.events_as_payments(b))).awaitTermination()
    run()
    n1 = lake.read("bronze", "events").count()
    audit = lake.read("bronze", "ingest_audit")
    assert audit.count() == 3 and audit.agg(F.sum("consumed")).first()[0] == ev.count()
    run()                                   # same checkpoint: nothing new is read
    assert lake.read("bronze", "events").count() == n1 == ev.count()


def test_stream_batch_replay_is_idempotent(spark):
    from ledgerlake.lake import Lake
    from ledgerlake.streaming import bronze_batch_writer
    lake = Lake(spark, tempfile.mkdtemp(prefix="ll-lake-", dir="/tmp"))
    w = bronze_batch_writer(lake)
    batch = spark.createDataFrame(
        [('{"event_type":"payment_created","transaction_id":"t","merchant_id":"m","amount":1.0,'
          '"timestamp":"2026-01-01T00:00:00Z"}',)], "value string")
    w(batch, 7)
    w(batch, 7)                              # replay of batch 7 after a failure
    w(spark.createDataFrame([], "value string"), 8)   # empty batch skipped
    assert lake.read("bronze", "events").count() == 1


def test_hourly_stream_extension(spark):
    from ledgerlake.streaming import hourly_volume_stream
    src_dir = tempfile.mkdtemp(prefix="ll-src-", dir="/tmp")
    rows = [("t1", "USD", "us-east", Decimal("1.00"), datetime(2026, 1, 1, 0, 10)),
            ("t1", "USD", "us-east", Decimal("1.00"), datetime(2026, 1, 1, 0, 10)),
            ("t2", "USD", "us-east", Decimal("2.00"), datetime(2026, 1, 1, 0, 50)),
            ("t3", "USD", "us-east", Decimal("4.00"), datetime(2026, 1, 1, 5, 0))]
    schema = ("transaction_id string, currency string, region string, amount_decimal decimal(18,2),"
              " event_ts timestamp_ntz")
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(src_dir)
    out_dir = tempfile.mkdtemp(prefix="ll-out-", dir="/tmp")
    q = (hourly_volume_stream(spark.readStream.schema(schema).parquet(src_dir))
         .writeStream.outputMode("append").format("parquet").option("path", f"{out_dir}/data")
         .option("checkpointLocation", f"{out_dir}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.read.parquet(f"{out_dir}/data").collect()
    # the 00:00 hour is closed by the watermark: t1 counted once, t2 once.
    assert [(r.transaction_count, float(r.total_volume)) for r in got] == [(2, 3.0)]


def test_nightly_end_to_end(spark, lake):
    from ledgerlake.plans.catalog import wire_events
    from ledgerlake.plans.nightly import ingest_batch, run_nightly
    from ledgerlake.sources.synthetic import merchant_reference, synthetic_events
    lake.overwrite(merchant_reference(spark, 500), "bronze", "merchant_reference")
    ev = synthetic_events(spark.range(4000), "id", "2026-01-31", days_back=3)
    counts = ingest_batch(lake, ev, batch_id=1)
    assert counts["raw_payments"] == 4000 and counts["dead_letter"] == 0
    assert ingest_batch(lake, ev, batch_id=1) == counts          # replay: no duplicates
    assert lake.read("bronze", "events").count() == sum(counts.values())
    clock = F.lit("2026-02-01 00:00:00").cast("timestamp")
    out = run_nightly(lake, "2026-01-29", "r1", clock=clock)
    assert out["silver_cleanse"]["records_processed"] > 0
    assert out["reconciliation"]["reconciled"] + out["reconciliation"]["discrepancies"] \
        + out["reconciliation"]["awaiting_settlement"] > 0
    assert out["gold_aggregation"]["merchant_summary_records"] > 0
    assert out["merchant_analytics"]["records"] > 0
    assert out["feature_store"]["customer_features"] > 0
    again = run_nightly(lake, "2026-01-29", "r1", clock=clock)     # rerun is idempotent
    assert lake.read("gold", "daily_merchant_summary").count() == \
        out["gold_aggregation"]["merchant_summary_records"]
    assert again["silver_cleanse"]["records_processed"] == out["silver_cleanse"]["records_processed"]
    assert lake.read("silver", "cleansed_transactions").count() == \
        out["silver_cleanse"]["records_processed"]
    # a second day accumulates, the first stays
    run_nightly(lake, "2026-01-30", "r2", clock=clock)
    days = {str(r[0]) for r in lake.read("gold", "daily_merchant_summary").select("report_date").distinct().collect()}
    assert days == {"2026-01-29", "2026-01-30"}


def test_nightly_with_json_wire_and_optimize(spark, lake):
    from ledgerlake.plans.catalog import wire_events
    from ledgerlake.plans.nightly import ingest_batch, run_gold
    c = ingest_batch(lake, wire_events(spark, SF001), batch_id=1, raw_json=True)
    assert c["raw_payments"] > 0 and c["dead_letter"] > 0
    from ledgerlake.plans.nightly import run_silver_cleanse
    r = run_silver_cleanse(lake, None, "all")
    assert r["quarantined"] > 0
    g = run_gold(lake, "2024-01-15", optimize=True)
    assert g["merchant_summary_records"] > 0


def test_versioned_table_time_travel(spark, lake):
    from ledgerlake.operators.history import VersionedTable
    vt = VersionedTable(lake, "silver", "accounts", ["k"])
    v0 = spark.createDataFrame([(1, "original")], "k int, note string")
    assert vt.commit(v0) == 0
    v1 = spark.createDataFrame([(1, "original"), (2, "new")], "k int, note string")
    assert vt.commit(v1) == 1
    v2 = spark.createDataFrame([(2, "changed")], "k int, note string")
    assert vt.commit(v2) == 2
    assert [tuple(r) for r in vt.as_of(0).collect()] == [(1, "original")]
    assert sorted(map(tuple, vt.as_of(1).collect())) == [(1, "original"), (2, "new")]
    assert sorted(map(tuple, vt.as_of().collect())) == [(2, "changed")]
    h = {r.version: (r.inserted, r.updated, r.deleted) for r in vt.history().collect()}
    assert h == {0: (1, 0, 0), 1: (1, 0, 0), 2: (0, 1, 1)}


def test_text_stream_of_json_equals_batch_routing(spark):
    from ledgerlake.lake import Lake
    from ledgerlake.operators.ingest import decode_events, ingest_frame
    from ledgerlake.plans.catalog import wire_events
    from ledgerlake.streaming import start_bronze_stream, stream_source
    src_dir = tempfile.mkdtemp(prefix="ll-json-", dir="/tmp")
    wire = wire_events(spark, SF001)
    wire.repartition(4).write.mode("overwrite").text(src_dir)
    lake = Lake(spark, tempfile.mkdtemp(prefix="ll-lake-", dir="/tmp"))
    src = stream_source(spark, "text", src_dir, maxFilesPerTrigger="2")
    start_bronze_stream(lake, src, f"{lake.root}/_checkpoints/json").awaitTermination()
    got = {(r.target_table, r.reject_reason): r["count"]
           for r in lake.read("bronze", "events").groupBy("target_table", "reject_reason").count().collect()}
    want = {(r.target_table, r.reject_reason): r["count"]
            for r in ingest_frame(decode_events(wire)).groupBy("target_table", "reject_reason").count().collect()}
    assert got == want


def test_read_event_files(spark):
    from ledgerlake.operators.ingest import ingest_frame
    from ledgerlake.plans.catalog import wire_events
    from ledgerlake.sources import read_event_files
    d = tempfile.mkdtemp(prefix="ll-json-", dir="/tmp")
    wire_events(spark, SF001).write.mode("overwrite").text(d)
    rows = read_event_files(spark, d, "json")
    assert rows.count() == 1000
    assert ingest_frame(rows).filter(F.col("target_table") == "raw_payments").count() > 0
    assert read_event_files(spark, d, "text").columns == ["value"]


def test_cluster_conf():
    from ledgerlake.session import cluster_conf
    c = cluster_conf(100 * 1024 ** 4, 8000)
    assert int(c["spark.sql.shuffle.partitions"]) == 819200
    assert c["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert int(cluster_conf(10 * 1024 ** 2, 8)["spark.sql.shuffle.partitions"]) == 16


def test_optimize_one_partition_only(spark, lake):
    a = _rows(spark, 40)
    b = _rows(spark, 30, 100).withColumn("d", F.lit("2026-01-02").cast("date"))
    for part in (a, b):      # fragmented input: 6 small files per date
        part.repartition(6).write.mode("append").partitionBy("d").parquet(lake.path("silver", "t"))
    before_other = lake.file_count("silver", "t", "d=2026-01-01")
    r = mt.optimize_table(lake, "silver", "t", ["k"], partition_by=["d"], where={"d": "2026-01-02"})
    assert r["before"] > r["after"] == 1 and r["rows"] == 30
    assert lake.file_count("silver", "t", "d=2026-01-01") == before_other
    assert lake.read("silver", "t").count() == 70


def test_hourly_stream_update_mode_merges_batches(spark):
    from ledgerlake.lake import Lake
    from ledgerlake.streaming.ingest import start_hourly_stream
    schema = ("transaction_id string, currency string, region string, amount_decimal decimal(18,2),"
              " event_ts timestamp_ntz")
    src_dir = tempfile.mkdtemp(prefix="ll-src-", dir="/tmp")
    b1 = [("t1", "USD", "us-east", Decimal("1.00"), datetime(2026, 1, 1, 0, 10))]
    b1 += [("n1", "USD", None, Decimal("3.00"), datetime(2026, 1, 1, 0, 20))]
    b2 = [("t1", "USD", "us-east", Decimal("1.00"), datetime(2026, 1, 1, 0, 10)),   # replayed
          ("t2", "USD", "us-east", Decimal("2.00"), datetime(2026, 1, 1, 0, 40)),   # same hour
          ("n2", "USD", None, Decimal("4.00"), datetime(2026, 1, 1, 0, 30))]        # no region, open hour
    for i, rows in enumerate((b1, b2)):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{src_dir}/b{i}")
    lake = Lake(spark, tempfile.mkdtemp(prefix="ll-lake-", dir="/tmp"))
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", "1") \
        .option("recursiveFileLookup", "true").parquet(src_dir)
    q = start_hourly_stream(lake, src, f"{lake.root}/_ckpt")
    q.awaitTermination()
    got = sorted((str(r.region), r.transaction_count, float(r.total_volume))
                 for r in lake.read("gold", "hourly_volume_live").collect())
    assert got == [("None", 2, 7.0), ("us-east", 2, 3.0)]
    from ledgerlake.streaming.ingest import late_rows
    assert late_rows(q) == 0


def test_cli_seed_nightly_optimize(spark):
    import json as _json
    import subprocess
    import sys as _sys
    root = tempfile.mkdtemp(prefix="ll-cli-", dir="/tmp")
    env = dict(os.environ, PYSPARK_SUBMIT_ARGS="--master local[2] --conf spark.ui.enabled=false pyspark-shell")
    run = lambda *a: subprocess.run([_sys.executable, "-m", "ledgerlake", "--root", root, *a],
                                    cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                                    env=env, capture_output=True, text=True, timeout=600)
    r = run("seed", "--events", "3000", "--days", "3", "--anchor", "2026-01-31")
    assert r.returncode == 0, r.stderr[-2000:]
    assert _json.loads(r.stdout.strip().splitlines()[-1])["raw_payments"] == 3000
    r = run("nightly", "--catchup")
    assert r.returncode == 0, r.stderr[-2000:]
    out = _json.loads(r.stdout.strip().splitlines()[-1])
    assert out["silver_cleanse"]["records_processed"] == 3000
    r = run("optimize")
    assert r.returncode == 0, r.stderr[-2000:]
    assert "silver.cleansed_transactions" in _json.loads(r.stdout.strip().splitlines()[-1])


def test_replace_partition_clears_a_date_that_became_empty(spark, lake):
    a = _rows(spark, 5)
    b = _rows(spark, 3, 100).withColumn("d", F.lit("2026-01-02").cast("date"))
    lake.overwrite(a.unionByName(b), "gold", "t", ["d"])
    assert lake.replace_partition(b.limit(0), "gold", "t", {"d": "2026-01-02"}) == 0
    assert {str(r.d) for r in lake.read("gold", "t").select("d").distinct().collect()} == {"2026-01-01"}
    assert lake.replace_partition(b.limit(1), "gold", "t", {"d": "2026-01-02"}) == 1
    assert lake.read("gold", "t").count() == 6
    with pytest.raises(ValueError):
        lake.replace_partition(a, "gold", "t", {"d": "2026-01-02"})
    assert lake.read("gold", "t").count() == 6          # untouched by the refused call


def test_reference_end_to_end_case(spark, lake):
    """800 payments and 8 settlements of 5,000 for merch_1 through every layer."""
    from ledgerlake.operators.ingest import conform
    from ledgerlake.plans.nightly import ingest_batch, run_nightly
    from ledgerlake.schemas import UNION_SCHEMA
    pays = [("payment_created", f"txn_{i}", "merch_1", f"cust_{i % 37}", 10.0 + i % 90, "USD",
             "stripe", "us-east", f"2026-03-15T{i % 24:02d}:{i % 60:02d}:00Z") for i in range(800)]
    pay_df = spark.createDataFrame(pays, "event_type string, transaction_id string, merchant_id string,"
                                         " customer_id string, amount double, currency string, gateway string,"
                                         " region string, timestamp string")
    st = spark.createDataFrame([("settlement_processed", f"batch_{i}", "merch_1", 5000.0, 100.0, 4900.0,
                                 "2026-03-15T23:00:00Z") for i in range(8)],
                               "event_type string, batch_id string, merchant_id string, gross_amount double,"
                               " fees double, net_amount double, timestamp string")
    ev = conform(pay_df, UNION_SCHEMA).unionByName(conform(st, UNION_SCHEMA))
    c = ingest_batch(lake, ev, 1)
    assert (c["raw_payments"], c["raw_settlements"]) == (800, 8)
    out = run_nightly(lake, "2026-03-15", "e2e", clock=F.lit("2026-03-16 00:00:00").cast("timestamp"))
    assert out["silver_cleanse"]["records_processed"] == 800
    assert out["reconciliation"]["discrepancies"] == 1          # 800 payments != 40,000 settled
    assert out["gold_aggregation"]["merchant_summary_records"] == 1
    assert out["gold_aggregation"]["hourly_volume_records"] == 24
    assert out["merchant_analytics"]["records"] == 1
    assert out["feature_store"] == {"customer_features": 37, "merchant_features": 1}
    led = lake.read("silver", "reconciliation_ledger").first()
    assert float(led.settled_amount) == 40000.0


def test_register_views_for_sql(spark, lake):
    lake.overwrite(_rows(spark, 3), "gold", "daily")
    lake.append(_rows(spark, 2), "silver", "tx", ["d"])
    assert lake.register_views("t_") == ["t_gold_daily", "t_silver_tx"]
    assert spark.sql("SELECT count(*) AS n FROM t_silver_tx").first().n == 2


def test_stages_accept_date_objects(spark, lake):
    from datetime import date as _date
    from ledgerlake.plans.nightly import ingest_batch, run_nightly
    from ledgerlake.sources.synthetic import synthetic_events
    ingest_batch(lake, synthetic_events(spark.range(500), "id", "2026-01-31", days_back=2), 1)
    out = run_nightly(lake, _date(2026, 1, 31), "d", clock=F.lit("2026-02-01 00:00:00").cast("timestamp"))
    assert out["gold_aggregation"]["merchant_summary_records"] > 0
