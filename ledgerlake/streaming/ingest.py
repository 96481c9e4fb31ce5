"""Micro-batch Bronze ingest.

``stream_source`` (S1) gives a streaming frame with a string ``value``
column (Kafka) or typed rows (file sources).  ``start_bronze_stream`` (T1)
runs decode -> validate -> route per micro-batch in ``foreachBatch`` (W8)
with an available-now trigger and a stable checkpoint (T4).  Each batch
is written under ``ingest_source=<name>/ingest_batch=<id>`` with dynamic
partition overwrite, so a batch replayed after a failure replaces its own
output instead of duplicating it, and batches of other sources stay; per-batch counters (T3) come from ``observe`` on that one
write, not from extra actions.
"""
from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.ingest import bronze_record, decode_events, ingest_frame
from ..schemas import DEAD_LETTER, MONEY

BRONZE_PARTITIONS = ["target_table", "year", "month", "day", "ingest_source", "ingest_batch"]


def stream_source(spark: SparkSession, fmt: str, path: str | None = None,
                  schema: StructType | None = None, **options) -> DataFrame:
    """``readStream`` of any format.  For ``kafka`` the value is cast to
    a string column ``value`` (the connector jar must be on the classpath;
    it is not in this build's test image)."""
    r = spark.readStream.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    for k, v in options.items():
        r = r.option(k, v)
    df = r.load(path) if path is not None else r.load()
    if fmt == "kafka":
        df = df.select(F.col("value").cast("string").alias("value"))
    return df


def kafka_source(spark: SparkSession, bootstrap_servers: str, topic: str,
                 starting_offsets: str = "earliest", fail_on_data_loss: bool = False) -> DataFrame:
    """Subscribe to ``topic`` from the earliest offsets, tolerating data
    loss, with the message value as a string column ``value``."""
    return stream_source(spark, "kafka", None, None, **{
        "kafka.bootstrap.servers": bootstrap_servers, "subscribe": topic,
        "startingOffsets": starting_offsets, "failOnDataLoss": str(fail_on_data_loss).lower()})


def checkpoint_path(lake, source: str, sink: str) -> str:
    """One stable checkpoint folder per (source, sink) on the lake's shared
    storage: a rerun resumes from committed offsets instead of re-reading."""
    return f"{lake.root}/_checkpoints/{source}__{sink}"


def bronze_batch_writer(lake, layer: str = "bronze", table: str = "events",
                        prepare: Callable[[DataFrame], DataFrame] | None = None,
                        raw_json: bool = True, audit_table: str = "ingest_audit",
                        source: str = "stream") -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function; ``source`` names the stream."""

    from ..plans.changes import observed_days, record_commits

    def process(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():                                    # T2
            return
        df = prepare(batch) if prepare is not None else batch
        if raw_json:
            df = decode_events(df)
        routed = bronze_record(ingest_frame(df), batch_id, source)
        obs = Observation()
        counted = routed.observe(
            obs, F.count(F.lit(1)).alias("consumed"),
            F.count_if(F.col("target_table") != DEAD_LETTER).alias("valid"),
            F.count_if(F.col("target_table") == DEAD_LETTER).alias("invalid"),
            observed_days().alias("days"))
        lake.replace_partitions(counted, layer, table, BRONZE_PARTITIONS)
        m = obs.get
        record_commits(lake, m["days"] or [], source, batch_id)
        audit = lake.spark.createDataFrame(
            [(source, int(batch_id), int(m["consumed"]), int(m["valid"]), int(m["invalid"]))],
            "ingest_source string, ingest_batch long, consumed long, valid long, invalid long")
        lake.replace_partitions(audit, layer, audit_table, ["ingest_source", "ingest_batch"])

    return process


def start_bronze_stream(lake, events: DataFrame, checkpoint: str, **writer_kw) -> StreamingQuery:
    """Start the ingest stream (available-now).  ``checkpoint`` must be a
    stable folder per (source, sink) on shared storage (T4).  Batch numbers
    restart with a new checkpoint, so the source is named after it unless
    ``source`` is given in ``writer_kw``."""
    writer_kw.setdefault("source", f"stream-{zlib.crc32(checkpoint.encode()):08x}")
    return (events.writeStream.foreachBatch(bronze_batch_writer(lake, **writer_kw))
                  .option("checkpointLocation", checkpoint)
                  .trigger(availableNow=True).start())


def hourly_volume_stream(payments: DataFrame, watermark: str = "2 hours",
                         ts: str = "event_ts") -> DataFrame:
    """T5 (extension): A2 as a stream.  Drops replayed ``transaction_id``s
    within the watermark and emits each hour x currency x region once, in
    append mode, after the watermark passes the hour.

    Watermarks need an instant (TIMESTAMP); the UTC wall-clock NTZ column
    maps to one through epoch microseconds, and the window start maps back,
    so no session time zone is involved.
    """
    epoch = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
    instant = F.timestamp_micros(F.timestamp_diff("MICROSECOND", epoch, F.col(ts)))
    return (payments.withColumn("_event_instant", instant)
                    .withWatermark("_event_instant", watermark)
                    .dropDuplicatesWithinWatermark(["transaction_id"])
                    .groupBy(F.window("_event_instant", "1 hour").alias("w"), "currency", "region")
                    .agg(F.count("transaction_id").alias("transaction_count"),
                         F.sum("amount_decimal").cast(MONEY).alias("total_volume"))
                    .select(F.timestamp_add("MICROSECOND", F.unix_micros(F.col("w.start")), epoch)
                             .alias("hour"), "currency", "region", "transaction_count", "total_volume"))


def start_hourly_stream(lake, payments: DataFrame, checkpoint: str, layer: str = "gold",
                        table: str = "hourly_volume_live", watermark: str = "2 hours",
                        state_partitions: int | None = None) -> StreamingQuery:
    """T5 sink: update mode + ``foreachBatch`` upsert on (hour, currency,
    region), NULL equal to NULL, in partitions of one day.  Every batch
    rewrites the days it changed, open hours included, and replaying a batch
    is a no-op.  Events later than the watermark do not enter the table;
    ``late_rows`` counts them, and the batch aggregate (A2) holds them.

    ``state_partitions`` fixes the number of state-store partitions when the
    stream is first started (it is then kept in the checkpoint); the query
    runs in a clone of the session, so the session's own setting is
    restored right after ``start()``."""
    keys = ["hour", "currency", "region"]

    def upsert(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            lake.upsert(batch.withColumn("day", F.to_date("hour")), layer, table, keys, partition_by=["day"],
                        check_unique=False, null_safe=True)

    writer = (hourly_volume_stream(payments, watermark).writeStream.outputMode("update")
              .foreachBatch(upsert).option("checkpointLocation", checkpoint)
              .trigger(availableNow=True))
    if state_partitions is None:
        return writer.start()
    conf = lake.spark.conf
    before = conf.get("spark.sql.shuffle.partitions")
    conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    try:
        return writer.start()
    finally:
        conf.set("spark.sql.shuffle.partitions", before)


def late_rows(query: StreamingQuery) -> int:
    """Rows that the query's watermark has dropped so far (of the progress kept)."""
    return sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)
