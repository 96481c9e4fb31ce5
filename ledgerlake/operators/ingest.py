"""Bronze: decode (S2), partition columns (C4), validate (C1/F1) and route."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import first_failure
from ..functions.scalars import parse_event_ts, partition_strings
from ..schemas import (BRONZE_TABLE, DEAD_LETTER, EVENT_KINDS, KIND_AMOUNT, KIND_KEY,
                       UNION_SCHEMA)


def decode_events(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """JSON text -> the 20 union columns, keeping ``raw_value``.

    ``decode_error`` is ``malformed_json`` when the text is not a JSON
    object, NULL otherwise; other columns of ``raw`` pass through.
    """
    keep = [c for c in raw.columns if c != value_col]
    d = F.from_json(F.col(value_col), UNION_SCHEMA, {"mode": "PERMISSIVE"})
    out = raw.select(*keep, F.col(value_col).alias("raw_value"), d.alias("_d"))
    malformed = F.col("raw_value").isNull() | F.json_object_keys("raw_value").isNull()
    return out.select(*keep, "raw_value", "_d.*",
                      F.when(F.col("event_type").isNull() & malformed, F.lit("malformed_json"))
                       .alias("decode_error"))


def add_partition_columns(df: DataFrame, ingest_ts: Column | None = None) -> DataFrame:
    """C4: ``event_ts``, zero-padded ``year``/``month``/``day`` and ``ingest_timestamp``.

    ``ingest_ts`` is injectable so reruns are reproducible; default is the
    query's current timestamp.
    """
    ts = ingest_ts if ingest_ts is not None else F.current_timestamp()
    with_ts = df.withColumn("event_ts", parse_event_ts("timestamp"))
    return with_ts.select("*", *partition_strings("event_ts"), ts.alias("ingest_timestamp"))


def _by_kind(mapping: dict[str, str]) -> Column:
    expr = None
    for kind, col in mapping.items():
        expr = (F.when(F.col("event_type") == kind, F.col(col)) if expr is None
                else expr.when(F.col("event_type") == kind, F.col(col)))
    return expr


def reject_reason(df: DataFrame) -> Column:
    """C1/F1 generalised to every kind; NULL when the event is valid.

    Order: decode error, unknown kind, missing key, missing merchant,
    missing amount, amount <= 0.
    """
    key = _by_kind(KIND_KEY)
    amt = _by_kind(KIND_AMOUNT)
    checks = []
    if "decode_error" in df.columns:
        checks.append(("malformed_json", F.col("decode_error").isNotNull()))
    checks += [
        ("unknown_event_type", ~F.coalesce(F.col("event_type").isin(list(EVENT_KINDS)), F.lit(False))),
        ("null_event_key", key.isNull()),
        ("null_merchant_id", F.col("merchant_id").isNull()),
        ("null_amount", amt.isNull()),
        ("non_positive_amount", amt <= 0),
    ]
    return first_failure(checks)


def route_events(df: DataFrame) -> DataFrame:
    """add ``reject_reason`` and ``target_table`` (bronze table or dead letter)."""
    with_reason = df.withColumn("reject_reason", reject_reason(df))
    target = F.when(F.col("reject_reason").isNotNull(), F.lit(DEAD_LETTER))
    for kind, tbl in BRONZE_TABLE.items():
        target = target.when(F.col("event_type") == kind, F.lit(tbl))
    return with_reason.withColumn("target_table", target)


def validate_payments(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid) payments by F1; complement via coalesce, not EXCEPT."""
    from ..functions.predicates import bronze_valid
    ok = bronze_valid()
    return df.filter(ok), df.filter(~ok)


def ingest_frame(events: DataFrame, ingest_ts: Column | None = None) -> DataFrame:
    """S3 without the write: partition columns + validation + routing."""
    return route_events(add_partition_columns(events, ingest_ts))


def conform(df: DataFrame, schema) -> DataFrame:
    """Schema enforcement: add missing columns as NULL, cast to the declared
    types, drop extras, keep declared order."""
    cols = []
    for f in schema.fields:
        c = F.col(f.name) if f.name in df.columns else F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def bronze_record(routed: DataFrame, batch_id: int, source: str = "batch") -> DataFrame:
    """The fixed Bronze row (``schemas.BRONZE_SCHEMA``) of a routed frame.

    The raw payload is kept only for dead letters (D3), so valid events are
    not stored twice.
    """
    from ..schemas import BRONZE_SCHEMA
    df = (routed.withColumn("ingest_source", F.lit(source))
                .withColumn("ingest_batch", F.lit(int(batch_id)).cast("long")))
    if "raw_value" in df.columns:
        df = df.withColumn("raw_value", F.when(F.col("target_table") == DEAD_LETTER, F.col("raw_value")))
    return conform(df, BRONZE_SCHEMA)
