"""Sources: fixture views over test tables, event decoding, synthetic events."""

from pyspark.sql import DataFrame, SparkSession


def read_event_files(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """S3 source: event files in the wire format.

    ``json`` reads with the declared union schema (no inference) and keeps
    malformed lines as rows (PERMISSIVE); ``text`` yields the raw ``value``
    column for ``decode_events``; anything else is read as typed rows.
    """
    from ..schemas import UNION_SCHEMA
    if fmt == "json":
        return spark.read.schema(UNION_SCHEMA).option("mode", "PERMISSIVE").json(path)
    if fmt == "text":
        return spark.read.text(path)
    return spark.read.format(fmt).load(path)
