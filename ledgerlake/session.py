"""Session helpers: a local session for tests/bench and the checkpoint folder."""
from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: int = 8, shuffle_partitions: int = 8, driver_memory: str = "8g",
                  app: str = "ledgerlake") -> SparkSession:
    """Session for tests and the local bench (UI off, AQE on, UTC)."""
    return (SparkSession.builder.master(f"local[{cores}]").appName(app)
            .config("spark.ui.enabled", "false")
            .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
            .config("spark.sql.adaptive.enabled", "true")
            .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
            .config("spark.sql.adaptive.skewJoin.enabled", "true")
            .config("spark.driver.memory", driver_memory)
            .config("spark.sql.session.timeZone", "UTC")
            .getOrCreate())


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder for lineage cuts and staging tables.

    Order: the context's checkpoint dir, then ``spark.checkpoint.dir`` from
    the session conf, then ``fallback`` (a folder on the lake's own shared
    storage), then ``<spark.sql.warehouse.dir>/_checkpoints``.  The chosen
    folder is installed on the context only when none was set.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not d:
        d = fallback or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def cluster_conf(input_bytes: int, total_cores: int, target_partition_mb: int = 128) -> dict[str, str]:
    """Suggested settings for a run over ``input_bytes`` on ``total_cores``.

    Shuffle partitions start at about one per ``target_partition_mb`` of input
    (at least 2x cores) and AQE coalesces them at run time; AQE skew handling
    splits any shuffle partition more than 5x the median and over 256 MB.
    """
    mb = target_partition_mb
    parts = max(2 * total_cores, input_bytes // (mb * 1024 * 1024))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{mb}m",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.shuffle.partitions": str(int(parts)),
        "spark.sql.files.maxPartitionBytes": f"{mb}m",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    }


def apply_conf(spark: SparkSession, conf: dict[str, str]) -> None:
    for k, v in conf.items():
        spark.conf.set(k, v)
