"""Session settings."""

import re

from pyspark.sql import SparkSession

# What the results depend on, plus how skewed joins are treated.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot key even when the aggregate above the join then needs one more exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Spark 4.1 takes a union of joins as hash partitioned, which no longer holds once adaptive
    # execution re-plans one of the joins: aggregates over such a union lost rows
    "spark.sql.unionOutputPartitioning": "false",
}

TARGET_PARTITION_BYTES = 128 * 1024 * 1024


def apply_settings(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shuffle_partitions_for(input_bytes: int, cores: int) -> int:
    """Initial shuffle partitions for an input size; adaptive execution merges what turns out small."""
    return max(cores, -(-input_bytes // TARGET_PARTITION_BYTES))


def build_session(app_name: str = "retailoom", input_bytes: int | None = None, cores: int = 8, **conf) -> SparkSession:
    """A session for a batch run. ``conf`` takes further settings with ``_`` for ``.``."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    if input_bytes is not None:
        builder = builder.config("spark.sql.shuffle.partitions", shuffle_partitions_for(input_bytes, cores))
    for key, value in conf.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables that driver and executors share.

    It is what ``spark.checkpoint.dir`` names. Where that is unset and driver and executors are one process, as in tests,
    it is a folder of the warehouse; on a cluster a folder that may be each machine's own is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return (named or f"{spark.conf.get('spark.sql.warehouse.dir')}/_stored").rstrip("/")
