"""Session settings the plans are tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Spark's own defaults are right for most of these; they are spelled out because the plans rely on
# them: adaptive execution coalesces small partitions, splits skewed join partitions and switches
# to a broadcast join once the real size of a shuffled side is known.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Building a wide plan makes thousands of column calls; recording a call site for each is slow.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    app_name: str = "shopscope", master: str | None = None, shuffle_width: int | None = None, **extra: str
) -> SparkSession:
    """A session with the settings above.

    ``shuffle_width`` is the number of partitions a shuffle begins with. Adaptive execution merges
    small ones but adds none, so on a cluster it should be the largest shuffled table's size over
    some 128 MB (100 TB: several hundred thousand), at least a few times the number of cores.
    """
    if shuffle_width is not None:
        extra = {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(shuffle_width), **extra}
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shuffle_width(spark: SparkSession) -> int:
    """The number of partitions that shuffles begin with."""
    fixed = spark.conf.get("spark.sql.shuffle.partitions")
    return int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) or fixed)
