"""Session settings the jobs are written for."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession

# Join skew is split at run time, also where the join feeds an aggregate on the same key. A
# join whose every build partition measures below the threshold is hashed instead of sorted.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    # A stored base has a dozen folders: a task writes them side by side instead of sorting for them.
    "spark.sql.maxConcurrentOutputFileWriters": "24",
}


_BLOCK_BYTES = 32 * 1024
_SPLIT_BYTES = 128 * 1024 * 1024
# A stored claim takes some 20 bytes of a file and 20 times that as a row: what a task reads, or gets
# from a shuffle after merging, is kept to so many bytes. Smaller sizes of the session stay.
_READ_BYTES = 16 * 1024 * 1024
_READ_CONF = (
    "spark.sql.files.maxPartitionBytes",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes",
)


def configure(spark: SparkSession, input_bytes: int | None = None) -> SparkSession:
    """Apply the run-time settings to a session.

    ``input_bytes``, the size of the claims, sizes the widest shuffle: as many partitions as
    keep its blocks (one per map and reduce task) at 32 KB, and splits of the same size on the
    map side. That is 58,000 partitions of 1.9 GB at 100 TB, 5,800 of 190 MB at 1 TB. A larger
    partition count of the session stays.
    """
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    to_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    for key in _READ_CONF:
        if to_bytes(spark.conf.get(key)) > _READ_BYTES:
            spark.conf.set(key, str(_READ_BYTES))
    if input_bytes is not None:
        partitions = math.ceil(math.sqrt(input_bytes / _BLOCK_BYTES))
        name = "spark.sql.shuffle.partitions"
        spark.conf.set(name, str(max(partitions, int(spark.conf.get(name)))))
        split = math.ceil(input_bytes / partitions)
        if split > _SPLIT_BYTES:
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    return spark


def input_bytes(*tables: DataFrame) -> int:
    """Size of what the tables are read from, as Spark's own statistics have it: for files, their
    length."""
    total = 0
    for t in tables:
        leaves = t._jdf.queryExecution().optimizedPlan().collectLeaves()
        for k in range(leaves.size()):
            total += int(str(leaves.apply(k).stats().sizeInBytes()))
    return total


def broadcasts(spark: SparkSession) -> bool:
    """Whether the session lets tables be broadcast; -1 as its threshold turns that off."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    return not threshold.startswith("-") and threshold.rstrip("bB") != "0"


def staging_root(spark: SparkSession) -> str:
    """Shared folder for stored steps: ``spark.checkpoint.dir`` of the session."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return folder
