"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

# Settings that the plans in this package count on. AQE splits skewed join
# partitions (also where that costs one more shuffle), joins a small side by
# broadcast only after its size is known, hashes instead of sorting where every
# partition of one side has turned out small, and merges small shuffle partitions.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.session.timeZone": "UTC",
    # up to so many keys are looked for by name, which the Bloom filters of a file answer
    "spark.sql.parquet.pushdown.inFilterThreshold": "1000",
    # repeated names in JSON are good, the last one counts
    "spark.sql.variant.allowDuplicateKeys": "true",
}

# Streaming state beyond one heap: RocksDB on local disk, changes uploaded to the checkpoint. All
# stores of an executor share one bound of memory, a join keeps one store per partition instead of
# four, and a put is no read before (which only counts rows for the progress report). Its files take
# no room ahead of what is in them, and are packed in larger blocks than by default.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "1000",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
    "spark.sql.streaming.stateStore.rocksdb.blockSizeKB": "32",
    "spark.sql.streaming.join.stateFormatVersion": "3",
}

# For a query that drains what is there in a batch or two. Its state is written once, as files of the
# store: a log of its changes would hold the same again. A task's store leaves the local disk when
# the task is done, as no batch or only a last one reads it again.
DRAIN_SETTINGS = {
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "false",
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}


def build_session(app: str = "tidemart", master: str | None = None, zone: str = "UTC",
                  rocksdb: bool = True, partitions: int | None = None,
                  **extra: str) -> SparkSession:
    """`partitions`: shuffle partitions, some 200 MB each for the largest shuffle. Batch jobs may
    start with far too many, as AQE merges them; a stream keeps the number it was started with.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**SETTINGS, **(STATE_SETTINGS if rocksdb else {}),
                "spark.sql.session.timeZone": zone, **extra}
    if partitions:
        settings["spark.sql.shuffle.partitions"] = str(partitions)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder below spark.checkpoint.dir, which every executor can reach.

    Only on one machine, where none is named, a local folder is set; executors of a cluster would
    each write to their own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.conf.get("spark.master", "local")):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="run-")
        spark.conf.set("spark.checkpoint.dir", root)
    run = spark.sql("SELECT uuid()").first()[0]
    return f"{root.rstrip('/')}/tidemart-{run}"
