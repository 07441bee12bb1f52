"""Session settings the operators assume, and the shared work folder."""

import os

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # A micro-batch stores the changes of its state, not the files that hold them, and both compactly.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
    "spark.sql.streaming.stateStore.compression.codec": "zstd",
}


def sized_for(input_bytes, cores, partition_bytes=256 * 1024 * 1024, most=None):
    """Settings for a batch over ``input_bytes``: shuffle partitions of about ``partition_bytes`` and
    at least two per core. ``most`` bounds their number, at the price of larger partitions. Adaptive execution joins
    what turns out small; it cannot split what was planned too coarse, but for skewed joins."""
    wanted = max(2 * cores, -(-input_bytes // partition_bytes))
    return {"spark.sql.shuffle.partitions": str(min(wanted, most or wanted)),
            "spark.sql.files.maxPartitionBytes": str(partition_bytes)}


def build_session(app="millrace", master=None, **settings):
    """A session with the settings above; keyword settings win (dots written as ``__``)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in settings.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def streaming_session(spark, partitions=None):
    """A sibling session for streaming queries.

    It shares the cluster but not the settings, so the state-store provider and the number of
    state partitions (fixed for the life of a checkpoint) leave the caller's session untouched.
    """
    session = spark.newSession()
    for key, value in SETTINGS.items():
        session.conf.set(key, value)
    session.conf.set("spark.sql.shuffle.partitions",
                     str(partitions or spark.sparkContext.defaultParallelism))
    return session


def work_folder(spark, name):
    """A fresh folder under the shared folder named by ``spark.checkpoint.dir``.

    Only a local session may do without that setting; it works beside its tables, in the warehouse.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        shared = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/millrace-work"
    return f"{shared.rstrip('/')}/{name}-{os.urandom(6).hex()}"
