"""Session defaults and the shared scratch folder."""

import uuid
from collections import Counter
from contextlib import contextmanager
from threading import Lock

from pyspark.sql import SparkSession

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# The engine relies on these; a cluster only has to size shuffle.partitions (the
# upper bound AQE coalesces from) to its data.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # a join on (height, sequence) may use tables that are bucketed by height alone
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    STATE_STORE: ROCKSDB,
}


def local_session(cpus="*", shuffle_partitions=8, memory="12g", **conf):
    """A local session with the engine's defaults, for tests and the benchmark."""
    builder = (SparkSession.builder.master(f"local[{cpus}]").appName("forkline")
               .config("spark.ui.enabled", "false")
               .config("spark.driver.memory", memory)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def rocksdb_state(spark):
    """Streams that start inside keep their state in RocksDB, whatever the session's default.

    ``transformWithState`` has no other store.  A query copies the session's settings when it
    starts, and one with a checkpoint goes by that, so the setting is put back at once.
    """
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(STATE_STORE) if before is None else spark.conf.set(STATE_STORE, before)


_inside, _before, _lock = Counter(), {}, Lock()


@contextmanager
def shuffles_removed(*sessions):
    """Writes inside remove their shuffle files as soon as they end.

    Otherwise these stay until the driver happens to collect its garbage, and the steps of a long
    job add up on the disks.  Threads may be inside together; the last one out puts the setting back.
    """
    found = {s._jsparkSession.toString(): s for s in sessions}
    with _lock:
        for name, spark in found.items():
            if not _inside[name]:
                _before[name] = spark.conf.get(SHUFFLE_CLEANUP, None)
                spark.conf.set(SHUFFLE_CLEANUP, "true")
            _inside[name] += 1
    try:
        yield
    finally:
        with _lock:
            for name, spark in found.items():
                _inside[name] -= 1
                if not _inside[name]:
                    del _inside[name]
                    before = _before.pop(name)
                    spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


def scratch_dir(spark, label):
    """A fresh folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``.  A local session, whose executors are
    the driver, may leave it unset: then it lies in the warehouse.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


def written(spark, df, label):
    """The rows as a table in the scratch folder: lineage ends there, a lost executor costs a reread."""
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
