"""Reorg-aware state and series computed on the stream itself.

None of them depends on the order in which rows arrive: what a stream emits are amounts that
add up, and a late row is one more amount.
"""

import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from forkline.operators.collapse import OWN
from forkline.session import rocksdb_state


def net_state(rows: DataFrame, keys: list) -> DataFrame:
    """Running net sign and newest committed row per key, for update mode.

    State is one row per key for as long as the query runs: there is no depth limit for
    reverts.  It lives in the state store, which spills to disk with RocksDB.
    """
    rest = [c for c in rows.columns if c not in keys and c not in OWN]
    return rows.groupBy(*keys).agg(
        F.sum("sign").alias("net"), F.max(F.when(F.col("sign") == 1, F.struct("seq", *rest))).alias("row"))


def start_current(rows: DataFrame, keys: list, path: str, checkpoint: str) -> StreamingQuery:
    """Upsert log of the current state: each micro-batch adds the new version of the keys
    it changed; :func:`read_current` takes the newest version of each."""
    def upsert(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("version", F.lit(batch_id).cast("bigint"))
         .write.mode("overwrite").parquet(f"{path}/batch={batch_id:012d}"))
    return (net_state(rows, keys).writeStream.outputMode("update").option("checkpointLocation", checkpoint)
            .foreachBatch(upsert).trigger(availableNow=True).start())


def read_versions(spark, path: str, keys: list) -> DataFrame:
    versions = spark.read.option("basePath", path).parquet(path).drop("batch")
    return (versions.groupBy(*keys).agg(F.max(F.struct("version", "net", "row")).alias("_v"))
            .select(*keys, F.col("_v.net").alias("net"), F.col("_v.row").alias("row")))


def read_current(spark, path: str, keys: list) -> DataFrame:
    latest = read_versions(spark, path, keys).where("net > 0")
    return latest.select(*keys, "row.*")


class OutcomeProcessor(StatefulProcessor):
    """Adds up the rows of one block; its key ends with the block's time in milliseconds.

    A timer at the block's time, which the watermark reaches once no revert is expected any
    more, emits the outcome.  A row that comes after that is emitted at once, as a correction
    to be added.  A second timer lets go of the state; rows later still are corrections as well.
    """

    def __init__(self, keep_ms: int):
        self.keep_ms = keep_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("outcome", "net bigint, seq bigint, final boolean")

    def _out(self, key, net, seq, late):
        return Row(block_number=key[0], hash=key[1], millis=key[2], net=net, seq=seq, late=late)

    def _settle(self, key):
        self.state.update((None, None, True))
        self.handle.registerTimer(key[2] + self.keep_ms)

    def handleInputRows(self, key, rows, timerValues):
        known = self.state.get() if self.state.exists() else None
        late = known[2] if known else timerValues.getCurrentWatermarkInMs() >= key[2]
        net, seq = (known[0], known[1]) if known and not late else (0, None)
        for r in rows:
            net += r["sign"]
            if r["sign"] == 1:
                seq = r["seq"] if seq is None else max(seq, r["seq"])
        if late:
            if not known:
                self._settle(key)
            yield self._out(key, net, seq, True)
            return
        if not known:
            # due as soon as the watermark is at the block's time
            self.handle.registerTimer(key[2] - 1)
        self.state.update((net, seq, False))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if not self.state.exists():
            return
        net, seq, final = self.state.get()
        if final:
            self.state.clear()
        else:
            self._settle(key)
            yield self._out(key, net, seq, False)

    def close(self) -> None:
        pass


OUTCOME = "block_number bigint, hash binary, millis bigint, net bigint, seq bigint, late boolean"


def outcomes(blocks: DataFrame, finality: str = "1 hour", keep_ms: int = 86_400_000) -> DataFrame:
    """Outcome of each block once the newest block is ``finality`` later, then corrections.

    Append mode.  The rows of a block add up: its net sign is the sum of ``net``, its newest
    commit the greatest ``seq`` (:func:`read_outcomes`), whatever came late and whatever state
    has been let go.
    """
    # the watermark column itself stays below, or rows behind the watermark would be dropped here
    rows = blocks.withWatermark("timestamp", finality).select(
        "block_number", "hash", F.unix_millis("timestamp").alias("millis"), F.col("sign").cast("bigint").alias("sign"), "seq")
    return rows.groupBy("block_number", "hash", "millis").transformWithState(
        OutcomeProcessor(keep_ms), OUTCOME, "append", "EventTime")


def start_append(rows: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Write what a stream emits, a folder per micro-batch that a replay writes anew."""
    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id:012d}")
    with rocksdb_state(rows.sparkSession):
        return (rows.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
                .foreachBatch(save).trigger(**(trigger or {"availableNow": True})).start())


def _folders(spark, path: str) -> DataFrame:
    return spark.read.option("basePath", path).parquet(path).drop("batch")


def read_outcomes(spark, path: str) -> DataFrame:
    """Outcome of each block so far; ``corrected`` tells whether a late row changed it."""
    return (_folders(spark, path).groupBy("block_number", "hash", "millis")
            .agg(F.sum("net").alias("net"), F.max("seq").alias("seq"), F.bool_or("late").alias("corrected")))


def block_series(blocks: DataFrame, interval: str = "5 minutes") -> DataFrame:
    """Tumbling series in which reverts subtract what their commits added."""
    return (blocks.groupBy(F.window("timestamp", interval).alias("w"))
            .agg(F.sum("sign").alias("blocks"), F.sum(F.col("sign") * F.col("gas_used")).alias("gas_used"))
            .select(F.col("w.start").alias("interval"), "blocks", "gas_used"))


def start_series(blocks: DataFrame, path: str, checkpoint: str, interval: str = "5 minutes", **trigger) -> StreamingQuery:
    """Write the series of each micro-batch by itself: no state, no watermark, no row too late."""
    def save(batch: DataFrame, batch_id: int) -> None:
        block_series(batch, interval).write.mode("overwrite").parquet(f"{path}/batch={batch_id:012d}")
    return (blocks.writeStream.option("checkpointLocation", checkpoint)
            .foreachBatch(save).trigger(**(trigger or {"availableNow": True})).start())


def read_series(spark, path: str) -> DataFrame:
    """The series so far: the parts of all micro-batches added up."""
    parts = _folders(spark, path)
    return parts.groupBy("interval").agg(*[F.sum(c).alias(c) for c in parts.columns if c != "interval"])


# executors need not have the package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
