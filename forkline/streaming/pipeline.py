"""The live path: a stream of notifications into the signed tables."""

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from forkline import schemas
from forkline.operators import flatten
from forkline.sources import backfill, sequence
from forkline.sources.store import Store
from forkline.streaming.retry import with_retry


#: Bytes of notification files that one task takes, as far as their row groups allow.
SPLIT = 8 << 20


def ingest_batch(store: Store, batch: DataFrame, batch_id: int, time_unit: str = "s", daily: bool = True,
                 prefix: str = "st", **retry) -> None:
    """Write one micro-batch.  Rows of all four tables, those set aside, the daily partials and
    then the progress row.  A batch that is committed is left alone; one that is not is
    written anew."""
    name = f"{prefix}-{batch_id:012d}"
    if store.committed_by(name):
        return

    def write():
        also = {"reorg_events": lambda: batch.where(F.col("kind").isin("ChainReverted", "ChainReorged")).count()}
        if daily:
            timed = flatten.flatten_transactions(batch, time_unit, block_time=True)
            also["daily"] = lambda: store.append_daily(timed, name)
        good, seen = flatten.counted(batch, time_unit, schemas.WIDTHS)

        def quarantine():
            # the tables count what they leave out; the batch is read again only if there is any
            if not any(s.get["n"] for s in seen.values()):
                return 0
            return store.append_quarantine(flatten.set_aside(flatten.flatten(batch, time_unit), schemas.WIDTHS, batch)[1], name)
        store.write_batch(good, name, "stream", also=also, after={"quarantined": quarantine})

    with_retry(write, **retry)


def start(store: Store, notifications: DataFrame, checkpoint: str, processing_time: str | None = None,
          time_unit: str = "s", daily: bool = True, **retry) -> StreamingQuery:
    """Start ingesting.  Batches carry the id that Spark keeps in the checkpoint, so two
    streams, or one with a new checkpoint, never write each other's batches.  Without
    ``processing_time`` everything available is drained and the query ends; a trigger like
    ``"100 milliseconds"`` keeps it running.

    ``notifications`` may be a stream of notifications or one of ranges (``sequence.ranges``),
    whose batches come in the order of their numbers; that one takes a trigger, and
    ``sequence.drain`` ends it."""
    known = []
    by_number = sequence.is_ranges(notifications)

    def write(batch: DataFrame, batch_id: int) -> None:
        if not known:
            known.append(store.spark.read.json(f"{checkpoint.rstrip('/')}/metadata").first()["id"])
            # the stream's own copy of the session: a task's share of a batch does not grow with the batch
            batch.sparkSession.conf.set("spark.sql.files.maxPartitionBytes", SPLIT)
        rows = sequence.fetch(batch) if by_number else batch
        ingest_batch(store, rows, batch_id, time_unit, daily, f"st-{known[0]}", **retry)

    writer = notifications.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    trigger = {"processingTime": processing_time} if processing_time else {"availableNow": True}
    return writer.trigger(**trigger).start()


def backfill_then_live(store: Store, history: DataFrame, notifications: DataFrame, checkpoint: str,
                       check_missing: bool = True, **options) -> StreamingQuery:
    """Backfill all of ``history``, then follow ``notifications``.  Backfilled sequences lie
    below every live one, so live reorgs of backfilled heights win."""
    backfill.run(store, history, after=-1, check_missing=check_missing)
    return start(store, notifications, checkpoint, **options)
