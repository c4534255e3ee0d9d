"""Batch figures from Spark's own progress events, appended to the metrics table."""

from datetime import datetime, timezone
from threading import Lock

from pyspark.sql.streaming.listener import StreamingQueryListener

from forkline import schemas
from forkline.sources.store import Store


class ProgressListener(StreamingQueryListener):
    """Samples of every micro-batch, a few numbers each, none per row.  They go to the store's
    metrics table every ``every`` batches and when a query ends; what is held back is no more
    than that, and nothing is cut."""

    FIGURES = ("numInputRows", "batchDuration", "inputRowsPerSecond", "processedRowsPerSecond")

    def __init__(self, store: Store, every: int = 100):
        self.store, self.every = store, every
        self.rows, self.batches, self.ended, self.lock = [], 0, 0, Lock()

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        ts = datetime.fromisoformat(p.timestamp.replace("Z", "+00:00")).astimezone(timezone.utc)
        dropped = sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
        figures = {f: getattr(p, f, None) for f in self.FIGURES} | {"numRowsDroppedByWatermark": dropped}
        with self.lock:
            self.rows += [(ts, f"{p.name or p.id}.{k}", None, float(v)) for k, v in figures.items() if v is not None]
            self.batches += 1
            due = self.batches >= self.every
        if due:
            self.flush()

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self.flush()
        self.ended += 1

    def flush(self) -> None:
        """Write what is held back."""
        with self.lock:
            rows, self.rows, self.batches = self.rows, [], 0
        if rows:
            self.store.append_metrics(self.store.spark.createDataFrame(rows, schemas.METRICS))
