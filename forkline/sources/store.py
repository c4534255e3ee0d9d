"""Signed tables on shared storage: atomic batches, compaction, maintained aggregates.

Layout under one root::

    <table>/batch=<id>/block_bucket=<n>/*.parquet     append-only change log
                                                      (blocks: month=<yyyymm>/block_bucket=<n>)
    progress/batch=<id>/*.parquet                     one row, written last
    <table>_current/gen=<id>/block_bucket=<n>/...     collapsed copies
    <table>_manifest/gen=<id>/...                     buckets a generation covers
    <table>_batches/gen=<id>/...                      batches of the log it has seen
    daily_sender_stats/batch=<id>/...                 additive partial rows
    quarantine/batch=<id>/...                         rows set aside, with the reason
    transactions_index/batch=<id>/prefix=<hex>/...    hash to height bucket
    coverage/batch=<id>/...                           ranges of heights
    metrics/...                                       samples, appended

A batch writes only its own folders and counts once its progress row exists, so a retried
or half-written batch never shows up twice or in part.  A batch that counts is never
written again.  Generations are numbered by the store.  The change log is never
rewritten: history of reverted blocks stays queryable after compaction.
"""

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, Window, functions as F, types as T

from forkline import schemas
from forkline.functions import timex
from forkline.operators import collapse as sign
from forkline.plans import catalog
from forkline.session import shuffles_removed
from forkline.sources import coverage

PROGRESS = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("lo", T.LongType()),
    T.StructField("hi", T.LongType()),
    T.StructField("rows", T.LongType()),
    T.StructField("committed_blocks", T.LongType()),
    T.StructField("reverted_blocks", T.LongType()),
    T.StructField("events", T.LongType()),
    T.StructField("reorg_events", T.LongType()),
    T.StructField("quarantined", T.LongType()),
    T.StructField("committed_at", T.TimestampType()),
])

QUARANTINE = T.StructType([
    T.StructField("table", T.StringType()),
    T.StructField("reason", T.StringType()),
    T.StructField("block_number", T.LongType()),
    T.StructField("sign", T.ByteType()),
    T.StructField("seq", T.LongType()),
    T.StructField("row", T.StringType()),
])

DAILY = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("address", T.BinaryType()),
    T.StructField("tx_count", T.LongType()),
    T.StructField("total_gas", T.LongType()),
    T.StructField("total_value", T.StringType()),
])


def write_options(name: str, compression: str = "zstd", max_records: int = 5_000_000, bulk: bool = True) -> dict:
    """Parquet options of a table: codec, file size bound and, in bulk files, bloom filters
    (sized to the data; the small files of a micro-batch are not worth them)."""
    out = {"compression": compression, "maxRecordsPerFile": str(max_records)}
    if bulk:
        out["parquet.bloom.filter.adaptive.enabled"] = "true"
        out |= {f"parquet.bloom.filter.enabled#{c}": "true" for c in schemas.BLOOM[name]}
    return out


INDEX = T.StructType([T.StructField("tx_hash", T.BinaryType()), T.StructField("block_bucket", T.LongType())])
PREFIX = T.StructField("prefix", T.StringType())

RANGES = T.StructType([T.StructField("lo", T.LongType()), T.StructField("hi", T.LongType())])

BATCH = T.StructField("batch", T.StringType())
GENERATION = T.StructField("gen", T.LongType())


#: Rows of a log, all tables together, above which its buckets are compacted one after another.
PASS_ROWS = 20_000_000


def _folders(name: str) -> list:
    return [f.name for f in schemas.PARTITIONS[name]]


class Store:
    def __init__(self, spark: SparkSession, root: str, bucket_width: int = timex.BLOCKS_PER_BUCKET,
                 compression: str = "zstd", max_records: int = 5_000_000):
        self.spark = spark
        self.root = root.rstrip("/")
        self.bucket_width = bucket_width
        self.compression = compression
        self.max_records = max_records

    def path(self, *parts: str) -> str:
        return "/".join([self.root, *parts])

    def _read(self, name: str, schema, partitions) -> DataFrame:
        full = T.StructType([*schema.fields, *partitions])
        try:
            return self.spark.read.schema(full).option("basePath", self.path(name)).parquet(self.path(name))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], full)

    def _laid_out(self, df: DataFrame, name: str, rebalance: bool) -> DataFrame:
        made = {"block_bucket": timex.block_bucket("block_number", self.bucket_width)}
        if name == "blocks":
            made["month"] = timex.month_bucket("timestamp")
        out = df.withColumns(made)
        if rebalance:
            # AQE merges small buckets' tasks and splits a bucket too large for one task
            out = out.hint("rebalance", "block_bucket")
        return out.sortWithinPartitions(*_folders(name), *schemas.SORT[name])

    # ---- change log

    def append(self, name: str, df: DataFrame, batch: str, rebalance: bool = False, bulk: bool = False) -> dict:
        """Write one table's rows of a batch; returns counts observed on the way.

        Rows are written by the tasks that made them.  ``rebalance`` shuffles by bucket
        first, for input that is not clustered by height; ``bulk`` adds bloom filters."""
        seen = Observation(f"{name}-{batch}")
        height_rows = [F.count_if(F.col("sign") == 1).alias("commits"), F.count_if(F.col("sign") == -1).alias("reverts"),
                       F.min("block_number").alias("lo"), F.max("block_number").alias("hi")]
        (self._laid_out(df.observe(seen, *height_rows), name, rebalance).write.mode("overwrite")
         .options(**write_options(name, self.compression, self.max_records, bulk=bulk))
         .partitionBy(*_folders(name)).parquet(self.path(name, f"batch={batch}")))
        return seen.get

    def commit(self, batch: str, source: str, seen: dict, reorg_events: int = 0, span=None,
               quarantined: int = 0) -> None:
        """Make a batch visible: one small row, written after all its tables."""
        blocks = seen["blocks"]
        rows = sum(s["commits"] + s["reverts"] for s in seen.values())
        lo, hi = span or (blocks["lo"], blocks["hi"])
        row = (source, lo, hi, rows, blocks["commits"], blocks["reverts"],
               rows - blocks["commits"] - blocks["reverts"], reorg_events, quarantined)
        values = [F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, PROGRESS.fields)]
        (self.spark.range(0, 1, 1, 1).select(*values, F.current_timestamp().alias("committed_at"))
         .write.mode("overwrite").parquet(self.path("progress", f"batch={batch}")))

    def write_batch(self, tables: dict, batch: str, source: str, rebalance: bool = False,
                    bulk: bool = False, span=None, also: dict | None = None, after: dict | None = None) -> dict:
        """All tables of a batch side by side, ``also`` beside them and ``after`` them, then the
        commit.  Order among the tables does not matter: none of them counts before the commit.
        A committed batch is left as it is, and is an error if another source committed it."""
        owner = self.committed_by(batch)
        if owner is not None:
            if owner != source:
                raise ValueError(f"batch {batch} was committed by {owner}, not {source}")
            return {}
        # index and coverage read what was written: two narrow columns instead of nested blocks
        derived = {"transactions": lambda rows: self.append_index(rows, batch),
                   "blocks": lambda rows: self.append_coverage(rows, batch, bulk)}

        def table(name):
            seen = self.append(name, tables[name], batch, rebalance, bulk)
            if name in derived:
                derived[name](self._read(f"{name}/batch={batch}", schemas.TABLES[name], schemas.PARTITIONS[name]))
            return seen
        with shuffles_removed(self.spark, *(df.sparkSession for df in tables.values())):
            done = self.together({**{name: (lambda name=name: table(name)) for name in schemas.TABLES}, **(also or {})})
            done |= {name: job() for name, job in (after or {}).items()}
        seen = {name: done[name] for name in schemas.TABLES}
        if span is None and not any(s["commits"] + s["reverts"] for s in seen.values()) and not done.get("quarantined"):
            # nothing came: the empty folders do not count without a commit
            return seen
        self.commit(batch, source, seen, done.get("reorg_events", 0), span, done.get("quarantined", 0))
        return seen

    def together(self, jobs: dict) -> dict:
        """Run independent Spark jobs at the same time, so that small ones share executors."""
        with ThreadPoolExecutor(len(jobs)) as pool:
            futures = {k: pool.submit(inheritable_thread_target(self.spark)(job)) for k, job in jobs.items()}
            return {k: f.result() for k, f in futures.items()}

    def committed_by(self, batch: str) -> str | None:
        """The source of a committed batch; where there is none, no job runs."""
        row = self._read(f"progress/batch={batch}", PROGRESS, []).select("source").first()
        return row and row[0]

    def progress(self) -> DataFrame:
        return self._read("progress", PROGRESS, [BATCH])

    def cursor(self, default: int = 0) -> int:
        """Highest processed height: one row from the progress table."""
        top = self.progress().agg(F.max("hi")).first()[0]
        return default if top is None else top

    def rebuilt_cursor(self, current: bool = False) -> DataFrame:
        """The cursor recomputed from the block table itself."""
        blocks = self.table("blocks")
        rows = sign.net_positive(blocks, schemas.KEYS["blocks"]) if current else sign.active_rows(blocks)
        return rows.agg(F.max("block_number").alias("cursor"))

    def committed_batches(self) -> DataFrame:
        return self.progress().select("batch").distinct()

    def _log(self, name: str) -> DataFrame:
        return self._read(name, schemas.TABLES[name], [BATCH, *schemas.PARTITIONS[name]])

    def table(self, name: str) -> DataFrame:
        """The signed change log, committed batches only."""
        return self._tagged(self._log(name).join(self.committed_batches(), "batch", "left_semi").drop("batch"))

    def _tagged(self, df: DataFrame) -> DataFrame:
        """Tell the catalogue how wide a bucket is, so that it can prune by height."""
        return df.withMetadata("block_bucket", {"width": self.bucket_width})

    # ---- heights held

    def append_coverage(self, blocks: DataFrame, batch: str, bulk: bool = False) -> None:
        found = coverage.ranges(blocks, self.bucket_width) if bulk else coverage.batch_ranges(blocks)
        found.coalesce(1).write.mode("overwrite").parquet(self.path("coverage", f"batch={batch}"))

    def coverage(self) -> DataFrame:
        """Merged ranges of the heights that committed batches hold."""
        parts = self._read("coverage", RANGES, [BATCH]).join(self.committed_batches(), "batch", "left_semi")
        return coverage.merge(parts.select("lo", "hi"))

    def gaps(self, lo: int = 0) -> DataFrame:
        """Ranges from ``lo`` up to the highest height that no batch holds."""
        merged = self.coverage()
        return coverage.gaps(merged, lo, merged.agg(F.max("hi")).scalar())

    # ---- metrics

    def append_metrics(self, samples: DataFrame) -> None:
        samples.select(*[f.name for f in schemas.METRICS.fields]).coalesce(1).write.mode("append").parquet(self.path("metrics"))

    def metrics(self) -> DataFrame:
        """All samples: those appended, and the counters that follow from the committed batches."""
        appended = self._read("metrics", schemas.METRICS, [])
        return appended.unionByName(self.counters())

    def counters(self) -> DataFrame:
        """Cumulative counters in the long metric form, one sample per committed batch."""
        # one row per batch: small whatever the batches held
        upto = Window.partitionBy("name").orderBy("ts", "batch").rowsBetween(Window.unboundedPreceding, 0)
        samples = self.progress().select(F.col("committed_at").alias("ts"), "batch", F.inline(F.array(*[
            F.struct(F.lit(out).alias("name"), F.col(c).cast("double").alias("v")) for out, c in (
                ("blocks_processed_total", "committed_blocks"), ("events_captured_total", "events"),
                ("reorgs_handled_total", "reorg_events"), ("reverted_blocks_total", "reverted_blocks"))])))
        return samples.select("ts", "name", F.lit(None).cast("double").alias("le"), F.sum("v").over(upto).alias("value"))

    # ---- lookup by hash

    def append_index(self, transactions: DataFrame, batch: str) -> None:
        """Where the transactions of a batch are: hash and height bucket, in folders by the first
        hex digit of the hash, sorted by it inside."""
        rows = transactions.select("tx_hash", timex.block_bucket("block_number", self.bucket_width).alias("block_bucket"))
        # a transaction that is committed and reverted in one batch is named twice, which lookups do not mind;
        # a folder takes the files its rows need, not one of every task
        (rows.withColumn("prefix", self._prefix()).hint("rebalance", "prefix").sortWithinPartitions("prefix", "tx_hash")
         .write.mode("overwrite").partitionBy("prefix").parquet(self.path("transactions_index", f"batch={batch}")))

    @staticmethod
    def _prefix():
        return F.substring(F.lower(F.hex("tx_hash")), 1, 1)

    def places(self, hashes: DataFrame) -> list:
        """(batch, height bucket) of each asked transaction: as many rows as there are hits."""
        asked = hashes.select("tx_hash").distinct().withColumn("prefix", self._prefix())
        index = self._read("transactions_index", INDEX, [BATCH, PREFIX])
        # the list of asked hashes prunes the folders of the index
        hits = index.join(asked, ["prefix", "tx_hash"], "left_semi").join(self.committed_batches(), "batch", "left_semi")
        return [(r["batch"], r["block_bucket"]) for r in hits.select("batch", "block_bucket").distinct().collect()]

    def lookup(self, hashes: DataFrame) -> DataFrame:
        """Committed rows of a list of transaction hashes.  Only the folders that the index names
        are opened, whatever the size of the log."""
        full = T.StructType([*schemas.TRANSACTIONS.fields, BATCH, *schemas.PARTITIONS["transactions"]])
        folders = [self.path("transactions", f"batch={b}", f"block_bucket={k}") for b, k in self.places(hashes)]
        if not folders:
            return self.spark.createDataFrame([], full).drop("batch")
        rows = self.spark.read.schema(full).option("basePath", self.path("transactions")).parquet(*folders).drop("batch")
        return catalog.lookup_transactions(rows, hashes)

    # ---- rows set aside

    def append_quarantine(self, bad: DataFrame, batch: str) -> int:
        seen = Observation(f"quarantine-{batch}")
        (bad.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite")
         .parquet(self.path("quarantine", f"batch={batch}")))
        return seen.get["n"]

    def quarantine(self) -> DataFrame:
        return self._read("quarantine", QUARANTINE, [BATCH]).join(self.committed_batches(), "batch", "left_semi")

    # ---- maintained daily statistics

    def append_daily(self, transactions_with_time: DataFrame, batch: str) -> None:
        (catalog.daily_sender_stats(transactions_with_time).write.mode("overwrite")
         .parquet(self.path("daily_sender_stats", f"batch={batch}")))

    def daily_sender_stats(self) -> DataFrame:
        parts = self._read("daily_sender_stats", DAILY, [BATCH])
        return catalog.merge_daily(parts.join(self.committed_batches(), "batch", "left_semi").drop("batch"))

    # ---- compaction

    def _manifest(self, name: str) -> DataFrame:
        return self._read(f"{name}_manifest", T.StructType([T.StructField("covered_bucket", T.LongType())]), [GENERATION])

    def _newest(self, name: str) -> DataFrame:
        """The newest generation of each bucket: one row per bucket."""
        return self._manifest(name).groupBy(F.col("covered_bucket").alias("block_bucket")).agg(F.max("gen").alias("gen"))

    def compact(self, name: str, buckets: tuple | None = None) -> DataFrame:
        """Collapse the log, or a range of its buckets, into a new generation; returns the
        keys reverted too often.  A bucket whose rows all vanished is covered by the
        manifest and so becomes empty."""
        gen = (self._manifest(name).agg(F.max("gen")).first()[0] or 0) + 1
        # which batches it covers is written first: later commits belong to the next generation
        listed = self.path(f"{name}_batches", f"gen={gen}")
        self.committed_batches().coalesce(1).write.mode("overwrite").parquet(listed)
        seen = self.spark.read.schema(T.StructType([BATCH])).parquet(listed)
        log = self._log(name).join(seen, "batch", "left_semi").drop("batch")
        if buckets is not None:
            log = log.where(F.col("block_bucket").between(*buckets))
        manifest = self.path(f"{name}_manifest", f"gen={gen}")
        # a list of folder numbers, from the folders alone; nothing reads the generation before its manifest
        held = [r[0] for r in log.select("block_bucket").distinct().collect()]
        whole = (self.progress().agg(F.sum("rows")).first()[0] or 0) <= PASS_ROWS
        passes = [log] if whole or len(held) < 2 else [
            log.where(F.col("block_bucket").eqNullSafe(F.lit(b).cast("bigint"))) for b in sorted(held, key=lambda b: (b is not None, b))]
        with shuffles_removed(self.spark):
            for i, part in enumerate(passes):
                current = sign.collapse(part.drop(*_folders(name)), schemas.KEYS[name])
                # the rows of one bucket are spread over tasks by key, which is all that a bucket's files need
                (self._laid_out(current, name, rebalance=len(passes) == 1).write.mode("append" if i else "overwrite")
                 .options(**write_options(name, self.compression, self.max_records))
                 .partitionBy(*_folders(name)).parquet(self.path(f"{name}_current", f"gen={gen}")))
            (self.spark.createDataFrame([(b,) for b in held], "covered_bucket bigint").coalesce(1)
             .write.mode("overwrite").parquet(manifest))
        return sign.anomalies(log, schemas.KEYS[name])

    def current(self, name: str) -> DataFrame:
        """Collapsed rows: of every bucket its newest generation."""
        rows = self._read(f"{name}_current", schemas.TABLES[name], [GENERATION, *schemas.PARTITIONS[name]])
        return self._tagged(rows.join(self._newest(name), ["block_bucket", "gen"], "left_semi").drop("gen"))

    def touched(self, name: str) -> list:
        """Buckets with batches that their newest generation has not seen: a list of folder
        numbers, from the folders alone."""
        folders = (self._log(name).join(self.committed_batches(), "batch", "left_semi")
                   .select("block_bucket", "batch").distinct())
        seen = self._read(f"{name}_batches", T.StructType([BATCH]), [GENERATION])
        late = (folders.join(self._newest(name), "block_bucket", "left")
                .join(seen, ["gen", "batch"], "left_anti").select("block_bucket").distinct())
        return sorted(r[0] for r in late.collect())

    def latest(self, name: str) -> DataFrame:
        """Current state now: the newest generations, and the log itself for the buckets
        that later batches touched.  Only those buckets are collapsed."""
        late = F.col("block_bucket").isin(self.touched(name))
        fresh = sign.collapse(self.table(name).where(late), schemas.KEYS[name])
        return self._tagged(self.current(name).where(~late).select(*fresh.columns).unionByName(fresh))


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; bytes as hex text."""
    kinds = dict(df.dtypes)
    flat = df.select(*[F.lower(F.hex(F.col(f"`{c}`"))).alias(c) if kinds[c] == "binary" else F.col(f"`{c}`")
                       for c in df.columns])
    flat.write.mode("overwrite").option("header", True).csv(path)
