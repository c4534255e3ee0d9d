"""Historical backfill over ``(cursor, head]`` in height chunks."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from forkline.operators import flatten
from forkline.sources.store import Store


def head(blocks: DataFrame, column: str = "block_number") -> int | None:
    """Newest height: one row, one column, aggregated on the executors."""
    return blocks.agg(F.max(column)).first()[0]


def missing_blocks(blocks: DataFrame, lo: int, hi: int | None) -> DataFrame:
    """Heights in ``[lo, hi]`` that have no row.  The expected heights are a distributed
    range, never a list."""
    spark: SparkSession = blocks.sparkSession
    expected = spark.range(lo, lo if hi is None else hi + 1).withColumnRenamed("id", "block_number")
    return expected.join(blocks.select("block_number").distinct(), "block_number", "left_anti")


class MissingBlocks(ValueError):
    pass


def chunks(after: int, to: int, batch_size: int) -> list:
    """Half-open-below ranges ``(lo, hi]``; one job each, so their number is what matters."""
    return [(lo, min(lo + batch_size, to)) for lo in range(after, to, batch_size)]


def run(store: Store, history: DataFrame, batch_size: int = 1_000_000, after: int | None = None,
        to: int | None = None, time_unit: str = "s", check_missing: bool = True,
        rebalance: bool = False) -> int:
    """Flatten nested historical blocks into the store; returns the number of chunks
    written.  Every chunk is one distributed job and one atomic batch, so a rerun resumes
    after the last chunk that was committed.  A history whose files are clustered by height
    needs no shuffle; set ``rebalance`` for one that is not, or files get small."""
    after = store.cursor(default=0) if after is None else after
    to = head(history.select(F.col("header.number").alias("block_number"))) if to is None else to
    if to is None or after >= to:
        return 0
    done = chunks(after, to, batch_size)
    for lo, hi in done:
        part = history.where((F.col("header.number") > lo) & (F.col("header.number") <= hi))
        if check_missing:
            gap = missing_blocks(part.select(F.col("header.number").alias("block_number")), lo + 1, hi).limit(1).collect()
            if gap:
                raise MissingBlocks(f"block {gap[0][0]} is missing from the history")
        tables = flatten.flatten(flatten.flatten_batch_blocks(part), time_unit)
        store.write_batch(tables, f"bf-{lo + 1:015d}-{hi:015d}", "backfill", rebalance, bulk=True, span=(lo + 1, hi))
    return len(done)


def progress_percent(store: Store, start: int, to: int) -> DataFrame:
    """Share of ``(start, to]`` done after each committed chunk."""
    done = F.col("hi") - F.lit(start)
    return (store.progress().where("source = 'backfill'")
            .select("batch", "hi", (done / F.lit(float(max(to - start, 1))) * 100).alias("percent")))
