"""Notification sources: batch replay and stream, always with the explicit schema."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from forkline import schemas


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.NOTIFICATION).parquet(path)


def stream(spark: SparkSession, path: str, max_files: int | None = None,
           max_bytes: str | None = None) -> DataFrame:
    """A stream over a folder of notification files.  ``max_files`` or ``max_bytes`` per
    micro-batch is the back-pressure: a slow sink delays reading, nothing piles up."""
    reader = spark.readStream.schema(schemas.NOTIFICATION)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.parquet(path)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Historical blocks, one nested block per row."""
    return spark.read.schema(schemas.BLOCK).parquet(path)


def committed_blocks(notifications: DataFrame) -> DataFrame:
    """The blocks of plain commits, as a history to backfill from."""
    return notifications.where("kind = 'ChainCommitted'").select(F.inline("new"))


def canonical_blocks(notifications: DataFrame) -> DataFrame:
    """The blocks that are current after all these notifications, as a history to backfill
    from: without what was reverted, with the new side of every reorg.

    The netting reads heights and hashes only; whole blocks are joined back once.
    """
    sides = [notifications.select(F.lit(sign).alias("sign"), "seq", F.inline(
        F.arrays_zip(F.col(f"{side}.header.number").alias("n"), F.col(f"{side}.header.hash").alias("h"))).alias("n", "h"))
        for side, sign in (("old", -1), ("new", 1))]
    current = (sides[0].unionByName(sides[1]).groupBy("n", "h")
               .agg(F.sum("sign").alias("net"), F.max(F.when(F.col("sign") == 1, F.col("seq"))).alias("at"))
               .where("net > 0").select("n", "h", "at"))
    blocks = notifications.select("seq", F.explode("new").alias("b"))
    return (blocks.join(current, (F.col("seq") == F.col("at")) & (F.col("b.header.number") == F.col("n"))
                        & (F.col("b.header.hash") == F.col("h")), "left_semi").select("b.*"))
