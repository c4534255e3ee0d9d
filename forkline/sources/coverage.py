"""Which heights there are, as ranges: the gap check reads ranges instead of all heights."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from forkline.functions import timex
from forkline.operators import ordered


def ranges(heights: DataFrame, width: int = timex.BLOCKS_PER_BUCKET) -> DataFrame:
    """(lo, hi) of the runs of consecutive heights in ``block_number``."""
    seen = heights.select("block_number").distinct()
    ranked = ordered.rank_in_keys(seen, [], ["block_number"], timex.block_bucket("block_number", width), "_rank")
    return (ranked.groupBy((F.col("block_number") - F.col("_rank")).alias("_run"))
            .agg(F.min("block_number").alias("lo"), F.max("block_number").alias("hi")).drop("_run"))


def batch_ranges(heights: DataFrame) -> DataFrame:
    """The same for the heights of one micro-batch, which fit one array: no shuffle but of one row per task."""
    found = heights.agg(F.sort_array(F.collect_set("block_number")).alias("h")).where("size(h) > 0")
    opens = "filter(h, (x, i) -> i = 0 OR h[greatest(i - 1, 0)] < x - 1)"
    closes = "filter(h, (x, i) -> i = size(h) - 1 OR h[least(i + 1, size(h) - 1)] > x + 1)"
    return found.selectExpr(f"inline(arrays_zip({opens}, {closes})) AS (lo, hi)")


def merge(parts: DataFrame) -> DataFrame:
    """Ranges that overlap or touch become one.  ``parts`` has a row per range, few per batch."""
    before = Window.orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, 0)
    opens = F.col("lo") > F.coalesce(F.max("hi").over(before) + 1, F.col("lo") - 1)
    return (parts.withColumn("_opens", opens.cast("int")).withColumn("_run", F.sum("_opens").over(upto))
            .groupBy("_run").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("_run"))


def gaps(merged: DataFrame, lo: int, hi: Column | int) -> DataFrame:
    """(lo, hi) of the heights between ``lo`` and ``hi`` that no range holds."""
    last = hi if isinstance(hi, Column) else F.lit(hi)
    inside = merged.where((F.col("hi") >= lo) & (F.col("lo") <= last)).select("lo", "hi")
    ends = inside.unionByName(inside.sparkSession.range(1).select(F.lit(lo - 1).cast("bigint").alias("lo"), F.lit(lo - 1).cast("bigint").alias("hi")))
    following = F.coalesce(F.lead("lo").over(Window.orderBy("lo", "hi")), last + 1)
    return ends.select((F.col("hi") + 1).alias("lo"), (following - 1).cast("bigint").alias("hi")).where("lo <= hi")


def heights(gap_ranges: DataFrame) -> DataFrame:
    """The heights of ranges, one row each, made on the executors."""
    return gap_ranges.select(F.explode(F.sequence("lo", "hi")).alias("block_number"))
