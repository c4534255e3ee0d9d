"""Exact order statistics and throughput."""

from pyspark.sql import DataFrame, Window, functions as F

from forkline.operators import ordered
from forkline.session import written

SIDE = 16
#: Distinct values that one task may order by itself.
ONE_TASK = 1_000_000


def _cut(counts: DataFrame, groups: list, value: str) -> DataFrame:
    """Number the about even pieces (``_part``) each group's values fall into."""
    cuts = counts.groupBy(*groups).agg(ordered.cut_points(F.col(value), SIDE).alias("_c"))
    grouped = cuts.select(*groups, ordered._grouped(F.col("_c"), SIDE).alias("_cuts"))
    placed = counts.join(grouped, groups) if groups else counts.withColumn("_cuts", grouped.scalar())
    return ordered.add_piece(placed, F.col(value), "_cuts", "_part", SIDE)


def _holding(placed: DataFrame, ranks: DataFrame, groups: list, on: list) -> DataFrame:
    """The piece that holds each wanted rank, and the rank inside that piece."""
    before = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = (placed.groupBy(*groups, "_part").agg(F.sum("_n").alias("_rows"))
              .withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0))))
    joined = _with(ranks, pieces, on)
    inside = (F.col("rank") >= F.col("_before")) & (F.col("rank") < F.col("_before") + F.col("_rows"))
    return joined.where(inside).withColumn("rank", F.col("rank") - F.col("_before")).drop("_rows", "_before")


def _pick_ranks(counts: DataFrame, groups: list, value: str, ranks: DataFrame) -> DataFrame:
    """Values at 0-based ``rank`` per group, from distinct values and their counts.

    A group is cut into 256 pieces by approximate cut points; the rows in each are counted
    exactly and only the piece with the wanted rank is kept, cut and counted once more.
    What is finally ordered is about a 65,536th of the group.  The cut points affect
    balance, never the answer.
    """
    placed = _cut(counts, groups, value)
    wanted = _holding(placed, ranks, groups, groups)
    first = placed.join(wanted.select(*groups, "p", "_part"), [*groups, "_part"]).drop("_part")
    within = [*groups, "p"]
    placed = _cut(first, within, value)
    wanted = _holding(placed, wanted.drop("_part"), within, within)
    run = Window.partitionBy(*within).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    return (placed.join(wanted, [*within, "_part"]).withColumn("_upto", F.sum("_n").over(run))
            .where((F.col("rank") < F.col("_upto")) & (F.col("rank") >= F.col("_upto") - F.col("_n")))
            .select(*within, value))


def _in_order(counts: DataFrame, groups: list, value: str, ranks: DataFrame) -> DataFrame:
    """The same where all distinct values are few enough for one task."""
    run = Window.partitionBy(*groups).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    placed = _with(counts.withColumn("_upto", F.sum("_n").over(run)), ranks, groups)
    return (placed.where((F.col("rank") < F.col("_upto")) & (F.col("rank") >= F.col("_upto") - F.col("_n")))
            .select(*groups, "p", value))


def _with(df: DataFrame, other: DataFrame, groups: list) -> DataFrame:
    # without groups both sides are constant in size: ranks, pieces or totals
    return df.join(other, groups) if groups else df.withColumn("_one", F.lit(1)).join(
        other.withColumn("_one", F.lit(1)), "_one").drop("_one")


def nearest_rank_stats(df: DataFrame, value: str, groups: list = (), percentiles=(50, 95, 99)) -> DataFrame:
    """``p50, p95, p99, avg, min, max`` with the nearest-rank rule: position
    ``floor(p / 100 * n)`` of the sorted values, at most ``n - 1``.  A table without rows
    gives one row of zeros when there are no groups."""
    groups = list(groups)
    samples = df.where(F.col(value).isNotNull())
    # counted once; all that follows reads the table
    counts = written(df.sparkSession, samples.groupBy(*groups, value).agg(F.count(F.lit(1)).alias("_n")), "counts")
    whole = counts.groupBy(*groups).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("samples"),
        F.coalesce(F.sum(F.col(value) * F.col("_n")) / F.sum("_n"), F.lit(0.0)).alias("avg"),
        F.coalesce(F.min(value), F.lit(0.0)).alias("min"), F.coalesce(F.max(value), F.lit(0.0)).alias("max"))
    position = F.least(F.call_function("div", F.col("p").cast("bigint") * F.col("samples"), F.lit(100).cast("bigint")),
                       F.col("samples") - 1)
    ranks = (whole.select(*groups, "samples", F.explode(F.array(*[F.lit(p) for p in percentiles])).alias("p"))
             .select(*groups, "p", position.alias("rank")))
    pick = _in_order if counts.count() <= ONE_TASK else _pick_ranks
    picked = pick(counts, groups, value, ranks)
    wide = picked.groupBy(*groups).agg(*[
        F.max(F.when(F.col("p") == p, F.col(value))).alias(f"p{p}") for p in percentiles])
    return _with(whole, wide, groups).select(*groups, "samples", *[F.coalesce(f"p{p}", F.lit(0.0)).alias(f"p{p}") for p in percentiles],
                         "avg", "min", "max")


def throughput(rows: DataFrame, ts: str, seconds=None) -> DataFrame:
    """Rows per second over the elapsed time of the data, or over ``seconds``."""
    span = F.lit(float(seconds)) if seconds is not None else (
        F.max(F.col(ts).cast("double")) - F.min(F.col(ts).cast("double")))
    return rows.agg(F.count(F.lit(1)).alias("rows"), span.alias("elapsed_seconds")).withColumn(
        "rows_per_second", F.when(F.col("elapsed_seconds") > 0, F.col("rows") / F.col("elapsed_seconds")))
