"""Order-dependent operators that never put a whole series into one task.

A long ordered series is cut into buckets by a monotone expression of its order
columns.  Work inside a bucket is an ordinary window; what crosses a bucket border
travels through a table with one row per (series, bucket), which is the only thing
windowed over a whole series.  Pick a bucket so that both are small: its rows are one
task's work, its count per series the length of the border table.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

BUCKET = "_bucket"
SIDE = 32  # cut points are searched in two steps of 32


def cut_points(values: Column, side: int = SIDE) -> Column:
    """Aggregate: ``side ** 2`` approximately even cut points, grouped for a two-step search."""
    parts = side * side
    return F.percentile_approx(values, [i / parts for i in range(1, parts)], 10 * parts)


def _grouped(cuts: Column, side: int = SIDE) -> Column:
    coarse = F.transform(F.sequence(F.lit(1), F.lit(side - 1)), lambda k: F.get(cuts, k * side - 1))
    fine = F.transform(F.sequence(F.lit(0), F.lit(side - 1)), lambda k: F.slice(cuts, k * side + 1, side - 1))
    return F.struct(coarse.alias("coarse"), fine.alias("fine"))


def add_piece(df: DataFrame, value: Column, cuts: str, out: str, side: int = SIDE) -> DataFrame:
    """Add the number of cut points at or below ``value``, a monotone piece number; drops
    the cuts.  The coarse step is its own column so that it is worked out once."""
    return (df.withColumn("_coarse", F.size(F.filter(F.col(cuts)["coarse"], lambda c: c <= value)))
            .withColumn(out, F.col("_coarse") * side + F.size(
                F.filter(F.get(F.col(cuts)["fine"], F.col("_coarse")), lambda c: c <= value)))
            .drop("_coarse", cuts))


def bucketed(df: DataFrame, bucket) -> DataFrame:
    """Add the bucket column.  ``bucket`` is a monotone expression of the order columns, or
    the name of the leading order column: then the buckets follow the data, about a
    thousand pieces of even size found by one pass over that column, so that a crowded
    hour is cut as finely as it needs.  Cut points affect balance only, never results."""
    if isinstance(bucket, Column):
        return df.withColumn(BUCKET, bucket)
    cuts = df.agg(cut_points(F.col(bucket)).alias("c")).select(_grouped(F.col("c"))).scalar()
    return add_piece(df.withColumn("_cuts", cuts), F.col(bucket), "_cuts", BUCKET)


def _series(df: DataFrame, keys: list, bucket):
    """The bucketed rows and the columns that name a series.  The keys (labels that may be
    null) become one struct, which is never null and equals itself field by field, so that
    a plain join on it keeps the partitioning of the windows."""
    data = bucketed(df, bucket)
    return (data.withColumn("_key", F.struct(*keys)), ["_key"]) if keys else (data, [])


def lag_columns(df: DataFrame, keys: list, order: list, values: dict, bucket) -> DataFrame:
    """Add ``out = lag(value)`` for each ``out: value column``, per ``keys`` in ``order``."""
    data, key = _series(df, keys, bucket)
    inside = Window.partitionBy(*key, BUCKET).orderBy(*order)
    whole = Window.partitionBy(*key).orderBy(BUCKET)
    pack = F.struct(*[F.col(v).alias(o) for o, v in values.items()])
    last = (data.groupBy(*key, BUCKET)
            .agg(F.max(F.struct(*order, pack.alias("_v"))).alias("_last"))
            .select(*key, BUCKET, F.lag("_last._v").over(whole).alias("_carry")))
    marked = data.withColumn("_lag", F.lag(pack).over(inside)) \
                 .withColumn("_first", F.row_number().over(inside) == 1)
    joined = marked.join(last, [*key, BUCKET], "left")
    previous = F.when(F.col("_first"), F.col("_carry")).otherwise(F.col("_lag"))
    out = joined.withColumn("_prev", previous)
    return out.select(*df.columns, *[F.col(f"_prev.{o}").alias(o) for o in values])


def rank_in_keys(df: DataFrame, keys: list, order: list, bucket, out: str) -> DataFrame:
    """Add the 1-based row number per ``keys`` in ``order``."""
    data, key = _series(df, keys, bucket)
    inside = Window.partitionBy(*key, BUCKET).orderBy(*order)
    before = Window.partitionBy(*key).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    counts = (data.groupBy(*key, BUCKET).agg(F.count(F.lit(1)).alias("_n"))
              .select(*key, BUCKET, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    joined = data.withColumn("_rn", F.row_number().over(inside)).join(counts, [*key, BUCKET], "left")
    return joined.select(*df.columns, (F.col("_rn") + F.col("_before")).alias(out))


def running_max(df: DataFrame, keys: list, order: list, value: str, bucket, out: str) -> DataFrame:
    """Add the maximum of ``value`` from the start of the series to the current row."""
    data, key = _series(df, keys, bucket)
    inside = Window.partitionBy(*key, BUCKET).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*key).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    tops = (data.groupBy(*key, BUCKET).agg(F.max(value).alias("_top"))
            .select(*key, BUCKET, F.max("_top").over(before).alias("_carry")))
    joined = data.withColumn("_local", F.max(value).over(inside)).join(tops, [*key, BUCKET], "left")
    return joined.select(*df.columns, F.greatest("_local", "_carry").alias(out))


def rolling_mean(df: DataFrame, order: list, value: str, n: int, bucket, out: str,
                 scale: float = 1.0, span: int = 50_000) -> DataFrame:
    """Add the mean of ``value`` over the current and the ``n - 1`` preceding rows of the
    whole ordered table, divided by ``scale``.

    Rows get their dense position, are cut into spans of positions, and the last ``n - 1``
    rows of a span are copied to the next one, so every frame is complete inside its span
    however sparse or dense the order keys are.
    """
    if span < n:
        raise ValueError("a span must hold at least one frame")
    placed = rank_in_keys(df, [], order, bucket, "_pos")
    position = F.col("_pos") - 1
    home = F.call_function("div", position, F.lit(span).cast("bigint"))
    near_end = position % span >= span - (n - 1)
    copies = F.when(near_end, F.array(home, home + 1)).otherwise(F.array(home))
    spread = placed.withColumn("_home", home).withColumn("_span", F.explode(copies))
    frame = Window.partitionBy("_span").orderBy("_pos").rowsBetween(-(n - 1), 0)
    # exact sum of integers first, one division last
    mean = (F.sum(F.col(value).cast("decimal(38,0)")).over(frame).cast("double")
            / F.count(value).over(frame) / F.lit(scale))
    return (spread.withColumn(out, mean).where(F.col("_span") == F.col("_home"))
            .select(*df.columns, out))


def trailing_mean(df: DataFrame, keys: list, order: list, value: str, n: int, bucket, out: str,
                  span: int = 50_000) -> DataFrame:
    """Add the mean of ``value`` over the ``n`` rows before the current one, per ``keys``.

    As in :func:`rolling_mean` every series is cut into spans of positions, and the last ``n`` rows
    of a span are copied to the next."""
    if span < n:
        raise ValueError("a span must hold at least one frame")
    placed = rank_in_keys(df, keys, order, bucket, "_pos")
    position = F.col("_pos") - 1
    home = F.call_function("div", position, F.lit(span).cast("bigint"))
    copies = F.when(position % span >= span - n, F.array(home, home + 1)).otherwise(F.array(home))
    spread = placed.withColumn("_home", home).withColumn("_span", F.explode(copies))
    frame = Window.partitionBy(*keys, "_span").orderBy("_pos").rowsBetween(-n, -1)
    return (spread.withColumn(out, F.avg(value).over(frame)).where(F.col("_span") == F.col("_home"))
            .select(*df.columns, out))


def tail_rolling_mean(df: DataFrame, order: list, value: str, n: int, k: int, out: str,
                      scale: float = 1.0) -> DataFrame:
    """The last ``k`` rows of :func:`rolling_mean`.  Their frames lie inside the last
    ``k + n - 1`` rows, so a top-k of that constant size is all that is windowed."""
    tail = df.orderBy(*[F.col(c).desc() for c in order]).limit(k + n - 1)
    frame = Window.orderBy(*order).rowsBetween(-(n - 1), 0)
    mean = (F.sum(F.col(value).cast("decimal(38,0)")).over(frame).cast("double")
            / F.count(value).over(frame) / F.lit(scale))
    return tail.withColumn(out, mean).orderBy(*[F.col(c).desc() for c in order]).limit(k)


def count_over(df: DataFrame, keys: list, out: str) -> DataFrame:
    """Add the number of rows with the same keys, as a window count would, from partial counts."""
    data = df.withColumn("_key", F.struct(*keys))  # never null, equal field by field
    totals = data.groupBy("_key").agg(F.count(F.lit(1)).alias(out))
    return data.join(totals, "_key").select(*df.columns, out)
