"""Daily distinct counts and quantiles from partials that merge: sketches, not values, are stored.

A sketch has a bounded size whatever it saw, and merging is associative and commutative, so the
partials of batches, buckets or clusters may be folded in any order.  What a revert should take back
cannot be taken out of a sketch: partials describe committed rows; for the current state build them
from collapsed rows.
"""

from pyspark.sql import Column, DataFrame, functions as F

#: log2 of the HLL registers, and the k of the quantile sketches.
PRECISION, K = 12, 400
#: Bounds of the estimates at these sizes, at three standard deviations: relative distinct count, rank of a quantile.
DISTINCT_ERROR, RANK_ERROR = 3 * 1.04 / 2 ** (PRECISION / 2), 0.013
QUANTILES = (0.5, 0.95)


def daily(transactions: DataFrame, cut: Column | None = None, time: str = "timestamp") -> DataFrame:
    """Partial rows per day (and per value of ``cut``): transactions with their block's time in ``time``."""
    groups = [F.to_date(time).alias("date"), *([cut.alias("cut")] if cut is not None else [])]
    return transactions.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("tx_count"), F.hll_sketch_agg("to", PRECISION).alias("receivers"),
        F.hll_sketch_agg("from", PRECISION).alias("senders"), F.kll_sketch_agg_bigint("gas_used", K).alias("gas")).drop("cut")


def merge(partials: DataFrame) -> DataFrame:
    """One row per day from any number of partial rows."""
    return partials.groupBy("date").agg(
        F.sum("tx_count").alias("tx_count"), F.hll_union_agg("receivers").alias("receivers"),
        F.hll_union_agg("senders").alias("senders"), F.kll_merge_agg_bigint("gas", K).alias("gas"))


def estimates(merged: DataFrame) -> DataFrame:
    """date, tx_count, distinct receivers and senders, and the quantiles of the gas used."""
    return merged.select("date", "tx_count", F.hll_sketch_estimate("receivers").alias("receivers"),
                         F.hll_sketch_estimate("senders").alias("senders"),
                         *[F.kll_sketch_get_quantile_bigint("gas", F.lit(q)).alias(f"p{round(100 * q)}") for q in QUANTILES])


def compare(transactions: DataFrame, merged: DataFrame, other: DataFrame) -> DataFrame:
    """Per day, whether the estimates of ``merged`` lie within the stated error of the exact figures
    and whether ``other``, merged from other partials, says the same.

    A quantile is within the error if the share of rows below it, and of rows up to it, has the wanted
    one between them, give or take the rank error.
    """
    got = estimates(merged)
    rows = transactions.withColumn("date", F.to_date("timestamp")).join(got.select("date", "p50", "p95"), "date")
    below = lambda p: F.count_if(F.col("gas_used") < F.col(p)) / F.count(F.lit(1))
    upto = lambda p: F.count_if(F.col("gas_used") <= F.col(p)) / F.count(F.lit(1))
    exact = rows.groupBy("date").agg(
        F.count_distinct("to").alias("_receivers"), F.count_distinct("from").alias("_senders"),
        *[f(p).alias(f"_{n}_{p}") for p in ("p50", "p95") for n, f in (("below", below), ("upto", upto))])
    near = lambda a, b, e: F.abs(F.col(a) - F.col(b)) <= F.greatest(F.lit(1.0), e * F.col(b))
    inside = lambda p, q: (F.col(f"_below_{p}") <= q + RANK_ERROR) & (F.col(f"_upto_{p}") >= q - RANK_ERROR)
    also = estimates(other).select("date", *[F.col(c).alias(f"o_{c}") for c in ("tx_count", "receivers", "senders", "p50", "p95")])
    # compactions inside a quantile sketch depend on the cut; its answers do so within the error only
    alike = (F.col("o_tx_count") == F.col("tx_count")) & near("o_receivers", "receivers", 2 * DISTINCT_ERROR) & near(
        "o_senders", "senders", 2 * DISTINCT_ERROR)
    return got.join(exact, "date").join(also, "date").select(
        "date", "tx_count", near("receivers", "_receivers", DISTINCT_ERROR).alias("receivers_within"),
        near("senders", "_senders", DISTINCT_ERROR).alias("senders_within"), inside("p50", 0.5).alias("p50_within"),
        inside("p95", 0.95).alias("p95_within"), alike.alias("same_in_any_order"))
