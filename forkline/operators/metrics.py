"""Metric time series over a long table ``metrics(ts, name, le, value)``.

Windows are half-open intervals ``[start, end)`` aligned to the epoch; nothing is
extrapolated beyond the samples.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from forkline.operators import ordered

SERIES = ["name"]


def counter_deltas(samples: DataFrame, series=SERIES, bucket="ts") -> DataFrame:
    """Growth since the previous sample of the series; after a reset, the new value."""
    previous = ordered.lag_columns(samples, list(series), ["ts"], {"_prev": "value"}, bucket)
    return previous.withColumn("delta", F.when(F.col("_prev").isNull(), 0.0)
                               .when(F.col("value") < F.col("_prev"), F.col("value"))
                               .otherwise(F.col("value") - F.col("_prev"))).drop("_prev")


def _seconds(interval: str) -> int:
    import datetime
    n, unit = interval.split()
    return int(datetime.timedelta(**{unit.rstrip("s") + "s": int(n)}).total_seconds())


def increase(samples: DataFrame, window: str, step: str | None = None, series=SERIES,
             bucket="ts") -> DataFrame:
    """Counter growth inside each window; null with fewer than two samples.

    The delta of a window's first sample reaches back before the window, so it is taken
    off again.  That keeps this a plain, partially combined aggregate.
    """
    deltas = counter_deltas(samples, series, bucket)
    span = F.window("ts", window, step or window)
    grown = deltas.groupBy(*series, span.alias("_w")).agg(
        F.count(F.lit(1)).alias("samples"),
        (F.sum("delta") - F.min_by("delta", "ts")).alias("_grown"))
    return grown.select(*series, F.col("_w.start").alias("window_start"), "samples",
                        F.when(F.col("samples") >= 2, F.col("_grown")).alias("increase"))


def rate(samples: DataFrame, window: str, step: str | None = None, series=SERIES,
         per_seconds: int = 1, bucket="ts") -> DataFrame:
    """:func:`increase` per second, or per ``per_seconds``."""
    grown = increase(samples, window, step, series, bucket)
    return grown.withColumn("rate", F.col("increase") / _seconds(window) * per_seconds).drop("increase")


def histogram(observations: DataFrame, bounds: list, groups: list, value: str = "value") -> DataFrame:
    """Cumulative ``le`` counts with a ``+Inf`` bucket, in one pass without multiplying rows."""
    counts = observations.groupBy(*groups).agg(
        *[F.count_if(F.col(value) <= b).alias(f"_le{i}") for i, b in enumerate(bounds)],
        F.count(value).alias("_inf"))
    entries = [F.struct(F.lit(float(b)).alias("le"), F.col(f"_le{i}").alias("count")) for i, b in enumerate(bounds)]
    entries.append(F.struct(F.lit(float("inf")).alias("le"), F.col("_inf").alias("count")))
    return counts.select(*groups, F.inline(F.array(*entries)))


def histogram_quantile(buckets: DataFrame, q: float, groups: list, count: str = "count",
                       scale: float = 1.0) -> DataFrame:
    """Quantile from cumulative buckets by linear interpolation inside the first bucket
    that reaches ``q`` of the total; the open bucket gives its lower bound."""
    entries = buckets.groupBy(*groups).agg(F.array_sort(F.collect_list(
        F.struct(F.col("le"), F.col(count).cast("double").alias("c")))).alias("_b"))
    size = F.size("_b")
    total = F.element_at("_b", -1)["c"]
    hit = F.array_position(F.transform("_b", lambda b: b["c"] >= q * total), True).cast("int")
    ranked = entries.withColumn("_total", total).withColumn("_i", hit).withColumn("_size", size)
    upper = F.get("_b", F.col("_i") - 1)
    lower_le = F.when(F.col("_i") > 1, F.get("_b", F.col("_i") - 2)["le"]).otherwise(0.0)
    lower_c = F.when(F.col("_i") > 1, F.get("_b", F.col("_i") - 2)["c"]).otherwise(0.0)
    inside = lower_le + (upper["le"] - lower_le) * F.try_divide(q * F.col("_total") - lower_c, upper["c"] - lower_c)
    value = (F.when(F.col("_total") > 0, F.when(F.col("_i") == F.col("_size"), lower_le).otherwise(inside)))
    return ranked.select(*groups, (value * scale).alias("quantile"))


def bucket_rates(bucket_samples: DataFrame, window: str, series=("name", "le")) -> DataFrame:
    """Rate of every cumulative bucket counter, the input of :func:`histogram_quantile`."""
    return rate(bucket_samples, window, series=list(series))


def last_value(samples: DataFrame, series=SERIES) -> DataFrame:
    """Newest non-null value of each series."""
    return (samples.where("value IS NOT NULL").groupBy(*series)
            .agg(F.max("ts").alias("ts"), F.max_by("value", "ts").alias("value")))


def saturation_percent(gauge: DataFrame, capacity: float = 10_000.0) -> DataFrame:
    return gauge.withColumn("saturation_percent", F.col("value") / capacity * 100)


def threshold_band(value: Column, bands: list, first: str) -> Column:
    """Name of the band a value falls in; ``bands`` are ascending ``(lower bound, name)``."""
    out = F.lit(first)
    for bound, name in bands:
        out = F.when(value >= bound, name).otherwise(out)
    return F.when(value.isNotNull(), out)


BUFFER_BANDS = [(5_000, "yellow"), (8_000, "orange"), (10_000, "red")]
LATENCY_MS_BANDS = [(5, "yellow"), (10, "red")]


def circuit_health(trips: Column) -> Column:
    return F.when(trips >= 1, "Circuit Open").when(trips.isNotNull(), "Healthy")


def alert_states(samples: DataFrame, condition: Column, hold: str, series=SERIES,
                 bucket="ts") -> DataFrame:
    """State of an alert at each sample: ``inactive``, ``pending`` or ``firing``.

    It fires once its condition has held for ``hold`` without a sample to the contrary.
    """
    series = list(series)
    marked = ordered.bucketed(samples, bucket).withColumn("_on", F.coalesce(condition, F.lit(False)))
    cut = F.col(ordered.BUCKET)  # found once, used by both steps
    switched = ordered.lag_columns(marked, series, ["ts"], {"_was": "_on"}, cut)
    starts = switched.withColumn("_start", F.when(F.col("_on") & ~F.coalesce("_was", F.lit(False)), F.col("ts")))
    since = ordered.running_max(starts, series, ["ts"], "_start", cut, "_since")
    held = F.col("ts") >= F.col("_since") + F.expr(f"INTERVAL {hold}")
    state = F.when(~F.col("_on"), "inactive").when(held, "firing").otherwise("pending")
    return since.select(*series, "ts", "value", F.when(F.col("_on"), F.col("_since")).alias("active_since"),
                        state.alias("state"))


def throughput_drops(rates: DataFrame, trailing: int = 10, fraction: float = 0.5,
                     series=SERIES, span: int = 50_000) -> DataFrame:
    """Windows whose rate is below ``fraction`` of the mean of the ``trailing`` windows
    before them.  Input has one row per series and window; no task sees more than a span of them."""
    return (ordered.trailing_mean(rates, list(series), ["window_start"], "rate", trailing, "window_start", "baseline", span)
            .withColumn("dropped", F.coalesce(F.col("rate") < F.col("baseline") * fraction, F.lit(False))))


def missing_scrapes(samples: DataFrame, interval_seconds: int = 15, series=SERIES) -> DataFrame:
    """Scrape intervals between a series' first and last sample that hold no sample.

    Expected ticks are made day by day, so that one long series is neither one array nor
    one task.
    """
    series = list(series)
    tick = F.call_function("div", F.unix_seconds("ts"), F.lit(interval_seconds).cast("bigint"))
    per_day = 86_400 // interval_seconds
    seen = samples.select(*series, tick.alias("tick")).distinct()
    span = seen.groupBy(*series).agg(F.min("tick").alias("lo"), F.max("tick").alias("hi"))
    day = F.lit(per_day).cast("bigint")
    days = span.select(*series, "lo", "hi", F.explode(F.sequence(
        F.call_function("div", F.col("lo"), day), F.call_function("div", F.col("hi"), day))).alias("_day"))
    spread = days.repartition(*series, "_day")
    ticks = spread.select(*series, F.explode(F.sequence(
        F.greatest("lo", F.col("_day") * day), F.least("hi", F.col("_day") * day + day - 1))).alias("tick"))
    return (ticks.join(seen, [*series, "tick"], "left_anti")
            .select(*series, F.timestamp_seconds(F.col("tick") * interval_seconds).alias("missing_from")))


def series_stats(samples: DataFrame, series=SERIES) -> DataFrame:
    """Legend figures of each series: mean, max, last, p95, p99."""
    from forkline.operators import stats
    ranks = stats.nearest_rank_stats(samples, "value", list(series))
    last = last_value(samples, series).select(*series, F.col("value").alias("last"))
    return ranks.join(last, list(series)).select(*series, F.col("avg").alias("mean"), "max", "last", "p95", "p99")


def progress_state(samples: DataFrame, series=SERIES) -> DataFrame:
    """``stalled`` where the newest value of a progress counter is still zero."""
    return last_value(samples, series).withColumn(
        "state", F.when(F.col("value") == 0, "stalled").otherwise("progressing"))
