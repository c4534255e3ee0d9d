"""Metric operators on hand-written samples."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from forkline import schemas
from forkline.operators import metrics

START = datetime(2024, 1, 1)


def samples(spark, values, name="c", step=15):
    rows = [(START + timedelta(seconds=step * i), name, None, None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, schemas.METRICS)


def test_rate_with_reset_and_too_few_samples(spark):
    df = samples(spark, [10, 20, 5, 6, 100])  # four samples in the first minute, one in the next
    rows = metrics.increase(df, "1 minute").orderBy("window_start").collect()
    assert [(r.samples, r.increase) for r in rows] == [(4, 10 + 5 + 1), (1, None)]
    rates = metrics.rate(df, "1 minute", per_seconds=60).orderBy("window_start").collect()
    assert rates[0].rate == pytest.approx(16) and rates[1].rate is None


def test_sliding_rate_equals_brute_force(spark):
    values = [(i * 7) % 50 for i in range(60)]
    got = {r.window_start: r.increase for r in metrics.increase(samples(spark, values), "2 minutes", "30 seconds").collect()}
    for start, increase in got.items():
        inside = [v for i, v in enumerate(values) if start <= START + timedelta(seconds=15 * i) < start + timedelta(minutes=2)]
        want = sum(b if b < a else b - a for a, b in zip(inside, inside[1:])) if len(inside) > 1 else None
        assert increase == want


def test_histogram_and_quantile(spark):
    df = samples(spark, [0.002, 0.004, 0.02, 3.0], "lat")
    hist = metrics.histogram(df, [0.005, 0.01, 0.025], ["name"])
    assert [(r.le, r["count"]) for r in hist.orderBy("le").collect()] == [(0.005, 2), (0.01, 2), (0.025, 3), (float("inf"), 4)]
    q = lambda p: metrics.histogram_quantile(hist, p, ["name"]).first()["quantile"]
    assert q(0.25) == pytest.approx(0.0025) and q(0.5) == pytest.approx(0.005)
    assert q(0.99) == pytest.approx(0.025)  # open bucket: its lower bound
    none = metrics.histogram(df.where("value > 100"), [1.0], ["name"])
    assert metrics.histogram_quantile(none, 0.5, ["name"]).count() == 0


def test_bucket_rates_feed_the_quantile(spark):
    rows = [(START + timedelta(seconds=15 * i), "b", le, float(i * n)) for i in range(4) for le, n in ((1.0, 1), (2.0, 3), (float("inf"), 4))]
    rates = metrics.bucket_rates(spark.createDataFrame(rows, schemas.METRICS), "1 minute")
    r = metrics.histogram_quantile(rates, 0.5, ["name", "window_start"], count="rate").first()
    assert r["quantile"] == pytest.approx(1.5)


def test_last_value_skips_nulls(spark):
    assert metrics.last_value(samples(spark, [1, 2, None])).first().value == 2


def test_bands_and_health(spark):
    df = spark.createDataFrame([(4999.0,), (5000.0,), (8000.0,), (10000.0,), (None,)], "v double")
    got = [r[0] for r in df.select(metrics.threshold_band(F.col("v"), metrics.BUFFER_BANDS, "green")).collect()]
    assert got == ["green", "yellow", "orange", "red", None]
    assert [r[0] for r in spark.createDataFrame([(0.0,), (1.0,)], "v double").select(metrics.circuit_health(F.col("v"))).collect()] \
        == ["Healthy", "Circuit Open"]


def test_alert_fires_after_its_hold_time(spark):
    df = samples(spark, [1, 9, 9, 9, 1, 9, None, 9], step=60)
    rows = metrics.alert_states(df, F.col("value") > 5, "2 MINUTES").orderBy("ts").collect()
    assert [r.state for r in rows] == ["inactive", "pending", "pending", "firing", "inactive", "pending", "inactive", "pending"]


def test_throughput_drop(spark):
    rows = [("c", i, 10.0 if i < 5 else 4.0) for i in range(7)]
    df = spark.createDataFrame(rows, "name string, window_start int, rate double")
    assert [r.dropped for r in metrics.throughput_drops(df, 3).orderBy("window_start").collect()] == [False] * 5 + [True, False]


def test_missing_scrapes(spark):
    df = samples(spark, [1] * 10).where("ts NOT IN ('2024-01-01 00:00:30', '2024-01-01 00:01:15')")
    got = sorted(str(r.missing_from)[-8:] for r in metrics.missing_scrapes(df).collect())
    assert got == ["00:00:30", "00:01:15"]


def test_progress_and_saturation(spark):
    assert metrics.progress_state(samples(spark, [0, 0])).first().state == "stalled"
    assert metrics.progress_state(samples(spark, [0, 3])).first().state == "progressing"
    assert metrics.saturation_percent(samples(spark, [2500])).first().saturation_percent == 25
