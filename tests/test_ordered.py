"""Bordered operators and rank statistics against brute force, on skewed series."""

import random

import pytest
from pyspark.sql import functions as F

from forkline.operators import ordered, stats


def skewed(spark, n=600):
    """A third of the rows in one series, most of them crowded into one short stretch."""
    r = random.Random(3)
    rows = []
    for i in range(n):
        k = "hot" if i % 3 == 0 else (None if i % 17 == 0 else f"s{i % 5}")
        rows.append((k, 1000 + i if i % 2 else 100_000 + 40 * i, r.randint(0, 50)))
    return rows, spark.createDataFrame(rows, "k string, t bigint, v int").repartition(6)


def series(rows):
    out = {}
    for k, t, v in sorted(rows, key=lambda x: x[1]):
        out.setdefault(k, []).append((t, v))
    return out


BUCKETS = ["t", "t div 7", "t div 1000000"]


@pytest.mark.parametrize("which", range(3))
def test_lag_rank_and_running_max(spark, which):
    bucket = BUCKETS[which] if which == 0 else F.expr(BUCKETS[which])
    rows, df = skewed(spark)
    lagged = {(r.k, r.t): r.p for r in ordered.lag_columns(df, ["k"], ["t"], {"p": "v"}, bucket).collect()}
    ranked = {(r.k, r.t): r.n for r in ordered.rank_in_keys(df, ["k"], ["t"], bucket, "n").collect()}
    topped = {(r.k, r.t): r.m for r in ordered.running_max(df, ["k"], ["t"], "v", bucket, "m").collect()}
    assert len(lagged) == len(ranked) == len(topped) == len(rows)
    for k, items in series(rows).items():
        for i, (t, _) in enumerate(items):
            assert lagged[k, t] == (items[i - 1][1] if i else None)
            assert ranked[k, t] == i + 1
            assert topped[k, t] == max(v for _, v in items[:i + 1])


@pytest.mark.parametrize("span", [5, 13, 10_000])
def test_rolling_mean_over_sparse_positions(spark, span):
    rows, df = skewed(spark)
    got = {r.t: r.m for r in ordered.rolling_mean(df, ["t"], "v", 5, F.expr("t div 50"), "m", span=span).collect()}
    ordered_rows = sorted(rows, key=lambda x: x[1])
    for i, (_, t, _) in enumerate(ordered_rows):
        frame = [v for _, _, v in ordered_rows[max(0, i - 4):i + 1]]
        assert got[t] == pytest.approx(sum(frame) / len(frame))
    tail = ordered.tail_rolling_mean(df, ["t"], "v", 5, 20, "m").collect()
    assert [r.t for r in tail] == [t for _, t, _ in ordered_rows[::-1][:20]]
    assert all(r.m == pytest.approx(got[r.t]) for r in tail)


def nearest(values, p):
    return sorted(values)[min(int(p * len(values)) // 100, len(values) - 1)]


@pytest.mark.parametrize("values", [[5.0], [1.0] * 100, [float(i % 7) for i in range(1000)],
                                    [random.Random(1).random() for _ in range(3000)], list(map(float, range(100)))])
def test_nearest_rank(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(4)
    r = stats.nearest_rank_stats(df, "v").first()
    assert (r.samples, r.p50, r.p95, r.p99) == (len(values), nearest(values, 50), nearest(values, 95), nearest(values, 99))
    assert (r.min, r.max) == (min(values), max(values)) and r.avg == pytest.approx(sum(values) / len(values))


def test_nearest_rank_of_nothing_is_zero(spark):
    r = stats.nearest_rank_stats(spark.createDataFrame([], "v double"), "v").first()
    assert (r.samples, r.p50, r.p95, r.p99, r.avg, r.min, r.max) == (0, 0, 0, 0, 0, 0, 0)


def test_nearest_rank_per_group(spark):
    rows, df = skewed(spark)
    got = {r.k: (r.p50, r.p95, r.p99) for r in stats.nearest_rank_stats(df.where("k IS NOT NULL"), "v", ["k"]).collect()}
    for k, items in series(rows).items():
        if k is not None:
            values = [v for _, v in items]
            assert got[k] == tuple(nearest(values, p) for p in (50, 95, 99))


def test_throughput(spark):
    df = spark.createDataFrame([(i,) for i in range(11)], "t int").select(F.timestamp_seconds(F.col("t") * 2).alias("ts"))
    assert stats.throughput(df, "ts").first().rows_per_second == pytest.approx(11 / 20)
    assert stats.throughput(df, "ts", 5).first().rows_per_second == pytest.approx(2.2)
