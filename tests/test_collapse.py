"""The sign algebra against a plain Python replay."""

import random

import pytest
from pyspark.sql import functions as F

from forkline import schemas
from forkline.operators import collapse as sign

KEY = ["k"]


def frame(spark, rows):
    return spark.createDataFrame(rows, "k int, v string, sign tinyint, seq bigint")


def test_worked_example(spark):
    rows = [(1000, "a", 1, 0), (1001, "b", 1, 1), (1002, "c", 1, 2), (1001, "b", -1, 3), (1002, "c", -1, 4),
            (1001, "b2", 1, 5), (1002, "c2", 1, 6)]
    got = {(r.k, r.v) for r in sign.collapse(frame(spark, rows), KEY).collect()}
    assert got == {(1000, "a"), (1001, "b2"), (1002, "c2")}


def test_three_read_modes_differ(spark):
    df = frame(spark, [(i, "x", s, i * 2 + (s < 0)) for s in (1, -1) for i in range(5)])
    assert df.count() == 10 and sign.active_rows(df).count() == 5
    assert sign.net_positive(df, KEY).count() == 0 and sign.collapse(df, KEY).count() == 0
    assert sign.audit(df).first().asDict() == {"total": 10, "commits": 5, "reverts": 5, "net": 0}


def test_filter_on_other_columns_stays_above(spark):
    df = frame(spark, [(1, "a", 1, 0), (1, "a", -1, 1), (1, "b", 1, 2)])
    current = sign.collapse(df, KEY)
    assert current.where("v = 'a'").count() == 0
    plan = current.where("v = 'a' AND k = 1")._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Aggregate"):]
    assert "(k" in below and "= a" not in below


def test_anomalies_are_kept_apart(spark):
    df = frame(spark, [(1, "a", 1, 0), (1, "a", -1, 1), (1, "a", -1, 2), (2, "b", 1, 3), (2, "b", 1, 4)])
    assert [(r.k, r.net, r.commits, r.reverts) for r in sign.anomalies(df, KEY).collect()] == [(1, -1, 1, 2)]
    assert [(r.k, r.seq) for r in sign.collapse(df, KEY).collect()] == [(2, 4)]
    assert sorted((r.k, r.net) for r in sign.integrity_violations(df, KEY).collect()) == [(1, -1), (2, 2)]


def history(seed, n=400):
    """Random commits, reverts and replacements; returns rows and the expected state."""
    r, rows, live, seq = random.Random(seed), [], {}, 0
    for _ in range(n):
        k = min(r.randint(0, 40), r.randint(0, 40))  # low keys are hot
        if k in live:
            rows.append((k, live.pop(k), -1, seq))
            seq += 1
            if r.random() < 0.5:
                continue
        live[k] = f"v{seq}"
        rows.append((k, live[k], 1, seq))
        seq += 1
    return rows, live


@pytest.mark.parametrize("seed", range(3))
def test_random_histories(spark, seed):
    rows, live = history(seed)
    df = frame(spark, random.Random(seed).sample(rows, len(rows))).repartition(5)
    current = sign.collapse(df, KEY)
    assert {r.k: r.v for r in current.collect()} == live
    assert sign.collapse(current, KEY).exceptAll(current).count() == 0
    assert {(r.k, r.v) for r in sign.net_over_all_columns(df).collect()} == set(live.items())
    assert {(r.k, r.v) for r in sign.committed_except_reverted(df).collect()} == set(live.items())


def test_reverted_runs_against_brute_force(spark):
    heights = [1, 2, 3, 7, 9, 10, 511, 512, 513, 514, 2000]
    df = spark.createDataFrame([(h, -1) for h in heights for _ in range(2)], "block_number bigint, sign int")
    got = sorted((r.first_block, r.last_block, r["class"]) for r in sign.reverted_runs(df, width=512).collect())
    assert got == [(1, 3, "shallow"), (7, 7, "shallow"), (9, 10, "shallow"), (511, 514, "medium"), (2000, 2000, "shallow")]


def test_parent_links(spark):
    df = spark.createDataFrame([(1, "a", "z"), (2, "b", "a"), (3, "c", "x"), (5, "e", "d")],
                               "block_number bigint, hash string, parent_hash string")
    assert {r.block_number: r.link for r in sign.parent_links(df).collect()} == {1: "gap", 2: "linked", 3: "broken", 5: "gap"}


def test_parent_links_with_two_hashes_at_a_height(spark):
    rows = [(1, "a", "z"), (2, "b", "a"), (2, "B", "a"), (3, "c", "B"), (4, "d", "x")]
    df = spark.createDataFrame(rows, "block_number bigint, hash string, parent_hash string")
    got = sorted((r["hash"], r.link) for r in sign.parent_links(df).collect())
    assert got == [("B", "ambiguous"), ("a", "gap"), ("b", "ambiguous"), ("c", "linked"), ("d", "broken")]


def test_storage_as_of(spark):
    rows = [(1, 1, b"a", b"s", b"1", 1), (5, 1, b"a", b"s", b"2", 2), (5, -1, b"a", b"s", b"2", 3), (9, 1, b"a", b"s", b"3", 4)]
    df = spark.createDataFrame(rows, "block_number bigint, sign int, address binary, slot binary, value binary, seq bigint")
    at = lambda n: [bytes(r.value) for r in sign.storage_as_of(df, schemas.KEYS["storage_diffs"], n).collect()]
    assert at(0) == [] and at(6) == [b"1"] and at(9) == [b"3"]


def test_aggregate_is_partial_and_spreads_by_the_whole_key(spark, chain):
    plan = sign.collapse(chain.logs, schemas.KEYS["logs"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "hashpartitioning(block_number" in plan and "log_index" in plan
