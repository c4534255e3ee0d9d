"""Notifications nested by offsets, files that grow with the chain, and an ingest that reads each batch no more often than it must."""

import os

import pytest
from pyspark.sql import functions as F

from forkline import schemas
from forkline.fixtures import Chain
from forkline.operators import flatten
from forkline.plans import registered
from forkline.sources.store import Store
from forkline.streaming import pipeline


def rows(df):
    def plain(r):
        sides = {s: [dict(b, state=None if b["state"] is None else {k: dict(v) for k, v in dict(b["state"]).items()}) for b in r[s]]
                 for s in ("old", "new")}
        return dict(r, **sides)
    return sorted((plain(r) for r in df.toArrow().to_pylist()), key=lambda r: (r["seq"], str(r)))


@pytest.mark.parametrize("batch", [7, 10_000])
def test_nested_equals_the_plain_build(spark, chain, batch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        nested = rows(chain.nested(3, 4))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert nested == rows(chain.notifications) and len(nested) > 100


def test_nested_with_gaps_and_repeated_rows(spark, chain, tmp_path):
    """Events that are missing or there twice, blocks without events, transactions without logs."""
    events = chain.table("events").where("event_id % 7 <> 3 AND event_id NOT BETWEEN 200 AND 230")
    events.unionByName(events.where("event_id % 11 = 4")).write.parquet(str(tmp_path / "events.parquet"))
    chain.table("lineitem").where("l_orderkey % 5 <> 2").write.parquet(str(tmp_path / "lineitem.parquet"))
    odd = Chain(spark, str(tmp_path))
    assert rows(odd.nested(2, 30)) == rows(odd.notifications)


def test_nested_takes_one_sort_and_no_join(chain):
    plan = chain.nested(3, 4)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window [" not in plan and "Join" not in plan and plan.count("Sort [") == 1


def test_files_grow_in_number_with_the_chain(spark, monkeypatch):
    monkeypatch.setattr(registered, "HEIGHTS", 2)
    monkeypatch.setattr(registered, "_RUNS", {})
    c = Chain(spark, "/root/testdata/sf0.001")
    assert registered._file_count(c) == 60 and registered._quarter(c) == 15


def test_bulk_files_grow_with_the_chain_and_bounded_ones_do_not(spark, monkeypatch):
    monkeypatch.setattr(registered, "_RUNS", {})
    monkeypatch.setattr(registered, "FILE_ROWS", 3)
    monkeypatch.setattr(registered, "FILE_SHARE", 50)
    c = Chain(spark, "/root/testdata/sf0.001")

    def most(store):
        return registered._files(store, "transactions").groupBy("file").count().agg(F.max("count"), F.sum("count")).first()[:]
    assert most(registered._bounded(c)) == (3, c.transactions.count())
    size, rows = most(registered._bulk(c))
    assert 3 < size <= 20 and rows == c.transactions.count()


def test_clean_batches_are_not_read_for_quarantine(spark, chain, tmp_path, monkeypatch):
    called = []
    kept = Store.append_quarantine
    monkeypatch.setattr(Store, "append_quarantine", lambda self, bad, batch: called.append(batch) or kept(self, bad, batch))
    chain.notifications.repartition(6, "seq").write.parquet(str(tmp_path / "in"))
    clean = spark.read.schema(schemas.NOTIFICATION).parquet(str(tmp_path / "in"))
    store = Store(spark, str(tmp_path / "s"), bucket_width=1000)
    pipeline.ingest_batch(store, clean, 0)
    assert called == [] and store.progress().first()["quarantined"] == 0
    # one bucket, so one file for each first digit of a hash
    index = [f for d, _, fs in os.walk(tmp_path / "s" / "transactions_index") for f in fs if f.endswith(".parquet")]
    assert len(index) == 16
    fewer = F.transform("new", lambda b: b.withField("receipts", F.slice(b["receipts"], 1, F.size(b["receipts"]) - 1)))
    cut = F.transform("new", lambda b: b.withField("header", b["header"].withField("miner", F.lit(b"\x01"))))
    for i, new in ((1, fewer), (2, cut)):
        damaged = clean.withColumn("new", F.when(F.col("seq") < 40, new).otherwise(F.col("new")))
        bad = flatten.set_aside(flatten.flatten(damaged), schemas.WIDTHS, damaged)[1].count()
        pipeline.ingest_batch(store, damaged, i)
        assert bad > 0 and store.progress().where(F.col("batch").endswith(f"{i:012d}")).first()["quarantined"] == bad
    assert len(called) == 2
