"""Storage and streaming: equal to batch whatever the micro-batches, restarts and faults."""

import os
import time

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from forkline import schemas
from forkline.operators import collapse as sign, flatten, metrics
from forkline.plans import catalog, registered
from forkline.session import SHUFFLE_CLEANUP
from forkline.sources import backfill, notifications, schema as ddl, store as store_module
from forkline.sources.store import Store, write_options
from forkline.streaming import pipeline, state
from forkline.streaming.listener import ProgressListener
from forkline.streaming.retry import RetriesExhausted, with_retry


@pytest.fixture(scope="module")
def folder(spark, chain, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("n") / "notifications")
    chain.notifications.repartition(6, "seq").write.parquet(path)
    return path


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def ingest(spark, folder, tmp_path, **kw):
    store = Store(spark, str(tmp_path / "store"), bucket_width=32)
    live = notifications.stream(spark, folder, **kw)
    pipeline.start(store, live, str(tmp_path / "cp")).awaitTermination()
    return store


def test_micro_batches_do_not_change_the_result(spark, chain, folder, tmp_path):
    one = ingest(spark, folder, tmp_path / "one")
    many = ingest(spark, folder, tmp_path / "many", max_files=2)
    assert one.progress().count() == 1 and many.progress().count() == 3
    for name in schemas.TABLES:
        assert same(many.table(name).drop("block_bucket", "month"), one.table(name).drop("block_bucket", "month"))
    assert same(many.table("blocks").drop("block_bucket", "month"), chain.blocks)
    assert same(many.daily_sender_stats(), catalog.daily_sender_stats(chain.transactions, chain.blocks))


def test_replayed_and_restarted_batches_count_once(spark, chain, folder, tmp_path):
    store = ingest(spark, folder, tmp_path, max_files=2)
    before = store.table("logs").count()
    pipeline.ingest_batch(store, notifications.read(spark, folder).limit(0), 0)  # empty batch: a no-op
    pipeline.start(store, notifications.stream(spark, folder, max_files=2), str(tmp_path / "cp")).awaitTermination()
    assert store.table("logs").count() == before == chain.logs.count()


def test_half_written_batch_is_invisible_and_then_replaced(spark, chain, folder, tmp_path):
    store = Store(spark, str(tmp_path / "s"), bucket_width=32)
    batch = notifications.read(spark, folder)
    original, calls = store.append, []

    def flaky(name, df, batch_id, rebalance=False, bulk=False):
        calls.append(name)
        if name == "logs" and calls.count("logs") == 1:
            original("blocks", df.sparkSession.createDataFrame([], schemas.BLOCKS), "unrelated")
            raise OSError("disk went away")
        return original(name, df, batch_id, rebalance)

    store.append = flaky
    with pytest.raises(RetriesExhausted):
        pipeline.ingest_batch(store, batch, 0, attempts=1)
    assert store.table("transactions").count() == 0 and store.cursor() == 0
    delays = []
    pipeline.ingest_batch(store, batch, 0, sleep=delays.append)
    assert delays == []
    for name in schemas.TABLES:
        assert store.table(name).count() == getattr(chain, name).count()


def test_retry_delays_and_permanent_errors():
    delays, tries = [], []

    def down():
        tries.append(1)
        raise OSError("connection refused")

    with pytest.raises(RetriesExhausted, match="after 5 attempts"):
        with_retry(down, sleep=delays.append)
    assert len(tries) == 5 and delays == [1, 2, 4, 8]

    def wrong():
        tries.append(1)
        raise AnalysisException("no such column")

    with pytest.raises(AnalysisException):
        with_retry(wrong, sleep=delays.append)
    assert len(tries) == 6


def test_compaction(spark, chain, folder, tmp_path):
    store = ingest(spark, folder, tmp_path)
    bad = store.compact("blocks")
    assert same(bad, sign.anomalies(chain.blocks, schemas.KEYS["blocks"]))
    want = sign.collapse(chain.blocks, schemas.KEYS["blocks"])
    assert same(store.current("blocks").drop("block_bucket", "month"), want)
    assert same(store.table("blocks").drop("block_bucket", "month"), chain.blocks)  # the log stays
    # a later revert empties a whole bucket; compacting just that bucket must empty it too
    late = want.where("block_number < 32").withColumn("sign", F.lit(-1).cast("byte")).withColumn("seq", F.lit(10 ** 6))
    empty = {n: spark.createDataFrame([], s) for n, s in schemas.TABLES.items()}
    store.write_batch({**empty, "blocks": late}, "zz", "test")
    store.compact("blocks", buckets=(0, 0))
    assert same(store.current("blocks").drop("block_bucket", "month"), want.where("block_number >= 32"))


def shuffled_bytes(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(f.length() for f in (files.apply(i) for i in range(files.size())) if f.getName().startswith("shuffle_"))


@pytest.mark.parametrize("rows", [0, 10 ** 9])
def test_compaction_leaves_no_shuffle_files(spark, chain, folder, tmp_path, monkeypatch, rows):
    """Bucket by bucket or at once, the generation is the same; what was shuffled is gone, the setting as before."""
    monkeypatch.setattr(store_module, "PASS_ROWS", rows)
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    store = ingest(spark, folder, tmp_path)
    held = shuffled_bytes(spark)
    store.compact("logs")
    for _ in range(50):
        # lists of folders are left, a few hundred bytes of each task; the rows themselves were far more
        if shuffled_bytes(spark) - held < 50_000:
            break
        time.sleep(0.2)
    else:
        raise AssertionError("the rows that were shuffled are still on the disk")
    store.compact("blocks")
    for name in ("blocks", "logs"):
        assert same(store.current(name).drop("block_bucket", "month"), sign.collapse(getattr(chain, name), schemas.KEYS[name]))
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == before
    # a part of the buckets: one pass of each, or all at once
    store.compact("logs", buckets=(0, 1))
    assert same(store.current("logs").drop("block_bucket"), sign.collapse(chain.logs, schemas.KEYS["logs"]))
    assert [r[0] for r in store._manifest("logs").where("gen = 2").orderBy("covered_bucket").collect()] == [0, 1]


def test_latest_after_many_generations(spark, chain, folder, tmp_path):
    store = Store(spark, str(tmp_path / "s"), bucket_width=32)
    every = notifications.read(spark, folder)
    pipeline.ingest_batch(store, every.where("seq <= 350"), 0)
    for _ in range(11):
        store.compact("blocks")
    assert store.touched("blocks") == []
    pipeline.ingest_batch(store, every.where("seq > 350"), 1)
    want = sign.collapse(chain.blocks, schemas.KEYS["blocks"])
    assert 0 < len(store.touched("blocks")) < 4
    assert same(store.latest("blocks").drop("block_bucket", "month"), want)
    store.compact("blocks", buckets=(3, 3))
    assert 3 not in store.touched("blocks")
    assert same(store.latest("blocks").drop("block_bucket", "month"), want)


def test_two_streams_in_one_store(spark, chain, folder, tmp_path):
    store = Store(spark, str(tmp_path / "s"), bucket_width=32)
    every = notifications.read(spark, folder)
    for i, part in enumerate(("seq <= 200", "seq > 200")):
        source = str(tmp_path / f"in{i}")
        every.where(part).write.parquet(source)
        pipeline.start(store, notifications.stream(spark, source), str(tmp_path / f"cp{i}")).awaitTermination()
    assert same(store.table("blocks").drop("block_bucket", "month"), chain.blocks)


def test_committed_batch_is_left_alone(spark, folder, tmp_path):
    store = Store(spark, str(tmp_path / "s"), bucket_width=32)
    every = notifications.read(spark, folder)
    pipeline.ingest_batch(store, every, 0)
    reader, n = store.table("blocks"), store.table("blocks").count()
    pipeline.ingest_batch(store, every.where("seq <= 8"), 0)  # a replay with less input
    assert reader.count() == n == store.table("blocks").count()
    with pytest.raises(ValueError, match="committed by stream"):
        store.write_batch(flatten.flatten(every), "st-000000000000", "other")


def test_bounds_reach_the_scan_below_collapse(spark, folder, tmp_path):
    store = ingest(spark, folder, tmp_path)
    current = sign.collapse(store.table("logs"), schemas.KEYS["logs"])
    some = catalog.block_range(current, 40, 50)
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert any("block_bucket" in p.split("]")[0] for p in plan.split("PartitionFilters:")[1:])
    assert some.count() == current.where("block_number BETWEEN 40 AND 50").count()


def test_pruning_by_height(spark, folder, tmp_path):
    store = ingest(spark, folder, tmp_path)
    logs = store.table("logs")
    plan = catalog.block_range(logs, 40, 50)._jdf.queryExecution().executedPlan().toString()
    assert "block_bucket" in plan.split("PartitionFilters:")[1].split("]")[0]
    assert catalog.block_range(logs, 40, 50).count() == logs.where("block_number BETWEEN 40 AND 50").count()
    recent = catalog.last_blocks(logs, store.table("blocks"), 20)
    assert recent.count() == logs.where("block_number > 79").count()


def test_pruning_by_month(spark, chain, folder, tmp_path):
    store = ingest(spark, folder, tmp_path)
    series = catalog.block_series(store.table("blocks"), as_of="2024-01-20 00:00:00")
    plan = series._jdf.queryExecution().executedPlan().toString()
    assert "month" in plan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert same(series, catalog.block_series(chain.blocks, as_of="2024-01-20 00:00:00"))
    exact = catalog.indexing_rate(chain.blocks, lookback="30 DAY", k=None)
    assert same(catalog.indexing_rate(store.table("blocks"), lookback="30 DAY", k=None, approximate=True), exact)


def test_backfill_resumes_and_reports_gaps(spark, chain, folder, tmp_path):
    store = Store(spark, str(tmp_path / "s"), bucket_width=32)
    history = notifications.committed_blocks(notifications.read(spark, folder)).cache()
    assert backfill.run(store, history, batch_size=30, after=-1, to=59) == 2
    assert store.cursor() == 59
    assert backfill.run(store, history, batch_size=30) == 2 and store.cursor() == 99
    assert backfill.run(store, history, batch_size=30) == 0  # cursor at head
    want = chain.blocks.where("seq = block_number * 8 + 1").select("block_number", "hash", "gas_used")
    assert same(want, store.table("blocks"))
    percents = [r.percent for r in backfill.progress_percent(store, -1, 99).orderBy("hi").collect()]
    assert percents == [30, 60, 90, 100]
    with pytest.raises(backfill.MissingBlocks, match="block 50 "):
        backfill.run(Store(spark, str(tmp_path / "t")), history.where("header.number <> 50"), after=-1)


def test_backfill_then_stream(spark, chain, folder, tmp_path):
    store = Store(spark, str(tmp_path / "s"), bucket_width=32)
    every = notifications.read(spark, folder)
    early = F.coalesce(F.get("new", F.lit(0)), F.get("old", F.lit(0)))["header"]["number"] < 50
    backfill.run(store, notifications.committed_blocks(every.where(early)), after=-1, to=49)
    later = str(tmp_path / "later")
    every.where(~early).write.parquet(later)
    pipeline.start(store, notifications.stream(spark, later), str(tmp_path / "cp")).awaitTermination()
    got = sign.net_positive(store.table("blocks").where("block_number >= 50"), schemas.KEYS["blocks"])
    assert same(got, sign.net_positive(chain.blocks.where("block_number >= 50"), schemas.KEYS["blocks"]))
    assert store.table("blocks").where("block_number < 50").count() == 50


def test_streaming_state_is_batch_state_for_any_split(spark, chain, folder, tmp_path):
    keys = schemas.KEYS["blocks"]
    want = sign.collapse(chain.blocks.select("block_number", "hash", "sign", "seq", "gas_used"), keys)
    for files in (1, 6):
        rows = flatten.flatten_blocks(notifications.stream(spark, folder, max_files=files))
        path = str(tmp_path / f"cur{files}")
        state.start_current(rows.select("block_number", "hash", "sign", "seq", "gas_used"), keys, path,
                            str(tmp_path / f"cp{files}")).awaitTermination()
        assert same(state.read_current(spark, path, keys), want)
        negative = state.read_versions(spark, path, keys).where("net < 0").count()
        assert negative == sign.anomalies(chain.blocks, keys).count()


def test_listener_and_counters(spark, folder, tmp_path):
    listener = ProgressListener(Store(spark, str(tmp_path / "store")), every=1)
    spark.streams.addListener(listener)
    try:
        store = ingest(spark, folder, tmp_path, max_files=3)
        for _ in range(100):
            if listener.ended:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    samples = store.metrics()
    assert samples.where("name LIKE '%.numInputRows'").agg(F.sum("value")).first()[0] > 0
    assert metrics.increase(samples.where("name = 'blocks_processed_total'"), "1 hour").count() > 0
    assert {r[0] for r in store.counters().select("name").distinct().collect()} == {
        "blocks_processed_total", "events_captured_total", "reorgs_handled_total", "reverted_blocks_total"}


def test_ddl_and_migrations(spark):
    db = "forkline_test"
    spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
    assert ddl.migrate(spark, db) == 1 and ddl.migrate(spark, db) == 0
    assert spark.table(f"{db}.schema_migrations").count() == 1 and ddl.current_version(spark, db) == 1
    more = [*ddl.default_migrations(db), (3, "third", [f"CREATE TABLE {db}.c (i int) USING parquet"]),
            (2, "second", [f"CREATE TABLE {db}.b (i int) USING parquet"])]
    assert [m[0] for m in ddl.pending(spark, db, more)] == [2, 3]
    assert ddl.migrate(spark, db, more) == 2 and ddl.current_version(spark, db) == 3
    ddl.create_all(spark, db)
    assert ddl.verify(spark, db) == []
    assert "PARTITIONED BY (block_bucket)" in ddl.show_create(spark, db, "logs")
    assert "PARTITIONED BY (month, block_bucket)" in ddl.show_create(spark, db, "blocks")
    assert ddl.describe(spark, db, "logs").where("col_name = 'topics'").count() == 1
    ddl.drop_all(spark, db)
    assert len(ddl.verify(spark, db)) == 4
    ddl.create_all(spark, db, buckets=4)
    assert "CLUSTERED BY (block_number)" in ddl.show_create(spark, db, "blocks")
    assert ddl.verify(spark, db) == []
    ddl.drop_all(spark, db)


def test_bulk_files_carry_bloom_filters(spark, chain, tmp_path):
    assert "parquet.bloom.filter.enabled#from" in write_options("transactions")
    assert not any("bloom" in k for k in write_options("transactions", bulk=False))
    store = Store(spark, str(tmp_path / "s"), compression="snappy", max_records=500)
    store.append("transactions", chain.transactions, "b", rebalance=True, bulk=True)
    files = [os.path.join(d, f) for d, _, fs in os.walk(tmp_path) for f in fs if f.endswith(".parquet")]
    assert len(files) >= 3 and all("snappy" in f for f in files)


def test_bloom_filters_skip_row_groups(spark, chain, tmp_path):
    """Rows the scan lets through for a hash nobody has, which lies inside every file's range."""
    # each hash once, as in a long table: then pages hold no dictionary that would skip as well
    once, read = chain.transactions.dropDuplicates(["tx_hash"]), {}
    for bulk in (True, False):
        store = Store(spark, str(tmp_path / str(bulk)), max_records=500)
        store.append("transactions", once, "b", rebalance=True, bulk=bulk)
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            rows = spark.read.schema(schemas.TRANSACTIONS).parquet(store.path("transactions", "batch=b")).where(
                F.col("tx_hash") == F.unhex(F.lit("7f" + "00" * 31)))
            assert rows.collect() == []
            scan = rows._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
            read[bulk] = scan.metrics().get("numOutputRows").get().value()
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert read[False] > 0.9 * once.count() and read[True] < 0.1 * read[False]


def test_notifications_order_the_logs_twice_only(chain):
    plan = chain.notifications._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 2


def test_history_is_read_from_files(spark, chain):
    history = registered._canonical(chain, chain.notifications)
    assert "Exchange" not in history._jdf.queryExecution().executedPlan().toString()
    assert same(history.select("header"), notifications.canonical_blocks(chain.notifications).select("header"))


def test_publication_deals_by_bucket_and_heights(spark, chain, tmp_path, monkeypatch):
    monkeypatch.setattr(ddl, "HEIGHTS", 25)
    store = Store(spark, str(tmp_path / "store"), bucket_width=50)
    store.write_batch(chain.tables, "b-0", "test")
    name = f"published_{tmp_path.name.replace('-', '_')}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path / 'db'}'")
    spark.sql(ddl.create_statement(name, "transactions", 4))
    ddl.publish(store, name, "transactions", 4)
    table = spark.table(f"{name}.transactions")
    assert same(table.drop("block_bucket"), chain.transactions)
    # each file holds heights of one task's range and of one bucket
    files = table.groupBy(F.input_file_name()).agg(
        F.count_distinct(F.pmod(F.hash("block_number"), F.lit(4))).alias("buckets"), F.count_distinct(F.floor(F.col("block_number") / 25)).alias("ranges"))
    assert files.agg(F.max("buckets"), F.max("ranges"), F.count("*") > 8).first()[:] == (1, 1, True)
