"""Streams whose result does not depend on the order of files, and the operators that keep state."""

import datetime as dt
import os
import random
import types

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from forkline import schemas
from forkline.operators import collapse as sign, flatten, forks, sketches
from forkline.plans import registered
from forkline.session import STATE_STORE
from forkline.sources import coverage, notifications, schema as ddl, sequence
from forkline.sources.store import Store
from forkline.streaming import live, pipeline, state

from conftest import SF

START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.fixture(scope="module")
def folder(spark, chain, tmp_path_factory):
    """Six files, each with notifications from the whole chain, touched in a random order."""
    path = str(tmp_path_factory.mktemp("n") / "notifications")
    chain.notifications.repartition(6, "seq").write.parquet(path)
    files = sorted(f for f in os.listdir(path) if f.endswith(".parquet"))
    random.Random(3).shuffle(files)
    for i, f in enumerate(files):
        os.utime(f"{path}/{f}", (1_700_000_000 + i, 1_700_000_000 + i))
    return path


@pytest.fixture(scope="module")
def store(spark, folder, tmp_path_factory):
    root = tmp_path_factory.mktemp("s")
    out = Store(spark, str(root / "store"), bucket_width=16)
    sequence.drain(pipeline.start(out, sequence.ranges(spark, folder, 40), str(root / "cp"), "0 seconds"))
    return out


# ---- order by number

def test_batches_come_by_number_and_hold_their_bound(spark, chain, folder, store):
    for name in schemas.TABLES:
        assert same(store.table(name).drop("block_bucket", "month"), getattr(chain, name))
    n = chain.notifications.count()
    tops = [(r["lo"], r["hi"]) for r in store.progress().orderBy("batch").collect()]
    assert len(tops) == -(-n // 40)
    assert all(a[1] <= b[0] + 1 for a, b in zip(tops, tops[1:]))  # heights ascend from batch to batch


def test_reader_bounds_and_late_files(tmp_path):
    write = lambda name, seqs: pq.write_table(pa.table({"seq": pa.array(seqs, pa.int64())}), f"{tmp_path}/{name}.parquet")
    write("a", [5, 1, 9]), write("b", [2, 8, 7, 7])
    reader, offset, taken = sequence.SequenceReader(str(tmp_path), 3), None, []
    offset = reader.initialOffset()
    while True:
        ranges, end = reader.read(offset)
        found = list(ranges)
        assert found == list(reader.readBetweenOffsets(offset, end))
        if end == offset:
            break
        taken.append((end["seq"], end["rows"], sorted((os.path.basename(p)[0], n) for p, _, _, n in found)))
        offset = end
    assert taken == [(5, 3, [("a", 2), ("b", 1)]), (8, 6, [("b", 3)]), (9, 7, [("a", 1)])]
    write("c", [11, 12])
    _, end = reader.read(offset)
    assert end == {"seq": 12, "rows": 9}
    write("d", [3])
    for late in (reader, sequence.SequenceReader(str(tmp_path), 3)):  # also after a restart
        with pytest.raises(sequence.LateNotifications):
            late.read(end)
    assert sequence.SequenceReader(str(tmp_path / "none"), 3).read(offset | {"rows": 0})[1]["rows"] == 0


def test_stream_by_number_goes_on_after_a_restart(spark, chain, tmp_path):
    source, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "cp"))
    for part in ("seq <= 200", "seq > 200"):
        chain.notifications.where(part).coalesce(2).write.mode("append").parquet(source)
        rows = sequence.stream(spark, source, 30)
        sequence.drain(state.start_append(rows.select("seq", "kind"), out, checkpoint, processingTime="0 seconds"))
    got = spark.read.parquet(out)
    assert same(got.drop("batch"), chain.notifications.select("seq", "kind"))
    bounds = got.groupBy("batch").agg(F.count("*").alias("n"), F.min("seq").alias("lo"), F.max("seq").alias("hi")).orderBy("batch").collect()
    assert all(r.n <= 30 for r in bounds) and all(a.hi < b.lo for a, b in zip(bounds, bounds[1:]))


# ---- outcomes

def test_stream_of_some_fields_holds_the_same_rows(spark, folder, tmp_path):
    rows = sequence.stream(spark, folder, 60, fields=["header.number", "state"])
    assert [f.name for f in rows.schema["new"].dataType.elementType] == ["header", "state"]
    out = str(tmp_path / "out")
    sequence.drain(state.start_append(flatten.flatten_state(rows), out, str(tmp_path / "cp"), processingTime="0 seconds"))
    assert same(spark.read.parquet(out).drop("batch"), flatten.flatten_state(notifications.read(spark, folder)))
    with pytest.raises(ValueError):
        sequence.stream(spark, folder, 60, fields=["header.nothing"])


def outcomes(blocks):
    return blocks.groupBy("block_number", "hash").agg(
        F.sum("sign").alias("net"), F.max(F.when(F.col("sign") == 1, F.col("seq"))).alias("seq"))


@pytest.mark.parametrize("finality,keep_ms", [("1 minute", 1000), ("20 days", 10**9)])
def test_outcomes_for_any_file_order(spark, chain, folder, tmp_path, finality, keep_ms):
    rows = flatten.flatten_blocks(notifications.stream(spark, folder, max_files=2))
    out = str(tmp_path / "out")
    state.start_append(state.outcomes(rows, finality, keep_ms), out, str(tmp_path / "cp")).awaitTermination()
    got = state.read_outcomes(spark, out)
    until = chain.blocks.agg(F.max("timestamp") - F.expr(f"INTERVAL {finality}")).first()[0]
    want = outcomes(chain.blocks.where(F.col("timestamp") <= F.lit(until)))
    assert same(got.where(F.timestamp_millis("millis") <= F.lit(until)).select("block_number", "hash", "net", "seq"), want)
    if keep_ms == 1000:
        # late rows came out of the same stream, as corrections
        assert got.where("corrected").count() > 0


def test_series_for_any_file_order(spark, chain, folder, tmp_path):
    rows = flatten.flatten_blocks(notifications.stream(spark, folder, max_files=1))
    state.start_series(rows, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert same(state.read_series(spark, str(tmp_path / "out")), state.block_series(chain.blocks))


# ---- previous values and alerts

def test_previous_values_after_each_batch(spark, tmp_path):
    """Commits, a revert in the middle and a replacement: the batch operator agrees after every batch."""
    a, s = b"a" * 20, b"s" * 32
    row = lambda height, sg, seq, value: (height, sg, a, s, value, seq)
    batches = [[row(1, 1, 1, b"x"), row(5, 1, 2, b"y"), row(9, 1, 3, b"z")], [row(5, -1, 4, b"y")],
               [row(7, 1, 5, b"w"), row(5, 1, 6, b"v")], [row(1, -1, 7, b"x"), row(9, -1, 8, b"z"), row(9, 1, 9, b"q")], [row(3, 1, 10, b"t")]]
    source, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "cp"))
    sent = []
    for batch in batches:
        sent += batch
        spark.createDataFrame(batch, schemas.STORAGE_DIFFS).coalesce(1).write.mode("append").parquet(source)
        rows = spark.readStream.schema(schemas.STORAGE_DIFFS).parquet(source)
        state.start_append(live.previous_slot_values(rows), out, checkpoint).awaitTermination()
        want = sign.previous_slot_value(sign.collapse(spark.createDataFrame(sent, schemas.STORAGE_DIFFS), schemas.KEYS["storage_diffs"]))
        got = live.read_previous(spark.read.parquet(out))
        columns = ["block_number", "address", "slot", "value", "previous_value"]
        assert same(got.select(*columns), want.select(*columns))


def test_alerts_and_absence(spark, tmp_path):
    at = lambda s: START + dt.timedelta(seconds=s)
    source, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "cp"))
    # b goes on, a ends; samples of a batch out of order
    batches = [[(at(60), "a", 20.0), (at(0), "a", 20.0), (at(0), "b", 1.0)], [(at(120), "a", 20.0), (at(180), "a", 1.0), (at(240), "a", 30.0)],
               [(at(900), "b", 1.0)], [(at(2000), "b", 1.0)]]
    for batch in batches:
        spark.createDataFrame([(t, n, None, v) for t, n, v in batch], schemas.METRICS).coalesce(1).write.mode("append").parquet(source)
        rows = spark.readStream.schema(schemas.METRICS).parquet(source)
        state.start_append(live.alerts(rows, F.col("value") > 12, 120_000, "100 seconds", 600_000), out, checkpoint).awaitTermination()
    got = [(r["name"], (r["millis"] - int(START.timestamp() * 1000)) // 1000, r["state"])
           for r in spark.read.parquet(out).orderBy("name", "millis").collect()]
    assert got == [("a", 0, "pending"), ("a", 60, "pending"), ("a", 120, "firing"), ("a", 180, "inactive"), ("a", 240, "pending"),
                   ("a", 840, "absent"), ("b", 0, "inactive"), ("b", 600, "absent"), ("b", 900, "inactive"), ("b", 1500, "absent")]


def test_alerts_keep_samples_that_share_a_millisecond(spark, tmp_path):
    at = lambda us: START + dt.timedelta(microseconds=us)
    source, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "cp"))
    hour = 3_600_000_000
    # written against the order of time; the hold is reached by 100 microseconds only
    for batch in ([(at(300), 20.0), (at(100), 1.0)], [(at(200), 30.0)], [(at(120_000_200), 40.0), (at(120_000_150), 40.0)], [(at(hour), 1.0)]):
        spark.createDataFrame([(t, "a", None, v) for t, v in batch], schemas.METRICS).coalesce(1).write.mode("append").parquet(source)
        rows = spark.readStream.schema(schemas.METRICS).parquet(source)
        state.start_append(live.alerts(rows, F.col("value") > 12, 120_000, "10 minutes", 2 * 3_600_000), out, checkpoint).awaitTermination()
    got = sorted((r["millis"] - int(START.timestamp() * 1000), r["value"], r["state"]) for r in spark.read.parquet(out).collect())
    assert got == [(0, 1.0, "inactive"), (0, 20.0, "pending"), (0, 30.0, "pending"), (120_000, 40.0, "firing"), (120_000, 40.0, "pending")]


class _Handle:
    """State and timers of one key; ``calls`` counts what would go to the state server."""

    def __init__(self):
        self.calls, self.timers = 0, set()

    def _state(self):
        handle, held = self, {}

        class State:
            def __getattr__(self, name):
                handle.calls += 1
                return {"exists": lambda: None in held, "get": lambda: held[None], "update": lambda v: held.__setitem__(None, v),
                        "getValue": held.get, "updateValue": held.__setitem__, "removeKey": held.pop, "keys": lambda: list(held)}[name]
        return State()

    def getValueState(self, name, schema):
        return self._state()

    def getMapState(self, name, key, schema):
        return self._state()

    def registerTimer(self, millis):
        self.calls += 1
        self.timers.add(millis)


def _rows(columns, schema, pack):
    return [r for b in pack([pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*columns), schema)], [n for n, _ in schema])])
            for r in b.to_pylist()]


SAMPLE = [("name", pa.string()), ("micros", pa.int64()), ("value", pa.float64()), ("hot", pa.bool_())]


@pytest.mark.parametrize("merge", [live.MERGE, 300])
def test_alerts_call_the_state_once_for_many_samples(monkeypatch, merge):
    """Samples in any order, over several watermarks: state, start and absence of each, by a few calls."""
    monkeypatch.setattr(live, "MERGE", merge)
    monkeypatch.setattr(live, "CHUNK", 250)
    rnd, hold, absent = random.Random(3), 50, 90
    times = sorted(rnd.sample(range(0, 200_000), 6_000))
    values = [None if rnd.random() < 0.02 else float(rnd.random() < 0.9) * 20 for _ in times]
    samples = [("a", t * 1000, v, v is not None and v > 12) for t, v in zip(times, values)]
    handle, processor, got = _Handle(), live.AlertProcessor(hold, absent), []
    processor.init(handle)

    def timers(watermark):
        for t in sorted(t for t in handle.timers if t <= watermark):
            handle.timers.discard(t)
            packed = [r.asDict() for r in processor.handleExpiredTimer(("a",), types.SimpleNamespace(getCurrentWatermarkInMs=lambda: watermark), None)]
            for r in packed:
                batch = pa.RecordBatch.from_pylist([r], pa.schema([("name", pa.string()), ("part", pa.int64()), ("packed", pa.binary())]))
                got.extend(x for b in live._unpack_alerts([batch]) for x in b.to_pylist())
    for lo, hi in ((0, 2_000), (2_000, 2_100), (2_100, 6_000)):
        some = samples[lo:hi]
        rnd.shuffle(some)
        for a in range(0, len(some), 1_000):
            list(processor.handleInputRows(("a",), iter(_rows(some[a:a + 1_000], SAMPLE, live._pack_samples)), None))
        timers(times[hi - 1] - 100)
    timers(10 ** 6)
    want, since, last = [], None, None
    for t, v, hot in ((x[1] // 1000, x[2], x[3]) for x in samples):
        if last is not None and last + absent < t:
            want.append((last + absent, None, since, "absent"))
        since = (t if since is None else since) if hot else None
        want.append((t, v, since, "inactive" if not hot else "firing" if t >= since + hold else "pending"))
        last = t
    want.append((last + absent, None, since, "absent"))
    key = lambda r: (r[0], r[3] != "absent")
    assert sorted(((r["millis"], r["value"], r["active_since"], r["state"]) for r in got), key=key) == sorted(want, key=key)
    assert handle.calls < len(samples) / 20


CHANGE = [("address", pa.binary()), ("slot", pa.binary()), ("block_number", pa.int64()), ("sign", pa.int64()), ("seq", pa.int64()), ("value", pa.binary())]


@pytest.mark.parametrize("shuffled", [False, True])
def test_previous_values_call_the_state_once_for_many_changes(monkeypatch, shuffled):
    """Commits, reverts and replacements of one slot over many pieces: after every batch what is read
    equals the changes in order, by a few calls."""
    monkeypatch.setattr(live, "HEIGHTS", 64)
    rnd, changes = random.Random(5), []
    for height in rnd.sample(range(0, 2_000), 1_200):
        changes.append((b"a", b"s", height, 1, 8 * height + 1, rnd.choice([b"", b"x%d" % height, None])))
        if rnd.random() < 0.3:
            changes.append((b"a", b"s", height, -1, 8 * height + 2, b"gone"))
            if rnd.random() < 0.5:
                changes.append((b"a", b"s", height, 1, 8 * height + 3, b"y%d" % height))
    changes.sort(key=lambda r: rnd.random() if shuffled else r[4])
    handle, processor, newest = _Handle(), live.SlotProcessor(), {}
    processor.init(handle)
    for a in range(0, len(changes), 300):
        packed = _rows(changes[a:a + 300], CHANGE, live._pack_changes)
        out = [r.asDict() for r in processor.handleInputRows((b"a", b"s"), iter(packed), None)]
        schema = pa.schema([("address", pa.binary()), ("slot", pa.binary()), ("version", pa.int64()), ("packed", pa.binary())])
        for b in live._unpack_changes([pa.RecordBatch.from_pylist(out, schema)]):
            for r in b.to_pylist():
                newest[r["block_number"]] = max(newest.get(r["block_number"], (0,)), (r["version"], r["live"], r["value"], r["previous_value"]), key=lambda v: v[0])
        net, top = {}, {}
        for _, _, height, sg, seq, value in changes[:a + 300]:
            net[height] = net.get(height, 0) + sg
            if sg == 1:
                top[height] = max(top.get(height, (-1, None)), (seq, value), key=lambda v: v[0])
        alive = sorted(h for h in net if net[h] > 0)
        want = {h: (top[h][1], top[alive[i - 1]][1] if i else None) for i, h in enumerate(alive)}
        assert {h: v[2:] for h, v in newest.items() if v[1]} == want
    assert handle.calls < len(changes) / (2 if shuffled else 10)


@pytest.mark.parametrize("name", ["m10_live_alerts", "r13_finalized_blocks", "r13_corrected_outcomes", "t13_live_previous_slot_value"])
def test_streams_with_state_run_under_any_default_store(spark, name):
    before = spark.conf.get(STATE_STORE)
    hdfs = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    spark.conf.set(STATE_STORE, hdfs)
    try:
        registered._RUNS.clear()
        assert registered.QUERIES[name](spark, SF).count() > 0
        assert spark.conf.get(STATE_STORE) == hdfs
    finally:
        spark.conf.set(STATE_STORE, before)


# ---- fork tree

@pytest.mark.parametrize("seed", [1, 2])
def test_fork_tree_of_random_trees(spark, seed):
    rnd = random.Random(seed)
    nodes = {0: None}
    for i in range(1, 150):
        nodes[i] = i - 1 if rnd.random() < 0.7 else rnd.choice([*nodes, 1000 + i])  # some parents are not there
    height = {}
    for i in nodes:
        height[i] = height.get(nodes[i], rnd.randint(0, 5)) + 1
    name = lambda i: None if i is None else i.to_bytes(4, "big")
    rows = [(height[i], name(i), name(p)) for i, p in nodes.items()]
    df = spark.createDataFrame(rows + rows[:20], "block_number bigint, hash binary, parent_hash binary")
    chain, at = [], min(nodes, key=lambda i: (-height[i], i))
    while at in nodes:
        chain.append(at)
        at = nodes[at]
    want = {}
    for i in nodes:
        on, low, steps = i in chain, i, 0
        while nodes[low] in nodes and (nodes[low] in chain) == on:
            low, steps = nodes[low], steps + 1
        want[name(i)] = (height[i], on, name(low), steps)
    got = {bytes(r["hash"]): (r["block_number"], r["on_head_chain"], bytes(r["branch_root"]), r["branch_depth"]) for r in forks.fork_tree(df).collect()}
    assert got == want
    assert forks.fork_tree(df.limit(0)).count() == 0


# ---- sketches

def test_sketches_merge_in_any_order(spark):
    rows = spark.range(40_000).select(
        (F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") % 200_000)).alias("timestamp"),
        F.pmod(F.xxhash64("id"), F.lit(9000)).cast("string").cast("binary").alias("to"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(300)).cast("string").cast("binary").alias("from"),
        (21_000 + F.pmod(F.xxhash64("id", F.lit(2)), F.lit(100_000))).alias("gas_used"))
    parts = sketches.daily(rows, F.col("gas_used") % 13)
    left, right = parts.where("tx_count % 2 = 0"), parts.where("tx_count % 2 = 1")
    one, other = sketches.merge(left.unionByName(right)), sketches.merge(sketches.merge(right).unionByName(sketches.merge(left)))
    got = sketches.compare(rows, one, other).collect()
    assert got and all(r[c] for r in got for c in r.asDict() if c not in ("date", "tx_count"))


# ---- catalog tables, lookup, coverage

def test_published_tables_join_and_collapse_without_a_shuffle(spark, chain, store):
    db, buckets = "forkline_published", 4
    spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
    ddl.create_all(spark, db, buckets)
    for name in ("blocks", "transactions"):
        ddl.publish(store, db, name, buckets)
        ddl.publish(store, db, name, buckets, heights=(1, 2))  # again in part: nothing changes
        assert same(spark.table(f"{db}.{name}").drop("block_bucket", "month"), getattr(chain, name))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        blocks, tx = spark.table(f"{db}.blocks"), spark.table(f"{db}.transactions")
        joined = tx.join(blocks.select("block_number", "seq", "timestamp"), ["block_number", "seq"])
        current = sign.collapse(blocks, schemas.KEYS["blocks"])
        for df in (joined, current):
            assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == chain.transactions.count()
        assert same(current.drop("block_bucket", "month"), sign.collapse(chain.blocks, schemas.KEYS["blocks"]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        ddl.drop_all(spark, db)
    assert store.table("blocks").count() == chain.blocks.count()  # the store is not touched


def test_lookup_opens_the_named_folders_only(spark, chain, store):
    wanted = chain.transactions.where("nonce IN (5, 6, 700)").select("tx_hash")
    got = store.lookup(wanted)
    assert same(got.drop("block_bucket"), chain.transactions.where("sign = 1 AND nonce IN (5, 6, 700)"))
    stored = lambda df: [f for f in df.inputFiles() if "/transactions/batch=" in f]
    folders = {os.path.dirname(f).split("/")[-1] for f in stored(got)}
    assert 0 < len(stored(got)) < len(stored(store.table("transactions"))) / 2 and folders == {"block_bucket=0", "block_bucket=4"}
    assert store.lookup(spark.createDataFrame([(b"no such hash",)], "tx_hash binary")).count() == 0


def test_coverage_and_gaps(spark, store):
    assert [tuple(r) for r in store.coverage().collect()] == [(0, 99)] and store.gaps().count() == 0
    heights = spark.createDataFrame([(h,) for h in [1, 2, 3, 7, 8, 20, 20]], "block_number bigint")
    parts = coverage.ranges(heights, width=5)
    assert sorted(map(tuple, parts.collect())) == [(1, 3), (7, 8), (20, 20)]
    assert same(coverage.batch_ranges(heights), parts) and coverage.batch_ranges(heights.limit(0)).count() == 0
    merged = coverage.merge(parts.unionByName(spark.createDataFrame([(3, 6), (8, 9)], "lo bigint, hi bigint")))
    assert sorted(map(tuple, merged.collect())) == [(1, 9), (20, 20)]
    found = coverage.gaps(merged, 0, 25)
    assert sorted(map(tuple, found.collect())) == [(0, 0), (10, 19), (21, 25)]
    assert sorted(r[0] for r in coverage.heights(found).collect()) == [0, *range(10, 20), *range(21, 26)]


def test_empty_batch_leaves_no_commit(spark, tmp_path):
    out = Store(spark, str(tmp_path / "s"))
    pipeline.ingest_batch(out, spark.createDataFrame([], schemas.NOTIFICATION), 0)
    assert out.progress().count() == 0 and out.committed_by("st-000000000000") is None
