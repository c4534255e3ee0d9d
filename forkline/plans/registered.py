"""Registered queries: each runs an operator over the whole derived tables and, where SQL
can state it, carries the equivalent SQL."""

import time

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, Window, functions as F, types as T

from forkline import schemas
from forkline.fixtures import Chain, LATENCY_BUCKETS
from forkline.functions import bytesx, timex, u256
from forkline.operators import collapse as sign, flatten, forks, metrics, ordered, sketches, stats
from forkline.plans import catalog
from forkline.plans.oracles import CHAIN_SQL
from forkline.session import scratch_dir, shuffles_removed
from forkline.sources import backfill, notifications, schema, sequence
from forkline.sources.store import Store, export_csv
from forkline.streaming import live, pipeline, state
from forkline.streaming.listener import ProgressListener

QUERIES = {}
ORACLES = {}

TOKEN = "000000000000000000000000000000000000c001"
SLOT = "0" * 64
TX_HASH_SQL = "sha256('tx:4')"


def comparable(df: DataFrame) -> DataFrame:
    """Plain column types: hex and decimal text, bigint, double rounded to six places."""
    out = []
    for f in df.schema.fields:
        c, t = F.col(f"`{f.name}`"), f.dataType
        if isinstance(t, T.BinaryType):
            c = bytesx.to_hex(c)
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = timex.format_second(c)
        elif isinstance(t, (T.DateType, T.DecimalType)):
            c = c.cast("string")
        elif isinstance(t, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(t, T.DoubleType):
            c = F.round(c, 6)
        out.append(c.alias(f.name))
    return df.select(*out)


def query(name: str, sql: str | None = None):
    def register(fn):
        def run(spark, sf_dir):
            return comparable(fn(Chain(spark, sf_dir)))
        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = CHAIN_SQL + sql
        return fn
    return register


TS = "strftime({}, '%Y-%m-%d %H:%M:%S')"


def ts(expr):
    return TS.format(expr)


_RUNS = {}


def _once(c: Chain, what: str, make):
    """Run a pipeline once per application and input folder; its tables stay on disk."""
    key = (c.spark.sparkContext.applicationId, c.sf_dir, what)
    if key not in _RUNS:
        _RUNS[key] = make()
    return _RUNS[key]


#: Files of notifications (times a whole number on a long chain), the heights of one of them at most, and
#: bytes of a row group of them: a file is made by one task and read by as many as it has groups.
FILES = 12
HEIGHTS = 5_000
ROW_GROUP = 8 << 20


def _scratch(c: Chain, nested: DataFrame, label: str) -> str:
    path = scratch_dir(c.spark, label)
    with shuffles_removed(c.spark):
        nested.write.option("parquet.block.size", ROW_GROUP).parquet(path)
    return path


def _file_count(c: Chain) -> int:
    return FILES * _once(c, "files", lambda: -(-(c.head + 1) // (FILES * HEIGHTS)))


def _quarter(c: Chain) -> int:
    """Files of a micro-batch: four batches whatever the length of the chain."""
    return _file_count(c) // 4


def _notification_folder(c: Chain) -> str:
    def make():
        # in the order of time, in files by height, so that every stream takes several batches
        files = _file_count(c)
        return _scratch(c, c.nested(files, -(-(c.head + 1) // files)), "notifications")
    return _once(c, "notifications", make)


def _canonical(c: Chain, rows: DataFrame) -> DataFrame:
    """The history to backfill, as files: each table and check reads them, none repeats the netting."""
    return notifications.read_blocks(c.spark, _scratch(c, notifications.canonical_blocks(rows), "history"))


def _notifications(c: Chain) -> DataFrame:
    return notifications.read(c.spark, _notification_folder(c))


# ---- signed tables and sign algebra -------------------------------------------------

BLOCK_COLUMNS = ("block_number, CAST(sign AS BIGINT) AS sign, hash, parent_hash, " + ts("timestamp") + " AS timestamp, gas_used, "
                 "CAST(gas_limit AS BIGINT) AS gas_limit, CAST(base_fee AS VARCHAR) AS base_fee, miner, state_root, extra_data, seq")
TX_COLUMNS = ('tx_hash, block_number, tx_index, CAST(sign AS BIGINT) AS sign, "from", "to", value, input, '
              "CAST(status AS BIGINT) AS status, nonce, gas_limit, gas_used, CAST(gas_price AS VARCHAR) AS gas_price, "
              "CAST(max_fee_per_gas AS VARCHAR) AS max_fee_per_gas, "
              "CAST(max_priority_fee_per_gas AS VARCHAR) AS max_priority_fee_per_gas, CAST(chain_id AS BIGINT) AS chain_id, seq")
LOG_COLUMNS = ("block_number, CAST(sign AS BIGINT) AS sign, tx_hash, tx_index, log_index, address, topic0, topic1, topic2, topic3, data, seq")
DIFF_COLUMNS = "block_number, CAST(sign AS BIGINT) AS sign, address, slot, value, seq"


def _typed(logs):
    return flatten.with_typed_topics(logs).drop("topics")


@query("t1_blocks", f"SELECT {BLOCK_COLUMNS} FROM blocks")
def _(c):
    return flatten.flatten_blocks(_notifications(c))


@query("t2_t3_transactions", f"SELECT {TX_COLUMNS} FROM transactions")
def _(c):
    return flatten.flatten_transactions(_notifications(c))


@query("t4_t5_t12_logs", f"SELECT {LOG_COLUMNS} FROM logs")
def _(c):
    return _typed(flatten.flatten_logs(_notifications(c)))


@query("t6_storage_diffs", f"SELECT {DIFF_COLUMNS} FROM storage_diffs")
def _(c):
    return flatten.flatten_state(_notifications(c))


@query("t7_table_counts", """
SELECT 'blocks' AS name, count(*) AS rows, CAST(sum(sign) AS BIGINT) AS net, max(block_number) AS highest FROM blocks
UNION ALL SELECT 'transactions', count(*), CAST(sum(sign) AS BIGINT), max(block_number) FROM transactions
UNION ALL SELECT 'logs', count(*), CAST(sum(sign) AS BIGINT), max(block_number) FROM logs
UNION ALL SELECT 'storage_diffs', count(*), CAST(sum(sign) AS BIGINT), max(block_number) FROM storage_diffs""")
def _(c):
    out = None
    for name, df in flatten.flatten(_notifications(c)).items():
        part = df.agg(F.count(F.lit(1)).alias("rows"), F.sum("sign").alias("net"),
                      F.max("block_number").alias("highest")).select(F.lit(name).alias("name"), "*")
        out = part if out is None else out.unionByName(part)
    return out


@query("t8_negated_blocks", "SELECT block_number, hash, CAST(-sign AS BIGINT) AS sign FROM blocks")
def _(c):
    return sign.negate(c.blocks).select("block_number", "hash", "sign")


@query("t9_j7_log_hash_enrichment", "SELECT block_number, log_index, seq, tx_hash FROM logs")
def _(c):
    bare = c.logs.withColumn("tx_hash", bytesx.zeros(32))
    return flatten.enrich_log_hash(bare, c.transactions).select("block_number", "log_index", "seq", "tx_hash")


@query("t10_receipt_status", """
SELECT CAST(status AS BIGINT) AS status, count(*) AS transactions, CAST(sum(gas_used) AS BIGINT) AS gas FROM transactions GROUP BY 1""")
def _(c):
    return (flatten.flatten_transactions(_notifications(c)).groupBy("status")
            .agg(F.count(F.lit(1)).alias("transactions"), F.sum("gas_used").alias("gas")))


def _damaged(c: Chain) -> DataFrame:
    """The notifications with a short transaction hash in every tenth block and one receipt
    too few in every tenth other."""
    def block(b):
        tenth = b["header"]["number"] % 10
        cut = F.transform(b["transactions"], lambda t, i: F.when(
            i == 0, t.withField("hash", F.substring(t["hash"], 1, 31))).otherwise(t))
        fewer = F.slice(b["receipts"], 1, F.greatest(F.size(b["receipts"]) - 1, F.lit(0)))
        return (b.withField("transactions", F.when(tenth == 2, cut).otherwise(b["transactions"]))
                .withField("receipts", F.when(tenth == 3, fewer).otherwise(b["receipts"])))
    return _notifications(c).withColumns({side: F.transform(side, block) for side in ("old", "new")})


@query("t10_misaligned_receipts", """
SELECT block_number, CAST(sign AS BIGINT) AS sign, seq, count(*) AS transactions, count(*) - 1 AS receipts
FROM transactions WHERE block_number % 10 = 3 GROUP BY block_number, sign, seq HAVING count(*) > 1""")
def _(c):
    return flatten.misaligned(_damaged(c))


@query("t10_t14_ingest_quarantine", """
SELECT 'transactions' AS "table", 'width' AS reason, count(*) AS n,
       (SELECT count(*) FROM transactions WHERE block_number % 10 <> 2 OR tx_index <> 0) AS good_transactions,
       count(*) + (SELECT count(*) FROM logs WHERE block_number % 10 = 2 AND tx_index = 0) + (SELECT count(*) FROM
         (SELECT 1 FROM transactions WHERE block_number % 10 = 3 GROUP BY block_number, sign, seq HAVING count(*) > 1)) AS counted
FROM transactions WHERE block_number % 10 = 2 AND tx_index = 0""")
def _(c):
    def make():
        store = Store(c.spark, scratch_dir(c.spark, "quarantine"), bucket_width=_bucket_width(c))
        pipeline.ingest_batch(store, _damaged(c), 0)
        return store
    store = _once(c, "damaged", make)
    bad = store.quarantine().where("`table` = 'transactions'").groupBy("table", "reason").agg(F.count(F.lit(1)).alias("n"))
    return bad.withColumns({"good_transactions": store.table("transactions").agg(F.count(F.lit(1))).scalar(),
                            "counted": store.progress().agg(F.sum("quarantined")).scalar()})


@query("t11_effective_gas_price", """
SELECT t.block_number, t.tx_hash, t.seq, CAST(CASE WHEN max_priority_fee_per_gas IS NOT NULL
  THEN least(max_fee_per_gas, base_fee + max_priority_fee_per_gas) ELSE gas_price END AS VARCHAR) AS effective_gas_price
FROM transactions t JOIN blocks b ON t.block_number = b.block_number AND t.seq = b.seq""")
def _(c):
    fees = c.blocks.select("block_number", "seq", "base_fee")
    return c.transactions.join(fees, ["block_number", "seq"]).select(
        "block_number", "tx_hash", "seq", flatten.effective_gas_price(
            "base_fee", "gas_price", "max_fee_per_gas", "max_priority_fee_per_gas").alias("effective_gas_price"))


@query("t13_w3_previous_slot_value", """
SELECT block_number, address, slot, value, lag(value) OVER (PARTITION BY address, slot ORDER BY block_number) AS previous_value
FROM final_diffs""")
def _(c):
    current = sign.collapse(c.storage_diffs, schemas.KEYS["storage_diffs"])
    return sign.previous_slot_value(current).select("block_number", "address", "slot", "value", "previous_value")


@query("t13_live_previous_slot_value", """
SELECT block_number, address, slot, value, lag(value) OVER (PARTITION BY address, slot ORDER BY block_number) AS previous_value
FROM final_diffs""")
def _(c):
    """Kept on write: reverts and replacements change the next change's previous value."""
    def make():
        path = scratch_dir(c.spark, "slots")
        rows = live.previous_slot_values(flatten.flatten_state(_live(c, fields=["header.number", "state"])))
        sequence.drain(state.start_append(rows, path, scratch_dir(c.spark, "slots-cp"), processingTime="0 seconds"))
        return path
    return live.read_previous(c.spark.read.parquet(_once(c, "slots", make))).select(
        "block_number", "address", "slot", "value", "previous_value")


@query("t14_width_check", """
SELECT 'good' AS verdict, count(*) AS rows FROM transactions WHERE "to" IS NOT NULL
UNION ALL SELECT 'quarantined', count(*) FROM transactions WHERE "to" IS NULL""")
def _(c):
    cut = c.transactions.withColumn("to", F.when(F.col("to").isNull(), F.lit(b"\x01")).otherwise(F.col("to")))
    good, bad = flatten.split_by_width(cut, schemas.WIDTHS["transactions"])
    return (good.agg(F.count(F.lit(1)).alias("rows")).select(F.lit("good").alias("verdict"), "rows")
            .unionByName(bad.agg(F.count(F.lit(1)).alias("rows")).select(F.lit("quarantined").alias("verdict"), "rows")))


@query("t15_response_shape", """
SELECT '0x' || tx_hash AS tx_hash, block_number, '0x' || "from" AS "from", '0x' || "to" AS "to", value FROM transactions""")
def _(c):
    return flatten.response_shape(c.transactions.select("tx_hash", "block_number", "from", "to", "value"))


@query("r1_active_blocks", f"SELECT {BLOCK_COLUMNS} FROM blocks WHERE sign = 1")
def _(c):
    return sign.active_rows(c.blocks)


@query("r2_collapse_blocks", f"SELECT {BLOCK_COLUMNS} FROM final_blocks")
def _(c):
    return sign.collapse(c.blocks, schemas.KEYS["blocks"])


@query("r2_collapse_transactions", f"SELECT {TX_COLUMNS} FROM final_transactions")
def _(c):
    return sign.collapse(c.transactions, schemas.KEYS["transactions"])


@query("r2_collapse_logs", f"SELECT {LOG_COLUMNS} FROM final_logs")
def _(c):
    return sign.collapse(_typed(c.logs), schemas.KEYS["logs"])


@query("r2_collapse_storage_diffs", f"SELECT {DIFF_COLUMNS} FROM final_diffs")
def _(c):
    return sign.collapse(c.storage_diffs, schemas.KEYS["storage_diffs"])


@query("r2_collapse_by_height", """
SELECT b.block_number, b.hash, b.seq FROM blocks b JOIN (
  SELECT block_number, sum(sign) AS net, max(seq) FILTER (WHERE sign = 1) AS seq FROM blocks GROUP BY 1) k
ON b.block_number = k.block_number AND b.seq = k.seq WHERE net > 0""")
def _(c):
    return sign.collapse(c.blocks, ["block_number"]).select("block_number", "hash", "seq")


@query("r3_net_positive", "SELECT block_number, hash, CAST(sum(sign) AS BIGINT) AS net FROM blocks GROUP BY 1, 2 HAVING sum(sign) > 0")
def _(c):
    return sign.net_positive(c.blocks, ["block_number", "hash"])


@query("r4_net_all_columns", """
SELECT block_number, address, slot, value, CAST(sum(sign) AS BIGINT) AS net FROM storage_diffs GROUP BY 1, 2, 3, 4 HAVING sum(sign) > 0""")
def _(c):
    return sign.net_over_all_columns(c.storage_diffs)


@query("r4_except_all", """
SELECT block_number, address, slot, value FROM storage_diffs WHERE sign = 1
EXCEPT ALL SELECT block_number, address, slot, value FROM storage_diffs WHERE sign = -1""")
def _(c):
    return sign.committed_except_reverted(c.storage_diffs)


@query("r5_reverted_keys", "SELECT block_number, tx_hash, CAST(sum(sign) AS BIGINT) AS net FROM transactions GROUP BY 1, 2 HAVING sum(sign) = 0")
def _(c):
    return sign.reverted_keys(c.transactions, schemas.KEYS["transactions"])


@query("r6_integrity_violations", "SELECT block_number, hash, CAST(sum(sign) AS BIGINT) AS net FROM blocks GROUP BY 1, 2 HAVING sum(sign) <> 1")
def _(c):
    return sign.integrity_violations(c.blocks, schemas.KEYS["blocks"])


@query("r7_duplicate_reverts", """
SELECT block_number, tx_hash, CAST(sum(sign) AS BIGINT) AS net, count(*) FILTER (WHERE sign = 1) AS commits,
       count(*) FILTER (WHERE sign = -1) AS reverts FROM transactions GROUP BY 1, 2 HAVING sum(sign) < 0""")
def _(c):
    return sign.anomalies(c.transactions, schemas.KEYS["transactions"])


@query("r8_audit", """
SELECT count(*) AS total, count(*) FILTER (WHERE sign = 1) AS commits, count(*) FILTER (WHERE sign = -1) AS reverts,
       CAST(sum(sign) AS BIGINT) AS net FROM logs""")
def _(c):
    return sign.audit(c.logs)


@query("r9_reorg_frequency", f"""
SELECT {ts("date_trunc('day', timestamp)")} AS date, count(DISTINCT block_number) AS reorg_count FROM blocks WHERE sign = -1 GROUP BY 1""")
def _(c):
    return sign.reorg_frequency(c.blocks)


@query("r10_reorg_depths", """
SELECT block_number * 4 + 1 AS seq, CASE WHEN class = 'replaced' THEN 'ChainReorged' ELSE 'ChainReverted' END AS kind,
       CAST(1 AS BIGINT) AS depth, 'shallow' AS class FROM classed WHERE class <> 'plain'
UNION ALL SELECT block_number * 4 + 2, 'ChainReverted', CAST(1 AS BIGINT), 'shallow' FROM classed WHERE class = 'dup_revert'""")
def _(c):
    return sign.reorg_depths(_notifications(c))


@query("r10_reverted_runs", """
, heights AS (SELECT DISTINCT block_number AS n FROM blocks WHERE sign = -1),
islands AS (SELECT n, n - row_number() OVER (ORDER BY n) AS g FROM heights)
SELECT min(n) AS first_block, max(n) AS last_block, count(*) AS depth,
       CASE WHEN count(*) <= 3 THEN 'shallow' WHEN count(*) < 100 THEN 'medium' ELSE 'deep' END AS class
FROM islands GROUP BY g""")
def _(c):
    return sign.reverted_runs(c.blocks)


@query("r12_sign_weighted", """
SELECT "from" AS sender, CAST(sum(sign) AS BIGINT) AS transactions, CAST(sum(sign * gas_used) AS BIGINT) AS gas FROM transactions GROUP BY 1""")
def _(c):
    rows = c.transactions.withColumnRenamed("from", "sender")
    return sign.sign_weighted(rows, ["sender"], {"gas": "gas_used"}, count="transactions")


@query("r14_k6_apply_reorg", """
SELECT block_number, hash, CAST(sign AS BIGINT) AS sign FROM blocks JOIN classed USING (block_number)
WHERE class = 'replaced' AND NOT (sign = 1 AND seq = block_number * 8 + 1)""")
def _(c):
    reorgs = _notifications(c).where("kind = 'ChainReorged'")
    rows = flatten.flatten_blocks(reorgs)
    old, new = rows.where("sign = -1"), rows.where("sign = 1")
    return sign.apply_reorg(sign.negate(old), new).select("block_number", "hash", "sign")


PARENT_SQL = """
SELECT b.block_number, b.hash, b.parent_hash,
       coalesce((SELECT max(p.hash) FROM {t} p WHERE p.block_number + 1 = b.block_number AND p.hash = b.parent_hash),
                (SELECT min(p.hash) FROM {t} p WHERE p.block_number + 1 = b.block_number)) AS below_hash,
       CASE WHEN (SELECT count(DISTINCT p.hash) FROM {t} p WHERE p.block_number = b.block_number) > 1 THEN 'ambiguous'
            WHEN (SELECT count(*) FROM {t} p WHERE p.block_number + 1 = b.block_number) = 0 THEN 'gap'
            WHEN (SELECT count(*) FROM {t} p WHERE p.block_number + 1 = b.block_number AND p.hash = b.parent_hash) > 0
            THEN 'linked' ELSE 'broken' END AS link FROM {t} b"""


@query("r15_parent_links", PARENT_SQL.format(t="final_blocks"))
def _(c):
    return sign.parent_links(sign.collapse(c.blocks, schemas.KEYS["blocks"]))


@query("r15_parent_links_lost_reverts", ", lost AS (SELECT DISTINCT block_number, hash, parent_hash FROM blocks WHERE sign = 1)"
       + PARENT_SQL.format(t="lost"))
def _(c):
    # every commit as if no revert had arrived
    return sign.parent_links(c.blocks.where("sign = 1").select("block_number", "hash", "parent_hash").distinct())


@query("r15_r10_fork_tree", """
, nodes AS (SELECT DISTINCT hash, parent_hash, block_number FROM blocks),
chain AS (SELECT hash, parent_hash, 0 AS d FROM (SELECT * FROM nodes ORDER BY block_number DESC, hash LIMIT 1)
          UNION ALL SELECT n.hash, n.parent_hash, d + 1 FROM chain c JOIN nodes n ON n.hash = c.parent_hash),
low AS (SELECT max(d) AS top, arg_max(hash, d) AS root FROM chain),
off AS (SELECT * FROM nodes WHERE hash NOT IN (SELECT hash FROM chain)),
walk AS (SELECT hash, hash AS lowest, parent_hash AS up, 0 AS d FROM off
         UNION ALL SELECT w.hash, n.hash, n.parent_hash, d + 1 FROM walk w JOIN off n ON n.hash = w.up),
tree AS (SELECT hash, true AS on_head_chain, root AS branch_root, top - d AS branch_depth FROM chain, low
         UNION ALL SELECT hash, false, arg_max(lowest, d), max(d) FROM walk GROUP BY hash)
SELECT block_number, hash, on_head_chain, branch_root, CAST(branch_depth AS BIGINT) AS branch_depth
FROM nodes JOIN tree USING (hash)""")
def _(c):
    # neither sign nor sequence is read
    return forks.fork_tree(c.blocks.select("block_number", "hash", "parent_hash"))


# a recursive term needs the keyword in front of all terms
ORACLES["r15_r10_fork_tree"] = ORACLES["r15_r10_fork_tree"].replace("WITH steps", "WITH RECURSIVE steps", 1)


# ---- filters, joins, scans -----------------------------------------------------------

@query("s4_s10_head", """
SELECT (SELECT max(block_number) FROM blocks) AS head, (SELECT max(block_number) FROM blocks WHERE sign = 1) AS active_head,
       (SELECT max(block_number) FROM final_blocks) AS current_head""")
def _(c):
    current = sign.collapse(c.blocks.select("block_number", "hash", "sign", "seq"), schemas.KEYS["blocks"])
    return c.blocks.agg(F.max("block_number").alias("head"),
                        F.max(F.when(F.col("sign") == 1, F.col("block_number"))).alias("active_head")).withColumn(
        "current_head", current.agg(F.max("block_number")).scalar())


@query("s11_f1_range_scan", "SELECT block_number, hash, seq FROM blocks WHERE block_number BETWEEN 20 AND 60")
def _(c):
    return catalog.block_range(c.blocks, 20, 60).select("block_number", "hash", "seq")


@query("f2_bytes_equality", f"SELECT block_number, log_index, seq FROM logs WHERE address = '{TOKEN}'")
def _(c):
    return c.logs.where(F.col("address") == bytesx.literal(TOKEN, 20)).select("block_number", "log_index", "seq")


@query("f3_f5_gas_threshold", "SELECT tx_hash, seq, gas_used FROM transactions WHERE gas_used > 60000 AND status = 1")
def _(c):
    return c.transactions.where("gas_used > 60000 AND status = 1").select("tx_hash", "seq", "gas_used")


@query("f4_creations_and_calls", """
SELECT "to" IS NULL AS creation, count(*) AS transactions FROM transactions GROUP BY 1""")
def _(c):
    return c.transactions.groupBy(F.col("to").isNull().alias("creation")).agg(F.count(F.lit(1)).alias("transactions"))


@query("f6_token_id_logs", "SELECT block_number, log_index, seq FROM logs WHERE length(topic3) = 64")
def _(c):
    return c.logs.where(F.octet_length(bytesx.topic(3)) == 32).select("block_number", "log_index", "seq")


@query("f7_j5_last_blocks", """
SELECT tx_hash, seq FROM transactions WHERE block_number > (SELECT max(block_number) FROM blocks WHERE sign = 1) - 50""")
def _(c):
    return catalog.last_blocks(c.transactions, c.blocks, 50).select("tx_hash", "seq")


@query("f8_relative_time", """
SELECT block_number, hash, seq FROM blocks WHERE timestamp > (SELECT max(timestamp) FROM blocks) - INTERVAL 2 DAY""")
def _(c):
    newest = timex.reference_time(c.blocks, "timestamp")
    return c.blocks.where(F.col("timestamp") > timex.minus(newest, "2 DAY")).select("block_number", "hash", "seq")


@query("f9_u256_threshold", "SELECT block_number, log_index, seq FROM logs WHERE amount > 1000000000000000000000")
def _(c):
    return c.logs.where(u256.hex_greater("data", 10 ** 21)).select("block_number", "log_index", "seq")


@query("j1_j2_f10_tx_blocks", f"""
SELECT t.tx_hash, t.seq AS tx_seq, b.seq AS block_seq, {ts("b.timestamp")} AS timestamp
FROM transactions t JOIN blocks b ON t.block_number = b.block_number AND b.sign = 1 WHERE t.sign = 1""")
def _(c):
    b = sign.active_rows(c.blocks).select("block_number", "timestamp", F.col("seq").alias("block_seq"))
    return sign.active_rows(c.transactions).join(b, "block_number").select(
        "tx_hash", F.col("seq").alias("tx_seq"), "block_seq", "timestamp")


@query("j4_two_key_join", """
, big AS (SELECT * FROM logs WHERE sign = 1 AND topic0 = 'ddf252ad1be2c89b69c2b068fc378daa952ba7f163c4a11628f55a4df523b3ef'
          AND amount > 1000000000000000000000),
r AS (SELECT DISTINCT block_number, substr(topic2, 25) AS address FROM big),
s AS (SELECT DISTINCT block_number, substr(topic1, 25) AS address FROM big)
SELECT block_number, address, count(*) AS suspicious_transactions FROM r JOIN s USING (block_number, address) GROUP BY 1, 2""")
def _(c):
    return catalog.same_block_large_flows_joined(c.logs)


@query("j6_s5_missing_blocks", """
SELECT n AS block_number FROM range(0, (SELECT max(block_number) + 1 FROM blocks)) r(n)
WHERE n NOT IN (SELECT block_number FROM final_blocks)""")
def _(c):
    current = sign.net_positive(c.blocks, schemas.KEYS["blocks"])
    return backfill.missing_blocks(current, 0, backfill.head(c.blocks))


@query("k1_latest_blocks", f"""
SELECT block_number, hash, {ts("timestamp")} AS timestamp, gas_used, miner FROM blocks WHERE sign = 1
ORDER BY blocks.timestamp DESC, block_number DESC, seq DESC LIMIT 10""")
def _(c):
    return catalog.latest_blocks(c.blocks)


@query("k2_latest_hundred", f"""
SELECT block_number, hash, {ts("timestamp")} AS timestamp, gas_used, miner FROM final_blocks
ORDER BY final_blocks.timestamp DESC, block_number DESC, seq DESC LIMIT 100""")
def _(c):
    return catalog.latest_current_blocks(c.blocks, 100)


@query("k3_lookup_many", """
SELECT tx_hash, block_number, seq FROM transactions WHERE sign = 1 AND tx_hash IN (SELECT sha256('tx:' || (o_orderkey * 7)) FROM orders)""")
def _(c):
    wanted = c.table("orders").select(F.unhex(F.sha2(F.concat(
        F.lit("tx:"), (F.col("o_orderkey") * 7).cast("string")), 256)).alias("tx_hash"))
    return catalog.lookup_transactions(c.transactions, wanted).select("tx_hash", "block_number", "seq")


@query("k5_chain_order", """
SELECT block_number, log_index, address, seq FROM final_logs ORDER BY block_number, log_index""")
def _(c):
    return sign.collapse(c.logs, schemas.KEYS["logs"]).orderBy("block_number", "log_index").select(
        "block_number", "log_index", "address", "seq")


# ---- aggregates and windows ----------------------------------------------------------

@query("a1_a11_tx_count_per_block", "SELECT block_number, count(*) AS tx_count FROM final_transactions GROUP BY 1")
def _(c):
    return catalog.tx_count_per_block(sign.net_positive(c.transactions, schemas.KEYS["transactions"]))


@query("a3_a4_a5_gas_totals", """
SELECT CAST(status AS BIGINT) AS status, CAST(sum(gas_used) AS BIGINT) AS gas, round(avg(gas_used), 6) AS avg_gas, max(gas_used) AS max_gas,
       round(CAST(sum(CAST(gas_used AS HUGEINT) * gas_price) AS DOUBLE) / 1e18, 6) AS ether, round(avg(gas_price / 1e9), 6) AS gwei,
       count("to") AS calls, count(DISTINCT "from") AS senders
FROM transactions WHERE sign = 1 GROUP BY 1""")
def _(c):
    return sign.active_rows(c.transactions).groupBy("status").agg(
        F.sum("gas_used").alias("gas"), F.avg("gas_used").alias("avg_gas"), F.max("gas_used").alias("max_gas"),
        (F.sum(catalog._cost()).cast("double") / 1e18).alias("ether"),
        (F.sum("gas_price").cast("double") / F.count("gas_price") / 1e9).alias("gwei"),
        F.count("to").alias("calls"), F.count_distinct("from").alias("senders"))


@query("a7_quantiles", """
SELECT "to" AS contract, quantile_cont(gas_used, 0.5) AS median_gas, round(quantile_cont(gas_used, 0.95), 6) AS p95_gas
FROM transactions WHERE sign = 1 AND status = 1 AND "to" IS NOT NULL GROUP BY 1""")
def _(c):
    return catalog.contract_gas(c.transactions, c.blocks, last_n=10 ** 15, min_calls=0, k=None).select(
        "contract", "median_gas", "p95_gas")


@query("a9_distinct_senders", 'SELECT DISTINCT "from" AS sender FROM transactions')
def _(c):
    return c.transactions.select(F.col("from").alias("sender")).distinct()


@query("a10_u256_sum", """
SELECT "from" AS sender, CAST(sum(CAST(value AS HUGEINT)) AS VARCHAR) AS total_value,
       CAST(sum(sign * CAST(value AS HUGEINT)) AS VARCHAR) AS net_value FROM transactions GROUP BY 1""")
def _(c):
    return c.transactions.groupBy(F.col("from").alias("sender")).agg(
        u256.sum_signed("value").alias("total_value"),
        u256.sum_signed("value", "sign").alias("net_value"))


DAILY_SQL = """
SELECT strftime(timestamp, '%Y-%m-%d') AS date, "from" AS address, CAST(sum(t.sign) AS BIGINT) AS tx_count,
       CAST(sum(t.sign * t.gas_used) AS BIGINT) AS total_gas, CAST(sum(t.sign * CAST(value AS HUGEINT)) AS VARCHAR) AS total_value
FROM transactions t JOIN blocks b ON t.block_number = b.block_number AND t.seq = b.seq GROUP BY 1, 2"""


@query("a12_daily_sender_stats", DAILY_SQL)
def _(c):
    return catalog.daily_sender_stats(c.transactions, c.blocks)


@query("a14_merge_partials", DAILY_SQL)
def _(c):
    daily = catalog.daily_partials(c.transactions, c.blocks)
    sides = [catalog.daily_sender_stats(daily.where(side).withColumnRenamed("timestamp", "block_time"))
             for side in ("sign = 1", "sign = -1")]
    return catalog.merge_daily(sides[0].unionByName(sides[1]))


@query("a12_a14_daily_sketches", """
SELECT strftime(timestamp, '%Y-%m-%d') AS date, count(*) AS tx_count, true AS receivers_within, true AS senders_within,
       true AS p50_within, true AS p95_within, true AS same_in_any_order
FROM transactions t JOIN blocks b ON t.block_number = b.block_number AND t.seq = b.seq WHERE t.sign = 1 GROUP BY 1""")
def _(c):
    """Merged partials against the exact figures: every estimate within its stated error, and
    the same whichever way the partials are cut."""
    rows = catalog.daily_partials(c.transactions.where("sign = 1"), c.blocks)
    cuts = [sketches.merge(sketches.daily(rows, F.pmod(F.col(k), F.lit(7)))) for k in ("block_number", "nonce")]
    return sketches.compare(rows, *cuts).withColumn("date", F.col("date").cast("string"))


LATENCY_SQL = """
, ranked AS (SELECT {g}value, row_number() OVER ({w}ORDER BY value) - 1 AS i, count(*) OVER ({w2}) AS n FROM {t})
SELECT {g}any_value(n) AS samples, max(value) FILTER (WHERE i = least(n * 50 // 100, n - 1)) AS p50,
       max(value) FILTER (WHERE i = least(n * 95 // 100, n - 1)) AS p95, max(value) FILTER (WHERE i = least(n * 99 // 100, n - 1)) AS p99,
       round(avg(value), 6) AS avg, min(value) AS min, max(value) AS max FROM ranked {b}"""


@query("a15_latency_stats", LATENCY_SQL.format(g="", w="", w2="", t="events", b=""))
def _(c):
    return stats.nearest_rank_stats(c.table("events"), "value")


@query("a15_latency_stats_by_type", LATENCY_SQL.format(
    g="event_type, ", w="PARTITION BY event_type ", w2="PARTITION BY event_type", t="events", b="GROUP BY event_type"))
def _(c):
    return stats.nearest_rank_stats(c.table("events"), "value", ["event_type"])


@query("a16_events_per_block", """
SELECT block_number, CAST(sum(n) AS BIGINT) AS events FROM (
  SELECT block_number, count(*) AS n FROM transactions WHERE sign = 1 GROUP BY 1
  UNION ALL SELECT block_number, count(*) FROM logs WHERE sign = 1 GROUP BY 1
  UNION ALL SELECT block_number, count(*) FROM storage_diffs WHERE sign = 1 GROUP BY 1) GROUP BY 1""")
def _(c):
    return catalog.events_per_block(c.transactions, c.logs, c.storage_diffs)


@query("a17_throughput", """
SELECT count(*) AS rows, round(epoch(max(timestamp)) - epoch(min(timestamp)), 6) AS elapsed_seconds,
       round(count(*) / (epoch(max(timestamp)) - epoch(min(timestamp))), 6) AS rows_per_second FROM blocks""")
def _(c):
    return stats.throughput(c.blocks, "timestamp")


@query("w1_rolling_mean", """
SELECT block_number, seq, strftime(timestamp, '%Y-%m-%d %H:%M') AS time, round(base_fee / 1e9, 6) AS base_fee_gwei,
       round(avg(base_fee) OVER (ORDER BY block_number, seq ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) / 1e9, 6) AS rolling_avg
FROM blocks WHERE sign = 1""")
def _(c):
    return catalog.rolling_base_fee(c.blocks, k=None)


@query("w2_count_over_address", f"""
SELECT block_number, log_index, seq, count(*) OVER (PARTITION BY address) AS total FROM logs""")
def _(c):
    return ordered.count_over(c.logs.select("block_number", "log_index", "seq", "address"), ["address"], "total").drop("address")


# ---- catalogue -----------------------------------------------------------------------

@query("q1_total_blocks", "SELECT count(*) AS total_blocks FROM blocks WHERE sign = 1")
def _(c):
    return catalog.total_blocks(c.blocks)


@query("q2_latest_block", f"""
SELECT block_number, hash AS block_hash, {ts("timestamp")} AS block_time, gas_used, miner FROM blocks WHERE sign = 1
ORDER BY block_number DESC, seq DESC LIMIT 1""")
def _(c):
    return catalog.latest_block(c.blocks)


@query("q3_transaction_detail", f"""
SELECT tx_hash AS transaction, block_number, "from" AS sender, "to" AS recipient, round(CAST(value AS DOUBLE) / 1e18, 6) AS eth_value,
       gas_used, CAST(status AS BIGINT) AS status FROM transactions WHERE sign = 1 AND tx_hash = {TX_HASH_SQL}
ORDER BY block_number DESC, seq DESC LIMIT 1""")
def _(c):
    import hashlib
    return catalog.transaction_detail(c.transactions, hashlib.sha256(b"tx:4").hexdigest())


TOP_GAS_SQL = """
SELECT "from" AS address, count(*) AS tx_count, CAST(sum(gas_used) AS BIGINT) AS total_gas,
       round(CAST(sum(CAST(gas_used AS HUGEINT) * gas_price) AS DOUBLE) / 1e18, 6) AS eth_spent,
       round(CAST(sum(gas_price) AS DOUBLE) / count(*) / 1e9, 6) AS avg_gwei_price
FROM transactions WHERE sign = 1 AND block_number > (SELECT max(block_number) FROM blocks {head}) - {n}
GROUP BY "from" ORDER BY {order} DESC, "from" LIMIT 10"""


@query("q4_top_gas_consumers", TOP_GAS_SQL.format(head="WHERE sign = 1", n=10000, order="total_gas"))
def _(c):
    return catalog.top_gas_consumers(c.transactions, c.blocks)


@query("q4_k4_top_ether_spenders", TOP_GAS_SQL.format(head="", n=1000, order="sum(CAST(gas_used AS HUGEINT) * gas_price)"))
def _(c):
    return catalog.top_gas_consumers(c.transactions, c.blocks, 1000, order_by="eth_spent", active_head=False)


@query("q5_indexing_rate", f"""
SELECT {ts("date_trunc('minute', timestamp)")} AS minute, count(*) AS blocks_indexed, round(sum(gas_used) / 1e6, 6) AS million_gas,
       count(DISTINCT miner) AS unique_miners
FROM blocks WHERE sign = 1 AND timestamp > (SELECT max(timestamp) FROM blocks WHERE sign = 1) - INTERVAL 1 HOUR
GROUP BY date_trunc('minute', timestamp) ORDER BY date_trunc('minute', timestamp) DESC LIMIT 10""")
def _(c):
    return catalog.indexing_rate(c.blocks)


@query("q6_contract_events", f"""
SELECT block_number, log_index, tx_hash AS transaction, topic0 AS event_signature, address AS contract FROM logs
WHERE sign = 1 AND address = '{TOKEN}' AND topic0 = '{catalog.TRANSFER}'
ORDER BY block_number DESC, seq DESC, log_index DESC LIMIT 100""")
def _(c):
    return catalog.contract_events(c.logs, TOKEN)


@query("q7_erc20_transfers", f"""
SELECT block_number, log_index, tx_hash AS transaction, address AS token_contract, topic1 AS from_address, topic2 AS to_address,
       CAST(amount AS VARCHAR) AS amount FROM logs
WHERE sign = 1 AND address = '{TOKEN}' AND topic0 = '{catalog.TRANSFER}' AND block_number > 10
ORDER BY block_number DESC, seq DESC, log_index DESC LIMIT 10""")
def _(c):
    return catalog.erc20_transfers(c.logs, TOKEN, 10)


@query("x5_x6_all_transfer_amounts", f"""
SELECT block_number, log_index, seq, CAST(amount AS VARCHAR) AS amount FROM logs WHERE topic0 = '{catalog.TRANSFER}'""")
def _(c):
    return c.logs.where(F.col("topic0") == bytesx.literal(catalog.TRANSFER)).select(
        "block_number", "log_index", "seq", u256.from_hex(F.col("data")).alias("amount"))


@query("q8_reverted_blocks", """
SELECT block_number, hash AS block_hash, CAST(sum(sign) AS BIGINT) AS net_sign FROM blocks GROUP BY 1, 2 HAVING sum(sign) = 0
ORDER BY block_number DESC, hash LIMIT 10""")
def _(c):
    return catalog.reverted_blocks(c.blocks)


@query("q9_reorg_frequency", f"""
SELECT {ts("date_trunc('day', timestamp)")} AS date, count(DISTINCT block_number) AS reorg_count FROM blocks WHERE sign = -1
GROUP BY 1 ORDER BY 1 DESC LIMIT 30""")
def _(c):
    return catalog.reorg_frequency(c.blocks)


@query("q10_active_block_count", """
SELECT count(*) AS active_blocks FROM (SELECT block_number FROM blocks GROUP BY 1 HAVING sum(sign) > 0)""")
def _(c):
    return catalog.active_block_count(c.blocks)


@query("q11_j3_a2_tx_per_block", f"""
SELECT b.block_number, {ts("b.timestamp")} AS timestamp, count(t.tx_hash) AS tx_count
FROM blocks b LEFT JOIN transactions t ON b.block_number = t.block_number AND t.sign = 1
WHERE b.sign = 1 AND b.block_number BETWEEN 0 AND 1000000 GROUP BY b.block_number, b.timestamp""")
def _(c):
    return catalog.tx_per_block(c.blocks, c.transactions, 0, 1_000_000)


@query("q12_block_series", f"""
SELECT {ts("time_bucket(INTERVAL 5 MINUTE, timestamp)")} AS "interval", count(*) AS blocks, round(avg(gas_used), 6) AS avg_gas,
       max(gas_used) AS max_gas
FROM blocks WHERE sign = 1 AND timestamp > (SELECT max(timestamp) FROM blocks WHERE sign = 1) - INTERVAL 1 DAY GROUP BY 1""")
def _(c):
    return catalog.block_series(c.blocks)


@query("q12_block_series_whole", f"""
SELECT {ts("time_bucket(INTERVAL 5 MINUTE, timestamp)")} AS "interval", count(*) AS blocks, round(avg(gas_used), 6) AS avg_gas,
       max(gas_used) AS max_gas FROM blocks WHERE sign = 1 GROUP BY 1""")
def _(c):
    return catalog.block_series(c.blocks, lookback="10000 DAY")


@query("q13_slot_history", f"""
SELECT block_number, slot AS storage_slot, value AS storage_value FROM storage_diffs
WHERE sign = 1 AND address = '{TOKEN}' AND slot = '{SLOT}' ORDER BY block_number DESC, seq DESC LIMIT 10""")
def _(c):
    return catalog.slot_history(c.storage_diffs, TOKEN, SLOT)


@query("q14_rolling_base_fee", """
SELECT block_number, seq, strftime(timestamp, '%Y-%m-%d %H:%M') AS time, round(base_fee / 1e9, 6) AS base_fee_gwei,
       round(avg(base_fee) OVER (ORDER BY block_number, seq ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) / 1e9, 6) AS rolling_avg
FROM blocks WHERE sign = 1 AND block_number > 5 ORDER BY block_number DESC, seq DESC LIMIT 100""")
def _(c):
    return catalog.rolling_base_fee(c.blocks, min_block=5)


@query("q15_deployments", f"""
SELECT t.block_number, t.tx_hash AS transaction, t."from" AS deployer, t.gas_used, {ts("b.timestamp")} AS deployed_at
FROM transactions t JOIN blocks b ON t.block_number = b.block_number AND b.sign = 1
WHERE t.sign = 1 AND t."to" IS NULL AND t.status = 1 AND t.block_number > 5
ORDER BY t.block_number DESC, t.tx_index DESC, t.seq DESC, b.seq DESC LIMIT 20""")
def _(c):
    return catalog.deployments(c.transactions, c.blocks, 5)


NFT_SQL = f"""
SELECT block_number, log_index, address AS nft_contract, substr(topic1, 25) AS from_address, substr(topic2, 25) AS to_address,
       CAST(token_id AS VARCHAR) AS token_id, count(*) OVER (PARTITION BY address) AS total_transfers
FROM logs WHERE sign = 1 AND topic0 = '{catalog.TRANSFER}' AND length(topic3) = 64 AND block_number > 5"""


@query("q16_nft_transfers", NFT_SQL + " ORDER BY block_number DESC, seq DESC, log_index DESC LIMIT 50")
def _(c):
    return catalog.nft_transfers(c.logs, 5)


@query("q16_nft_transfers_whole", NFT_SQL)
def _(c):
    return catalog.nft_transfers(c.logs, 5, k=None)


CONTRACT_GAS_SQL = """
SELECT "to" AS contract, count(*) AS call_count, round(CAST(sum(gas_used) AS DOUBLE) / count(*), 6) AS avg_gas_per_call,
       round(CAST(sum(CAST(gas_used AS HUGEINT) * gas_price) AS DOUBLE) / 1e18, 6) AS total_eth_cost,
       quantile_cont(gas_used, 0.5) AS median_gas, round(quantile_cont(gas_used, 0.95), 6) AS p95_gas
FROM transactions WHERE sign = 1 AND "to" IS NOT NULL AND status = 1
  AND block_number > (SELECT max(block_number) FROM blocks WHERE sign = 1) - 50000
GROUP BY "to" HAVING count(*) > 100 ORDER BY sum(CAST(gas_used AS HUGEINT) * gas_price) DESC, "to" LIMIT 20"""


@query("q17_contract_gas", CONTRACT_GAS_SQL)
def _(c):
    return catalog.contract_gas(c.transactions, c.blocks)


FLOW_SQL = f"""
, big AS (SELECT * FROM logs WHERE sign = 1 AND topic0 = '{catalog.TRANSFER}' AND amount > 1000000000000000000000),
r AS (SELECT DISTINCT block_number, substr(topic2, 25) AS address FROM big),
s AS (SELECT DISTINCT block_number, substr(topic1, 25) AS address FROM big)
SELECT block_number, address, count(*) AS suspicious_transactions FROM r JOIN s USING (block_number, address) GROUP BY 1, 2"""


@query("q18_same_block_large_flows", FLOW_SQL + " ORDER BY block_number DESC, address LIMIT 10")
def _(c):
    return catalog.same_block_large_flows(c.logs)


@query("q18_same_block_large_flows_whole", FLOW_SQL)
def _(c):
    return catalog.same_block_large_flows(c.logs, k=None)


@query("q18_large_flow_transfers", f"""
, big AS (SELECT * FROM logs WHERE sign = 1 AND topic0 = '{catalog.TRANSFER}' AND amount > 1000000000000000000000)
SELECT block_number, address, CAST(sum(r) AS BIGINT) AS receives, CAST(sum(1 - r) AS BIGINT) AS sends FROM (
  SELECT block_number, substr(topic2, 25) AS address, 1 AS r FROM big
  UNION ALL SELECT block_number, substr(topic1, 25), 0 FROM big) GROUP BY 1, 2 HAVING sum(r) > 0 AND sum(1 - r) > 0""")
def _(c):
    return catalog.large_flow_transfers(c.logs)


@query("q19_daily_active_stats", """
SELECT strftime(timestamp, '%Y-%m-%d') AS date, "from" AS address, count(*) AS tx_count,
       CAST(sum(t.gas_used) AS BIGINT) AS total_gas, CAST(sum(CAST(value AS HUGEINT)) AS VARCHAR) AS total_value
FROM transactions t JOIN blocks b ON t.block_number = b.block_number WHERE t.sign = 1 AND b.sign = 1 GROUP BY 1, 2""")
def _(c):
    return catalog.daily_active_stats(c.transactions, c.blocks)


@query("q19_a13_top_daily", """
, daily AS (SELECT CAST(timestamp AS DATE) AS date, "from" AS address, sum(t.sign) AS tx_count, sum(t.sign * t.gas_used) AS total_gas
  FROM transactions t JOIN blocks b ON t.block_number = b.block_number AND t.seq = b.seq GROUP BY 1, 2)
SELECT strftime(date, '%Y-%m-%d') AS date, address AS sender, CAST(sum(tx_count) AS BIGINT) AS transactions, CAST(sum(total_gas) AS BIGINT) AS gas_used
FROM daily WHERE daily.date >= (SELECT max(date) FROM daily) - 30 GROUP BY daily.date, address ORDER BY gas_used DESC, daily.date, address LIMIT 100""")
def _(c):
    return catalog.top_daily(catalog.daily_sender_stats(c.transactions, c.blocks))


@query("q20_contract_logs", f"SELECT {LOG_COLUMNS} FROM final_logs WHERE address = '{TOKEN}' AND block_number >= 5")
def _(c):
    return _typed(catalog.contract_logs_from(sign.collapse(c.logs, schemas.KEYS["logs"]), TOKEN, 5))


@query("q21_integrity_report", """
SELECT CASE WHEN net = 1 THEN 'active' WHEN net = 0 THEN 'reverted' WHEN net < 0 THEN 'reverted too often' ELSE 'committed twice' END AS outcome,
       CAST(net AS BIGINT) AS net, count(*) AS keys
FROM (SELECT sum(sign) AS net FROM transactions GROUP BY block_number, tx_hash) GROUP BY net""")
def _(c):
    return catalog.integrity_report(c.transactions, schemas.KEYS["transactions"])


@query("q22_storage_as_of", """
SELECT address, slot, max(block_number) AS block_number, arg_max(value, block_number) AS value FROM final_diffs
WHERE block_number <= (SELECT max(block_number) // 2 FROM blocks) GROUP BY 1, 2""")
def _(c):
    middle = c.blocks.agg(F.call_function("div", F.max("block_number"), F.lit(2).cast("bigint"))).scalar()
    return catalog.storage_as_of(c.storage_diffs, middle)


# ---- scalar functions ----------------------------------------------------------------

@query("x1_x4_bytes", """
SELECT tx_hash, seq, lower(tx_hash) AS hex, '0x' || tx_hash AS prefixed, length(input) // 2 AS width,
       substr(tx_hash, 25) AS tail, '0x' || substr(tx_hash, 1, 8) || '...' || substr(tx_hash, 57) AS short
FROM transactions""")
def _(c):
    text = bytesx.to_hex0x(F.col("tx_hash"))
    return c.transactions.select(
        "tx_hash", "seq", bytesx.to_hex("tx_hash").alias("hex"), text.alias("prefixed"),
        F.octet_length(bytesx.from_hex(F.concat(F.lit("0x"), "input"))).alias("width"), F.substring("tx_hash", 13, 20).alias("tail"),
        bytesx.short_hash(text).alias("short"))


@query("x7_x8_u256_round_trip", """
SELECT tx_hash, seq, value, lpad(lower(to_hex(CAST(value AS HUGEINT))), 64, '0') AS word FROM transactions""")
def _(c):
    word = u256.to_be(F.col("value"))
    return c.transactions.select("tx_hash", "seq", u256.from_be(word).alias("value"), word.alias("word"))


BIG = """list_reduce(list_prepend(CAST(0 AS BIGNUM), list_transform(string_split({h}, ''), lambda ch: CAST(CAST('0x' || ch AS INTEGER) AS BIGNUM))),
  lambda a, d: list_reduce([a, a, a, a, a], lambda c, i: c + c) + d)"""


@query("x7_x8_a10_full_width", f"""
, wide AS (SELECT DISTINCT ON (tx_hash) "from", tx_hash, {BIG.format(h="tx_hash")} AS v FROM transactions)
SELECT "from" AS sender, CAST(sum(v) AS VARCHAR) AS total, CAST(max(v) AS VARCHAR) AS largest, count(*) AS back FROM wide GROUP BY 1""")
def _(c):
    """Hashes as numbers of the full 256 bits: decoded, added up, encoded again."""
    rows = c.transactions.select("from", "tx_hash").distinct().withColumn("v", u256.from_be("tx_hash"))
    return rows.groupBy(F.col("from").alias("sender")).agg(
        u256.sum_signed("v").alias("total"), F.max_by("v", "tx_hash").alias("largest"),
        F.count_if(u256.to_be("v") == F.col("tx_hash")).alias("back"))


@query("x9_x12_time", f"""
SELECT block_number, seq, strftime(timestamp, '%Y-%m-%d %H:%M') AS minute_text, {ts("timestamp")} AS second_text,
       {ts("date_trunc('minute', timestamp)")} AS minute, {ts("date_trunc('day', timestamp)")} AS day,
       {ts("time_bucket(INTERVAL 5 MINUTE, timestamp)")} AS five, strftime(timestamp, '%Y%m') AS month,
       block_number // 100000 AS bucket, {ts("timestamp - INTERVAL 1 HOUR")} AS earlier FROM blocks""")
def _(c):
    t = F.col("timestamp")
    return c.blocks.select("block_number", "seq", timex.format_minute(t).alias("minute_text"),
                           timex.format_second(t).alias("second_text"), F.date_trunc("minute", t).alias("minute"),
                           F.date_trunc("day", t).alias("day"), timex.start_of(t, "5 minutes").alias("five"),
                           timex.month_bucket(t).alias("month"), timex.block_bucket().alias("bucket"),
                           timex.minus(t, "1 HOUR").alias("earlier"))


@query("x13_scaling", """
SELECT tx_hash, seq, round(CAST(value AS DOUBLE) / 1e18, 6) AS ether, round(gas_price / 1e9, 6) AS gwei,
       round(gas_used / 1e6, 6) AS million_gas, coalesce("to", '') AS recipient FROM transactions""")
def _(c):
    return c.transactions.select("tx_hash", "seq", u256.scaled("value", 18).alias("ether"),
                                 u256.scaled("gas_price", 9).alias("gwei"), (F.col("gas_used") / 1e6).alias("million_gas"),
                                 F.coalesce(F.hex("to"), F.lit("")).alias("recipient")).withColumn(
        "recipient", F.lower("recipient"))


@query("x15_unix_time", f"SELECT block_number, seq, {ts('timestamp')} AS from_seconds, {ts('timestamp')} AS from_millis FROM blocks")
def _(c):
    return c.blocks.select("block_number", "seq",
                           timex.from_unix(F.unix_seconds("timestamp")).alias("from_seconds"),
                           timex.from_unix(F.unix_millis("timestamp"), "ms").alias("from_millis"))


# ---- metric time series --------------------------------------------------------------

COUNTERS = "name LIKE 'events_total_%'"

DELTA_SQL = """
, deltas AS (SELECT ts, name, value, CASE WHEN p IS NULL THEN 0 WHEN value < p THEN value ELSE value - p END AS delta
  FROM (SELECT ts, name, value, lag(value) OVER (PARTITION BY name ORDER BY ts) AS p FROM metrics WHERE name LIKE 'events_total_%')),
grown AS (SELECT name, time_bucket(INTERVAL 30 MINUTE, ts) AS w, count(*) AS samples, sum(delta) - arg_min(delta, ts) AS inc
  FROM deltas GROUP BY 1, 2)
"""


@query("m1_w4_rate", DELTA_SQL + f"""
SELECT name, {ts("w")} AS window_start, samples, round(CASE WHEN samples >= 2 THEN inc / 1800 END, 6) AS rate FROM grown""")
def _(c):
    return metrics.rate(c.metrics.where(COUNTERS), "30 minutes")


@query("m2_increase", DELTA_SQL + f"""
SELECT name, {ts("w")} AS window_start, samples, CASE WHEN samples >= 2 THEN inc END AS increase FROM grown""")
def _(c):
    return metrics.increase(c.metrics.where(COUNTERS), "30 minutes")


@query("m3_rate_per_minute", DELTA_SQL + f"""
SELECT name, {ts("w")} AS window_start, samples, round(CASE WHEN samples >= 2 THEN inc / 1800 * 60 END, 6) AS rate FROM grown""")
def _(c):
    return metrics.rate(c.metrics.where(COUNTERS), "30 minutes", per_seconds=60)


HISTOGRAM_SQL = f"""
, bounds AS (SELECT unnest({LATENCY_BUCKETS + [1e308]}) AS le),
hist AS (SELECT le, count(*) FILTER (WHERE value <= le) AS count FROM bounds, (SELECT value FROM metrics WHERE name = 'latency_seconds') GROUP BY le)
"""


@query("m4_histogram", HISTOGRAM_SQL + """
SELECT 'latency_seconds' AS name, CASE WHEN le > 1e300 THEN '+Inf' ELSE CAST(le AS VARCHAR) END AS le, count FROM hist""")
def _(c):
    seen = c.metrics.where("name = 'latency_seconds'")
    return metrics.histogram(seen, LATENCY_BUCKETS, ["name"]).withColumn(
        "le", F.when(F.col("le") == float("inf"), "+Inf").otherwise(F.col("le").cast("string")))


@query("m5_histogram_quantile", HISTOGRAM_SQL + """
, pos AS (SELECT le, CAST(count AS DOUBLE) AS c, coalesce(lag(le) OVER (ORDER BY le), 0) AS lo, CAST(coalesce(lag(count) OVER (ORDER BY le), 0) AS DOUBLE) AS lc,
               max(count) OVER () AS total FROM hist),
picked AS (SELECT q, arg_min(CASE WHEN le > 1e300 THEN lo ELSE lo + (le - lo) * (q * total - lc) / (c - lc) END, le) AS v
  FROM pos, (SELECT unnest([0.5, 0.95, 0.99]) AS q) WHERE c >= q * total GROUP BY q)
SELECT 'latency_seconds' AS name, CAST(q AS DOUBLE) AS q, round(v * 1000, 6) AS quantile FROM picked""")
def _(c):
    hist = metrics.histogram(c.metrics.where("name = 'latency_seconds'"), LATENCY_BUCKETS, ["name"])
    out = None
    for q in (0.5, 0.95, 0.99):
        part = metrics.histogram_quantile(hist, q, ["name"], scale=1000.0).withColumn("q", F.lit(q))
        out = part if out is None else out.unionByName(part)
    return out


@query("m6_last_value", f"""
SELECT name, {ts("max(ts)")} AS ts, arg_max(value, ts) AS value FROM metrics GROUP BY name""")
def _(c):
    return metrics.last_value(c.metrics)


@query("m7_saturation", """
SELECT name, value, round(value / 10000 * 100, 6) AS saturation_percent FROM metrics WHERE name = 'buffer_rows'""")
def _(c):
    return metrics.saturation_percent(c.metrics.where("name = 'buffer_rows'").select("name", "value"))


@query("m8_threshold_bands", """
SELECT band, count(*) AS samples FROM (SELECT CASE WHEN value * 100 >= 10000 THEN 'red' WHEN value * 100 >= 8000 THEN 'orange'
  WHEN value * 100 >= 5000 THEN 'yellow' ELSE 'green' END AS band FROM metrics WHERE name = 'buffer_rows') GROUP BY band""")
def _(c):
    band = metrics.threshold_band(F.col("value") * 100, metrics.BUFFER_BANDS, "green")
    return c.metrics.where("name = 'buffer_rows'").groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("samples"))


@query("m9_circuit_health", DELTA_SQL + f"""
SELECT name, {ts("w")} AS window_start, CASE WHEN inc >= 1 THEN 'Circuit Open' ELSE 'Healthy' END AS health FROM grown WHERE samples >= 2""")
def _(c):
    grown = metrics.increase(c.metrics.where(COUNTERS), "30 minutes").where("samples >= 2")
    return grown.select("name", "window_start", metrics.circuit_health(F.col("increase")).alias("health"))


@query("m10_alert_hold", f"""
, marked AS (SELECT ts, name, value, value > 12 AS hot, lag(value > 12) OVER (ORDER BY ts) AS was FROM metrics WHERE name = 'buffer_rows'),
since AS (SELECT *, max(CASE WHEN hot AND NOT coalesce(was, false) THEN ts END) OVER (ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM marked)
SELECT name, {ts("ts")} AS ts, value, {ts("CASE WHEN hot THEN s END")} AS active_since,
       CASE WHEN NOT hot THEN 'inactive' WHEN ts >= s + INTERVAL 10 MINUTE THEN 'firing' ELSE 'pending' END AS state FROM since""")
def _(c):
    return metrics.alert_states(c.metrics.where("name = 'buffer_rows'"), F.col("value") > 12, "10 MINUTES")


@query("m10_live_alerts", f"""
, marked AS (SELECT ts, name, value, value > 12 AS hot, lag(value > 12) OVER (ORDER BY ts) AS was FROM metrics WHERE name = 'buffer_rows'),
since AS (SELECT *, max(CASE WHEN hot AND NOT coalesce(was, false) THEN ts END) OVER (ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM marked)
SELECT name, {ts("ts")} AS ts, value, {ts("CASE WHEN hot THEN s END")} AS active_since,
       CASE WHEN NOT hot THEN 'inactive' WHEN ts >= s + INTERVAL 10 MINUTE THEN 'firing' ELSE 'pending' END AS state FROM since""")
def _(c):
    """The alert of m10 from a stream; samples wait until the watermark is past them."""
    def make():
        source, path = scratch_dir(c.spark, "samples"), scratch_dir(c.spark, "alerts")
        files = _file_count(c) // 2
        c.gauge.repartition(files, "ts").write.parquet(source)
        rows = c.spark.readStream.schema(schemas.METRICS).option("maxFilesPerTrigger", files // 3).parquet(source)
        # files in any order: the delay is the whole span of the samples, and one sample later still lets all go
        samples = c.spark.read.schema(schemas.METRICS).parquet(source)
        span = samples.agg(F.max(F.unix_seconds("ts")) - F.min(F.unix_seconds("ts"))).first()[0] + 1
        last = samples.agg((F.max("ts") + F.make_dt_interval(secs=F.lit(2.0 * span))).alias("ts")).select(
            "ts", F.lit("clock").alias("name"), F.lit(None).cast("double").alias("le"), F.lit(0.0).alias("value"))
        checkpoint = scratch_dir(c.spark, "alerts-cp")

        def run():
            found = live.alerts(rows, F.col("value") > 12, 600_000, f"{span} seconds", absent_ms=3_600_000)
            state.start_append(found, path, checkpoint).awaitTermination()

        run()
        last.write.mode("append").parquet(source)
        run()
        return path
    found = c.spark.read.parquet(_once(c, "alerts", make)).where("name = 'buffer_rows' AND state <> 'absent'")
    return found.select("name", F.timestamp_millis("millis").alias("ts"), "value",
                        F.timestamp_millis("active_since").alias("active_since"), "state")


@query("m11_throughput_drop", DELTA_SQL + f"""
, rates AS (SELECT name, w, CASE WHEN samples >= 2 THEN inc / 1800 END AS rate FROM grown),
based AS (SELECT *, avg(rate) OVER (PARTITION BY name ORDER BY w ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS b FROM rates)
SELECT name, {ts("w")} AS window_start, round(rate, 6) AS rate, round(b, 6) AS baseline, coalesce(rate < b * 0.5, false) AS dropped FROM based""")
def _(c):
    rates = metrics.rate(c.metrics.where(COUNTERS), "30 minutes").drop("samples")
    return metrics.throughput_drops(rates)


@query("m12_missing_scrapes", f"""
, seen AS (SELECT DISTINCT name, CAST(floor(epoch(ts)) AS BIGINT) // 300 AS tick FROM metrics WHERE name LIKE 'events_total_%'),
span AS (SELECT name, min(tick) AS lo, max(tick) AS hi FROM seen GROUP BY 1),
expected AS (SELECT name, unnest(range(lo, hi + 1)) AS tick FROM span)
SELECT e.name, {ts("make_timestamp(e.tick * 300 * 1000000)")} AS missing_from FROM expected e
ANTI JOIN seen s ON e.name = s.name AND e.tick = s.tick""")
def _(c):
    return metrics.missing_scrapes(c.metrics.where(COUNTERS), 300)


@query("m13_series_stats", """
, ranked AS (SELECT name, ts, value, row_number() OVER (PARTITION BY name ORDER BY value) - 1 AS i, count(*) OVER (PARTITION BY name) AS n FROM metrics)
SELECT name, round(avg(value), 6) AS mean, round(max(value), 6) AS max, round(arg_max(value, ts), 6) AS last,
       round(max(value) FILTER (WHERE i = least(n * 95 // 100, n - 1)), 6) AS p95,
       round(max(value) FILTER (WHERE i = least(n * 99 // 100, n - 1)), 6) AS p99
FROM ranked GROUP BY name""")
def _(c):
    return metrics.series_stats(c.metrics)


@query("m14_progress_state", f"""
SELECT name, {ts("max(ts)")} AS ts, arg_max(value, ts) AS value, CASE WHEN arg_max(value, ts) = 0 THEN 'stalled' ELSE 'progressing' END AS state
FROM metrics WHERE name LIKE 'events_total_%' GROUP BY name""")
def _(c):
    return metrics.progress_state(c.metrics.where(COUNTERS))


# ---- storage and streaming -----------------------------------------------------------

def _bucket_width(c: Chain) -> int:
    """At least ten buckets whatever the size of the chain."""
    return _once(c, "width", lambda: max(1, (c.head + 1) // 12))


def _live(c: Chain, source=sequence.stream, **options) -> DataFrame:
    """The notifications as a stream in the order of their numbers, in four to five batches."""
    return source(c.spark, _notification_folder(c), max(1, _notifications(c).count() // 4), **options)


def _streamed(c: Chain) -> Store:
    def make():
        store = Store(c.spark, scratch_dir(c.spark, "store"), bucket_width=_bucket_width(c))
        sequence.drain(pipeline.start(store, _live(c, sequence.ranges), scratch_dir(c.spark, "ingest"), "0 seconds"))
        return store
    return _once(c, "streamed", make)


def _backfilled(c: Chain) -> Store:
    def make():
        store = Store(c.spark, scratch_dir(c.spark, "backfill"))
        history = _canonical(c, _notifications(c))
        # reverted heights that nothing replaced are gaps of the canonical chain
        backfill.run(store, history, after=-1, check_missing=False)
        return store
    return _once(c, "backfilled", make)


def _compacted(c: Chain) -> Store:
    def make():
        store = _streamed(c)
        for name in schemas.TABLES:
            store.compact(name)
        # a second, partial generation must not change the answer
        store.compact("blocks", buckets=(0, 2))
        return store
    return _once(c, "compacted", make)


@query("ms1_ms3_stream_blocks", f"SELECT {BLOCK_COLUMNS} FROM blocks")
def _(c):
    return _streamed(c).table("blocks").drop("block_bucket", "month")


@query("ms3_stream_transactions", f"SELECT {TX_COLUMNS} FROM transactions")
def _(c):
    return _streamed(c).table("transactions").drop("block_bucket", "month")


@query("ms3_stream_logs", f"SELECT {LOG_COLUMNS} FROM logs")
def _(c):
    return _typed(_streamed(c).table("logs")).drop("block_bucket", "month")


@query("ms3_stream_storage_diffs", f"SELECT {DIFF_COLUMNS} FROM storage_diffs")
def _(c):
    return _streamed(c).table("storage_diffs").drop("block_bucket", "month")


@query("ms8_ms11_counters", """
SELECT 'blocks_processed_total' AS name, CAST(count(*) FILTER (WHERE sign = 1) AS DOUBLE) AS value FROM blocks
UNION ALL SELECT 'reverted_blocks_total', CAST(count(*) FILTER (WHERE sign = -1) AS DOUBLE) FROM blocks
UNION ALL SELECT 'reorgs_handled_total', CAST(count(*) FILTER (WHERE sign = -1) AS DOUBLE) FROM blocks
UNION ALL SELECT 'events_captured_total', CAST((SELECT count(*) FROM transactions) + (SELECT count(*) FROM logs)
  + (SELECT count(*) FROM storage_diffs) AS DOUBLE)""")
def _(c):
    return metrics.last_value(_streamed(c).counters()).select("name", "value")


@query("d10_daily_stats_maintained", DAILY_SQL)
def _(c):
    return _streamed(c).daily_sender_stats()


@query("r11_compacted_blocks", f"SELECT {BLOCK_COLUMNS} FROM final_blocks")
def _(c):
    return _compacted(c).current("blocks").drop("block_bucket", "month")


@query("r11_compacted_transactions", f"SELECT {TX_COLUMNS} FROM final_transactions")
def _(c):
    return _compacted(c).current("transactions").drop("block_bucket", "month")


@query("r11_compacted_logs", f"SELECT {LOG_COLUMNS} FROM final_logs")
def _(c):
    return _typed(_compacted(c).current("logs")).drop("block_bucket", "month")


def _seam(c: Chain) -> Store:
    """Backfill up to the middle of the notifications, then live ones numbered from zero,
    among them reorgs and reverts of backfilled heights."""
    def make():
        store = Store(c.spark, scratch_dir(c.spark, "seam"), bucket_width=_bucket_width(c))
        every = _notifications(c)
        # any cut will do; an exact one would count every number in one task
        middle = every.agg(F.percentile_approx("seq", 0.5)).first()[0]
        files = 4 * -(-_file_count(c) // 8)
        width = -(-(4 * (c.head + 1) - middle) // files)
        renumbered = every.where(F.col("seq") > middle).withColumn("seq", F.col("seq") - F.lit(middle))
        live = _scratch(c, renumbered.repartitionById(files, F.call_function("div", F.col("seq"), F.lit(width).cast("bigint")).cast("int")), "seam-live")
        pipeline.backfill_then_live(store, _canonical(c, every.where(F.col("seq") <= middle)),
                                    notifications.stream(c.spark, live, max_files=files // 4),
                                    scratch_dir(c.spark, "seam-cp"), check_missing=False).awaitTermination()
        return store
    return _once(c, "seam", make)


def _tailed(c: Chain) -> Store:
    """Eleven generations of blocks and one of the other tables, then a tail of batches."""
    def make():
        store = Store(c.spark, scratch_dir(c.spark, "tailed"), bucket_width=_bucket_width(c))
        every = _notifications(c)
        cut = every.agg(F.percentile_approx("seq", F.array(F.lit(0.4), F.lit(0.8)))).first()[0]
        parts = (F.col("seq") <= cut[0], (F.col("seq") > cut[0]) & (F.col("seq") <= cut[1]), F.col("seq") > cut[1])
        pipeline.ingest_batch(store, every.where(parts[0]), 0)
        for name in schemas.TABLES:
            store.compact(name)
        pipeline.ingest_batch(store, every.where(parts[1]), 1)
        for i in range(10):
            store.compact("blocks", buckets=(i, i))
        pipeline.ingest_batch(store, every.where(parts[2]), 2)
        return store
    return _once(c, "tailed", make)


def _no_seq(columns: str) -> str:
    return columns.removesuffix(", seq")


_FINAL = {"blocks": "final_blocks", "transactions": "final_transactions", "logs": "final_logs", "storage_diffs": "final_diffs"}

for _name, _columns in (("blocks", BLOCK_COLUMNS), ("transactions", TX_COLUMNS), ("logs", LOG_COLUMNS),
                        ("storage_diffs", DIFF_COLUMNS)):
    @query(f"ms9_backfill_then_live_{_name}", f"SELECT {_no_seq(_columns)} FROM {_FINAL[_name]}")
    def _(c, name=_name):
        rows = sign.collapse(_seam(c).table(name), schemas.KEYS[name]).drop("block_bucket", "month", "seq")
        return _typed(rows) if name == "logs" else rows

    @query(f"r11_latest_{_name}", f"SELECT {_columns} FROM {_FINAL[_name]}")
    def _(c, name=_name):
        rows = _tailed(c).latest(name).drop("block_bucket", "month")
        return _typed(rows) if name == "logs" else rows


@query("r13_ms12_streaming_current", """
SELECT block_number, hash, seq, parent_hash, gas_used FROM final_blocks""")
def _(c):
    def make():
        path = scratch_dir(c.spark, "current")
        rows = flatten.flatten_blocks(notifications.stream(c.spark, _notification_folder(c), max_files=_quarter(c)))
        rows = rows.select("block_number", "hash", "sign", "seq", "parent_hash", "gas_used")
        state.start_current(rows, schemas.KEYS["blocks"], path, scratch_dir(c.spark, "current-cp")).awaitTermination()
        return path
    return state.read_current(c.spark, _once(c, "current", make), schemas.KEYS["blocks"])


OUTCOME_SQL = """
SELECT block_number, hash, CAST(sum(sign) AS BIGINT) AS net, max(seq) FILTER (WHERE sign = 1) AS seq FROM blocks
GROUP BY 1, 2 HAVING any_value(timestamp) <= (SELECT max(timestamp) FROM blocks) - INTERVAL 2 DAY"""


@query("r13_finalized_blocks", OUTCOME_SQL)
def _(c):
    def make():
        path = scratch_dir(c.spark, "final")
        rows = flatten.flatten_blocks(_live(c, fields=["header"]))
        sequence.drain(state.start_append(state.outcomes(rows, "2 days"), path, scratch_dir(c.spark, "final-cp"),
                                          processingTime="0 seconds"))
        return path
    return state.read_outcomes(c.spark, _once(c, "final", make)).select("block_number", "hash", "net", "seq")


@query("r13_corrected_outcomes", OUTCOME_SQL)
def _(c):
    def make():
        # files out of order, a watermark of a minute, state kept for a minute: many rows come late
        source, path = scratch_dir(c.spark, "shuffled"), scratch_dir(c.spark, "early")
        _notifications(c).repartition(_file_count(c), "seq").write.parquet(source)
        rows = flatten.flatten_blocks(notifications.stream(c.spark, source, max_files=_quarter(c)))
        state.start_append(state.outcomes(rows, "1 minute", keep_ms=60_000), path, scratch_dir(c.spark, "early-cp")).awaitTermination()
        return path
    until = flatten.flatten_blocks(_notifications(c)).agg(F.max("timestamp") - F.expr("INTERVAL 2 DAYS")).scalar()
    return state.read_outcomes(c.spark, _once(c, "early", make)).where(
        F.timestamp_millis("millis") <= until).select("block_number", "hash", "net", "seq")


@query("ms13_stream_series", f"""
SELECT {ts("time_bucket(INTERVAL 5 MINUTE, timestamp)")} AS "interval", CAST(sum(sign) AS BIGINT) AS blocks,
       CAST(sum(sign * gas_used) AS BIGINT) AS gas_used FROM blocks GROUP BY 1""")
def _(c):
    def make():
        path = scratch_dir(c.spark, "series")
        rows = flatten.flatten_blocks(notifications.stream(c.spark, _notification_folder(c), max_files=_quarter(c)))
        state.start_series(rows, path, scratch_dir(c.spark, "series-cp")).awaitTermination()
        return path
    return state.read_series(c.spark, _once(c, "series", make))


@query("s5_j6_coverage_gaps", """
, heights AS (SELECT DISTINCT block_number FROM blocks WHERE block_number % 9 <> 4),
ends AS (SELECT block_number AS lo, lead(block_number) OVER (ORDER BY block_number) - 1 AS hi FROM heights)
SELECT lo + 1 AS lo, hi FROM ends WHERE lo + 1 <= hi""")
def _(c):
    """Gaps of a store that was given eight heights of nine, from the ranges its batches left."""
    def make():
        store = Store(c.spark, scratch_dir(c.spark, "holes"), bucket_width=_bucket_width(c))
        middle = backfill.head(c.blocks) // 2
        held = c.blocks.where("block_number % 9 <> 4")
        for i, part in enumerate((held.where(F.col("block_number") <= middle), held.where(F.col("block_number") >= middle))):
            empty = {n: c.spark.createDataFrame([], s) for n, s in schemas.TABLES.items()}
            store.write_batch({**empty, "blocks": part}, f"part-{i}", "test")
        return store
    store = _once(c, "holes", make)
    return store.gaps(store.coverage().agg(F.min("lo")).first()[0])


@query("ms11_d1_metrics_table", """
SELECT 'numInputRows' AS name, CAST(count(*) AS DOUBLE) AS value FROM (SELECT DISTINCT seq // 2 FROM blocks)""")
def _(c):
    """Rows that the micro-batches took in, from the metrics table that the stream fed."""
    def make():
        store = Store(c.spark, scratch_dir(c.spark, "measured"), bucket_width=_bucket_width(c))
        listener = ProgressListener(store, every=2)
        c.spark.streams.addListener(listener)
        try:
            found = notifications.stream(c.spark, _notification_folder(c), max_files=_quarter(c)).select("seq")
            state.start_append(found, scratch_dir(c.spark, "measured-out"), scratch_dir(c.spark, "measured-cp")).awaitTermination()
            # progress events come by a queue of their own
            for _ in range(100):
                if listener.ended:
                    break
                time.sleep(0.1)
        finally:
            c.spark.streams.removeListener(listener)
        listener.flush()
        return store
    samples = _once(c, "measured", make).metrics().where("name LIKE '%.numInputRows'")
    return samples.groupBy(F.lit("numInputRows").alias("name")).agg(F.sum("value").alias("value"))


BUCKETS = 8


def _catalog(c: Chain) -> str:
    """The name of a database whose tables the ingested batches were published to."""
    def make():
        name = "forkline_" + scratch_dir(c.spark, "db").rsplit("-", 1)[1]
        c.spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_dir(c.spark, 'catalog')}'")
        schema.migrate(c.spark, name, [(1, "initial_schema", [schema.create_statement(name, t, BUCKETS) for t in schemas.TABLES])])
        for t in schemas.TABLES:
            schema.publish(_streamed(c), name, t, BUCKETS)
        # again, one range of heights: nothing may change
        schema.publish(_streamed(c), name, "transactions", BUCKETS, heights=(0, 2))
        return name
    return _once(c, "catalog", make)


@query("d2_catalog_transactions", f"SELECT {TX_COLUMNS} FROM transactions")
def _(c):
    return c.spark.table(f"{_catalog(c)}.transactions").drop("block_bucket")


@query("d2_r2_catalog_collapse", f"SELECT {BLOCK_COLUMNS} FROM final_blocks")
def _(c):
    return sign.collapse(c.spark.table(f"{_catalog(c)}.blocks"), schemas.KEYS["blocks"]).drop("month", "block_bucket")


@query("d2_j1_catalog_join", f"""
SELECT t.tx_hash, t.seq, t.block_number, {ts("b.timestamp")} AS timestamp FROM transactions t
JOIN blocks b ON t.block_number = b.block_number AND t.seq = b.seq""")
def _(c):
    db = _catalog(c)
    times = c.spark.table(f"{db}.blocks").select("block_number", "seq", "timestamp")
    return c.spark.table(f"{db}.transactions").join(times, ["block_number", "seq"]).select("tx_hash", "seq", "block_number", "timestamp")


@query("d3_d7_partitions", """
SELECT strftime(timestamp, '%Y%m') AS month, block_number // greatest(1, (SELECT max(block_number) + 1 FROM blocks) // 12) AS block_bucket,
       count(*) AS rows FROM blocks GROUP BY 1, 2""")
def _(c):
    """The folders of the published block table with their rows."""
    return c.spark.table(f"{_catalog(c)}.blocks").groupBy("month", "block_bucket").agg(F.count(F.lit(1)).alias("rows"))


@query("d3_d5_verified", """
SELECT name, CAST(0 AS BIGINT) AS problems, CAST(1 AS BIGINT) AS version, rows FROM (
  SELECT 'blocks' AS name, count(*) AS rows FROM blocks UNION ALL SELECT 'transactions', count(*) FROM transactions
  UNION ALL SELECT 'logs', count(*) FROM logs UNION ALL SELECT 'storage_diffs', count(*) FROM storage_diffs)""")
def _(c):
    """What verification and migrations say about each published table, and how many rows it has."""
    db = _catalog(c)
    problems, version = schema.verify(c.spark, db), schema.current_version(c.spark, db)
    out = None
    for t in schemas.TABLES:
        bad = sum(p.startswith(f"{db}.{t}") for p in problems)
        one = c.spark.table(f"{db}.{t}").agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(t).alias("name"), F.lit(bad).cast("bigint").alias("problems"), F.lit(version).cast("bigint").alias("version"), "rows")
        out = one if out is None else out.unionByName(one)
    return out


@query("k3_f2_hash_index", f"SELECT {TX_COLUMNS} FROM transactions WHERE sign = 1 AND nonce % 97 = 5")
def _(c):
    wanted = _streamed(c).table("transactions").where("nonce % 97 = 5").select("tx_hash")
    return _streamed(c).lookup(wanted).drop("block_bucket")


@query("s2_s6_backfill_blocks", """
SELECT block_number, hash, CAST(sign AS BIGINT) AS sign, parent_hash, extra_data FROM final_blocks""")
def _(c):
    return _backfilled(c).table("blocks").select("block_number", "hash", "sign", "parent_hash", "extra_data")


@query("s2_backfill_logs", """
SELECT block_number, log_index, tx_hash, CAST(sign AS BIGINT) AS sign, data FROM final_logs""")
def _(c):
    return _backfilled(c).table("logs").select("block_number", "log_index", "tx_hash", "sign", "data")


@query("s7_backfill_progress", """
, head2 AS (SELECT max(block_number) AS n FROM blocks),
done AS (SELECT least(lo + 1000000, n) AS hi, n FROM head2, range(-1, (SELECT max(block_number) FROM blocks), 1000000) r(lo))
SELECT hi, round((hi + 1) / (n + 1) * 100, 6) AS percent FROM done""")
def _(c):
    store = _backfilled(c)
    return backfill.progress_percent(store, -1, store.cursor()).drop("batch")


@query("s8_s9_s10_cursor", """
SELECT max(block_number) AS saved, max(block_number) AS cursor FROM blocks""")
def _(c):
    store = _streamed(c)
    return store.progress().agg(F.max("hi").alias("saved")).withColumn("cursor", store.rebuilt_cursor().scalar())


@query("d6_csv_export", """
SELECT CAST(block_number AS VARCHAR) AS block_number, hash, CAST(gas_used AS VARCHAR) AS gas_used FROM blocks WHERE sign = 1""")
def _(c):
    def make():
        path = scratch_dir(c.spark, "csv")
        export_csv(sign.active_rows(c.blocks).select("block_number", "hash", "gas_used"), path)
        return path
    return c.spark.read.schema("block_number string, hash string, gas_used string").option("header", True).csv(
        _once(c, "csv", make))


# ---- reruns, faults, migrations, files -----------------------------------------------

@query("s3_rerun_backfill", """
SELECT CAST(0 AS BIGINT) AS chunks_again, count(*) AS blocks, max(block_number) AS cursor FROM final_blocks""")
def _(c):
    """A backfill whose cursor is at the head does nothing, and leaves what is there."""
    store = _backfilled(c)
    again = backfill.run(store, notifications.canonical_blocks(_notifications(c)), check_missing=False)
    return store.progress().agg(F.lit(again).cast("bigint").alias("chunks_again"), F.sum("committed_blocks").alias("blocks"),
                                F.max("hi").alias("cursor"))


class _Interrupted(Store):
    """A store whose writes fail: ``faults`` names the batch number and the errors it meets in turn."""

    faults: dict = {}

    def append(self, name, df, batch, rebalance=False, bulk=False):
        waiting = self.faults.get(int(batch.rsplit("-", 1)[1]), [])
        if name == "logs" and waiting:
            raise waiting.pop(0)
        return super().append(name, df, batch, rebalance, bulk)


def _interrupted(c: Chain) -> tuple:
    """A stream that meets a passing fault, then one that stops it, and is started again from
    its checkpoint; at last an empty batch.  The store, and the batches committed at the stop."""
    def make():
        store = _Interrupted(c.spark, scratch_dir(c.spark, "interrupted"), bucket_width=_bucket_width(c))
        store.faults = {0: [OSError("connection reset")], 1: [OSError("timeout"), TypeError("wrong row")]}
        checkpoint = scratch_dir(c.spark, "interrupted-cp")

        def stream():
            return pipeline.start(store, notifications.stream(c.spark, _notification_folder(c), max_files=_quarter(c)), checkpoint,
                                  first_delay=0.01)
        try:
            stream().awaitTermination()
        except StreamingQueryException:
            pass
        stopped = store.committed_batches().count()
        stream().awaitTermination()
        pipeline.ingest_batch(store, _notifications(c).limit(0), 10 ** 6)
        return store, stopped
    return _once(c, "interrupted", make)


@query("ms5_ms6_interrupted_transactions", f"SELECT {TX_COLUMNS} FROM transactions")
def _(c):
    return _interrupted(c)[0].table("transactions").drop("block_bucket")


@query("ms5_ms6_interrupted_logs", f"SELECT {LOG_COLUMNS} FROM logs")
def _(c):
    return _typed(_interrupted(c)[0].table("logs")).drop("block_bucket")


@query("ms4_ms6_commits", """
SELECT CAST(1 AS BIGINT) AS batches_at_stop, CAST(0 AS BIGINT) AS empty_batches,
       count(*) FILTER (WHERE sign = 1) AS committed_blocks, count(*) FILTER (WHERE sign = -1) AS reverted_blocks FROM blocks""")
def _(c):
    """The stop left one batch committed, the empty batch left none, and nothing counts twice."""
    store, stopped = _interrupted(c)
    return store.progress().agg(F.lit(stopped).cast("bigint").alias("batches_at_stop"), F.count_if(F.col("rows") == 0).alias("empty_batches"),
                                F.sum("committed_blocks").alias("committed_blocks"), F.sum("reverted_blocks").alias("reverted_blocks"))


def _migrated(c: Chain) -> tuple:
    """A database whose tables are dropped, created and filled again, then migrated by a version
    that derives a table from them.  Its name, problems after the drop, versions pending before."""
    def make():
        name = "forkline_" + scratch_dir(c.spark, "db").rsplit("-", 1)[1]
        c.spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_dir(c.spark, 'migrated')}'")
        schema.migrate(c.spark, name)
        schema.publish(_streamed(c), name, "blocks")
        schema.drop_all(c.spark, name)
        dropped = len(schema.verify(c.spark, name))
        schema.migrate(c.spark, name)
        schema.publish(_streamed(c), name, "blocks")
        steps = [*schema.default_migrations(name), (2, "block_days", [
            f"CREATE TABLE {name}.block_days USING parquet AS SELECT to_date(timestamp) AS day, "
            f"sum(sign) AS blocks, sum(sign * gas_used) AS gas_used FROM {name}.blocks GROUP BY 1"])]
        todo = [m[0] for m in schema.pending(c.spark, name, steps)]
        if schema.migrate(c.spark, name, steps) != 1 or schema.migrate(c.spark, name, steps) != 0:
            raise AssertionError("a migration ran twice or not at all")
        return name, dropped, todo
    return _once(c, "migrated", make)


@query("f11_d5_migrated_days", """
SELECT CAST(CAST(timestamp AS DATE) AS VARCHAR) AS day, CAST(sum(sign) AS BIGINT) AS blocks,
       CAST(sum(sign * gas_used) AS BIGINT) AS gas_used, '2' AS pending, CAST(2 AS BIGINT) AS version FROM blocks GROUP BY 1""")
def _(c):
    name, _, todo = _migrated(c)
    return c.spark.table(f"{name}.block_days").select("day", "blocks", "gas_used", F.lit(",".join(map(str, todo))).alias("pending"),
                                                      F.lit(schema.current_version(c.spark, name)).alias("version"))


@query("d4_dropped_and_filled_again", f"SELECT {BLOCK_COLUMNS}, CAST(4 AS BIGINT) AS problems_after_drop FROM blocks")
def _(c):
    name, dropped, _ = _migrated(c)
    return c.spark.table(f"{name}.blocks").drop("block_bucket", "month").withColumn("problems_after_drop", F.lit(dropped))


@query("d12_definitions", """
SELECT name, provider, buckets, rows FROM (
  SELECT 'blocks' AS name, 'parquet' AS provider, '8' AS buckets, CAST(count(*) AS VARCHAR) AS rows FROM blocks
  UNION ALL SELECT 'transactions', 'parquet', '8', CAST(count(*) AS VARCHAR) FROM transactions
  UNION ALL SELECT 'logs', 'parquet', '8', CAST(count(*) AS VARCHAR) FROM logs
  UNION ALL SELECT 'storage_diffs', 'parquet', '8', CAST(count(*) AS VARCHAR) FROM storage_diffs)""")
def _(c):
    """Storage type, buckets and analysed row count of each published table, as the catalog describes it."""
    db = _catalog(c)
    out = None
    for t in schemas.TABLES:
        c.spark.sql(f"ANALYZE TABLE {db}.{t} COMPUTE STATISTICS")

        def said(key, value=F.col("data_type")):
            return F.max(F.when(F.col("col_name") == key, value))
        one = schema.describe(c.spark, db, t).agg(
            F.lit(t).alias("name"), said("Provider").alias("provider"), said("Num Buckets").alias("buckets"),
            said("Statistics", F.regexp_extract("data_type", "([0-9]+) rows", 1)).alias("rows"))
        out = one if out is None else out.unionByName(one)
    return out


FILE_ROWS = 500
#: On a long chain a bulk file holds this part of the transactions: files grow in size, not in number.
FILE_SHARE = 400


def _bulk_store(c: Chain, label: str, rows: int) -> Store:
    return Store(c.spark, scratch_dir(c.spark, label), bucket_width=_bucket_width(c), compression="lz4", max_records=rows)


def _bulk(c: Chain) -> Store:
    """The four tables written in bulk: clustered by bucket, LZ4, small files, bloom filters."""
    def make():
        store = _bulk_store(c, "bulk", max(FILE_ROWS, 10 * (c.head + 1) // FILE_SHARE))
        store.write_batch({n: getattr(c, n) for n in schemas.TABLES}, "bulk", "test", rebalance=True, bulk=True)
        return store
    return _once(c, "bulk", make)


def _bounded(c: Chain) -> Store:
    """The transactions in bulk, ``FILE_ROWS`` rows a file whatever their number."""
    def make():
        store = _bulk_store(c, "bounded", FILE_ROWS)
        store.append("transactions", c.transactions, "bulk", rebalance=True, bulk=True)
        return store
    return _once(c, "bounded", make)


def _files(store: Store, name: str) -> DataFrame:
    return store.spark.read.schema(schemas.TABLES[name]).parquet(store.path(name, "batch=bulk")).withColumns(
        {"file": F.col("_metadata.file_path"), "place": F.col("_metadata.row_index")})


@query("d8_order_in_files", """
SELECT name, rows, CAST(0 AS BIGINT) AS out_of_order FROM (
  SELECT 'blocks' AS name, count(*) AS rows FROM blocks UNION ALL SELECT 'transactions', count(*) FROM transactions
  UNION ALL SELECT 'logs', count(*) FROM logs UNION ALL SELECT 'storage_diffs', count(*) FROM storage_diffs)""")
def _(c):
    """Rows that stand before their predecessor in the order of their table; a file has a bounded number of rows."""
    out = None
    for t in schemas.TABLES:
        key = F.struct(*schemas.SORT[t])
        before = F.lag(key).over(Window.partitionBy("file").orderBy("place"))
        one = (_files(_bulk(c), t).select(key.alias("_key"), before.alias("_before"))
               .agg(F.lit(t).alias("name"), F.count(F.lit(1)).alias("rows"), F.count_if(F.col("_key") < F.col("_before")).alias("out_of_order")))
        out = one if out is None else out.unionByName(one)
    return out


@query("d11_codec_and_file_size", f"""
SELECT 'lz4' AS codec, true AS bounded, count(*) AS rows, count(*) > {FILE_ROWS} AS several_files FROM transactions""")
def _(c):
    sizes = _files(_bounded(c), "transactions").groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    codec = F.regexp_extract("file", "[.](lz4|zstd|snappy)[^/]*parquet$", 1)
    return sizes.agg(F.array_join(F.array_sort(F.collect_set(codec)), ",").alias("codec"), (F.max("n") <= FILE_ROWS).alias("bounded"),
                     F.sum("n").alias("rows"), (F.count(F.lit(1)) > 1).alias("several_files"))


@query("d9_sender_lookup", f"""
SELECT {TX_COLUMNS} FROM transactions WHERE "from" = (SELECT "from" FROM transactions WHERE sign = 1 ORDER BY block_number DESC, tx_index DESC, seq DESC LIMIT 1)""")
def _(c):
    """Transactions of one sender from files with bloom filters on it; the test counts the rows the scan lets through."""
    rows = _bulk(c).table("transactions").drop("block_bucket")
    newest = sign.active_rows(c.transactions).orderBy(F.desc("block_number"), F.desc("tx_index"), F.desc("seq")).select("from").first()[0]
    return rows.where(F.col("from") == F.lit(newest))
