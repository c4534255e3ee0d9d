"""The query catalogue.  Every function takes and returns DataFrames.

Signed tables are read the way the catalogue defines it, with ``sign = 1``; pass
collapsed tables to leave out rows that were reverted later.  ``k=None`` returns the
whole result; otherwise a top-k in a total order.
"""

from pyspark.sql import DataFrame, Window, functions as F

from forkline import schemas
from forkline.functions import bytesx, timex, u256
from forkline.operators import collapse as sign, ordered

TRANSFER = "ddf252ad1be2c89b69c2b068fc378daa952ba7f163c4a11628f55a4df523b3ef"
THOUSAND_TOKENS = 10 ** 21


def _top(df: DataFrame, order: list, k) -> DataFrame:
    return df.orderBy(*order) if k is None else df.orderBy(*order).limit(k)


def head_block(blocks: DataFrame, active_only: bool = True):
    """Newest height as a scalar subquery."""
    return (sign.active_rows(blocks) if active_only else blocks).agg(F.max("block_number")).scalar()


def last_blocks(df: DataFrame, blocks: DataFrame, n: int, active_only: bool = True) -> DataFrame:
    """Rows of the last ``n`` blocks.  Where the table is laid out by ``block_bucket`` the
    same bound also prunes partitions."""
    low = head_block(blocks, active_only) - n
    out = df.where(F.col("block_number") > low)
    width = bucket_width(df)
    return out if width is None else out.where(F.col("block_bucket") >= timex.block_bucket(low, width))


def bucket_width(df: DataFrame):
    """Heights per ``block_bucket`` of a stored table, kept in the column's metadata."""
    if "block_bucket" not in df.columns:
        return None
    return df.schema["block_bucket"].metadata.get("width")


def block_range(df: DataFrame, lo: int, hi: int) -> DataFrame:
    """Rows with ``lo <= block_number <= hi``, with partition pruning where possible."""
    out = df.where(F.col("block_number").between(lo, hi))
    width = bucket_width(df)
    return out if width is None else out.where(F.col("block_bucket").between(lo // width, hi // width))


def from_block(df: DataFrame, min_block: int) -> DataFrame:
    """Rows above a height, with partition pruning where possible."""
    out = df.where(F.col("block_number") > min_block)
    width = bucket_width(df)
    return out if width is None else out.where(F.col("block_bucket") >= min_block // width)


def _cost(gas="gas_used", price="gas_price"):
    return F.col(gas).cast("decimal(20,0)") * F.col(price)


def total_blocks(blocks: DataFrame) -> DataFrame:
    return sign.active_rows(blocks).agg(F.count(F.lit(1)).alias("total_blocks"))


def latest_blocks(blocks: DataFrame, k: int = 10) -> DataFrame:
    rows = sign.active_rows(blocks).select("block_number", "hash", "timestamp", "gas_used", "miner", "seq")
    return _top(rows, [F.desc("timestamp"), F.desc("block_number"), F.desc("seq")], k).drop("seq")


def latest_current_blocks(blocks: DataFrame, k: int = 100) -> DataFrame:
    """The last ``k`` blocks of the current state of a signed table.

    Block times rise with the height, so the top heights decide.  Only they are collapsed; the
    bound moves down, fourfold each time, while reverts leave fewer than ``k`` of them."""
    ends = blocks.agg(F.max("block_number").alias("hi"), F.min("block_number").alias("lo")).first()
    span = 2 * k
    while True:
        low = -1 if ends["hi"] is None else ends["hi"] - span
        rows = sign.collapse(from_block(blocks, low), schemas.KEYS["blocks"])
        if ends["hi"] is None or low < ends["lo"] or len(rows.select("block_number").limit(k).collect()) == k:
            return latest_blocks(rows, k)
        span *= 4


def latest_block(blocks: DataFrame) -> DataFrame:
    rows = sign.active_rows(blocks).orderBy(F.desc("block_number"), F.desc("seq")).limit(1)
    return rows.select("block_number", bytesx.to_hex("hash").alias("block_hash"),
                       timex.format_second("timestamp").alias("block_time"), "gas_used",
                       bytesx.to_hex("miner").alias("miner"))


def transaction_detail(transactions: DataFrame, tx_hash: str) -> DataFrame:
    """The newest committed row of a transaction; an empty result means not found."""
    rows = sign.active_rows(transactions).where(F.col("tx_hash") == bytesx.literal(tx_hash))
    return rows.orderBy(F.desc("block_number"), F.desc("seq")).limit(1).select(
        bytesx.to_hex("tx_hash").alias("transaction"), "block_number", bytesx.to_hex("from").alias("sender"),
        bytesx.to_hex("to").alias("recipient"), (F.col("value").cast("double") / 1e18).alias("eth_value"),
        "gas_used", "status")


def lookup_transactions(transactions: DataFrame, hashes: DataFrame) -> DataFrame:
    """Committed rows of a list of hashes; the optimizer picks the join by its size."""
    return sign.active_rows(transactions).join(hashes.select("tx_hash").distinct(), "tx_hash", "left_semi")


def top_gas_consumers(transactions: DataFrame, blocks: DataFrame, last_n: int = 10_000, k=10,
                      order_by: str = "total_gas", active_head: bool = True) -> DataFrame:
    rows = last_blocks(sign.active_rows(transactions), blocks, last_n, active_head)
    totals = rows.groupBy("from").agg(
        F.count(F.lit(1)).alias("tx_count"), F.sum("gas_used").alias("total_gas"),
        (F.sum(_cost()).cast("double") / 1e18).alias("eth_spent"),
        (F.sum("gas_price").cast("double") / F.count("gas_price") / 1e9).alias("avg_gwei_price"))
    return _top(totals, [F.desc(order_by), F.col("from")], k).withColumn(
        "address", bytesx.to_hex("from")).select("address", "tx_count", "total_gas", "eth_spent", "avg_gwei_price")


def _since(blocks: DataFrame, as_of, lookback: str) -> DataFrame:
    """Committed blocks newer than a bound; a table stored by month is pruned as well."""
    active = sign.active_rows(blocks)
    bound = timex.minus(timex.reference_time(active, "timestamp", as_of), lookback)
    out = active.where(F.col("timestamp") > bound)
    return out.where(F.col("month") >= timex.month_bucket(bound)) if "month" in blocks.columns else out


def indexing_rate(blocks: DataFrame, as_of=None, lookback: str = "1 HOUR", k=10,
                  approximate: bool = False) -> DataFrame:
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    per_minute = _since(blocks, as_of, lookback).groupBy(F.date_trunc("minute", "timestamp").alias("minute")).agg(
        F.count(F.lit(1)).alias("blocks_indexed"), (F.sum("gas_used") / 1e6).alias("million_gas"),
        distinct("miner").alias("unique_miners"))
    return _top(per_minute, [F.desc("minute")], k)


def contract_events(logs: DataFrame, address: str, topic0: str = TRANSFER, k=100) -> DataFrame:
    rows = sign.active_rows(logs).where((F.col("address") == bytesx.literal(address, 20))
                                        & (F.col("topic0") == bytesx.literal(topic0, 32)))
    return _top(rows, [F.desc("block_number"), F.desc("seq"), F.desc("log_index")], k).select(
        "block_number", "log_index", bytesx.to_hex("tx_hash").alias("transaction"),
        bytesx.to_hex("topic0").alias("event_signature"), bytesx.to_hex("address").alias("contract"))


def erc20_transfers(logs: DataFrame, token: str, min_block: int, k=10) -> DataFrame:
    rows = from_block(sign.active_rows(logs), min_block).where((F.col("topic0") == bytesx.literal(TRANSFER))
                                                               & (F.col("address") == bytesx.literal(token, 20)))
    return _top(rows, [F.desc("block_number"), F.desc("seq"), F.desc("log_index")], k).select(
        "block_number", "log_index", bytesx.to_hex("tx_hash").alias("transaction"),
        bytesx.to_hex("address").alias("token_contract"),
        bytesx.to_hex(bytesx.topic(1)).alias("from_address"), bytesx.to_hex(bytesx.topic(2)).alias("to_address"),
        u256.from_hex(F.col("data")).alias("amount"))


def reverted_blocks(blocks: DataFrame, k=10) -> DataFrame:
    rows = sign.reverted_keys(blocks, ["block_number", "hash"])
    return _top(rows, [F.desc("block_number"), F.col("hash")], k).select(
        "block_number", bytesx.to_hex("hash").alias("block_hash"), F.col("net").alias("net_sign"))


def reorg_frequency(blocks: DataFrame, days=30) -> DataFrame:
    return _top(sign.reorg_frequency(blocks), [F.desc("date")], days)


def active_block_count(blocks: DataFrame) -> DataFrame:
    return sign.net_positive(blocks, ["block_number"]).agg(F.count(F.lit(1)).alias("active_blocks"))


def tx_per_block(blocks: DataFrame, transactions: DataFrame, lo: int, hi: int) -> DataFrame:
    """Transactions per block row, empty blocks included.

    Counted below the join, so the join sees one row per height: a left join of block
    rows to transaction rows yields (block rows) x (transactions) per group.
    """
    counts = (block_range(sign.active_rows(transactions), lo, hi).groupBy("block_number")
              .agg(F.count("tx_hash").alias("_n")))
    heights = (block_range(sign.active_rows(blocks), lo, hi).groupBy("block_number", "timestamp")
               .agg(F.count(F.lit(1)).alias("_rows")))
    return (heights.join(counts, "block_number", "left")
            .select("block_number", "timestamp", (F.col("_rows") * F.coalesce("_n", F.lit(0))).alias("tx_count"))
            .orderBy("block_number"))


def block_series(blocks: DataFrame, interval: str = "5 minutes", as_of=None, lookback: str = "1 DAY") -> DataFrame:
    return (_since(blocks, as_of, lookback).groupBy(timex.start_of("timestamp", interval).alias("interval"))
            .agg(F.count(F.lit(1)).alias("blocks"), F.avg("gas_used").alias("avg_gas"),
                 F.max("gas_used").alias("max_gas")).orderBy("interval"))


def slot_history(diffs: DataFrame, address: str, slot: str, k=10) -> DataFrame:
    rows = sign.active_rows(diffs).where((F.col("address") == bytesx.literal(address, 20))
                                         & (F.col("slot") == bytesx.literal(slot, 32)))
    return _top(rows, [F.desc("block_number"), F.desc("seq")], k).select(
        "block_number", bytesx.to_hex("slot").alias("storage_slot"), bytesx.to_hex("value").alias("storage_value"))


def rolling_base_fee(blocks: DataFrame, n: int = 100, min_block: int = -1, k=100) -> DataFrame:
    """Base fee in gwei with its mean over ``n`` block rows; the filter comes first, so
    the first frames are short."""
    rows = (from_block(sign.active_rows(blocks), min_block)
            .select("block_number", "seq", "timestamp", "base_fee"))
    order = ["block_number", "seq"]
    if k is None:
        out = ordered.rolling_mean(rows, order, "base_fee", n, timex.block_bucket(), "rolling", 1e9)
    else:
        out = ordered.tail_rolling_mean(rows, order, "base_fee", n, k, "rolling", 1e9)
    return out.select("block_number", "seq", timex.format_minute("timestamp").alias("time"),
                      (F.col("base_fee").cast("double") / 1e9).alias("base_fee_gwei"),
                      F.col("rolling").alias("rolling_avg"))


def deployments(transactions: DataFrame, blocks: DataFrame, min_block: int, k=20) -> DataFrame:
    created = from_block(sign.active_rows(transactions), min_block).where(
        F.col("to").isNull() & (F.col("status") == 1))
    times = (from_block(sign.active_rows(blocks), min_block)
             .select("block_number", "timestamp", F.col("seq").alias("_block_seq")))
    rows = created.join(times, "block_number")
    return _top(rows, [F.desc("block_number"), F.desc("tx_index"), F.desc("seq"), F.desc("_block_seq")], k).select(
        "block_number", bytesx.to_hex("tx_hash").alias("transaction"), bytesx.to_hex("from").alias("deployer"),
        "gas_used", timex.format_second("timestamp").alias("deployed_at"))


def nft_transfers(logs: DataFrame, min_block: int, k=50) -> DataFrame:
    """Transfers with an indexed token id, each with its contract's total.

    The totals are a partially combined count joined back, not a window over a contract,
    so a hot contract is one row of the join.
    """
    rows = from_block(sign.active_rows(logs), min_block).where((F.col("topic0") == bytesx.literal(TRANSFER))
                                                               & (F.octet_length(bytesx.topic(3)) == 32))
    order = [F.desc("block_number"), F.desc("seq"), F.desc("log_index")]
    totals = rows.groupBy("address").agg(F.count(F.lit(1)).alias("total_transfers"))
    shown = rows.select("block_number", "seq", "log_index", "address", "topics")
    if k is not None:
        shown = shown.orderBy(*order).limit(k)
    return shown.join(totals, "address").orderBy(*order).select(
        "block_number", "log_index", bytesx.to_hex("address").alias("nft_contract"),
        bytesx.to_hex(bytesx.topic_address(bytesx.topic(1))).alias("from_address"),
        bytesx.to_hex(bytesx.topic_address(bytesx.topic(2))).alias("to_address"),
        u256.from_be(bytesx.topic(3)).alias("token_id"), "total_transfers")


#: Gas values that are counted as one range before the range that holds a rank is ordered.
GAS_RANGE = 4096


def _at_rank(pairs: str, rank: str) -> str:
    """SQL: of sorted (value, n) pairs the value at a 0-based rank, and the rank inside it."""
    here = f"s.value IS NULL AND {rank} < s.upto + p.n"
    return (f"aggregate({pairs}, named_struct('upto', 0L, 'value', CAST(NULL AS BIGINT), 'inside', CAST(NULL AS BIGINT)), (s, p) -> "
            f"named_struct('upto', s.upto + p.n, 'value', if({here}, p.value, s.value), 'inside', if({here}, {rank} - s.upto, s.inside)))")


def _interpolated(counts: DataFrame, totals: DataFrame, quantiles: dict) -> DataFrame:
    """The totals with interpolated quantiles of ``gas_used`` per contract.

    ``counts`` has ``(to, _span, gas_used, _n)`` and ``totals`` the counts of a contract's
    ranges of gas.  Only values of ranges that hold a wanted rank are ordered: a row holds at
    most as many ranges as the block gas limit has, or the values of one range per rank."""
    place = {name: f"((call_count - 1) * {q}D)" for name, q in quantiles.items()}
    ranks = [(f"{name}_{end}", f"{f}({at})", at) for name, at in place.items() for end, f in (("low", "floor"), ("high", "ceil"))]
    # the totals travel along, so that they are worked out once
    kept = ", ".join(c for c in totals.columns if c not in ("to", "_spans"))
    wanted = totals.selectExpr("to", f"struct({kept}) AS _total", "inline(array(" + ", ".join(
        f"named_struct('_which', '{which}', '_found', {_at_rank('_spans', rank)}, '_share', {at} - floor({at}))"
        for which, rank, at in ranks) + "))").selectExpr(
        "to", "_total", "_which", "_share", "_found.value AS _span", "_found.inside AS _rank")
    held = counts.select("to", "_span", "gas_used", "_n").join(wanted, ["to", "_span"])
    found = held.groupBy("to").agg(F.first("_total").alias("_total"), *[F.expr(e) for which, _, _ in ranks for e in (
        f"array_sort(collect_list(struct(gas_used AS value, _n AS n)) FILTER (WHERE _which = '{which}')) AS {which}_pairs",
        f"max(_rank) FILTER (WHERE _which = '{which}') AS {which}_rank",
        f"max(_share) FILTER (WHERE _which = '{which}') AS {which}_share")])
    exact = found.selectExpr("to", "_total.*", *[
        f"CAST({_at_rank(f'{which}_pairs', f'{which}_rank')}.value AS DOUBLE) AS {which}" for which, _, _ in ranks],
        *[f"{name}_low_share" for name in quantiles])
    return exact.selectExpr("*", *[f"{n}_low + ({n}_high - {n}_low) * {n}_low_share AS {n}" for n in quantiles])


def contract_gas(transactions: DataFrame, blocks: DataFrame, last_n: int = 50_000, min_calls: int = 100,
                 k=20, approximate: bool = False) -> DataFrame:
    """Mean, median and p95 gas per called contract.

    Calls are first counted by (contract, gas): that shuffle spreads a hot contract, and
    every figure follows from the counts.  ``approximate`` takes both quantiles from one
    mergeable sketch instead.
    """
    calls = last_blocks(sign.active_rows(transactions), blocks, last_n).where(
        F.col("to").isNotNull() & (F.col("status") == 1))
    counts = calls.groupBy("to", "gas_used").agg(
        F.count(F.lit(1)).alias("_n"), F.sum(_cost()).alias("_cost"))
    if approximate:
        sketched = calls.groupBy("to").agg(
            F.count(F.lit(1)).alias("call_count"), F.avg("gas_used").alias("avg_gas_per_call"),
            (F.sum(_cost()).cast("double") / 1e18).alias("total_eth_cost"),
            F.percentile_approx("gas_used", [0.5, 0.95]).alias("_q")).where(F.col("call_count") > min_calls)
        return _top(sketched, [F.desc("total_eth_cost"), F.col("to")], k).select(
            bytesx.to_hex("to").alias("contract"), "call_count", "avg_gas_per_call", "total_eth_cost",
            F.col("_q")[0].cast("double").alias("median_gas"), F.col("_q")[1].cast("double").alias("p95_gas"))
    counts = counts.withColumn("_span", F.call_function("div", F.col("gas_used"), F.lit(GAS_RANGE).cast("bigint")))
    ranges = counts.groupBy("to", "_span").agg(F.sum("_n").alias("_n"), F.sum("_cost").alias("_cost"), F.sum(
        F.col("gas_used").cast("decimal(20,0)") * F.col("_n")).alias("_gas"))
    totals = ranges.groupBy("to").agg(
        F.sum("_n").alias("call_count"), (F.sum("_gas").cast("double") / F.sum("_n")).alias("avg_gas_per_call"),
        (F.sum("_cost").cast("double") / 1e18).alias("total_eth_cost"),
        F.expr("array_sort(collect_list(struct(_span AS value, _n AS n)))").alias("_spans")).where(F.col("call_count") > min_calls)
    chosen = totals if k is None else totals.orderBy(F.desc("total_eth_cost"), F.col("to")).limit(k)
    found = _interpolated(counts, chosen, {"median_gas": 0.5, "p95_gas": 0.95})
    return (found.orderBy(F.desc("total_eth_cost"), F.col("to"))
            .withColumn("contract", bytesx.to_hex("to"))
            .select("contract", "call_count", "avg_gas_per_call", "total_eth_cost", "median_gas", "p95_gas"))


def large_transfers(logs: DataFrame, threshold: int = THOUSAND_TOKENS) -> DataFrame:
    return sign.active_rows(logs).where((F.col("topic0") == bytesx.literal(TRANSFER))
                                        & u256.hex_greater("data", threshold))


def same_block_large_flows(logs: DataFrame, threshold: int = THOUSAND_TOKENS, k=10) -> DataFrame:
    """Addresses that receive and send a large amount in one block.

    One scan and one partially combined aggregate instead of joining two distinct sets;
    the sets being distinct, each match counts once.
    """
    ends = large_transfers(logs, threshold).select("block_number", F.inline(F.array(
        F.struct(bytesx.topic_address(bytesx.topic(2)).alias("address"), F.lit(True).alias("received")),
        F.struct(bytesx.topic_address(bytesx.topic(1)).alias("address"), F.lit(False).alias("received")))))
    both = (ends.groupBy("block_number", "address")
            .agg(F.bool_or("received").alias("_in"), F.bool_or(~F.col("received")).alias("_out"))
            .where("_in AND _out AND address IS NOT NULL"))
    return _top(both, [F.desc("block_number"), F.col("address")], k).select(
        "block_number", bytesx.to_hex("address").alias("address"),
        F.lit(1).cast("bigint").alias("suspicious_transactions"))


def same_block_large_flows_joined(logs: DataFrame, threshold: int = THOUSAND_TOKENS) -> DataFrame:
    """The same pairs as an equi-join of the two distinct sets."""
    big = large_transfers(logs, threshold)
    received = big.select("block_number", bytesx.topic_address(bytesx.topic(2)).alias("address")).distinct()
    sent = big.select("block_number", bytesx.topic_address(bytesx.topic(1)).alias("address")).distinct()
    return received.join(sent, ["block_number", "address"]).groupBy("block_number", "address").agg(
        F.count(F.lit(1)).alias("suspicious_transactions"))


def large_flow_transfers(logs: DataFrame, threshold: int = THOUSAND_TOKENS) -> DataFrame:
    """Variant that counts the large transfers on each side."""
    ends = large_transfers(logs, threshold).select("block_number", F.inline(F.array(
        F.struct(bytesx.topic_address(bytesx.topic(2)).alias("address"), F.lit(1).alias("received")),
        F.struct(bytesx.topic_address(bytesx.topic(1)).alias("address"), F.lit(0).alias("received")))))
    return (ends.where("address IS NOT NULL").groupBy("block_number", "address")
            .agg(F.sum("received").alias("receives"), F.sum(1 - F.col("received")).alias("sends"))
            .where("receives > 0 AND sends > 0"))


def daily_partials(transactions: DataFrame, blocks: DataFrame) -> DataFrame:
    """Signed transactions with the time of their own block row: a row and its block
    share height and sequence, so forks never mix."""
    times = blocks.select("block_number", "seq", "timestamp")
    return transactions.join(times, ["block_number", "seq"])


def daily_sender_stats(transactions: DataFrame, blocks: DataFrame | None = None) -> DataFrame:
    """Per day and sender: transactions, gas and value, each row weighing its sign, so a
    revert takes back what its commit added.  Without ``blocks`` the transactions carry
    ``block_time`` already."""
    rows = (transactions.withColumnRenamed("block_time", "timestamp") if blocks is None
            else daily_partials(transactions, blocks))
    return rows.groupBy(F.to_date("timestamp").alias("date"), F.col("from").alias("address")).agg(
        F.sum("sign").alias("tx_count"), F.sum(F.col("sign") * F.col("gas_used")).alias("total_gas"),
        u256.sum_signed("value", "sign").alias("total_value"))


def daily_active_stats(transactions: DataFrame, blocks: DataFrame) -> DataFrame:
    """The literal materialised aggregate: committed transactions joined to committed
    blocks of the same height."""
    rows = sign.active_rows(transactions).join(
        sign.active_rows(blocks).select("block_number", "timestamp"), "block_number")
    return rows.groupBy(F.to_date("timestamp").alias("date"), F.col("from").alias("address")).agg(
        F.count(F.lit(1)).alias("tx_count"), F.sum("gas_used").alias("total_gas"),
        u256.sum_signed("value").alias("total_value"))


def merge_daily(partials: DataFrame) -> DataFrame:
    """Re-aggregate additive partial rows of several batches."""
    return partials.groupBy("date", "address").agg(
        F.sum("tx_count").alias("tx_count"), F.sum("total_gas").alias("total_gas"),
        u256.sum_signed(
            "ltrim('-', total_value)", "CASE WHEN total_value LIKE '-%' THEN -1 ELSE 1 END").alias("total_value"))


def top_daily(stats: DataFrame, as_of=None, days: int = 30, k=100) -> DataFrame:
    newest = (stats.agg(F.max("date")).scalar() if as_of is None else F.lit(as_of)).cast("date")
    rows = stats.where(F.col("date") >= F.date_sub(newest, days)).groupBy("date", "address").agg(
        F.sum("tx_count").alias("transactions"), F.sum("total_gas").alias("gas_used"))
    return _top(rows, [F.desc("gas_used"), F.col("date"), F.col("address")], k).select(
        "date", bytesx.to_hex("address").alias("sender"), "transactions", "gas_used")


def contract_logs_from(current_logs: DataFrame, address: str, min_block: int) -> DataFrame:
    """Current logs of a contract from a height on, in chain order."""
    return (from_block(current_logs, min_block - 1).where(F.col("address") == bytesx.literal(address, 20))
            .orderBy("block_number", "log_index"))


def integrity_report(table: DataFrame, keys: list) -> DataFrame:
    """Number of keys per net outcome."""
    outcome = (F.when(F.col("net") == 1, "active").when(F.col("net") == 0, "reverted")
               .when(F.col("net") < 0, "reverted too often").otherwise("committed twice"))
    return (sign.net_by_key(table, keys).groupBy(outcome.alias("outcome"), "net")
            .agg(F.count(F.lit(1)).alias("keys")))


def storage_as_of(diffs: DataFrame, block) -> DataFrame:
    from forkline import schemas
    return sign.storage_as_of(diffs, schemas.KEYS["storage_diffs"], block)


def tx_count_per_block(current_transactions: DataFrame) -> DataFrame:
    return current_transactions.groupBy("block_number").agg(F.count(F.lit(1)).alias("tx_count"))


def events_per_block(transactions: DataFrame, logs: DataFrame, diffs: DataFrame) -> DataFrame:
    """Rows captured per block over three tables, each counted before they are united."""
    counts = None
    for df in (transactions, logs, diffs):
        part = sign.active_rows(df).groupBy("block_number").agg(F.count(F.lit(1)).alias("_n"))
        counts = part if counts is None else counts.unionByName(part)
    return counts.groupBy("block_number").agg(F.sum("_n").alias("events"))
