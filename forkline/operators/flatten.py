"""Nested notifications to the four signed tables.

Each table picks its own fields out of the nested arrays before exploding them, so
the scan reads no others.  No table needs a shuffle: a receipt, its transaction and
its block sit in the same row.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F

from forkline import schemas
from forkline.functions import bytesx, timex

# Sequences of history start here below zero; notification numbers start at zero.
HISTORY = 1 << 60


def _segments(notifications: DataFrame, fields: dict) -> DataFrame:
    """One row per (notification, block) with its sign, sequence and chosen fields.

    Reverts of a notification come before its commits: ``2 * seq`` and ``2 * seq + 1``.
    """
    names = ", ".join(f"`{name}`" for name in fields)
    sides = []
    for side, sign, offset in (("old", -1, 0), ("new", 1, 1)):
        paths = ", ".join(f"{side}.{path}" for path in fields.values())
        sides.append(notifications.selectExpr(f"CAST({sign} AS TINYINT) AS sign", f"2 * seq + {offset} AS seq",
                                              f"inline(arrays_zip({paths})) AS ({names})"))
    return sides[0].unionByName(sides[1])


def _shape(df: DataFrame, schema, made: dict, extra=()) -> DataFrame:
    """The columns of ``schema`` in order, each from ``made`` or under its own name."""
    return df.selectExpr(*[f"CAST({made.get(f.name, f'`{f.name}`')} AS {f.dataType.simpleString()}) AS `{f.name}`"
                           for f in schema.fields], *extra)


def flatten_blocks(notifications: DataFrame, time_unit: str = "s") -> DataFrame:
    b = _segments(notifications, {f.name: f"header.{f.name}" for f in schemas.HEADER.fields})
    return _shape(b, schemas.BLOCKS, {
        "block_number": "number", "timestamp": timex.unix_sql("timestamp", time_unit),
        "base_fee": "coalesce(base_fee, 0)", "extra_data": "lower(hex(extra_data))"})


def flatten_transactions(notifications: DataFrame, time_unit: str = "s", block_time: bool = False,
                         uneven: Observation | None = None) -> DataFrame:
    """Transactions with their receipt's status and gas; ``block_time`` adds the header's.
    ``uneven`` counts, on the way, the blocks that :func:`misaligned` would give."""
    b = _segments(notifications, {"block_number": "header.number", "time": "header.timestamp",
                                  "transactions": "transactions", "receipts": "receipts"})
    # zipping with null would be null, so missing receipts become an empty array
    rows = (b.selectExpr("block_number", "sign", "seq", "time", "transactions AS tx",
                         "coalesce(receipts.status, array()) AS status", "coalesce(receipts.gas_used, array()) AS used")
            .selectExpr("block_number", "sign", "seq", "time", *(["size(coalesce(tx, array())) AS _n", "size(status) AS _m"] if uneven else []),
                        "posexplode(arrays_zip(tx, status, used)) AS (tx_index, p)"))
    if uneven:
        # the first row of a block stands for it
        rows = rows.observe(uneven, F.count_if(F.expr("tx_index = 0 AND _m <> 0 AND _m <> _n")).alias("n"))
    rows = rows.where("p.tx IS NOT NULL")
    made = {f.name: f"p.tx.`{f.name}`" for f in schemas.TRANSACTION.fields if f.name != "hash"}
    made |= {"tx_hash": "p.tx.hash", "from": f"coalesce(p.tx.`from`, {_zeros(20)})",
             "input": "lower(hex(p.tx.input))", "gas_price": "coalesce(p.tx.gas_price, 0)",
             "max_fee_per_gas": "coalesce(p.tx.max_fee_per_gas, p.tx.gas_price)",
             "chain_id": "coalesce(p.tx.chain_id, 1)", "status": "coalesce(p.status, 0)", "gas_used": "p.used"}
    extra = [f"{timex.unix_sql('time', time_unit)} AS block_time"] if block_time else []
    return _shape(rows, schemas.TRANSACTIONS, made, extra)


def flatten_logs(notifications: DataFrame) -> DataFrame:
    """Logs with a block-global index and the hash of their transaction."""
    b = _segments(notifications, {"block_number": "header.number", "transactions": "transactions",
                                  "receipts": "receipts"})
    flat = ("flatten(transform(coalesce(receipts.logs, array()), (ls, i) -> "
            "transform(coalesce(ls, array()), l -> struct(i AS tx_index, l AS log))))")
    rows = b.selectExpr("block_number", "sign", "seq", "transactions.hash AS hashes",
                        f"posexplode({flat}) AS (log_index, x)")
    topics = "coalesce(x.log.topics, array())"
    return _shape(rows, schemas.LOGS, {
        "tx_hash": f"coalesce(get(hashes, x.tx_index), {_zeros(32)})", "tx_index": "x.tx_index",
        "address": "x.log.address", "topic0": f"coalesce(try_element_at({topics}, 1), {_zeros(32)})",
        "topics": f"slice({topics}, 2, greatest(size({topics}) - 1, 0))", "data": "lower(hex(x.log.data))"})


def flatten_state(notifications: DataFrame) -> DataFrame:
    """One row per changed slot; accounts without changed storage give none."""
    b = _segments(notifications, {"block_number": "header.number", "state": "state"})
    rows = (b.selectExpr("block_number", "sign", "seq", "explode(state) AS (address, slots)")
            .selectExpr("block_number", "sign", "seq", "address", "explode(slots) AS (slot, value)"))
    return _shape(rows, schemas.STORAGE_DIFFS, {"slot": "lpad(slot, 32, X'00')", "value": "lpad(value, 32, X'00')"})


def _zeros(width: int) -> str:
    return f"X'{'00' * width}'"


def flatten(notifications: DataFrame, time_unit: str = "s") -> dict:
    """All four tables, in write order."""
    return {
        "blocks": flatten_blocks(notifications, time_unit),
        "transactions": flatten_transactions(notifications, time_unit),
        "logs": flatten_logs(notifications),
        "storage_diffs": flatten_state(notifications),
    }


def flatten_batch_blocks(blocks: DataFrame) -> DataFrame:
    """Backfilled blocks as commit notifications, so that backfill and stream share one
    path.  History has no reverts, so the height orders it; its sequences lie below those
    of every live notification, so that a reorg of backfilled heights is always newer."""
    block = F.struct(*[F.col(f.name) for f in schemas.BLOCK.fields])
    none = F.array().cast(schemas.NOTIFICATION["old"].dataType)
    return blocks.select((F.col("header.number") - HISTORY).alias("seq"), F.lit("ChainCommitted").alias("kind"),
                         none.alias("old"), F.array(block).alias("new"))


def misaligned(notifications: DataFrame) -> DataFrame:
    """Blocks whose receipts exist but do not match their transactions one to one."""
    b = _segments(notifications, {"block_number": "header.number", "transactions": "transactions",
                                  "receipts": "receipts"})
    n, m = F.size(F.coalesce("transactions", F.array())), F.size(F.coalesce("receipts", F.array()))
    return (b.select("block_number", "sign", "seq", n.alias("transactions"), m.alias("receipts"))
            .where("receipts <> 0 AND receipts <> transactions"))


def missing_receipts(notifications: DataFrame) -> DataFrame:
    """Blocks with transactions that came without receipts (their logs are empty)."""
    b = _segments(notifications, {"block_number": "header.number", "transactions": "transactions",
                                  "receipts": "receipts"})
    return (b.where(F.size(F.coalesce("receipts", F.array())) == 0)
            .where(F.size(F.coalesce("transactions", F.array())) > 0).select("block_number", "sign", "seq"))


def split_by_width(df: DataFrame, widths: dict) -> tuple:
    """``(good, quarantined)``: rows whose byte columns have their fixed width, or are
    null, and the rest."""
    ok = _wide(widths)
    return df.where(ok), df.where(~ok)


def _wide(widths: dict) -> Column:
    return reduce(Column.__and__, [F.coalesce(F.octet_length(c) == n, F.lit(True)) for c, n in widths.items()])


def set_aside(tables: dict, widths: dict, notifications: DataFrame) -> tuple:
    """``(good, bad)``: the tables without rows of a wrong width, and those rows, as JSON
    with their table and the reason, next to the blocks whose receipts do not match."""
    good, bad = {}, []
    for name, rows in tables.items():
        good[name], rest = split_by_width(rows, widths[name])
        bad.append(rest.select(F.lit(name).alias("table"), F.lit("width").alias("reason"), "block_number", "sign", "seq",
                               F.to_json(F.struct(*[F.col(f"`{c}`") for c in rest.columns])).alias("row")))
    uneven = misaligned(notifications)
    bad.append(uneven.select(F.lit("receipts").alias("table"), F.lit("misaligned").alias("reason"), "block_number",
                             "sign", "seq", F.to_json(F.struct("transactions", "receipts")).alias("row")))
    return good, reduce(DataFrame.unionByName, bad)


def counted(notifications: DataFrame, time_unit: str, widths: dict) -> tuple:
    """``(good, seen)``: the tables without rows of a wrong width, and observations ``n`` of how many
    rows :func:`set_aside` would set aside, known once all tables were written."""
    seen = {name: Observation() for name in [*schemas.TABLES, "receipts"]}
    tables = flatten(notifications, time_unit) | {"transactions": flatten_transactions(notifications, time_unit, uneven=seen["receipts"])}
    return {name: rows.observe(seen[name], F.count_if(~_wide(widths[name])).alias("n")).where(_wide(widths[name]))
            for name, rows in tables.items()}, seen


def split_by_cast(df: DataFrame, types: dict) -> tuple:
    """``(cast, quarantined)``: a value that does not fit its type is set aside whole,
    never turned into null."""
    lost = reduce(Column.__or__, [F.col(c).isNotNull() & F.col(c).try_cast(t).isNull() for c, t in types.items()])
    cast = df.where(~lost).withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})
    return cast, df.where(lost)


def enrich_log_hash(logs: DataFrame, transactions: DataFrame) -> DataFrame:
    """Give logs stored without a transaction hash the hash of the transaction at their
    index, from the same notification and side; zeros where there is none."""
    hashes = transactions.select("block_number", "tx_index", "seq", F.col("tx_hash").alias("_hash"))
    joined = logs.join(hashes, ["block_number", "tx_index", "seq"], "left")
    return joined.withColumn("tx_hash", F.coalesce("_hash", bytesx.zeros(32))).select(*logs.columns)


def effective_gas_price(base_fee, gas_price, max_fee, max_priority) -> Column:
    """What a transaction pays per gas: dynamic-fee transactions pay base fee plus tip,
    at most their maximum; others their gas price."""
    return (F.when(F.col(max_priority).isNotNull(),
                   F.least(F.col(max_fee), F.col(base_fee) + F.col(max_priority)))
            .otherwise(F.col(gas_price)).cast(schemas.U128))


def with_typed_topics(logs: DataFrame) -> DataFrame:
    return logs.withColumns({f"topic{n}": bytesx.topic(n) for n in (1, 2, 3)})


def response_shape(df: DataFrame) -> DataFrame:
    """Bytes as 0x hex text, for handing rows to a client."""
    kinds = dict(df.dtypes)
    return df.select(*[bytesx.to_hex0x(F.col(f"`{c}`")).alias(c) if kinds[c] == "binary" else F.col(f"`{c}`")
                       for c in df.columns])
