"""Chain tables derived by Spark from the ``events`` and ``lineitem`` tables.

Every event becomes a transaction, every lineitem a log; ten events form a block.
Fork classes of the block numbers make replaced, orphaned and twice-reverted blocks.
``oracles.CHAIN_SQL`` states the same formulas in SQL.

Grouping and ranking inside one block is bounded by what a block can hold (its gas
limit), as in the data model itself.
"""

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from forkline import nesting, schemas
from forkline.functions import bytesx

TRANSFER_TOPIC = "ddf252ad1be2c89b69c2b068fc378daa952ba7f163c4a11628f55a4df523b3ef"

# columns made by Chain._header_columns, in its order
HEADER_COLUMNS = ["hash", "parent_hash", "gas_limit", "base_fee", "miner", "state_root", "extra_data"]

# order of the logs of one transaction
LOG_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]

LATENCY_BUCKETS = [0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5]


def _fork_class(n):
    return (F.when(n % 17 == 3, "replaced").when(n % 53 == 7, "orphaned")
            .when(n % 211 == 11, "dup_revert").otherwise("plain"))


def _steps(n):
    """The (sign, fork, step) rows a block emits; ``step`` numbers its notifications."""
    def rows(*items):
        return F.array(*[F.struct(F.lit(s).cast("byte").alias("sign"), F.lit(f).alias("fork"),
                                  F.lit(p).alias("step")) for s, f, p in items])
    kind = _fork_class(n)
    return (F.when(kind == "replaced", rows((1, 0, 0), (-1, 0, 1), (1, 1, 1)))
            .when(kind == "orphaned", rows((1, 0, 0), (-1, 0, 1)))
            .when(kind == "dup_revert", rows((1, 0, 0), (-1, 0, 1), (-1, 0, 2)))
            .otherwise(rows((1, 0, 0))))


def _sha(text):
    return F.unhex(F.sha2(text, 256))


def _number(c, width):
    return bytesx.pad_bytes(F.unhex(F.hex(c)), width)


def _conform(df: DataFrame, schema) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


class Chain:
    """Lazily derived signed tables and notifications of one test-data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def _tx(self) -> DataFrame:
        e = self.table("events")
        i = F.col("event_id")
        kind = i % 13
        price = (F.lit(20) + i % 31) * F.lit(10 ** 9)
        dynamic = i % 3 != 0
        return e.select(
            F.call_function("div", i, F.lit(10).cast("bigint")).alias("block_number"),
            (i % 10).cast("int").alias("tx_index"),
            _sha(F.concat(F.lit("tx:"), i.cast("string"))).alias("tx_hash"),
            _number(F.col("user_id"), 20).alias("from"),
            F.when(F.col("event_type") != "signup",
                   _number(F.lit(4096) + (i * 7919) % 40, 20)).alias("to"),
            (F.round(F.col("value") * 100).cast("decimal(20,0)")
             * F.lit(10 ** 16).cast("decimal(17,0)")).cast("decimal(38,0)").cast("string").alias("value"),
            F.col("event_type").cast("binary").alias("input"),
            F.when(F.col("event_type") == "error", 0).otherwise(1).cast("short").alias("status"),
            i.alias("nonce"),
            (F.lit(21000) + kind * 7000).alias("gas_used"),
            (F.lit(21000) + kind * 10000).alias("gas_limit"),
            price.cast(schemas.U128).alias("gas_price"),
            F.when(dynamic, price + 5 * 10 ** 9).cast(schemas.U128).alias("max_fee_per_gas"),
            F.when(dynamic, F.lit(2 * 10 ** 9)).cast(schemas.U128).alias("max_priority_fee_per_gas"),
            F.lit(1).cast("bigint").alias("chain_id"))

    @cached_property
    def _headers(self) -> DataFrame:
        """One row per block height, fork independent."""
        e = self.table("events")
        i = F.col("event_id")
        return (e.groupBy(F.call_function("div", i, F.lit(10).cast("bigint")).alias("block_number"))
                .agg(F.date_trunc("second", F.min(F.col("ts").cast("timestamp"))).alias("timestamp"),
                     F.sum(F.lit(21000) + (i % 13) * 7000).alias("gas_used")))

    def _header_columns(self, fork):
        n = F.col("block_number")
        text = n.cast("string")
        return [
            _sha(F.concat(F.lit("block:"), text, F.lit(":"), fork.cast("string"))).alias("hash"),
            _sha(F.concat(F.lit("block:"), (n - 1).cast("string"), F.lit(":"),
                          F.when(_fork_class(n - 1) == "replaced", "1").otherwise("0"))
                 ).alias("parent_hash"),
            F.lit(30_000_000).cast("bigint").alias("gas_limit"),
            (F.lit(10 ** 10) + (n % 200) * F.lit(10 ** 8)).cast(schemas.U128).alias("base_fee"),
            _number(F.lit(160) + n % 7, 20).alias("miner"),
            _sha(F.concat(F.lit("root:"), text)).alias("state_root"),
            F.concat(F.lit("block_"), text).cast("binary").alias("extra_data"),
        ]

    @cached_property
    def _logs(self) -> DataFrame:
        """Logs of fork 0.  Order keys beyond the newest event fold back onto it, so
        every lineitem is a log of an existing transaction."""
        index = Window.partitionBy("block_number").orderBy("tx_index", *LOG_ORDER)
        return (self._log_rows.withColumn("log_index", F.row_number().over(index) - 1)
                .select("block_number", "tx_index", "log_index",
                        _sha(F.concat(F.lit("tx:"), F.col("event_id").cast("string"))).alias("tx_hash"),
                        *self._log_columns()))

    @cached_property
    def _log_rows(self) -> DataFrame:
        events = self.table("events").agg((F.max("event_id") + 1).alias("n")).scalar()
        return (self.table("lineitem").withColumn("event_id", F.pmod(F.col("l_orderkey"), events))
                .withColumn("block_number", F.call_function("div", F.col("event_id"), F.lit(10).cast("bigint")))
                .withColumn("tx_index", (F.col("event_id") % 10).cast("int")))

    @staticmethod
    def _log_columns() -> list:
        transfer = F.col("l_returnflag").isin("A", "R")
        topics = F.array(_number(F.col("l_partkey") % 20 + 1, 32), _number(F.col("l_suppkey") % 20 + 1, 32))
        nft = (F.col("l_linestatus") == "F") & (F.col("l_linenumber") == 1)
        cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
        return [_number(F.lit(49152) + F.col("l_suppkey") % 5, 20).alias("address"),
                F.when(transfer, bytesx.literal(TRANSFER_TOPIC)).otherwise(_sha(F.lit("other"))).alias("topic0"),
                F.when(nft, F.concat(topics, F.array(_number(F.col("l_partkey"), 32)))).otherwise(topics).alias("topics"),
                F.concat(F.lpad(F.lower(F.hex(cents)), 52, "0"), F.lit("0" * 12)).alias("data"),
                _number(F.col("l_partkey") % 8, 32).alias("slot")]

    def _signed(self, df: DataFrame, by_tx: bool) -> DataFrame:
        rows = (df.withColumn("_s", F.explode(_steps(F.col("block_number"))))
                .withColumn("sign", F.col("_s.sign")).withColumn("fork", F.col("_s.fork"))
                .withColumn("seq", (F.col("block_number") * 4 + F.col("_s.step")) * 2
                            + F.when(F.col("_s.sign") == 1, 1).otherwise(0))
                .drop("_s"))
        # the replacing fork leaves out the last transaction of the block
        return rows.where((F.col("fork") == 0) | (F.col("tx_index") != 9)) if by_tx else rows

    @cached_property
    def blocks(self) -> DataFrame:
        rows = self._signed(self._headers, by_tx=False)
        full = rows.select("block_number", "sign", "seq", "timestamp", "gas_used",
                           *self._header_columns(F.col("fork")))
        return _conform(full.withColumn("extra_data", bytesx.to_hex("extra_data")), schemas.BLOCKS)

    @cached_property
    def transactions(self) -> DataFrame:
        rows = self._signed(self._tx, by_tx=True)
        return _conform(rows.withColumn("input", bytesx.to_hex("input"))
                        .withColumn("max_fee_per_gas", F.coalesce("max_fee_per_gas", "gas_price")),
                        schemas.TRANSACTIONS)

    @cached_property
    def _signed_logs(self) -> DataFrame:
        return self._signed(self._logs, by_tx=True)

    @cached_property
    def logs(self) -> DataFrame:
        return _conform(self._signed_logs, schemas.LOGS)

    @cached_property
    def storage_diffs(self) -> DataFrame:
        last = (self._signed_logs.groupBy("block_number", "address", "slot", "sign", "seq")
                .agg(F.unhex(F.max_by("data", "log_index")).alias("value")))
        return _conform(last, schemas.STORAGE_DIFFS)

    @cached_property
    def tables(self) -> dict:
        return {name: getattr(self, name) for name in schemas.TABLES}

    @cached_property
    def notifications(self) -> DataFrame:
        """The same facts in the nested form a node would deliver."""
        logs = (self._logs.groupBy("block_number", "tx_index").agg(F.array_sort(F.collect_list(
            F.struct("log_index", "address",
                     F.concat(F.array("topic0"), F.col("topics")).alias("topics"),
                     F.unhex("data").alias("data")))).alias("logs")))
        tx_fields = [f.name for f in schemas.TRANSACTION.fields if f.name != "hash"]
        txs = (self._tx.join(logs, ["block_number", "tx_index"], "left")
               .groupBy("block_number").agg(F.array_sort(F.collect_list(F.struct(
                   "tx_index",
                   F.struct(F.col("tx_hash").alias("hash"), *tx_fields).alias("tx"),
                   F.struct("status", "gas_used", F.transform(
                       F.coalesce("logs", F.array()),
                       lambda l: F.struct(l["address"], l["topics"], l["data"])).alias("logs")
                   ).alias("receipt")))).alias("items")))

        # both forks' last values in one pass: the logs are put in order once for either
        last = (self._logs.groupBy("block_number", "address", "slot")
                .agg(F.unhex(F.max_by("data", "log_index")).alias("value0"),
                     F.unhex(F.max_by(F.col("data"), F.when(F.col("tx_index") != 9, F.col("log_index")))).alias("value1")))

        def slots(fork):
            return F.collect_list(F.when(F.col(f"value{fork}").isNotNull(), F.struct("slot", F.col(f"value{fork}").alias("value"))))

        def state(fork):
            entries = F.collect_list(F.when(F.size(f"slots{fork}") > 0, F.struct("address", F.map_from_entries(f"slots{fork}").alias("slots"))))
            return F.when(F.size(entries) > 0, F.map_from_entries(entries)).alias(f"state{fork}")

        states = (last.groupBy("block_number", "address").agg(slots(0).alias("slots0"), slots(1).alias("slots1"))
                  .groupBy("block_number").agg(state(0), state(1)))

        def block(fork):
            items = F.col("items") if fork == 0 else F.filter("items", lambda x: x["tx_index"] != 9)
            parts = {"number": F.col("block_number"), "timestamp": F.unix_seconds("timestamp"),
                     "gas_used": F.col("gas_used")}
            named = {f.name: parts.get(f.name) for f in schemas.HEADER.fields}
            for name, c in zip(HEADER_COLUMNS, self._header_columns(F.lit(fork))):
                named[name] = c
            return F.struct(F.struct(*[c.alias(n) for n, c in named.items()]).alias("header"),
                            F.transform(items, lambda x: x["tx"]).alias("transactions"),
                            F.transform(items, lambda x: x["receipt"]).alias("receipts"),
                            F.col(f"state{fork}").alias("state"))

        kind = _fork_class(F.col("block_number"))

        def steps(*kinds):
            return F.array(*[F.struct(F.lit(i).alias("step"), F.lit(k).alias("kind")) for i, k in enumerate(kinds)])

        nested = (self._headers.join(txs, "block_number")
                  .join(states, "block_number", "left")
                  .select("block_number", block(0).alias("b0"), block(1).alias("b1"))
                  .select("*", F.explode(F.when(kind == "replaced", steps("ChainCommitted", "ChainReorged"))
                                    .when(kind == "orphaned", steps("ChainCommitted", "ChainReverted"))
                                    .when(kind == "dup_revert", steps("ChainCommitted", "ChainReverted", "ChainReverted"))
                                    .otherwise(steps("ChainCommitted"))).alias("s")))
        none = F.array().cast(schemas.NOTIFICATION["old"].dataType)
        return nested.select(
            (F.col("block_number") * 4 + F.col("s.step")).alias("seq"), F.col("s.kind").alias("kind"),
            F.when(F.col("s.step") > 0, F.array("b0")).otherwise(none).alias("old"),
            F.when(F.col("s.step") == 0, F.array("b0")).when(F.col("s.kind") == "ChainReorged", F.array("b1"))
            .otherwise(none).alias("new"))

    @cached_property
    def head(self) -> int:
        """Newest height."""
        return (self.table("events").agg(F.max("event_id")).first()[0] or 0) // 10

    def nested(self, parts: int, heights: int) -> DataFrame:
        """``notifications``, dealt by height: part ``i`` holds heights from ``i * heights`` on, in order.

        One shuffle and one sort of flat rows, which tasks nest by offsets; a part is a task."""
        block = {f.name: f.dataType for f in schemas.BLOCK.fields}
        tx, receipt = block["transactions"].elementType, block["receipts"].elementType
        made = {"number": F.col("block_number"), "timestamp": F.unix_seconds("timestamp"), "gas_used": F.col("gas_used")}

        def header(fork):
            named = made | dict(zip(HEADER_COLUMNS, self._header_columns(F.lit(fork))))
            return F.struct(*[named[f.name].cast(f.dataType).alias(f.name) for f in schemas.HEADER.fields])

        number = F.col("block_number")
        heads = self._headers.select("block_number", F.struct(
            _fork_class(number).alias("kind"), header(0).alias("b0"), header(1).alias("b1")).alias("head"))
        names = {"hash": "tx_hash"}
        txs = self._tx.select("block_number", "tx_index", F.struct(
            F.struct(*[F.col(names.get(f.name, f.name)).cast(f.dataType).alias(f.name) for f in tx.fields]).alias("tx"),
            F.col("status").cast(receipt["status"].dataType).alias("status"),
            F.col("gas_used").cast(receipt["gas_used"].dataType).alias("used")).alias("tx"))
        logs = self._log_rows.select("block_number", "tx_index", *LOG_ORDER, "l_returnflag", "l_linestatus")
        rows = (heads.unionByName(txs, allowMissingColumns=True).unionByName(logs, allowMissingColumns=True)
                .where(number.isNotNull()))
        part = F.call_function("div", number, F.lit(heights).cast("bigint"))
        # nulls come first: a block before its transactions, each of them before its logs
        flat = (rows.repartitionById(parts, F.pmod(part, F.lit(parts)).cast("int"))
                .sortWithinPartitions("block_number", "tx_index", *LOG_ORDER, "tx"))
        log = {c: F.col(c) for c in ("address", "data", "slot")}
        log["topics"] = F.concat(F.array("topic0"), F.col("topics"))
        log["data"] = F.unhex("data")
        out = flat.select("block_number", "tx_index", "head", "tx", *self._log_columns()).select(
            "block_number", "tx_index", "head", "tx", *[c.alias(n) for n, c in log.items()])
        return out.mapInArrow(nesting.nest(to_arrow_schema(schemas.NOTIFICATION)), schemas.NOTIFICATION)

    @cached_property
    def metrics(self) -> DataFrame:
        """Samples in long form: a resetting counter per event type, a gauge, and a
        latency observation per event."""
        e = self.table("events").withColumn("ts", F.col("ts").cast("timestamp"))
        from forkline.operators import ordered
        ranked = ordered.rank_in_keys(e, ["event_type"], ["event_id"],
                                      F.call_function("div", F.col("event_id"), F.lit(4096).cast("bigint")), "rank")
        counters = ranked.select("ts", F.concat(F.lit("events_total_"), F.col("event_type")).alias("name"),
                                 F.lit(None).cast("double").alias("le"),
                                 (F.col("rank") % 500).cast("double").alias("value"))
        latency = e.select("ts", F.lit("latency_seconds").alias("name"), F.lit(None).cast("double").alias("le"),
                           (F.col("value") / 1000).alias("value"))
        return counters.unionByName(self.gauge).unionByName(latency)

    @cached_property
    def gauge(self) -> DataFrame:
        """The samples of ``metrics`` named ``buffer_rows``."""
        return self.table("events").select(F.col("ts").cast("timestamp").alias("ts"), F.lit("buffer_rows").alias("name"),
                                           F.lit(None).cast("double").alias("le"), F.round("value").alias("value"))
