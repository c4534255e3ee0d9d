"""Explicit schemas and identity keys of the signed tables; nothing is inferred."""

from pyspark.sql import types as T

U128 = T.DecimalType(38, 0)

HEADER = T.StructType([
    T.StructField("number", T.LongType()),
    T.StructField("hash", T.BinaryType()),
    T.StructField("parent_hash", T.BinaryType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("gas_used", T.LongType()),
    T.StructField("gas_limit", T.LongType()),
    T.StructField("base_fee", U128),
    T.StructField("miner", T.BinaryType()),
    T.StructField("state_root", T.BinaryType()),
    T.StructField("extra_data", T.BinaryType()),
])

TRANSACTION = T.StructType([
    T.StructField("hash", T.BinaryType()),
    T.StructField("from", T.BinaryType()),
    T.StructField("to", T.BinaryType()),
    T.StructField("value", T.StringType()),
    T.StructField("input", T.BinaryType()),
    T.StructField("nonce", T.LongType()),
    T.StructField("gas_limit", T.LongType()),
    T.StructField("gas_price", U128),
    T.StructField("max_fee_per_gas", U128),
    T.StructField("max_priority_fee_per_gas", U128),
    T.StructField("chain_id", T.LongType()),
])

RECEIPT = T.StructType([
    T.StructField("status", T.ShortType()),
    T.StructField("gas_used", T.LongType()),
    T.StructField("logs", T.ArrayType(T.StructType([
        T.StructField("address", T.BinaryType()),
        T.StructField("topics", T.ArrayType(T.BinaryType())),
        T.StructField("data", T.BinaryType()),
    ]))),
])

STATE = T.MapType(T.BinaryType(), T.MapType(T.BinaryType(), T.BinaryType()))

BLOCK = T.StructType([
    T.StructField("header", HEADER),
    T.StructField("transactions", T.ArrayType(TRANSACTION)),
    T.StructField("receipts", T.ArrayType(RECEIPT)),
    T.StructField("state", STATE),
])

NOTIFICATION = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("kind", T.StringType()),
    T.StructField("old", T.ArrayType(BLOCK)),
    T.StructField("new", T.ArrayType(BLOCK)),
])

BLOCKS = T.StructType([
    T.StructField("block_number", T.LongType()),
    T.StructField("sign", T.ByteType()),
    T.StructField("hash", T.BinaryType()),
    T.StructField("parent_hash", T.BinaryType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("gas_used", T.LongType()),
    T.StructField("gas_limit", T.LongType()),
    T.StructField("base_fee", U128),
    T.StructField("miner", T.BinaryType()),
    T.StructField("state_root", T.BinaryType()),
    T.StructField("extra_data", T.StringType()),
    T.StructField("seq", T.LongType()),
])

TRANSACTIONS = T.StructType([
    T.StructField("tx_hash", T.BinaryType()),
    T.StructField("block_number", T.LongType()),
    T.StructField("tx_index", T.IntegerType()),
    T.StructField("sign", T.ByteType()),
    T.StructField("from", T.BinaryType()),
    T.StructField("to", T.BinaryType()),
    T.StructField("value", T.StringType()),
    T.StructField("input", T.StringType()),
    T.StructField("status", T.ShortType()),
    T.StructField("nonce", T.LongType()),
    T.StructField("gas_limit", T.LongType()),
    T.StructField("gas_used", T.LongType()),
    T.StructField("gas_price", U128),
    T.StructField("max_fee_per_gas", U128),
    T.StructField("max_priority_fee_per_gas", U128),
    T.StructField("chain_id", T.LongType()),
    T.StructField("seq", T.LongType()),
])

LOGS = T.StructType([
    T.StructField("block_number", T.LongType()),
    T.StructField("sign", T.ByteType()),
    T.StructField("tx_hash", T.BinaryType()),
    T.StructField("tx_index", T.IntegerType()),
    T.StructField("log_index", T.IntegerType()),
    T.StructField("address", T.BinaryType()),
    T.StructField("topic0", T.BinaryType()),
    T.StructField("topics", T.ArrayType(T.BinaryType())),
    T.StructField("data", T.StringType()),
    T.StructField("seq", T.LongType()),
])

STORAGE_DIFFS = T.StructType([
    T.StructField("block_number", T.LongType()),
    T.StructField("sign", T.ByteType()),
    T.StructField("address", T.BinaryType()),
    T.StructField("slot", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("seq", T.LongType()),
])

METRICS = T.StructType([
    T.StructField("ts", T.TimestampType()),
    T.StructField("name", T.StringType()),
    T.StructField("le", T.DoubleType()),
    T.StructField("value", T.DoubleType()),
])

SCHEMA_MIGRATIONS = T.StructType([
    T.StructField("version", T.IntegerType()),
    T.StructField("name", T.StringType()),
    T.StructField("applied_at", T.TimestampType()),
])

# write order of one batch
TABLES = {
    "blocks": BLOCKS,
    "transactions": TRANSACTIONS,
    "logs": LOGS,
    "storage_diffs": STORAGE_DIFFS,
}

# what makes two rows "the same fact" for the sign algebra
KEYS = {
    "blocks": ["block_number", "hash"],
    "transactions": ["block_number", "tx_hash"],
    "logs": ["block_number", "tx_hash", "log_index"],
    "storage_diffs": ["block_number", "address", "slot"],
}

# fixed widths in bytes of the binary columns
WIDTHS = {
    "blocks": {"hash": 32, "parent_hash": 32, "miner": 20, "state_root": 32},
    "transactions": {"tx_hash": 32, "from": 20, "to": 20},
    "logs": {"tx_hash": 32, "address": 20, "topic0": 32},
    "storage_diffs": {"address": 20, "slot": 32, "value": 32},
}

# order of rows inside the files of a table, for row-group min/max pruning
SORT = {
    "blocks": ["block_number"],
    "transactions": ["block_number", "tx_index"],
    "logs": ["address", "block_number", "log_index"],
    "storage_diffs": ["address", "slot", "block_number"],
}

# columns that carry a Parquet bloom filter
BLOOM = {
    "blocks": ["hash"],
    "transactions": ["from", "tx_hash"],
    "logs": ["address"],
    "storage_diffs": ["address"],
}

# folders of a stored table: blocks by month and height bucket, the rest by height bucket
PARTITIONS = {
    "blocks": [T.StructField("month", T.StringType()), T.StructField("block_bucket", T.LongType())],
    "transactions": [T.StructField("block_bucket", T.LongType())],
    "logs": [T.StructField("block_bucket", T.LongType())],
    "storage_diffs": [T.StructField("block_bucket", T.LongType())],
}
