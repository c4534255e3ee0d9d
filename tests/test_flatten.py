"""Block-to-row mapping on hand-written notifications."""

from decimal import Decimal

import pytest

from forkline import schemas
from forkline.operators import flatten


def b20(n):
    return bytes([n]) * 20


def b32(n):
    return n.to_bytes(32, "big")


def header(n, **over):
    base = dict(number=n, hash=b32(n), parent_hash=b32(n - 1), timestamp=1_700_000_000 + 12 * n, gas_used=15_000_000,
                gas_limit=30_000_000, base_fee=Decimal(20 * 10 ** 9), miner=b20(0x42), state_root=b32(0xAB),
                extra_data=b"block")
    base.update(over)
    return tuple(base[f.name] for f in schemas.HEADER.fields)


def tx(i, **over):
    base = {"hash": b32(1000 + i), "from": b20(0x11), "to": b20(0x22), "value": "1000000000000000000", "input": b"\x01\xff",
            "nonce": i, "gas_limit": 21000, "gas_price": Decimal(20 * 10 ** 9), "max_fee_per_gas": None,
            "max_priority_fee_per_gas": None, "chain_id": None}
    base.update(over)
    return tuple(base[f.name] for f in schemas.TRANSACTION.fields)


def receipt(*logs, status=1):
    return (status, 21000, list(logs))


def log(*topics, data=b"\x07"):
    return (b20(0x33), [b32(t) for t in topics], data)


def block(n, txs=(), receipts=(), state=None, **over):
    return (header(n, **over), list(txs), None if receipts is None else list(receipts), state)


def notes(spark, *rows):
    return spark.createDataFrame([(i, kind, old, new) for i, (kind, old, new) in enumerate(rows)], schemas.NOTIFICATION)


def committed(spark, *blocks):
    return notes(spark, *[("ChainCommitted", [], [b]) for b in blocks])


def state_rows(spark, state, n=100):
    return flatten.flatten_state(committed(spark, block(n, state=state))).collect()


def test_state_empty(spark):
    assert state_rows(spark, {}) == []
    assert state_rows(spark, None) == []


def test_state_one_slot_is_padded(spark):
    (r,) = state_rows(spark, {b20(0x12): {b"\x0a\xbc": b"\x09\x99"}})
    assert (r.block_number, r.sign, bytes(r.address)) == (100, 1, b20(0x12))
    assert bytes(r.slot) == b32(0xABC) and bytes(r.value) == b32(0x999)


def test_state_five_slots(spark):
    rows = state_rows(spark, {b20(1): {b32(i): b32(10 * i) for i in range(1, 6)}}, 200)
    assert sorted(int.from_bytes(r.value, "big") for r in rows) == [10, 20, 30, 40, 50]


def test_state_two_accounts_and_one_without_storage(spark):
    rows = state_rows(spark, {b20(1): {b32(100): b32(500)}, b20(2): {b32(200): b32(600)}, b20(3): {}})
    assert {(bytes(r.address), int.from_bytes(r.slot, "big"), int.from_bytes(r.value, "big")) for r in rows} == {
        (b20(1), 100, 500), (b20(2), 200, 600)}


def test_state_revert(spark):
    df = notes(spark, ("ChainReverted", [block(500, state={b20(1): {b32(1): b32(2)}})], []))
    (r,) = flatten.flatten_state(df).collect()
    assert (r.sign, r.block_number) == (-1, 500)


def test_state_maximum_is_32_bytes(spark):
    top = b"\xff" * 32
    (r,) = state_rows(spark, {b20(1): {top: top}})
    assert bytes(r.slot) == top and bytes(r.value) == top


def test_block_defaults(spark):
    r = flatten.flatten_blocks(committed(spark, block(7, base_fee=None))).first()
    assert r.base_fee == 0 and r.extra_data == b"block".hex() and r.sign == 1
    assert r.timestamp.timestamp() == 1_700_000_000 + 84


def test_block_time_unit_is_explicit(spark):
    df = committed(spark, block(7, timestamp=1_640_000_000_000))
    assert flatten.flatten_blocks(df, "ms").first().timestamp.timestamp() == 1_640_000_000
    with pytest.raises(ValueError):
        flatten.flatten_blocks(df, "us")


def test_transaction_fields_and_defaults(spark):
    txs = [tx(0), tx(1, **{"from": None, "to": None, "gas_price": None}),
           tx(2, max_fee_per_gas=Decimal(25), max_priority_fee_per_gas=Decimal(2), chain_id=5)]
    rows = flatten.flatten_transactions(committed(spark, block(1, txs, [receipt(), receipt(status=0), receipt()]))).orderBy("tx_index").collect()
    a, b, c = rows
    assert [r.tx_index for r in rows] == [0, 1, 2] and [r.status for r in rows] == [1, 0, 1]
    assert a.value == "1000000000000000000" and a.input == "01ff" and a.chain_id == 1
    assert a.max_fee_per_gas == a.gas_price and a.max_priority_fee_per_gas is None
    assert bytes(b["from"]) == bytes(20) and b.to is None and b.gas_price == 0
    assert (c.max_fee_per_gas, c.max_priority_fee_per_gas, c.chain_id) == (25, 2, 5)


@pytest.mark.parametrize("receipts", [None, ()])
def test_transactions_without_receipts(spark, receipts):
    df = committed(spark, block(1, [tx(0), tx(1)], receipts))
    rows = flatten.flatten_transactions(df).collect()
    assert [(r.status, r.gas_used) for r in rows] == [(0, None)] * 2
    assert flatten.flatten_logs(df).count() == 0
    assert flatten.missing_receipts(df).count() == 1 and flatten.misaligned(df).count() == 0


def test_misaligned_receipts_are_reported(spark):
    df = committed(spark, block(1, [tx(0), tx(1)], [receipt()]), block(2, [tx(0)], [receipt()]))
    (r,) = flatten.misaligned(df).collect()
    assert (r.block_number, r.transactions, r.receipts) == (1, 2, 1)


def test_log_index_runs_over_the_block(spark):
    df = committed(spark, block(1, [tx(0), tx(1), tx(2)], [receipt(log(1), log(2, 3)), receipt(), receipt(log())]))
    rows = flatten.flatten_logs(df).orderBy("log_index").collect()
    assert [(r.log_index, r.tx_index) for r in rows] == [(0, 0), (1, 0), (2, 2)]
    assert [bytes(r.tx_hash) for r in rows] == [b32(1000), b32(1000), b32(1002)]
    assert [bytes(r.topic0) for r in rows] == [b32(1), b32(2), bytes(32)]
    assert [len(r.topics) for r in rows] == [0, 1, 0] and rows[0].data == "07"


def test_empty_receipts_give_no_logs(spark):
    assert flatten.flatten_logs(committed(spark, block(1))).count() == 0


def test_reorg_reverts_before_it_commits(spark):
    df = notes(spark, ("ChainCommitted", [], [block(1), block(2)]), ("ChainReorged", [block(2)], [block(2, hash=b32(99))]))
    rows = flatten.flatten_blocks(df).orderBy("seq", "block_number").collect()
    assert [(r.block_number, r.sign, r.seq) for r in rows] == [(1, 1, 1), (2, 1, 1), (2, -1, 2), (2, 1, 3)]


def test_width_split(spark):
    df = spark.createDataFrame([(b20(1),), (b"\x01",), (None,)], "address binary")
    good, bad = flatten.split_by_width(df, {"address": 20})
    assert good.count() == 2 and bad.count() == 1


def test_oversized_number_is_quarantined(spark):
    df = spark.createDataFrame([("5",), (str(2 ** 128 - 1),), (None,)], "base_fee string")
    good, bad = flatten.split_by_cast(df, {"base_fee": "decimal(38,0)"})
    assert sorted(str(r.base_fee) for r in good.collect()) == ["5", "None"]
    assert [r.base_fee for r in bad.collect()] == [str(2 ** 128 - 1)]


def test_scan_reads_only_what_a_table_needs(spark, tmp_path):
    path = str(tmp_path / "n")
    committed(spark, block(1, [tx(0)], [receipt(log(1))], {b20(1): {b32(1): b32(2)}})).write.parquet(path)
    stored = spark.read.schema(schemas.NOTIFICATION).parquet(path)
    plan = flatten.flatten_state(stored)._jdf.queryExecution().executedPlan().toString()
    assert "transactions" not in plan and "miner" not in plan
    assert "Exchange" not in flatten.flatten_logs(stored)._jdf.queryExecution().executedPlan().toString()
