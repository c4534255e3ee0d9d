"""Catalogue behaviour that the SQL checks do not reach."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from forkline import schemas
from forkline.functions import bytesx
from forkline.operators import collapse as sign
from forkline.plans import catalog


def test_lookup_of_an_unknown_hash_is_empty(chain):
    assert catalog.transaction_detail(chain.transactions, "0x" + "00" * 32).count() == 0
    known = hashlib.sha256(b"tx:4").hexdigest()
    assert catalog.transaction_detail(chain.transactions, "0x" + known).first().transaction == known


def test_collapsed_input_leaves_out_reverted_rows(chain):
    current = sign.collapse(chain.transactions, schemas.KEYS["transactions"])
    literal = catalog.top_gas_consumers(chain.transactions, chain.blocks, k=None).agg(F.sum("tx_count")).first()[0]
    settled = catalog.top_gas_consumers(current, chain.blocks, k=None).agg(F.sum("tx_count")).first()[0]
    assert settled == current.count() < literal


def test_quantiles_interpolate(spark):
    rows = [(b"\x01" * 20, g) for g in (10, 20, 20, 40)] + [(b"\x02" * 20, 7)]
    tx = spark.createDataFrame(rows, "to binary, gas_used bigint").selectExpr(
        "*", "1L AS block_number", "CAST(1 AS TINYINT) AS sign", "1 AS status", "CAST(1 AS DECIMAL(38,0)) AS gas_price")
    blocks = spark.createDataFrame([(1, 1)], "block_number bigint, sign int")
    got = {r.contract[:2]: (r.call_count, r.median_gas, r.p95_gas)
           for r in catalog.contract_gas(tx, blocks, min_calls=0, k=None).collect()}
    assert got["01"] == (4, 20.0, pytest.approx(20 + 0.85 * 20)) and got["02"] == (1, 7.0, 7.0)


def test_approximate_quantiles_are_close(chain):
    exact = {r.contract: r for r in catalog.contract_gas(chain.transactions, chain.blocks, min_calls=0, k=None).collect()}
    rough = catalog.contract_gas(chain.transactions, chain.blocks, min_calls=0, k=None, approximate=True).collect()
    assert len(rough) == len(exact)
    assert all(abs(r.median_gas - exact[r.contract].median_gas) <= 14_000 for r in rough)
    assert all(r.avg_gas_per_call == pytest.approx(exact[r.contract].avg_gas_per_call) for r in rough)


def test_filters_reach_the_scan(spark, chain, tmp_path):
    chain.logs.write.parquet(str(tmp_path / "logs"))
    logs = spark.read.schema(schemas.LOGS).parquet(str(tmp_path / "logs"))
    plan = catalog.contract_events(logs, "0xc001")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(sign,1)" in plan and "EqualTo(address" in plan and "TakeOrderedAndProject" in plan
    assert "data" not in plan.split("ReadSchema:")[1]


def test_no_catalogue_plan_has_a_cross_join_or_a_single_task_window(chain):
    plans = [catalog.nft_transfers(chain.logs, 5, k=None), catalog.contract_gas(chain.transactions, chain.blocks),
             catalog.same_block_large_flows(chain.logs), catalog.daily_sender_stats(chain.transactions, chain.blocks),
             catalog.tx_per_block(chain.blocks, chain.transactions, 0, 99)]
    for df in plans:
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_byte_helpers(spark):
    r = spark.range(1).select(
        bytesx.to_hex(bytesx.literal("0xABC")).alias("odd"), bytesx.to_hex(bytesx.literal("0x1", 4)).alias("padded"),
        bytesx.to_hex(bytesx.from_hex(F.lit("0Xff01"))).alias("raw"),
        bytesx.short_hash(F.lit("0x" + "12345678" * 8)).alias("short")).first()
    assert (r.odd, r.padded, r.raw, r.short) == ("0abc", "00000001", "ff01", "0x12345678...12345678")


def test_quantiles_over_many_ranges_of_gas(spark):
    """Ties, ranges far apart and a contract whose ranks fall on the border of two ranges."""
    rng = random.Random(7)
    gas = {1: [rng.randrange(30_000_000) for _ in range(3000)], 2: [catalog.GAS_RANGE - 1] * 5 + [catalog.GAS_RANGE] * 5,
           3: [21_000] * 400 + [rng.randrange(10 ** 12) for _ in range(20)]}
    tx = spark.createDataFrame([(bytes([c]) * 20, g) for c, gs in gas.items() for g in gs], "to binary, gas_used bigint").selectExpr(
        "*", "1L AS block_number", "CAST(1 AS TINYINT) AS sign", "1 AS status", "CAST(1 AS DECIMAL(38,0)) AS gas_price")
    blocks = spark.createDataFrame([(1, 1)], "block_number bigint, sign int")
    got = {int(r.contract[:2]): (r.median_gas, r.p95_gas) for r in catalog.contract_gas(tx, blocks, min_calls=0, k=None).collect()}
    for c, gs in gas.items():
        assert got[c] == pytest.approx(tuple(np.quantile(gs, [0.5, 0.95])))


@pytest.mark.parametrize("k", [1, 5, 40, 1000])
def test_last_current_blocks_below_a_long_revert(spark, chain, k):
    """All of the top is reverted, so that the first bound holds too few blocks."""
    top = chain.blocks.agg(F.max("block_number")).first()[0]
    current = sign.collapse(chain.blocks, schemas.KEYS["blocks"])
    gone = current.where(F.col("block_number") > top // 2).withColumn("sign", F.lit(-1).cast("byte")).withColumn("seq", F.lit(10 ** 6))
    signed = chain.blocks.unionByName(gone.select(*chain.blocks.columns))
    want = catalog.latest_blocks(sign.collapse(signed, schemas.KEYS["blocks"]), k).collect()
    assert catalog.latest_current_blocks(signed, k).collect() == want and len(want) <= k


def test_last_current_blocks_of_nothing(spark):
    assert catalog.latest_current_blocks(spark.createDataFrame([], schemas.BLOCKS), 5).collect() == []
