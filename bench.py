"""Benchmark: prints one JSON line.

Inputs are derived once from ``$BENCH_SF_DIR`` (default sf0.1) and stored; timed are the
load of nested notifications into the signed tables, the collapse, the catalogue on the
stored tables, and the latency of small micro-batches.
"""

import json
import os
import sys
import time

from pyspark.sql import functions as F

from forkline import schemas
from forkline.fixtures import LATENCY_BUCKETS, Chain
from forkline.operators import collapse as sign, flatten, metrics, stats
from forkline.plans import catalog
from forkline.session import local_session, scratch_dir
from forkline.sources import backfill, notifications, sequence
from forkline.sources.store import Store
from forkline.streaming import pipeline


def sink(df):
    df.write.format("noop").mode("overwrite").save()


def best(fn, runs):
    seconds = []
    for _ in range(runs):
        t0 = time.perf_counter()
        fn()
        seconds.append(time.perf_counter() - t0)
    return min(seconds)


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus, int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    chain = Chain(spark, sf_dir)

    source = scratch_dir(spark, "bench-notifications")
    chain.notifications.repartition(16, "seq").write.parquet(source)
    nested = notifications.read(spark, source)
    history = scratch_dir(spark, "bench-history")
    notifications.canonical_blocks(nested).repartitionByRange(16, "header.number").write.parquet(history)
    blocks_in = notifications.read_blocks(spark, history)
    metric_path = scratch_dir(spark, "bench-metrics")
    chain.metrics.write.parquet(metric_path)
    samples = spark.read.schema(schemas.METRICS).parquet(metric_path)

    times, n = {}, {"i": 0}

    def fresh():
        n["i"] += 1
        return Store(spark, scratch_dir(spark, f"bench-store-{n['i']}"))

    stores = []

    def load():
        # a committed batch is never written again, so every run needs a store of its own
        stores.append(fresh())
        stores[-1].write_batch(flatten.flatten(nested), "st-000000000000", "stream")

    times["load_four_tables"] = best(load, runs)
    store = stores[-1]

    def load_blocks_and_transactions():
        plain = fresh()
        plain.together({
            "blocks": lambda: plain.append("blocks", flatten.flatten_blocks(nested), "b"),
            "transactions": lambda: plain.append("transactions", flatten.flatten_transactions(nested), "b")})

    times["load_blocks_and_transactions"] = best(load_blocks_and_transactions, runs)
    times["backfill"] = best(lambda: backfill.run(fresh(), blocks_in, after=-1, check_missing=False), runs)

    t = {name: store.table(name) for name in schemas.TABLES}
    for name in schemas.TABLES:
        times[f"collapse_{name}"] = best(lambda: sink(sign.collapse(t[name].drop("block_bucket", "month"), schemas.KEYS[name])), runs)

    token = "000000000000000000000000000000000000c001"
    queries = {
        "q1_total_blocks": lambda: catalog.total_blocks(t["blocks"]),
        "q2_latest_block": lambda: catalog.latest_block(t["blocks"]),
        "q4_top_gas_consumers": lambda: catalog.top_gas_consumers(t["transactions"], t["blocks"]),
        "q7_erc20_transfers": lambda: catalog.erc20_transfers(t["logs"], token, 10),
        "q8_reverted_blocks": lambda: catalog.reverted_blocks(t["blocks"]),
        "q11_tx_per_block": lambda: catalog.tx_per_block(t["blocks"], t["transactions"], 0, 10 ** 6),
        "q12_block_series": lambda: catalog.block_series(t["blocks"]),
        "q14_rolling_base_fee": lambda: catalog.rolling_base_fee(t["blocks"]),
        "q14_rolling_base_fee_whole": lambda: catalog.rolling_base_fee(t["blocks"], k=None),
        "q15_deployments": lambda: catalog.deployments(t["transactions"], t["blocks"], 5),
        "q16_nft_transfers": lambda: catalog.nft_transfers(t["logs"], 5),
        "q17_contract_gas": lambda: catalog.contract_gas(t["transactions"], t["blocks"]),
        "q18_same_block_large_flows": lambda: catalog.same_block_large_flows(t["logs"]),
        "q19_daily_sender_stats": lambda: catalog.daily_sender_stats(t["transactions"], t["blocks"]),
        "q21_integrity_report": lambda: catalog.integrity_report(t["transactions"], schemas.KEYS["transactions"]),
        "q22_storage_as_of": lambda: catalog.storage_as_of(t["storage_diffs"], 5000),
        "t13_previous_slot_value": lambda: sign.previous_slot_value(
            sign.collapse(t["storage_diffs"].drop("block_bucket", "month"), schemas.KEYS["storage_diffs"])),
        "m1_rate": lambda: metrics.rate(samples.where("name LIKE 'events_total_%'"), "30 minutes"),
        "m5_histogram_quantile": lambda: metrics.histogram_quantile(metrics.histogram(
            samples.where("name = 'latency_seconds'"), LATENCY_BUCKETS, ["name"]), 0.95, ["name"]),
        "a15_latency_stats": lambda: stats.nearest_rank_stats(samples.where("name = 'latency_seconds'"), "value"),
    }
    for name, make in queries.items():
        times[name] = best(lambda: sink(make()), runs)

    # a real stream: ten micro-batches in the order of their numbers, read, flattened, written and committed
    per_batch = max(1, -(-nested.count() // 10))
    query = pipeline.start(fresh(), sequence.ranges(spark, source, per_batch), scratch_dir(spark, "bench-checkpoint"), "0 seconds")
    sequence.drain(query)
    progress = [p for p in query.recentProgress if p["numInputRows"]]
    latencies = sorted(p["durationMs"]["triggerExecution"] / 1000 for p in progress)

    counts = {name: df.count() for name, df in t.items()}
    rows = sum(counts.values())
    result = {
        "metric": "total seconds of load, collapse and catalogue queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in times.items()},
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "rows": counts,
        "load_rows_per_sec": round(rows / times["load_four_tables"]),
        # rows written, as an insert benchmark counts them; commits and reverts are both rows
        "blocks_per_sec": round(counts["blocks"] / times["load_blocks_and_transactions"]),
        "tx_per_sec": round(counts["transactions"] / times["load_blocks_and_transactions"]),
        "backfill_blocks_per_sec": round(blocks_in.count() / times["backfill"]),
        "collapse_rows_per_sec": round(rows / sum(times[f"collapse_{n}"] for n in schemas.TABLES)),
        "micro_batch_p50_sec": round(latencies[len(latencies) // 2], 3),
        "micro_batch_p95_sec": round(latencies[int(len(latencies) * 0.95)], 3),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
    sys.exit(0)
