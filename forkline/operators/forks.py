"""The tree of blocks by parent hash, without using signs.

Ancestors are found by pointer doubling: after k rounds every block knows its ancestor 2^k steps
below, so a chain of any length takes rounds in the number of its digits.  Each round is a join by
hash and a written table.  Blocks that have arrived at their root take no further part, so no hash
gathers the rows of all blocks above it.
"""

from pyspark.sql import DataFrame, functions as F

from forkline.session import written


def _start(nodes: DataFrame, parents: DataFrame) -> DataFrame:
    """hash, anc, steps, done: one step down to a parent that is there, else at the root."""
    known = parents.select(F.col("hash").alias("parent_hash"), F.lit(True).alias("known"))
    found = F.col("known").isNotNull()
    return nodes.join(known, "parent_hash", "left").select(
        "hash", F.when(found, F.col("parent_hash")).otherwise(F.col("hash")).alias("anc"),
        found.cast("bigint").alias("steps"), (~found).alias("done"))


def _double(jumps: DataFrame) -> DataFrame:
    """Twice as many steps for every block that is not at its root."""
    below = jumps.select(F.col("hash").alias("anc"), F.col("anc").alias("_a"), F.col("steps").alias("_s"), F.col("done").alias("_d"))
    moved = jumps.where("NOT done").join(below, "anc").select(
        "hash", F.col("_a").alias("anc"), (F.col("steps") + F.col("_s")).alias("steps"), F.col("_d").alias("done"))
    return jumps.where("done").unionByName(moved)


def _roots(jumps: DataFrame, each=None) -> DataFrame:
    """hash, anc, steps with the root of every block; ``each`` sees the jumps of every round."""
    spark = jumps.sparkSession
    while True:
        jumps = written(spark, jumps, "jumps")
        if each:
            each(jumps)
        if jumps.where("NOT done").isEmpty():
            return jumps
        jumps = _double(jumps)


def fork_tree(blocks: DataFrame) -> DataFrame:
    """Per block (block_number, hash): ``on_head_chain``, whether it is the highest block (ties: the
    smallest hash) or below it; ``branch_root``, the lowest block of its branch; ``branch_depth``, the
    steps from there.  The branch of a block on the head's chain goes down to the lowest block known;
    that of another ends above the block where it left the chain, or at a block without a parent."""
    spark = blocks.sparkSession
    nodes = written(spark, blocks.select("block_number", "hash", "parent_hash").distinct(), "blocks")
    head = nodes.orderBy(F.desc("block_number"), "hash").select("hash").limit(1)
    seen = {"chain": head}

    def spread(jumps):
        # those known to be on the chain and what lies 2^k steps below them
        below = seen["chain"].join(jumps, "hash").select(F.col("anc").alias("hash"))
        seen["chain"] = written(spark, seen["chain"].unionByName(below).distinct(), "chain")

    all_roots = _roots(_start(nodes, nodes.select("hash")), spread)
    on = all_roots.join(seen["chain"], "hash", "left_semi").select("hash", F.lit(True).alias("on_head_chain"), "anc", "steps")
    side = nodes.join(seen["chain"], "hash", "left_anti")
    off = _roots(_start(side, side.select("hash"))).select("hash", F.lit(False).alias("on_head_chain"), "anc", "steps")
    return nodes.select("block_number", "hash").join(on.unionByName(off), "hash").select(
        "block_number", "hash", "on_head_chain", F.col("anc").alias("branch_root"), F.col("steps").alias("branch_depth"))
