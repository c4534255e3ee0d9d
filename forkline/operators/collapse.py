"""The sign algebra: from signed, append-only rows to current state and reorg reports.

Every aggregate here combines partially before it shuffles and groups by the full
identity key, so neither a hot block nor a hot key lands whole in one task.
"""

from pyspark.sql import Column, DataFrame, functions as F

from forkline.functions import timex
from forkline.operators import ordered

OWN = ("sign", "seq")


def active_rows(df: DataFrame) -> DataFrame:
    """Rows of commits, whether or not a revert followed."""
    return df.where("sign = 1")


def net_by_key(df: DataFrame, keys: list) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum("sign").alias("net"))


def net_positive(df: DataFrame, keys: list) -> DataFrame:
    return net_by_key(df, keys).where("net > 0")


def collapse(df: DataFrame, keys: list) -> DataFrame:
    """Current state: per key with a positive net sign, its newest committed row.

    Filters on key columns move below this by themselves; filters on other columns
    must stay above it, because the two halves of a pair need not agree on them.  The
    bucket of a height in the key is a function of the key, so it is grouped by as well
    and bounds on it reach the scan.
    """
    if "block_number" in keys and "block_bucket" in df.columns:
        keys = [*keys, "block_bucket"]
    rest = [c for c in df.columns if c not in keys and c not in OWN]
    newest = F.max(F.when(F.col("sign") == 1, F.struct("seq", *rest)))
    state = (df.groupBy(*keys).agg(F.sum("sign").alias("_net"), newest.alias("_row"))
             .where("_net > 0"))
    picked = {**{k: F.col(k) for k in keys}, **{c: F.col("_row")[c] for c in ["seq", *rest]},
              "sign": F.lit(1).cast("byte")}
    return state.select(*[picked[c].alias(c) for c in df.columns])


def net_over_all_columns(df: DataFrame) -> DataFrame:
    """Rows whose commits outnumber their reverts, compared over every column: the exact
    multiset difference of commits and reverts, with its multiplicity as ``net``."""
    return net_positive(df, [c for c in df.columns if c not in OWN])


def committed_except_reverted(df: DataFrame) -> DataFrame:
    """The same difference as a bag of rows."""
    own = [c for c in df.columns if c not in OWN]
    return df.where("sign = 1").select(*own).exceptAll(df.where("sign = -1").select(*own))


def reverted_keys(df: DataFrame, keys: list) -> DataFrame:
    return net_by_key(df, keys).where("net = 0")


def integrity_violations(df: DataFrame, keys: list) -> DataFrame:
    return net_by_key(df, keys).where("net <> 1")


def anomalies(df: DataFrame, keys: list) -> DataFrame:
    """Keys reverted more often than committed."""
    return (df.groupBy(*keys)
            .agg(F.sum("sign").alias("net"), F.count_if(F.col("sign") == 1).alias("commits"),
                 F.count_if(F.col("sign") == -1).alias("reverts"))
            .where("net < 0"))


def audit(df: DataFrame) -> DataFrame:
    """Totals of a change log in one pass."""
    return df.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("sign") == 1).alias("commits"),
                  F.count_if(F.col("sign") == -1).alias("reverts"),
                  F.coalesce(F.sum("sign"), F.lit(0)).alias("net"))


def reorg_frequency(blocks: DataFrame) -> DataFrame:
    """Reverted heights per day."""
    return (blocks.where("sign = -1").groupBy(F.date_trunc("day", "timestamp").alias("date"))
            .agg(F.count_distinct("block_number").alias("reorg_count")))


def depth_class(depth: Column) -> Column:
    return F.when(depth <= 3, "shallow").when(depth < 100, "medium").otherwise("deep")


def reorg_depths(notifications: DataFrame) -> DataFrame:
    """Depth of every revert or reorg notification."""
    depth = F.size("old")
    return (notifications.where(F.col("kind").isin("ChainReverted", "ChainReorged"))
            .select("seq", "kind", depth.cast("bigint").alias("depth"), depth_class(depth).alias("class")))


def reverted_runs(blocks: DataFrame, width: int = timex.BLOCKS_PER_BUCKET) -> DataFrame:
    """Runs of consecutive reverted heights, from the table alone."""
    heights = blocks.where("sign = -1").select("block_number").distinct()
    ranked = ordered.rank_in_keys(heights, [], ["block_number"],
                                  timex.block_bucket("block_number", width), "_rank")
    runs = (ranked.groupBy((F.col("block_number") - F.col("_rank")).alias("_island"))
            .agg(F.min("block_number").alias("first_block"), F.max("block_number").alias("last_block"),
                 F.count(F.lit(1)).alias("depth")))
    return runs.select("first_block", "last_block", "depth", depth_class(F.col("depth")).alias("class"))


def negate(df: DataFrame) -> DataFrame:
    return df.withColumn("sign", (-F.col("sign")).cast("byte"))


def apply_reorg(old: DataFrame, new: DataFrame) -> DataFrame:
    """Reverts of the old segment followed by the commits of the new one."""
    return negate(old).unionByName(new)


def sign_weighted(df: DataFrame, groups: list, sums: dict, count: str = "rows") -> DataFrame:
    """Counts and sums that are right without collapsing: every row weighs its sign."""
    return df.groupBy(*groups).agg(
        F.sum("sign").alias(count),
        *[F.sum(F.col("sign") * F.col(c)).alias(out) for out, c in sums.items()])


def parent_links(current_blocks: DataFrame) -> DataFrame:
    """Check each block's parent hash against the blocks one height below, one row per block.

    An equi-join on the height instead of a window over the whole chain.  A height that
    holds several hashes (a lost revert) makes the block above it ``linked`` if one of them
    is its parent, and the blocks on that height themselves ``ambiguous``.
    """
    heights = current_blocks.groupBy("block_number").agg(F.collect_set("hash").alias("_hashes"))
    below = heights.select((F.col("block_number") + 1).alias("block_number"), F.col("_hashes").alias("_below"))
    joined = (current_blocks.join(below, "block_number", "left")
              .join(heights.select("block_number", (F.size("_hashes") > 1).alias("_several")), "block_number"))
    found = F.array_contains("_below", F.col("parent_hash"))
    return joined.select(
        "block_number", "hash", "parent_hash",
        F.when(found, F.col("parent_hash")).otherwise(F.array_min("_below")).alias("below_hash"),
        F.when(F.col("_several"), "ambiguous").when(F.col("_below").isNull(), "gap")
        .when(found, "linked").otherwise("broken").alias("link"))


def previous_slot_value(current_diffs: DataFrame, width: int = timex.BLOCKS_PER_BUCKET) -> DataFrame:
    """Each current storage change with the value the slot held before."""
    return ordered.lag_columns(current_diffs, ["address", "slot"], ["block_number"],
                               {"previous_value": "value"}, timex.block_bucket("block_number", width))


def storage_as_of(diffs: DataFrame, keys: list, block) -> DataFrame:
    """Value of every slot as of a height, from the signed log."""
    current = collapse(diffs.where(F.col("block_number") <= block), keys)
    return (current.groupBy("address", "slot")
            .agg(F.max(F.struct("block_number", "value")).alias("_v"))
            .select("address", "slot", F.col("_v.block_number").alias("block_number"),
                    F.col("_v.value").alias("value")))
