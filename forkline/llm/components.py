"""Connected components by alternating star contraction, every round a written table."""

from pyspark.sql import functions as F

from forkline.llm.common import written


def _state(edges):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(spark, edges, label="components"):
    """(node, component) for every node of `edges` (u, v): the smallest node reachable.

    A round hangs every neighbour above a node below the node's smallest neighbour (large star) and
    then every node and its smaller neighbours below the smallest of them (small star).  It ends when
    the edges stand still, after a number of rounds that grows with the logarithm of the largest
    component.  Self loops and repeated edges change nothing; no edges give no rows.  Only a count
    and a sum reach the driver.
    """
    edges = written(spark, edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
                    .filter("u < v").distinct(), label)
    before = _state(edges)
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        edges = (both.join(least, "u").filter("v > u AND m < v").select(F.col("m").alias("u"), "v").distinct())
        least = edges.groupBy("v").agg(F.min("u").alias("m"))
        small = edges.join(least, "v").select(F.col("m").alias("x"), F.col("u").alias("y"))
        small = small.filter("x < y").union(least.select(F.col("m").alias("x"), F.col("v").alias("y")))
        edges = written(spark, small.select(F.col("x").alias("u"), F.col("y").alias("v")).distinct(), label)
        now = _state(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("v").alias("node"), F.col("u").alias("component")).union(
        edges.select("u", "u").distinct())
