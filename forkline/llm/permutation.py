"""Approximate nearest neighbours by inner product, by a permutation index.

A vector is represented by its `PREFIX` nearest pivots in order.  Vectors are dealt into blocks; a
block posts its vectors, with the pivot's rank, in one inverted file per pivot.  A query adds up, over
the files of its own nearest pivots, how far the ranks lie apart (Spearman's footrule, an absent pivot
counting as rank `PREFIX`), and the share of a block that lies nearest is ranked again by the exact
inner product.  The best of all blocks are the answer.

Angles do not know lengths.  So vectors may be lifted by one coordinate to the length of the longest,
queries by a zero: then the nearest by angle is the one with the largest inner product.  Whether to
lift, and the share, are fitted: on a sample of about `SAMPLE` vectors (drawn by a hash of the row, all
where there are fewer) the smallest share that finds `GOAL` of the true neighbours of `PROBES` of them.
Pivots are `PIVOTS` different vectors of the sample, so their broadcast is bounded; every vector is
indexed, in blocks of any size by the same rule.

Cases: vectors that are null, zero, empty, of another length than most (ties: the shortest), or hold a
null or non-finite number take no part, neither as query nor as candidate; a null id neither.  Every
row is a candidate of its own, also one that repeats an id or a vector; a query is not its own
neighbour, but rows with its id are.  Equal scores go to the smaller id.  Empty tables give no rows;
other columns are not read.
"""

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from forkline.llm.common import written

PIVOTS, PREFIX = 1024, 64
SAMPLE, PROBES, GOAL = 4096, 64, 0.97
SHARES = (0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.45, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)
BLOCK, QUERIES = 8192, 1024
TOP = 20


def usable(vectors, vec_id="vec_id", embedding="embedding"):
    v = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return v.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite
                    & F.exists("v", lambda x: x != 0))


def _rows(column):
    return np.stack([np.asarray(v, np.float64) for v in column])


def lifted(x, longest):
    """Rows with one more coordinate that brings each to the length `longest`; unchanged for None."""
    if longest is None:
        return x
    return np.c_[x, np.sqrt(np.maximum(longest**2 - np.einsum("ij,ij->i", x, x), 0))]


def asked(x, longest):
    """Queries in the same space."""
    return x if longest is None else np.c_[x, np.zeros(len(x))]


def permutations(x, pivots, prefix):
    """The nearest pivots of each row, nearest first, by angle."""
    return np.argsort(-(x @ pivots.T), axis=1, kind="stable")[:, :prefix]


def _post(perms, n_pivots):
    """Inverted files: for each pivot the rows that have it and its ranks there."""
    order = np.argsort(perms, axis=None, kind="stable")
    starts = np.searchsorted(perms.ravel()[order], np.arange(n_pivots + 1))
    return order // perms.shape[1], order % perms.shape[1], starts


def footrules(queries, x, pivots, prefix):
    """For each query the footrule distance of all rows, up to a constant."""
    rows, ranks, starts = _post(permutations(x, pivots, prefix), len(pivots))
    for perm in permutations(queries, pivots, prefix):
        # both terms of a shared pivot's absence, taken back where it is shared
        foot = np.zeros(len(x), np.int32)
        for r, p in enumerate(perm):
            s, e = starts[p], starts[p + 1]
            gone = ranks[s:e]
            foot[rows[s:e]] += np.abs(gone - r) - (prefix - gone) - (prefix - r)
        yield foot


class Index:
    """Pivots and what was fitted with them."""

    def __init__(self, pivots, longest, share, prefix):
        self.pivots, self.longest, self.share, self.prefix = pivots, longest, share, min(prefix, len(pivots))

    def search(self, queries, q_rows, x, x_rows, ids, top):
        """(query position, candidate position, score) of each query's best in one block."""
        keep = max(top + 1, int(np.ceil(self.share * len(x))))
        feet = footrules(asked(queries, self.longest), lifted(x, self.longest), self.pivots, self.prefix)
        out = []
        for k, foot in enumerate(feet):
            near = np.argpartition(foot, keep)[:keep] if keep < len(x) else np.arange(len(x))
            near = near[x_rows[near] != q_rows[k]]
            score = (x[near] * queries[k]).sum(axis=1)
            best = np.lexsort((ids[near], -score))[:top]
            out.append((np.full(len(best), k), near[best], score[best]))
        return [np.concatenate(c) for c in zip(*out, strict=True)]


def fit(sample, longest, top=TOP, pivots=PIVOTS, prefix=PREFIX):
    """The index that finds `GOAL` of the neighbours within the sample at the smallest share."""
    order = np.random.default_rng(5).permutation(len(sample))
    x = sample[order]
    probes = np.arange(min(PROBES, len(x)))
    score = x[probes] @ x.T
    score[probes, probes] = -np.inf
    true = np.argsort(-score, axis=1, kind="stable")[:, :min(top, len(x) - 1)]
    some = np.unique(x, axis=0)
    some = some[np.random.default_rng(6).permutation(len(some))[:pivots]]
    best = None
    for lift in (None, longest):
        p = lifted(some, lift)
        p /= np.linalg.norm(p, axis=1, keepdims=True)
        # the place of each true neighbour in the order by footrule, the query itself left out
        places = [np.argsort(np.argsort(np.where(np.arange(len(x)) == k, np.iinfo(np.int32).max, foot), kind="stable"))[true[k]]
                  for k, foot in enumerate(footrules(asked(x[probes], lift), lifted(x, lift), p, min(prefix, len(p))))]
        for share in SHARES:
            found = np.mean(np.asarray(places) < max(top, np.ceil(share * len(x)))) if true.size else 1.0
            if found >= GOAL or share == SHARES[-1]:
                if best is None or share < best.share:
                    best = Index(p, lift, share, prefix)
                break
    return best


FOUND = {"query_row": "int64", "query_id": "int64", "vec_id": "int64", "score": "float64"}


def nearest(vectors, is_query, vec_id="vec_id", embedding="embedding", top=TOP, pivots=PIVOTS, prefix=PREFIX):
    """query_id, rank, vec_id, score: for each query the `top` nearest other rows by inner product.

    `is_query` is a condition on vec_id.
    """
    spark = vectors.sparkSession
    v = written(spark, usable(vectors, vec_id, embedding).withColumn("row", F.monotonically_increasing_id()), "vectors")
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    widths = v.groupBy(F.size("v").alias("width")).agg(F.count("*").alias("n"), F.max(square).alias("most"))
    usual = widths.orderBy(F.desc("n"), "width").first()
    if usual is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    v, n = v.filter(F.size("v") == usual["width"]), usual["n"]
    drawn = F.pmod(F.xxhash64("row"), F.lit(2**30)) < int(2**30 * min(1.0, SAMPLE / n))
    sample = v.select("v").filter(drawn).collect() or v.select("v").limit(1).collect()
    index = fit(np.array([r["v"] for r in sample]), float(np.sqrt(usual["most"])), top, pivots, prefix)
    shared = spark.sparkContext.broadcast(index)
    blocks, parts = max(1, -(-n // BLOCK)), max(1, -(-n // (20 * QUERIES)))
    data = v.select(F.pmod(F.xxhash64("row"), F.lit(blocks)).alias("b"), "row", "vec_id", "v")
    queries = v.filter(is_query(F.col("vec_id"))).select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("b"), "row", "vec_id", "v",
        F.pmod(F.xxhash64(F.col("row") + 1), F.lit(parts)).alias("q"))
    # every block meets every part of the query set
    data = data.withColumn("q", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))

    def one(left, right):
        if not len(left) or not len(right):
            return pd.DataFrame({c: np.zeros(0, kind) for c, kind in FOUND.items()})
        left, right = left.sort_values(["vec_id", "row"]), right.sort_values(["vec_id", "row"])
        ids, q_ids, q_rows = right["vec_id"].to_numpy(), left["vec_id"].to_numpy(), left["row"].to_numpy()
        q, i, s = shared.value.search(_rows(left["v"]), q_rows, _rows(right["v"]), right["row"].to_numpy(), ids, top)
        return pd.DataFrame({"query_row": q_rows[q], "query_id": q_ids[q], "vec_id": ids[i], "score": s})

    found = queries.groupBy("b", "q").cogroup(data.groupBy("b", "q")).applyInPandas(
        one, "query_row long, query_id long, vec_id long, score double")
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
            .select("query_id", "rank", "vec_id", "score"))
