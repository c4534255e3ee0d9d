"""Near-duplicate documents: HyperMinHash registers, banded, estimated, then confirmed on full sets.

A document's set holds its distinct shingles of five words (lower-cased A-Z; a shorter text is one
shingle).  Bucket j keeps the minimum of the set under its own hash function as 6 bits of leading
zeros and 10 bits of mantissa.  Filling buckets by functions of their own, not by a partition of the
set, leaves none empty in a text of a few shingles, so short texts are found as surely as long ones.

Work goes on sets, not documents: equal sets are one node.  Bands of registers make groups.  Every
member of a group is first compared with the group's smallest node only.  Then members of a group that
are still in different components are compared inside blocks: at first each confirms only its likeliest
partner in another component, which joins nearly all of a group of near copies; at last all that are
still apart are compared by registers and then by their sets (as 32-bit hashes, to be confirmed on the
texts like any other).  So a group never unfolds into its pairs and yet every pair in a group ends up
either compared or connected.  A pair at 0.75 shares one of 32 bands of 4
registers with probability 1 - 6e-6 and passes the estimate with probability 1 - 1e-9.

Cases: null, empty and blank texts have the empty set and are linked with nothing (component is the
own id, kept).  Every row is a document: rows that share a doc_id are linked by their texts alone, and a
row without a doc_id links others like any; a component's id is its smallest doc_id, null where all are
null, and `kept` compares null as equal.  Very long texts are whole sets, one in memory at a time.
Repeated rows get equal results.  Empty tables give no rows.  Other columns are not read.
"""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from forkline.llm.common import WordHashes, keyed, mix, rolling, slices, strings, written
from forkline.llm.components import components

BUCKETS, ROWS = 128, 4
MANTISSA = 10
WIDTH = 5
#: Six standard deviations of the estimate at 0.75 below it.
LEAST_ESTIMATE = 0.5
BLOCK = 1024

_rng = np.random.default_rng(7)
FACTORS = _rng.integers(0, 2**63, BUCKETS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
OFFSETS = _rng.integers(0, 2**63, BUCKETS, dtype=np.uint64)


def words_of(text):
    """ASCII lower case, split at ASCII white space, as UTF-8 bytes."""
    return text.encode().lower().split() if text else []


def shingles(text):
    words = words_of(text)
    if len(words) < WIDTH:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(WIDTH))))


def registers(minima):
    """64-bit minima as leading zeros (6 bits) and the bits after the leading one."""
    length = np.minimum(np.frexp(minima.astype(np.float64))[1], 64).astype(np.int64)
    # the conversion may have rounded up to the next power of two
    over = (length > 0) & ((minima >> np.maximum(length - 1, 0).astype(np.uint64)) == 0)
    zeros = np.minimum(64 - length + over, 63).astype(np.uint64)
    shifted = np.where(zeros < 63, minima << np.minimum(zeros + np.uint64(1), np.uint64(63)), np.uint64(0))
    return ((zeros << np.uint64(MANTISSA)) | (shifted >> np.uint64(64 - MANTISSA))).astype(np.uint16)


def signatures(batches):
    hashes = WordHashes()
    for pdf in batches:
        texts = strings(pdf["text"])
        for start, end in slices(texts):
            sets = []
            for text in texts[start:end]:
                words = words_of(text)
                h = hashes.of(words)
                sets.append(np.unique(rolling(h, min(WIDTH, len(h)))) if words else h)
            sizes = np.array([len(s) for s in sets], np.int64)
            minima = np.full((len(sets), BUCKETS), np.iinfo(np.uint64).max, np.uint64)
            fp = np.zeros((2, len(sets)), np.uint64)
            with np.errstate(over="ignore"):
                for i, s in enumerate(sets):
                    if len(s):
                        fp[0, i], fp[1, i] = s.sum(dtype=np.uint64), mix(s ^ FACTORS[0]).sum(dtype=np.uint64)
                flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
                owner = np.repeat(np.arange(len(sets)), sizes)
                for at in range(0, len(flat), 2048):
                    part, own = flat[at:at + 2048], owner[at:at + 2048]
                    first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
                    least = np.minimum.reduceat(part[:, None] * FACTORS + OFFSETS, first, axis=0)
                    minima[own[first]] = np.minimum(minima[own[first]], least)
            regs = registers(minima).astype("<u2")
            yield pd.DataFrame({
                "doc_id": pdf["doc_id"].iloc[start:end].to_numpy(), "k1": pdf["k1"].iloc[start:end].to_numpy(),
                "k2": pdf["k2"].iloc[start:end].to_numpy(), "n_shingles": sizes,
                "fp1": fp[0].view(np.int64), "fp2": fp[1].view(np.int64), "regs": pd.Series([r.tobytes() for r in regs], dtype=object)})


SIGNATURE = "doc_id long, k1 long, k2 long, n_shingles long, fp1 long, fp2 long, regs binary"


def estimate(a, b, n_a, n_b):
    """Jaccard estimate of register arrays (pairs, BUCKETS), corrected for chance collisions.

    Minima of sets of n and m elements are about exponential; two different ones share a register of
    r mantissa bits with probability nm / (n + m)^2 / (2 ln 2) / 2^r.
    """
    chance = n_a * n_b / (n_a + n_b) ** 2 / (2 * np.log(2)) / 2**MANTISSA
    return ((a == b).mean(axis=1) - chance) / (1 - chance)


def _matrix(column):
    return np.frombuffer(b"".join(map(bytes, column)), "<u2").reshape(-1, BUCKETS)


def _close(batches):
    for pdf in batches:
        if len(pdf):
            e = estimate(_matrix(pdf["ra"]), _matrix(pdf["rb"]), pdf["na"].to_numpy(float), pdf["nb"].to_numpy(float))
            yield pdf.loc[e >= LEAST_ESTIMATE, ["a", "b"]]


def _confirm(batches):
    # a hub comes many times: its set is remembered, up to a bound on the shingles held
    known, held = {}, 0
    for pdf in batches:
        good = []
        for a, b, ta, tb in zip(pdf["a"], pdf["b"], pdf["ta"], pdf["tb"], strict=True):
            if b not in known:
                if held > 200_000:
                    known, held = {}, 0
                known[b] = shingles(tb)
                held += len(known[b])
            x, y = shingles(ta), known[b]
            inter = len(x & y)
            good.append(100 * inter >= 75 * (len(x) + len(y) - inter))
        yield pdf.loc[np.array(good, bool), ["a", "b"]]


def _verified(pairs, nodes, texts):
    """The pairs (a, b) whose full sets are 0.75 alike."""
    n = nodes.select("node", "n_shingles", "regs")
    p = pairs.join(n.toDF("a", "na", "ra"), "a").join(n.toDF("b", "nb", "rb"), "b")
    p = p.filter("4 * least(na, nb) >= 3 * greatest(na, nb)").mapInPandas(_close, "a long, b long")
    p = p.join(texts.toDF("a", "ta"), "a").join(texts.toDF("b", "tb"), "b")
    return p.mapInPandas(_confirm, "a long, b long").toDF("u", "v")


def _hashes(batches):
    """The set of each text as sorted 32-bit hashes."""
    hashes = WordHashes()
    for pdf in batches:
        out = []
        for text in strings(pdf["text"]):
            h = hashes.of(words_of(text))
            out.append(np.unique((rolling(h, min(WIDTH, len(h))) >> np.uint64(32)).astype(np.uint32)).tobytes())
        yield pd.DataFrame({"node": pdf["node"], "hashes": pd.Series(out, index=pdf.index, dtype=object)})


def _alike(a, b):
    """Jaccard of two sorted arrays."""
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    both = int((b[at] == a).sum())
    return both / (len(a) + len(b) - both)


def _blocks(batches, likeliest):
    """Pairs of different components with a fitting estimate in each (key, i, j); rows come sorted by these.

    A pair is given in the first band it shares only.  With `likeliest` each node gives its best pair
    alone; without, the rows hold the sets and a pair must be nearly 0.75 alike by these.
    """
    def pairs(g):
        left, right = np.flatnonzero(g["side"] != 2), np.flatnonzero(g["side"] != 1)
        if not len(left) or not len(right):
            return None
        regs = _matrix(g["regs"])
        node, part, n = g["node"], g["component"], g["n_shingles"].astype(float)
        band, out = int(g["band"][0]), []
        if not likeliest:
            sets = [np.frombuffer(x, np.uint32) for x in g["hashes"]]
        for k in left:
            m = right[(part[right] != part[k]) & (4 * np.minimum(n[right], n[k]) >= 3 * np.maximum(n[right], n[k]))]
            if not len(m):
                continue
            shared = (regs[k] == regs[m]).reshape(len(m), -1, ROWS).all(axis=2)
            m = m[~shared[:, :band].any(axis=1)]
            e = estimate(regs[k:k + 1], regs[m], n[k], n[m])
            if likeliest:
                m = m[np.lexsort((node[m], -e))][:1] if len(m) and e.max() >= 0.75 else m[:0]
            else:
                m = np.array([x for x in m[e >= LEAST_ESTIMATE] if _alike(sets[k], sets[x]) >= 0.74], np.int64)
            out += [(min(node[k], x), max(node[k], x)) for x in node[m]]
        return out

    def found(frame, last):
        """The pairs of the groups in a frame, but for the last unless it is the end; what is left."""
        columns = {c: frame[c].to_numpy() for c in frame.columns}
        k = np.stack([columns[c] for c in ("key", "i", "j")])
        cuts = np.flatnonzero((k[:, 1:] != k[:, :-1]).any(axis=0)) + 1
        starts, ends = np.r_[0, cuts], np.r_[cuts, len(frame)]
        if not last:
            starts, ends = starts[:-1], ends[:-1]
        rows = {x for s, e in zip(starts, ends, strict=True) for x in pairs({c: v[s:e] for c, v in columns.items()}) or ()}
        out = pd.DataFrame(sorted(rows), columns=["a", "b"], dtype="int64")
        return out, frame.iloc[ends[-1] if len(ends) else 0:]

    rest = None
    for pdf in batches:
        if len(pdf):
            out, rest = found(pdf if rest is None else pd.concat([rest, pdf], ignore_index=True), False)
            yield out
    if rest is not None:
        yield found(rest, True)[0]


def _apart(members, nodes, linked, texts, likeliest):
    """Candidate pairs among members of a group that are in different components, by blocks of BLOCK members."""
    placed = members.join(linked, "node", "left").withColumn("component", F.coalesce("component", "node"))
    apart = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi")
    placed = placed.join(apart.select("key"), "key", "left_semi").withColumn(
        "blocks", F.ceil(F.col("n") / BLOCK).cast("int")).withColumn("blk", F.pmod(F.hash("node"), "blocks"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    tiles = (placed.select("key", "band", "node", "component", "blk", other.alias("o"))
             .select("key", F.least("blk", "o").alias("i"), F.greatest("blk", "o").alias("j"), "band", "node", "component",
                     F.expr("CASE WHEN blk = o THEN 0 WHEN blk < o THEN 1 ELSE 2 END").alias("side"))
             .join(nodes.select("node", "n_shingles", "regs"), "node"))
    if not likeliest:
        sets = texts.join(placed.select("node").distinct(), "node", "left_semi")
        tiles = tiles.join(sets.mapInPandas(_hashes, "node long, hashes binary"), "node")
    tiles = tiles.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")

    def compare(batches):
        yield from _blocks(batches, likeliest)
    return tiles.mapInPandas(compare, "a long, b long").distinct()


def groups(docs, doc_id="doc_id", text="text"):
    """One row per document: doc_id, k1, k2 (`common.keyed`), n_shingles, component_id, kept, and `stays`:
    whether this is the document of its component with the smallest doc_id (nulls last, then by key)."""
    spark = docs.sparkSession
    d = keyed(docs, doc_id, text)
    sig = written(spark, d.mapInPandas(signatures, SIGNATURE), "signatures")
    one = F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "k1", "k2")
    sets = sig.filter("n_shingles > 0").groupBy("fp1", "fp2", "n_shingles").agg(F.min(one).alias("one"), F.first("regs").alias("regs"))
    # written at once, so a set keeps its number
    nodes = written(spark, sets.withColumn("node", F.monotonically_increasing_id()), "nodes")
    bands = F.explode(F.sequence(F.lit(0), F.lit(BUCKETS // ROWS - 1)))
    posts = (nodes.select("node", "regs", bands.alias("band"))
             .select("node", "band", F.xxhash64(F.expr(f"substring(regs, {2 * ROWS} * band + 1, {2 * ROWS})"), "band").alias("key")))
    shared = posts.groupBy("key").agg(F.min("node").alias("hub"), F.count("*").alias("n")).filter("n > 1")
    members = written(spark, posts.join(shared, "key"), "members")
    # the text of one document for each set that shares a band
    some = nodes.join(members.select("node").distinct(), "node", "left_semi").select("node", "one.k1", "one.k2")
    texts = written(spark, d.select("k1", "k2", "text").join(some, ["k1", "k2"]).dropDuplicates(["k1", "k2"]).select("node", "text"), "texts")
    star = members.filter("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
    edges = written(spark, _verified(star, nodes, texts), "edges")
    linked = components(spark, edges)

    for likeliest in (True, False):
        late = written(spark, _verified(_apart(members, nodes, linked, texts, likeliest), nodes, texts), "edges")
        if not late.isEmpty():
            edges = edges.union(late)
            linked = components(spark, edges)

    sets = nodes.drop("regs").join(linked, "node", "left").withColumn("component", F.coalesce("component", "node"))
    first = sets.groupBy("component").agg(F.min("one").alias("first"))
    sets = sets.join(first, "component").select("fp1", "fp2", "n_shingles", "first")
    in_set, first = F.col("n_shingles") > 0, F.col("first")
    return (sig.drop("regs").join(sets, ["fp1", "fp2", "n_shingles"], "left")
            .select("doc_id", "k1", "k2", "n_shingles", F.when(in_set, first["doc_id"]).otherwise(F.col("doc_id")).alias("component_id"),
                    (~in_set | (F.col("k1") == first["k1"]) & (F.col("k2") == first["k2"])).alias("stays"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def near_duplicates(docs, doc_id="doc_id", text="text"):
    """One row per document: doc_id, n_shingles, component_id, kept (it is its component's smallest)."""
    return groups(docs, doc_id, text).select("doc_id", "n_shingles", "component_id", "kept")


def keep_one(docs, doc_id="doc_id", text="text"):
    """The rows of `docs` without near duplicates: of each component the document with the smallest doc_id.

    Documents that share a doc_id but not the text are judged by themselves.  Of rows that repeat doc_id
    and text the one with the smallest hash of all columns stays; rows without words all do.
    """
    columns = [f"c{i}" for i in range(len(docs.columns))]
    stay = groups(docs, doc_id, text).filter("stays").groupBy("k1", "k2").agg(F.count("*").alias("n"), F.max("n_shingles").alias("words"))
    rows = keyed(docs, doc_id, text, docs.columns).select("k1", "k2", *columns).join(stay, ["k1", "k2"])
    repeated = (F.col("n") > 1) & (F.col("words") > 0)
    one = (rows.filter(repeated).groupBy("k1", "k2").agg(F.min_by(F.struct(*columns), F.xxhash64(*columns)).alias("row")).select("row.*"))
    return rows.filter(~repeated).select(*columns).unionByName(one).toDF(*docs.columns)


ORACLE = """
WITH RECURSIVE docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (SELECT r, doc_id, list_distinct(list_transform(range(1, greatest(2, len(w) - 3)), lambda i: array_to_string(w[i:i + 4], ' '))) AS s
         FROM docs WHERE len(w) > 0),
sized AS (SELECT r, doc_id, s, len(s) AS n FROM sets),
shingles AS (SELECT r, n, md5_number(unnest(s)) AS h FROM sized),
links AS (SELECT a.r AS a, b.r AS b FROM shingles a JOIN shingles b ON a.h = b.h AND a.r <> b.r AND 4 * least(a.n, b.n) >= 3 * greatest(a.n, b.n)
          GROUP BY a.r, b.r, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
reach AS (SELECT r AS a, r AS b FROM docs UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
least_id AS (SELECT a AS r, min(doc_id) AS component_id FROM reach JOIN docs ON docs.r = reach.b GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, CASE WHEN n IS NULL THEN doc_id ELSE component_id END AS component_id,
       doc_id IS NOT DISTINCT FROM CASE WHEN n IS NULL THEN doc_id ELSE component_id END AS kept
FROM docs JOIN least_id USING (r) LEFT JOIN (SELECT r, n FROM sized) USING (r)"""
