"""Line dedup: documents probe a sharded minimal perfect hash over the distinct lines.

A line's key is the line without ASCII white space at its ends, A-Z lower-cased.  A key of `LEAST`
code points or more that stands in several documents stays only in the one with the smallest doc_id.

1. Documents name the 128-bit hashes of their keys, each once.
2. Distinct hashes fall into shards of about `SHARD`.  A shard builds a minimal perfect hash: at each
   level the keys that have a bit to themselves are placed, the others go on to the next level; a key's
   slot is the rank of its bit.  By slot lie a fingerprint (64 bits of the hash), the number of documents
   and, for keys of several documents, the smallest doc_id.
3. Documents send their hashes to the shards and probe the arrays; only what has to go comes back.
   Lines themselves never travel.  A shard with many probes (one that holds a line of every document)
   is copied, so that no task has more than `HOT` times its share.
4. Each document drops the lines that came back.

Cases: a null or empty text is one empty line.  A null doc_id counts as the largest; rows that share a
doc_id are one document, so they take no line from each other.  Very long lines and texts are whole;
repeated lines of the keeping document all stay.  Empty tables give no rows; other columns are not read.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from forkline.llm.common import MIX, keyed, mix, written

LEAST = 10
#: Hashes in a shard on average, and how many times that many one task may probe.
SHARD, HOT = 100_000, 4
#: Bits for each key that is still to be placed at a level.
ROOM = 2
LAST = 2**63 - 1


def keys_of(text):
    """The key of each line, as bytes."""
    return [line.strip() for line in text.encode().lower().split(b"\n")]


def counts(key, least=LEAST):
    return len(key) >= 4 * least or len(key) >= least and len(key.decode()) >= least


def name_lines(batches, least=LEAST):
    """Each document's distinct keys that are long enough, as hashes."""
    for batch in batches:
        hashes, sizes = [], []
        rows = batch.num_rows
        first = 0
        texts = batch.column("text")
        for i in range(rows):
            text = texts[i].as_py()
            found = {k for k in keys_of(text) if counts(k, least)} if text else ()
            hashes += map(xxhash.xxh3_128_digest, found)
            sizes.append(len(found))
            if len(hashes) >= 100_000 or i == rows - 1:
                h = np.frombuffer(b"".join(hashes), ">i8").astype(np.int64).reshape(-1, 2)
                at = pa.array(np.repeat(np.arange(first, i + 1), sizes))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).take(at) for c in ("k1", "k2", "owner")] + [pa.array(h[:, 0]), pa.array(h[:, 1])],
                    ["k1", "k2", "owner", "h1", "h2"])
                hashes, sizes, first = [], [], i + 1


def _place(h1, h2, level, size):
    with np.errstate(over="ignore"):
        return mix(h1 ^ mix(h2 + np.uint64(level) * MIX)) % np.uint64(size)


def perfect_hash(h1, h2):
    """(bits of all levels, sizes of the levels) for distinct 128-bit hashes."""
    bits, sizes = [], []
    while len(h1):
        size = max(64, ROOM * len(h1))
        at = _place(h1, h2, len(sizes), size)
        once = np.bincount(at.astype(np.int64), minlength=size) == 1
        bits.append(once)
        sizes.append(size)
        left = ~once[at]
        h1, h2 = h1[left], h2[left]
    return (np.concatenate(bits) if bits else np.zeros(0, bool)), sizes


class Shard:
    """Fingerprints, counts and owners by the slot of a key."""

    FIELDS = "bits binary, sizes array<long>, fingerprints binary, counts binary, owners binary"

    def __init__(self, bits, sizes, fingerprints, counts, owners):
        self.sizes = list(sizes)
        self.bits = np.unpackbits(np.frombuffer(bits, np.uint8), count=sum(self.sizes)).astype(bool)
        self.rank = np.cumsum(self.bits) - 1
        self.fingerprints = np.frombuffer(fingerprints, "<u8")
        self.counts = np.frombuffer(counts, f"<u{len(counts) // max(1, len(self.fingerprints)) or 1}")
        self.owners = np.frombuffer(owners, "<i8")
        self.owner_at = np.cumsum(self.counts > 1) - 1

    @staticmethod
    def build(h1, h2, counts, owners):
        """The fields of a shard, from numpy columns of distinct keys."""
        bits, sizes = perfect_hash(h1, h2)
        shard = Shard(np.packbits(bits).tobytes(), sizes, b"", b"", b"")
        order = np.empty(len(h1), np.int64)
        order[shard.slots(h1, h2)] = np.arange(len(h1))
        width = np.min_scalar_type(int(counts.max(initial=1))).itemsize
        return (np.packbits(bits).tobytes(), sizes, h2[order].astype("<u8").tobytes(), counts[order].astype(f"<u{width}").tobytes(),
                owners[order][counts[order] > 1].astype("<i8").tobytes())

    def slots(self, h1, h2):
        """Slot of each key; of a key that is not in the shard any slot, or -1."""
        out = np.full(len(h1), -1, np.int64)
        todo, base = np.arange(len(h1)), 0
        for level, size in enumerate(self.sizes):
            at = base + _place(h1[todo], h2[todo], level, size).astype(np.int64)
            hit = self.bits[at]
            out[todo[hit]] = self.rank[at[hit]]
            todo, base = todo[~hit], base + size
        return out

    def probe(self, h1, h2):
        """(number of documents, smallest doc_id) of each key; 0 for a key that is not in the shard."""
        slot = self.slots(h1, h2)
        found = slot >= 0
        found[found] = self.fingerprints[slot[found]] == h2[found]
        count, owner = np.zeros(len(h1), np.int64), np.full(len(h1), LAST)
        count[found] = self.counts[slot[found]]
        many = count > 1
        owner[many] = self.owners[self.owner_at[slot[many]]]
        return count, owner


def build_shards(batches):
    """Rows come sorted by shard: one row of arrays for each."""
    def shard(rows):
        h1, h2, n, owner = (np.concatenate([r[c] for r in rows]) for c in ("h1", "h2", "n", "owner"))
        fields = Shard.build(h1.view(np.uint64), h2.view(np.uint64), n, owner)
        return pd.DataFrame([(int(rows[0]["shard"].iloc[0]), *fields)],
                            columns=["shard", "bits", "sizes", "fingerprints", "counts", "owners"])

    open_rows = []
    for pdf in batches:
        for _, rows in pdf.groupby("shard", sort=False):
            if open_rows and open_rows[0]["shard"].iloc[0] != rows["shard"].iloc[0]:
                yield shard(open_rows)
                open_rows = []
            open_rows.append(rows)
    if open_rows:
        yield shard(open_rows)


def _probe(asked, shards):
    """Of one piece of a shard's probes those that have to go."""
    if not len(asked) or not len(shards):
        return pd.DataFrame({c: np.zeros(0, np.int64) for c in ("k1", "k2", "h1")})
    shard = Shard(*(shards[c].iloc[0] for c in ("bits", "sizes", "fingerprints", "counts", "owners")))
    count, owner = shard.probe(asked["h1"].to_numpy().view(np.uint64), asked["h2"].to_numpy().view(np.uint64))
    return asked.loc[(count > 1) & (asked["owner"].to_numpy() > owner), ["k1", "k2", "h1"]]


def strip(batches, least=LEAST):
    """Each text without the lines whose hashes come with it; further columns are handed on."""
    for batch in batches:
        total, dropped, kept = [], [], []
        for text, gone in zip(batch.column("text").to_pylist(), batch.column("gone").to_pylist(), strict=True):
            text = text or ""
            if not gone:
                total.append(text.count("\n") + 1)
                dropped.append(0)
                kept.append(text)
                continue
            gone = set(gone)
            lines = text.split("\n")
            stay = [line for line, key in zip(lines, keys_of(text), strict=True) if not (
                counts(key, least) and int.from_bytes(xxhash.xxh3_128_digest(key)[:8], "big", signed=True) in gone)]
            total.append(len(lines))
            dropped.append(len(lines) - len(stay))
            kept.append("\n".join(stay))
        rest = [c for c in batch.schema.names if c not in ("doc_id", "text", "gone")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(total, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.string()),
             *[batch.column(c) for c in rest]], names=["doc_id", "n_lines", "n_dropped", "kept_text", *rest])


def line_index(docs, doc_id="doc_id", text="text", least=LEAST, shard_size=SHARD):
    """The lines that documents name, and the shards of their index: (named, index), both written.

    named: k1, k2 (the document), owner (its doc_id), h1, h2, shard.  index: shard and Shard.FIELDS.
    """
    spark = docs.sparkSession
    d = keyed(docs, doc_id, text).select("k1", "k2", F.coalesce("doc_id", F.lit(LAST)).alias("owner"), "text")

    def name(batches):
        yield from name_lines(batches, least)
    named = written(spark, d.mapInArrow(name, "k1 long, k2 long, owner long, h1 long, h2 long"), "lines")
    shards = max(1, -(-named.count() // shard_size))
    named = named.withColumn("shard", F.pmod("h1", F.lit(shards)))
    # a document that names a line twice is a repeated row or one that shares its doc_id; either takes nothing from itself
    distinct = named.groupBy("h1", "h2", "shard").agg(F.count("*").alias("n"), F.min("owner").alias("owner"))
    index = distinct.repartition("shard").sortWithinPartitions("shard").mapInPandas(build_shards, f"shard long, {Shard.FIELDS}")
    return named, written(spark, index, "index")


def drop_repeats(docs, doc_id="doc_id", text="text", least=LEAST, carry=(), shard_size=SHARD):
    """One row per document: doc_id, n_lines, n_dropped, kept_text, and the columns of `carry` as c0, c1 ..."""
    spark = docs.sparkSession
    named, index = line_index(docs, doc_id, text, least, shard_size)
    # written, so that its size is known: it is broadcast only if it is small
    load = written(spark, named.groupBy("shard").count().withColumn(
        "copies", F.ceil(F.col("count") / (HOT * shard_size)).cast("int")).filter("copies > 1").select("shard", "copies"), "load")
    copies = F.coalesce("copies", F.lit(1))
    asked = named.join(load, "shard", "left").withColumn("copy", F.pmod(F.xxhash64("k1", "k2"), copies).cast("int")).drop("copies")
    answers = index.join(load, "shard", "left").withColumn("copy", F.explode(F.sequence(F.lit(0), copies - 1))).drop("copies")
    gone = (asked.groupBy("shard", "copy").cogroup(answers.groupBy("shard", "copy")).applyInPandas(_probe, "k1 long, k2 long, h1 long")
            .groupBy("k1", "k2").agg(F.collect_set("h1").alias("gone")))
    d = keyed(docs, doc_id, text, carry)
    more = [f"c{i}" for i in range(len(carry))]

    def run(batches):
        yield from strip(batches, least)
    schema = "doc_id long, n_lines long, n_dropped long, kept_text string" + "".join(f", {c} {kind}" for c, kind in d.select(*more).dtypes)
    return d.join(gone, ["k1", "k2"], "left").select("doc_id", "text", "gone", *more).mapInArrow(run, schema)


ORACLE = """
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, 9223372036854775807) AS owner,
                     string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
places AS (SELECT r, doc_id, owner, lines, unnest(range(1, len(lines) + 1)) AS i FROM docs),
keyed AS (SELECT *, lines[i] AS line, translate(regexp_replace(lines[i], '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g'),
                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM places),
judged AS (SELECT *, length(key) >= 10 AND owner > min(owner) OVER (PARTITION BY key) AS gone FROM keyed)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY r, doc_id"""
