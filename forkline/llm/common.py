"""What several operators share: keyed documents, written tables, word hashes in numpy."""

import numpy as np
import xxhash
from pyspark.sql import functions as F

from forkline.session import scratch_dir

WHITE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
MIX = np.uint64(0x9E3779B97F4A7C15)
ONE = np.uint64(1)


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(spark, df, label):
    """The rows as a Parquet table in the shared folder, so that a lost executor costs a reread."""
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.parquet(path)


def keyed(docs, doc_id="doc_id", text="text", carry=()):
    """doc_id, text, a key (k1, k2) that is never null, and the columns of `carry` as c0, c1 ...

    Rows that share a doc_id but not the text get different keys (128 bits tell texts apart); fully
    repeated rows share one, and with it their result.
    """
    return docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.col(text).cast("string").alias("text"),
        # the column before the text is its seed, so the two hashes of a text are unlike each other
        F.xxhash64(F.col(doc_id).cast("long"), F.col(text).cast("string")).alias("k1"),
        F.xxhash64(F.col(doc_id).isNull(), F.col(text).cast("string")).alias("k2"),
        *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry)])


class WordHashes(dict):
    """64-bit hashes of words as bytes, remembered up to a bound."""

    def __init__(self, bound=400_000):
        super().__init__()
        self.bound = bound

    def __missing__(self, word):
        if len(self) >= self.bound:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words):
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(h):
    """Spread the bits of 64-bit hashes."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def rolling(h, width):
    """Hash of each run of `width` consecutive elements; shorter input gives none."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        out, at, power, factor = np.zeros(n, np.uint64), 0, h, MIX
        size, left = 1, width
        # the width in binary: blocks of 1, 2, 4 ... elements, each made of two halves
        while left:
            if left & 1:
                out = out * factor + power[at:at + n]
                at += size
            left >>= 1
            if left:
                power = power[:len(power) - size] * factor + power[size:]
                factor = factor * factor
                size *= 2
        return mix(out)


def sliding(a, width, pick):
    """pick (np.minimum or np.maximum) over each run of `width` elements."""
    size = 1
    n = len(a) - width + 1
    if n <= 0:
        return a[:0]
    while size * 2 <= width:
        a = pick(a[:len(a) - size], a[size:])
        size *= 2
    return pick(a[:n], a[width - size:width - size + n])


def slices(texts, limit=4_000_000):
    """(from, to) of runs of texts with about `limit` characters, one long text alone at most."""
    start = total = 0
    for i, t in enumerate(texts):
        size = len(t) if t else 0
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(texts):
        yield start, len(texts)


def strings(series):
    """A pandas column as a list with None for nulls."""
    return [t if isinstance(t, str) else None for t in series]
