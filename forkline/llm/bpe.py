"""Byte-level BPE: merges by a priority queue over a linked list of symbols; decoding by the vocabulary.

Encoding follows the file: special strings are cut out first, the rest is split by the byte-level
pattern, and each word's bytes are symbols that are merged, lowest rank first and then leftmost.  Two
symbols that are neighbours and have a rank wait in a heap; an entry whose symbols have meanwhile
changed is stale and skipped.  So a word of n bytes costs n log n, however long it is.  Words met
before are remembered up to a bound.

Cases: null text is the empty text (no ids, decoded to ""); repeated rows get equal results; empty
tables give no rows; other columns are not read.
"""

import hashlib
import heapq
import json
import re

import pandas as pd
import regex
from pyspark.sql import functions as F

from forkline.llm.common import strings

# Fixed value: the pattern of byte-level pre-tokenization.
PLAIN_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# \s is the property White_Space there, while Python's also holds four control characters.
PATTERN = PLAIN_PATTERN.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
# The same for texts in which \w, \d and \s of the faster library mean just that.
SIMPLE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
UNUSUAL = re.compile("[^\t\n\r -~¡-©«-±´¶-¸»¿-ɏ‐-‧‰-‾€]")


def byte_letters():
    """The printable letter that stands for each byte in the vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(
        x for x in range(256) if x not in set(plain))}


class Pretokenizer:
    """Words of a text; the strings of special tokens are words of their own."""

    def __init__(self, special=()):
        self.special = sorted(special, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.full = regex.compile(PATTERN)

    @classmethod
    def from_file(cls, path):
        with open(path, encoding="utf-8") as f:
            return cls([t["content"] for t in json.load(f)["added_tokens"]])

    def plain(self, text):
        return (self.full if UNUSUAL.search(text) else SIMPLE).findall(text)

    def __call__(self, text):
        if self.special and any(s in text for s in self.special):
            out = []
            for i, part in enumerate(self.cut.split(text)):
                out += [part] if i % 2 else self.plain(part)
            return out
        return self.plain(text)


class Encoder:
    def __init__(self, path, bound=400_000):
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        letters = byte_letters()
        self.letters = [letters[b] for b in range(256)]
        self.bytes = {c: b for b, c in letters.items()}
        self.vocab = data["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in data["model"]["merges"]]
        ids = self.vocab
        # a pair of ids as one number, and what each rank merges into what
        self.ranks = {ids[a] << 20 | ids[b]: r for r, (a, b) in enumerate(pairs)}
        self.merges = [(ids[a], ids[b], ids[a + b]) for a, b in pairs]
        self.first = [ids[c] for c in self.letters]
        # each id's vocabulary string as bytes, and its number as text
        self.strings = {i: bytes([self.bytes[c] for c in t]) for t, i in self.vocab.items()}
        self.strings |= {i: t.encode() for t, i in self.special.items()}
        self.numbers = {i: str(i) for i in self.strings}
        self.split = Pretokenizer(self.special)
        self.known, self.older, self.bound = {}, {}, bound

    def merge(self, word):
        """Ids of one word."""
        symbols = [self.first[b] for b in word.encode()]
        n = len(symbols)
        if n < 2:
            return symbols
        rank, merges = self.ranks.get, self.merges
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        # an entry is a rank and a place in one number, so the lowest rank and then the leftmost comes first
        heap = [r << 32 | i for i in range(n - 1) if (r := rank(symbols[i] << 20 | symbols[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            entry = heapq.heappop(heap)
            i = entry & 0xFFFFFFFF
            a, b, new = merges[entry >> 32]
            j = after[i]
            if symbols[i] != a or j < 0 or symbols[j] != b:
                continue  # stale
            symbols[i], symbols[j] = new, -1
            k = after[i] = after[j]
            if k >= 0:
                before[k] = i
                if (r := rank(new << 20 | symbols[k])) is not None:
                    heapq.heappush(heap, r << 32 | i)
            h = before[i]
            if h >= 0 and (r := rank(symbols[h] << 20 | new)) is not None:
                heapq.heappush(heap, r << 32 | h)
        return [s for s in symbols if s >= 0]

    def ids(self, word):
        special = self.special.get(word)
        return self.merge(word) if special is None else [special]

    def encode(self, text):
        return [i for w in self.split(text) for i in self.ids(w)]

    def raw(self, ids):
        return b"".join([self.strings[i] for i in ids])

    def decode(self, ids):
        return self.raw(ids).decode("utf-8", "replace")

    def rows(self, text):
        """(number of ids, ids as text, decoded text)."""
        known, out = self.known, []
        if len(known) > self.bound:
            # words met again lately survive the next round
            self.older, self.known = known, {}
            known = self.known
        for w in self.split(text):
            e = known.get(w)
            if e is None:
                e = self.older.get(w)
                if e is None:
                    ids = self.ids(w)
                    e = len(ids), ",".join([self.numbers[i] for i in ids]), self.raw(ids)
                known[w] = e
            out.append(e)
        return (sum([e[0] for e in out]), ",".join([e[1] for e in out]),
                b"".join([e[2] for e in out]).decode("utf-8", "replace"))


def encode_and_decode(docs, path, doc_id="doc_id", text="text"):
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every document."""
    def digest(s):
        return hashlib.sha256(s.encode()).hexdigest()

    def run(batches):
        encoder = Encoder(path)
        for pdf in batches:
            rows = [encoder.rows(t or "") for t in strings(pdf["text"])]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "n_tokens": [r[0] for r in rows],
                                "ids_sha256": [digest(r[1]) for r in rows],
                                "decoded_sha256": [digest(r[2]) for r in rows]})

    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return d.mapInPandas(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode(docs, path, doc_id="doc_id", text="text"):
    """doc_id and the ids of every document."""
    def run(batches):
        encoder = Encoder(path)
        for pdf in batches:
            ids = [encoder.encode(t or "") for t in strings(pdf["text"])]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "ids": pd.Series(ids, index=pdf.index, dtype=object)})

    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return d.mapInPandas(run, "doc_id long, ids array<int>")


def decode(encoded, path, doc_id="doc_id", ids="ids"):
    """doc_id and the text of rows of ids; null ids give null."""
    def run(batches):
        encoder = Encoder(path)
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "text": [
                None if x is None else encoder.decode(x.tolist()) for x in pdf["ids"]]})

    d = encoded.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(ids).cast("array<int>").alias("ids"))
    return d.mapInPandas(run, "doc_id long, text string")
