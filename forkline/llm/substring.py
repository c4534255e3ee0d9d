"""Removal of passages that occur more than once, by sharded Aho-Corasick automata.

A window is `WINDOW` consecutive words.  Of each window the smallest hash among its phrases of
`PHRASE` words is its anchor; equal windows have equal anchors.  So

1. every document names its anchors and how often they stand in it; those that stand twice or more in
   the corpus are kept;
2. documents are cut into segments, the runs of windows under one repeated anchor; the anchor is the
   shard key, so each window's every occurrence meets in one shard;
3. a shard counts its windows by their hashes; those that seem to recur, joined with those that always
   follow them, are passages.  Each distinct passage goes once into an automaton of bounded size, and all
   segments stream through: the automaton finds the passages word for word and says how often they occur,
   which confirms or drops them;
4. words under an occurrence of a confirmed passage are removed.

Text outside segments holds no recurring window, so no document needs to visit a shard that cannot
match it.  Equal segments travel once with a count.  Windows under an anchor that stands more than
`HOT` times are segments of their own under their own hash, so no shard key is hot and nothing is left
out; and a shard has `HOT` x (2 `WINDOW` - `PHRASE`) different words at most, a letter of Unicode for each.

Cases: null and blank texts have no words; rows of fewer words than a window lose nothing; a row that
is repeated has its windows found elsewhere; null doc_ids are ordinary documents; very long texts are
whole, their segments leave the task as they are cut; empty tables give no rows; other columns are not read.
"""

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from forkline.llm.common import MIX, WordHashes, keyed, mix, rolling, sliding, strings, written

WINDOW, PHRASE = 35, 8
HOT = 10_000
#: Windows in one automaton; a shard compiles as many automata as it takes.
AUTOMATON = 20_000


def _anchors_of_windows(h):
    return sliding(rolling(h, PHRASE), WINDOW - PHRASE + 1, np.minimum)


def find_anchors(batches):
    """Per text: words, a hash of the word sequence, its anchors and the number of places of each."""
    hashes = WordHashes()
    for pdf in batches:
        out = []
        for text in strings(pdf["text"]):
            h = hashes.of(text.encode().split() if text else [])
            anchors, places = np.zeros(0, np.uint64), np.zeros(0, np.int64)
            t = np.zeros(2, np.uint64)
            if len(h) >= WINDOW:
                with np.errstate(over="ignore"):
                    phrases, least = rolling(h, PHRASE), _anchors_of_windows(h)
                    pad = np.zeros(WINDOW - PHRASE, np.uint64)
                    chosen = sliding(np.concatenate([pad, least, pad]), WINDOW - PHRASE + 1, np.maximum) == phrases
                    anchors, places = np.unique(phrases[chosen], return_counts=True)
                    t[0], t[1] = rolling(h, len(h))[0], rolling(mix(h), len(h))[0]
            out.append((len(h), *t.view(np.int64), anchors.view(np.int64), places.astype(np.int64)))
        yield pd.DataFrame({"k1": pdf["k1"], "k2": pdf["k2"], **{
            c: pd.Series([x[i] for x in out], index=pdf.index, dtype=object if c in ("anchors", "places") else "int64")
            for i, c in enumerate(("n_words", "t1", "t2", "anchors", "places"))}})


def cut_segments(batches):
    """Segments of documents under the repeated anchors that come with them."""
    hashes = WordHashes()
    for pdf in batches:
        rows = []
        for k1, k2, text, copies, anchors, hot in zip(*(pdf[c] for c in ("k1", "k2", "text", "copies", "anchors", "hot")),
                                                      strict=True):
            words = text.encode().split()
            h = hashes.of(words)
            with np.errstate(over="ignore"):
                least = _anchors_of_windows(h)
                known = np.asarray(anchors, np.int64).view(np.uint64)
                order = np.argsort(known)
                known, is_hot = known[order], np.asarray(hot, bool)[order]
                at = np.minimum(np.searchsorted(known, least), len(known) - 1)
                use = known[at] == least
                alone = use & is_hot[at]
                if alone.any():
                    least = np.where(alone, rolling(h, WINDOW), least)
            new = np.r_[True, (least[1:] != least[:-1]) | (use[1:] != use[:-1]) | alone[1:] | alone[:-1]]
            first = np.flatnonzero(new)
            end = np.r_[first[1:], len(least)]
            for s, e in zip(first[use[first]], end[use[first]], strict=True):
                seg = b" ".join(words[s:e + WINDOW - 1])
                rows.append((k1, k2, int(s), least[s:s + 1].view(np.int64)[0], copies, seg.decode()))
                if len(rows) >= 20_000:
                    yield _segments(rows)
                    rows = []
        yield _segments(rows)


SEGMENT = ["k1", "k2", "start", "anchor", "copies", "segment"]


def _segments(rows):
    return pd.DataFrame(rows, columns=SEGMENT).astype({c: "int64" for c in SEGMENT[:5]})


def _passages(hashes, weights):
    """(segment, from, to in words) of one place of each passage that seems to recur."""
    with np.errstate(over="ignore"):
        windows = [rolling(h, WINDOW) for h in hashes]
        longer = [rolling(h, WINDOW + 1) for h in hashes]
    sizes = np.array([len(w) for w in windows])
    owner = np.repeat(np.arange(len(sizes)), sizes)
    counted = lambda lists, own: (lambda u, at: (at, np.bincount(at, weights=weights[own])[at]))(
        *np.unique(np.concatenate(lists), return_inverse=True))
    which, n = counted(windows, owner)
    last = np.cumsum(sizes) - 1
    inner = np.ones(len(owner), bool)
    inner[last] = False
    # goes on if the next window follows wherever this one stands, and stands nowhere else
    on = np.zeros(len(owner), bool)
    if inner.any():
        _, twice = counted(longer, owner[inner])
        at = np.flatnonzero(inner)
        on[at] = (n[at] == twice) & (n[at + 1] == twice)
    many = n >= 2
    first = np.flatnonzero(many & ~np.r_[False, on[:-1]])
    end = np.flatnonzero(many & ~on)
    # the first window and the length tell passages apart
    _, one = np.unique(np.stack([which[first], end - first]), axis=1, return_index=True)
    first, end = first[one], end[one]
    base = (np.cumsum(sizes) - sizes)[owner[first]]
    return owner[first], first - base, end - base + WINDOW


def _search(texts, weights):
    """For each segment the flat [from, to, ...] of its words under passages that recur in these segments."""
    letters, coded = {}, []
    for t in texts:
        # one letter per word; surrogates are no letters
        coded.append("".join([letters.setdefault(w, chr(n if (n := len(letters) + 1) < 0xD800 else n + 0x800))
                              for w in t.split(" ")]))
    with np.errstate(over="ignore"):
        words = [mix(np.frombuffer(s.encode("utf-32-le"), np.uint32).astype(np.uint64) * MIX) for s in coded]
    passages = [coded[s][a:b] for s, a, b in zip(*_passages(words, np.asarray(weights)), strict=True)]
    found, at = [[] for _ in coded], 0
    while at < len(passages):
        automaton, first, size = ahocorasick.Automaton(), at, 0
        while at < len(passages) and size < AUTOMATON * WINDOW:
            automaton.add_word(passages[at], at)
            size += len(passages[at])
            at += 1
        automaton.make_automaton()
        places, seen = [], np.zeros(at - first, np.int64)
        for i, (s, n) in enumerate(zip(coded, weights, strict=True)):
            for e, k in automaton.iter(s):
                places.append((i, e + 1 - len(passages[k]), e + 1, k - first))
                seen[k - first] += n
        for i, a, b, k in places:
            if seen[k] > 1:
                found[i].append((a, b))
    out = []
    for spans in found:
        flat = []
        for a, b in sorted(spans):
            if flat and a <= flat[-1]:
                flat[-1] = max(flat[-1], b)
            else:
                flat += [a, b]
        out.append(flat)
    return out


def search_shards(batches):
    """Rows come sorted by anchor; anchors are searched together up to the size of one automaton."""
    def result(keys, texts, weights):
        spans = _search(texts, weights)
        hit = [i for i, x in enumerate(spans) if x]
        return pd.DataFrame({"anchor": [keys[i][0] for i in hit], "h": [keys[i][1] for i in hit],
                             "spans": pd.Series([spans[i] for i in hit], dtype=object)})

    keys, texts, weights, size = [], [], [], 0
    for pdf in batches:
        for anchor, h, text, n in zip(*(pdf[c].tolist() for c in ("anchor", "h", "segment", "n")), strict=True):
            if size >= AUTOMATON and anchor != keys[-1][0]:
                yield result(keys, texts, weights)
                keys, texts, weights, size = [], [], [], 0
            keys.append((anchor, h))
            texts.append(text)
            weights.append(n)
            size += text.count(" ") - WINDOW + 2
    if keys:
        yield result(keys, texts, weights)


def strip(batches):
    """The kept words of each text, joined by one space; further columns are handed on."""
    for batch in batches:
        total, removed, kept = [], [], []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
            words = text.encode().split() if text else []
            gone = np.zeros(len(words), bool)
            for a, b in spans or ():
                gone[a:b] = True
            total.append(len(words))
            removed.append(int(gone.sum()))
            kept.append(b" ".join(words if not removed[-1] else [words[i] for i in np.flatnonzero(~gone)]).decode())
        rest = [c for c in batch.schema.names if c not in ("doc_id", "text", "spans")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
             pa.array(kept, pa.string()), *[batch.column(c) for c in rest]],
            names=["doc_id", "text", "n_words", "n_removed", "kept_text", *rest])


def remove_repeats(docs, doc_id="doc_id", text="text", carry=()):
    """One row per document: doc_id, text, n_words, n_removed, kept_text, and the columns of `carry` as c0, c1 ..."""
    spark = docs.sparkSession
    d = keyed(docs, doc_id, text, carry)
    more = [f"c{i}" for i in range(len(carry))]
    a = written(spark, d.select("text", "k1", "k2").mapInPandas(
        find_anchors, "k1 long, k2 long, n_words long, t1 long, t2 long, anchors array<long>, places array<long>"), "anchors")
    named = a.filter("n_words >= 35")
    repeated = (named.select(F.inline(F.arrays_zip("anchors", "places")).alias("anchor", "n")).groupBy("anchor").agg(F.sum("n").alias("c"))
                .filter("c > 1").select("anchor", (F.col("c") > HOT).alias("hot")))
    # texts of the same words are searched once
    same = named.groupBy("t1", "t2").agg(F.min(F.struct("k1", "k2")).alias("k"), F.count("*").alias("copies"))
    one = same.select("k.k1", "k.k2", "copies")
    hits = (named.join(one, ["k1", "k2"], "left_semi").select("k1", "k2", F.explode("anchors").alias("anchor"))
            .join(repeated, "anchor").groupBy("k1", "k2").agg(F.collect_set(F.struct("anchor", "hot")).alias("x"))
            .join(one, ["k1", "k2"]).select("k1", "k2", "copies", "x.anchor", "x.hot").toDF(
                "k1", "k2", "copies", "anchors", "hot"))
    # the same columns as in the last join, so that documents are shuffled once for both
    segments = d.join(hits, ["k1", "k2"]).select("doc_id", "text", "k1", "k2", *more, "copies", "anchors", "hot").mapInPandas(
        cut_segments, "k1 long, k2 long, start long, anchor long, copies long, segment string").withColumn(
        "h", F.xxhash64("segment"))
    distinct = segments.groupBy("anchor", "h", "segment").agg(F.sum("copies").alias("n"))
    found = (distinct.repartition("anchor").sortWithinPartitions("anchor")
             .mapInPandas(search_shards, "anchor long, h long, spans array<int>"))
    spans = (segments.select("k1", "k2", "start", "anchor", "h").join(found, ["anchor", "h"])
             .select("k1", "k2", F.transform("spans", lambda x: (x + F.col("start")).cast("int")).alias("s"))
             .groupBy("k1", "k2").agg(F.flatten(F.collect_list("s")).alias("s")))
    every = (named.select("k1", "k2", "t1", "t2").distinct()
             .join(same.select("t1", "t2", F.col("k.k1").alias("r1"), F.col("k.k2").alias("r2")), ["t1", "t2"])
             .join(spans.toDF("r1", "r2", "s"), ["r1", "r2"]).select("k1", "k2", "s"))
    pairs = F.expr("transform(sequence(0, cast(size(s) / 2 as int) - 1), i -> array(s[2 * i], s[2 * i + 1]))")
    schema = "doc_id long, text string, n_words long, n_removed long, kept_text string" + "".join(
        f", {c} {kind}" for c, kind in d.select(*more).dtypes)
    return (d.join(every, ["k1", "k2"], "left")
            .select("doc_id", "text", *more, F.when(F.col("s").isNotNull(), pairs).alias("spans")).mapInArrow(strip, schema))


def clean(docs, doc_id="doc_id", text="text", size="n_chars"):
    """The rows of `docs` without repeated passages; a text that loses nothing stays as it is."""
    rest = [c for c in docs.columns if c != text]
    new_text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    new = {c: F.col(f"c{i}") for i, c in enumerate(rest)} | {text: new_text}
    if size in rest:
        new[size] = F.char_length(new_text).cast("long")
    return remove_repeats(docs, doc_id, text, rest).select(*[new[c].alias(c) for c in docs.columns])


ORACLE = """
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
starts AS (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM docs WHERE len(w) >= 35),
windows AS (SELECT r, i, md5(array_to_string(w[i:i + 34], ' ')) AS h FROM starts),
again AS (SELECT r, i FROM windows WHERE h IN (SELECT h FROM windows GROUP BY h HAVING count(*) > 1)),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS j FROM again),
gone_of AS (SELECT r, list(j) AS js FROM gone GROUP BY r),
kept AS (SELECT doc_id, len(w) AS n_words, len(coalesce(js, [])) AS n_removed, CASE WHEN js IS NULL THEN w ELSE
         list_transform(list_filter(list_zip(w, range(1, len(w) + 1)), lambda x: NOT list_contains(js, x[2])), lambda x: x[1]) END AS stay
         FROM docs LEFT JOIN gone_of USING (r))
SELECT doc_id, n_words, n_removed, sha256(array_to_string(stay, ' ')) AS kept_sha256 FROM kept"""
