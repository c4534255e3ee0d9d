"""Language of texts: script ranges narrow the candidates, a Viterbi path over words labels spans.

A word (a run of letters) scores log P(n-grams | language) over its 1- to 4-letter pieces with its
borders, from hashed counts.  Only languages that use the word's script are candidates.  A path that
pays `SWITCH` for each change of language labels every word, so a text in several languages falls into
spans; the text's language is the one with the most letters, its score their share weighted by how
sure the model is.

The counts come from a sample of the rows the caller names for training: of each language texts of
about `CHARS` characters in all, drawn whole by a hash of doc_id and text, and at least the one with the
smallest hash, however long.  So every language is learned, whatever the length of its texts and
whether or not they have ids.  The model holds one number per hashed piece and language.

Cases: a null text or one without a letter is `und` with score 0; with no training rows every text is
`und`; ties go to the language first in the alphabet; texts are read whole, one very long text alone in
memory; repeated rows get equal results; empty tables give no rows; other columns are not read.
"""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from forkline.llm.common import slices, strings, written

#: Characters of training text of a language, about.
CHARS = 1_000_000
SWITCH = 4.0
SIZE = 1 << 18
ORDERS = (1, 2, 3, 4)
# Blocks of code points by script.
SCRIPTS = ((0x41, 0x24F, "latin"), (0x1E00, 0x1EFF, "latin"), (0x370, 0x3FF, "greek"), (0x1F00, 0x1FFF, "greek"),
           (0x400, 0x52F, "cyrillic"), (0x530, 0x58F, "armenian"), (0x590, 0x5FF, "hebrew"), (0x600, 0x77F, "arabic"),
           (0x900, 0x97F, "devanagari"), (0x980, 0x9FF, "bengali"), (0xE00, 0xE7F, "thai"), (0x10A0, 0x10FF, "georgian"),
           (0x1100, 0x11FF, "hangul"), (0xAC00, 0xD7AF, "hangul"), (0x3040, 0x30FF, "kana"), (0x3400, 0x9FFF, "han"))


def _tables():
    """By code point of the first plane: script (0: no letter, 1: other letter) and lower case."""
    names = list(dict.fromkeys(s for _, _, s in SCRIPTS))
    letter = np.array([chr(c).isalpha() if not 0xD800 <= c < 0xE000 else False for c in range(0x10000)])
    script = letter.astype(np.uint8)
    for lo, hi, name in SCRIPTS:
        part = script[lo:hi + 1]
        part[letter[lo:hi + 1]] = 2 + names.index(name)
    lower = np.arange(0x10000, dtype=np.uint32)
    for c in range(0x10000):
        if letter[c] and len(x := chr(c).lower()) == 1:
            lower[c] = ord(x)
    return script, lower, len(names) + 2


SCRIPT, LOWER, N_SCRIPTS = _tables()


def words(texts):
    """Of texts joined: hashed n-grams with the word they belong to; each word's text, letters, script."""
    joined = " ".join(t or "" for t in texts) + " "
    codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    low = np.minimum(codes, 0xFFFF)
    script = np.where(codes < 0x10000, SCRIPT[low], 1 if not joined.isascii() else 0)
    if (codes >= 0x10000).any():
        far = np.flatnonzero(codes >= 0x10000)
        script[far] = [chr(c).isalpha() for c in codes[far]]
    letter = script > 0
    codes = np.where(codes < 0x10000, LOWER[low], codes).astype(np.uint64)
    edge = np.flatnonzero(np.diff(np.r_[False, letter, False].astype(np.int8)))
    first, past = edge[::2], edge[1::2]
    ends = np.cumsum([len(t or "") + 1 for t in texts])
    text_of = np.searchsorted(ends, first, side="right")
    # each word with a border before and after it
    sizes = past - first
    begin = np.cumsum(sizes + 2) - (sizes + 2)
    n = int((sizes + 2).sum())
    word_of = np.repeat(np.arange(len(first)), sizes + 2)
    flat = np.zeros(n, np.uint64)
    flat[_inside(begin, sizes, n)] = codes[letter]
    grams, owners = [], []
    with np.errstate(over="ignore"):
        for k in ORDERS:
            if n < k:
                continue
            h = np.full(n - k + 1, k, np.uint64)
            for j in range(k):
                h = (h ^ flat[j:n - k + 1 + j]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
            ok = word_of[:n - k + 1] == word_of[k - 1:]
            if k == 1:
                ok &= flat > 0
            grams.append((h[ok] % np.uint64(SIZE)).astype(np.int32))
            owners.append(word_of[:n - k + 1][ok])
    return grams, owners, text_of, sizes, script[first]


def _inside(begin, sizes, n):
    inside = np.ones(n, bool)
    inside[begin] = False
    inside[begin + sizes + 1] = False
    return inside


class Model:
    def __init__(self, langs, table, uses):
        self.langs, self.table, self.uses = langs, table, uses

    def predict(self, texts):
        """(language, score) of each text."""
        out = []
        for start, end in slices(texts, 2_000_000):
            out += self._predict(texts[start:end])
        return out

    def label(self, texts):
        """(text of each word, letters, label): the path over all words; label -1 has no candidate."""
        grams, owners, text_of, sizes, script = words(texts)
        n, k = len(sizes), len(self.langs)
        score = np.zeros((n, k), np.float64)
        for g, o in zip(grams, owners, strict=True):
            if len(o):
                first = np.flatnonzero(np.r_[True, o[1:] != o[:-1]])
                score[o[first]] += np.add.reduceat(self.table[g], first, axis=0, dtype=np.float64)
        allowed = self.uses[:, script].T
        known = allowed.any(axis=1)
        score = np.where(allowed | ~known[:, None], score, -1e6)
        score[~known] = 0
        return text_of, sizes, self._path(score, text_of, len(texts)), score, known

    def _path(self, score, text_of, n_texts):
        """Viterbi in all texts side by side, longest first."""
        lengths = np.bincount(text_of, minlength=n_texts)
        starts = np.cumsum(lengths) - lengths
        order = np.argsort(-lengths, kind="stable")
        path = np.zeros(len(score), np.int64)
        if not len(score):
            return path
        alive = np.searchsorted(-lengths[order], -np.arange(lengths.max()), side="left")
        came = np.zeros(score.shape, np.int32)
        value = np.zeros((n_texts, score.shape[1]))
        value[:alive[0]] = score[starts[order[:alive[0]]]]
        same = np.arange(score.shape[1], dtype=np.int32)
        for t in range(1, len(alive)):
            m = alive[t]
            v = value[:m]
            best = v.argmax(axis=1)
            top = v[np.arange(m), best] - SWITCH
            at = starts[order[:m]] + t
            stay = v >= top[:, None]
            came[at] = np.where(stay, same, best[:, None])
            value[:m] = np.where(stay, v, top[:, None]) + score[at]
        last = value.argmax(axis=1)
        for t in range(len(alive) - 1, -1, -1):
            m = alive[t]
            at = starts[order[:m]] + t
            path[at] = last[:m]
            last[:m] = came[at, last[:m]]
        return path

    def _predict(self, texts):
        if not self.langs:
            return [("und", 0.0)] * len(texts)
        text_of, sizes, path, score, known = self.label(texts)
        k = len(self.langs)
        weight = np.where(known, sizes, 0)
        letters = np.bincount(text_of * k + path, weights=weight, minlength=len(texts) * k).reshape(-1, k)
        any_letters = np.bincount(text_of, weights=sizes, minlength=len(texts))
        total = np.zeros((len(texts), k))
        np.add.at(total, text_of, score)
        best = letters.argmax(axis=1)
        share = letters[np.arange(len(texts)), best] / np.maximum(letters.sum(axis=1), 1)
        p = np.exp(np.clip(total - total.max(axis=1, keepdims=True), -700, 0))
        sure = (p / p.sum(axis=1, keepdims=True))[np.arange(len(texts)), best]
        # letters, but of no script that a learned language uses: the likeliest all the same, without a score
        return [(self.langs[b] if a else "und", float(s * max(q, 1.0 / k)) if a and l else 0.0)
                for b, s, q, a, l in zip(best, share, sure, any_letters, letters.sum(axis=1), strict=True)]

    def spans(self, text):
        """[(first word, past word, language)] of a text."""
        _, _, path, _, _ = self.label([text])
        cuts = np.flatnonzero(np.diff(path)) + 1
        return [(int(a), int(b), self.langs[path[a]]) for a, b in
                zip(np.r_[0, cuts], np.r_[cuts, len(path)], strict=True) if b > a]


def draw(labelled, chars=CHARS, doc_id="doc_id", text="text", lang="lang"):
    """(l, t): the sample of training texts."""
    rows = labelled.select(F.xxhash64(F.col(doc_id).cast("string"), F.col(text)).alias("h"), F.col(text).alias("t"),
                           F.col(lang).alias("l")).filter("t IS NOT NULL AND l IS NOT NULL")
    # written, so that Spark broadcasts it only if it is small
    sizes = written(labelled.sparkSession, rows.groupBy("l").agg(
        F.sum(F.length("t")).alias("n"), F.min(F.struct(F.pmod("h", F.lit(2**62)), "h")).alias("least")), "languages")
    share = F.pmod("h", F.lit(2**62)) / 2.0**62
    return rows.join(sizes, "l").filter((share < chars / F.col("n")) | (F.col("h") == F.col("least.h"))).select("l", "t")


def fit(labelled, chars=CHARS, doc_id="doc_id", text="text", lang="lang"):
    """A model from rows with text and language."""
    texts = {}
    for r in draw(labelled, chars, doc_id, text, lang).collect():
        texts.setdefault(r["l"], []).append(r["t"])
    langs = sorted(texts)
    counts = np.zeros((SIZE, len(langs)), np.float32)
    uses = np.zeros((len(langs), N_SCRIPTS), bool)
    totals = np.zeros((len(ORDERS), len(langs)))
    for j, name in enumerate(langs):
        grams, _, _, sizes, script = words(texts[name])
        for o, g in enumerate(grams):
            counts[:, j] += np.bincount(g, minlength=SIZE)
            totals[o, j] = len(g)
        share = np.bincount(script, weights=sizes, minlength=N_SCRIPTS) / max(1, sizes.sum())
        uses[j] = share >= 0.05
    table = np.log((counts + 0.1) / (counts.sum(axis=0) + 0.1 * SIZE)) if langs else counts
    # against the mean of the languages, and small, so that one rare piece decides nothing
    table = (np.clip(table - table.mean(axis=1, keepdims=True), -3, 3) / 2).astype(np.float32) if langs else table
    return Model(langs, table, uses)


def predict(docs, model, doc_id="doc_id", text="text"):
    """doc_id, lang_pred and score of every document."""
    shared = docs.sparkSession.sparkContext.broadcast((model.langs, model.table, model.uses))

    def run(batches):
        known = Model(*shared.value)
        for pdf in batches:
            found = known.predict(strings(pdf["text"]))
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "lang_pred": [x[0] for x in found], "score": [x[1] for x in found]})

    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return d.mapInPandas(run, "doc_id long, lang_pred string, score double")
