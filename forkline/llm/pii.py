"""Personal data: exact patterns, and a linear-chain conditional random field over word shapes.

The patterns find e-mail addresses, IPv4 addresses, card numbers and phone numbers.  The field is
trained from the labelled table in `pii_table` and adds what the patterns miss: a span it labels that
overlaps none of theirs.  Words without a digit or an @ are always outside in it, so a text falls apart
into runs of the other words, and these are decoded by Viterbi, many runs in one numpy batch.

Cases: null and empty texts have no spans; positions count code points; spans of one kind do not
overlap; repeated rows get equal results; an empty table gives no rows; other columns are not read
(`redact` hands them on).
"""

import re
from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from forkline.llm.common import strings
from forkline.llm.pii_table import ROWS

KINDS = ("email", "ip", "card", "phone")
LABELS = ["O"] + [f"{p}-{k}" for k in KINDS for p in "BI"]
LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# a match can begin at the first digit of a row of digits only
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")


def emails(text):
    """Spans of the address pattern, found from each @ so that long words cost nothing."""
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            free = m.end()
        at = text.find("@", max(at + 1, free))


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text):
    """[(kind, start, end)] by kind as in KINDS, then start."""
    out = []
    if "@" in text:
        out += [("email", s, e) for s, e in emails(text)]
    if DIGIT.search(text):
        out += [("ip", *m.span()) for m in IP.finditer(text)
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
        if "+" in text:
            out += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(DIGIT.findall(m[0])) <= 15]
    return out


MARK = re.compile(r"[0-9@]")
WORD = re.compile(r"\S+")
EDGE_LEFT, EDGE_RIGHT = "\"'[<{*_,.;:!?“”«»", "\"')]>}*_,.;:!?“”«»%&#$|"


def _word_at(text, i, lo):
    """The white-space word around position i, not before lo, without marks at its edges."""
    s = e = i
    while s > lo and not text[s - 1].isspace():
        s -= 1
    m = WORD.match(text, i)
    e = m.end()
    full = (s, e)
    while s < i and text[s] in EDGE_LEFT:
        s += 1
    while e > i + 1 and text[e - 1] in EDGE_RIGHT:
        e -= 1
    return full, (s, e)


def runs(text):
    """Runs of neighbouring words with a digit or an @: [(words, spans, word before, word after)]."""
    out, pos, last = [], 0, None
    while m := MARK.search(text, pos):
        (fs, fe), span = _word_at(text, m.start(), pos)
        if last is not None and not text[last:fs].strip():
            out[-1].append(span)
        else:
            out.append([span])
        pos = last = fe
    result = []
    for spans in out:
        s, e = spans[0][0], spans[-1][1]
        before = text[max(0, s - 40):s].split()
        after = text[e:e + 40].split()
        result.append(([text[a:b] for a, b in spans], spans, before[-1] if before else "", after[0] if after else ""))
    return result


def shape(word):
    return "".join("d" if c.isdigit() else "X" if c.isupper() else "x" if c.isalpha() else c for c in word[:40])


def squeezed(s):
    return re.sub(r"(.)\1+", r"\1", s)


def features(words, before, after):
    """Names of the features of each word of a run."""
    shapes = [shape(w) for w in words]
    out = []
    for i, (w, s) in enumerate(zip(words, shapes, strict=True)):
        digits = sum(c.isdigit() for c in w)
        left = shapes[i - 1] if i else "<"
        right = shapes[i + 1] if i + 1 < len(words) else ">"
        out.append(["bias", f"s={s}", f"q={squeezed(s)}", f"n={min(digits, 17)}", f"l={left[:8]}", f"r={right[:8]}",
                    f"l={left[:8]} n={digits}", f"r={right[:8]} n={digits}", f"@={'@' in w[1:-1]}", f"p={w[0] if not w[0].isalnum() else ''}",
                    f"dots={min(w.count('.'), 4)}", f"colons={min(w.count(':'), 3)}", f"dashes={min(w.count('-'), 3)}",
                    f"w={before.lower().strip(':.,')}" if i == 0 else "w"])
    return out


def parsed(row):
    """(runs, labels) of a row of the table."""
    spans, plain, at = [], "", 0
    for m in re.finditer(r"\[(\w+):([^\]]+)\]", row):
        plain += row[at:m.start()]
        spans.append((m[1], len(plain), len(plain) + len(m[2])))
        plain += m[2]
        at = m.end()
    plain += row[at:]
    for words, places, before, after in runs(plain):
        labels, now = [], None
        for s, e in places:
            hit = next((x for x in spans if x[1] <= s + 1 and e <= x[2] + 1 and s < x[2]), None)
            labels.append("O" if hit is None else ("I-" if hit is now else "B-") + hit[0])
            now = hit
        yield features(words, before, after), [LABELS.index(x) for x in labels]


class Field:
    """Weights of features and of transitions; index 0 of a transition is also what lies around a run."""

    def __init__(self, names, weights, moves):
        self.names, self.weights, self.moves = names, weights, moves

    def scores(self, feats):
        ids = self.names
        return np.stack([self.weights[[ids[f] for f in fs if f in ids]].sum(axis=0) for fs in feats])

    def decode(self, sequences):
        """Labels of each sequence of feature lists, all by one Viterbi over a padded batch."""
        if not sequences:
            return []
        n = len(LABELS)
        lengths = np.array([len(s) for s in sequences])
        flat = self.scores([f for s in sequences for f in s])
        starts = np.cumsum(lengths) - lengths
        order = np.argsort(-lengths, kind="stable")
        value = flat[starts[order]] + self.moves[0]
        back = []
        for t in range(1, lengths.max()):
            k = int((lengths > t).sum())
            step = value[:k, :, None] + self.moves
            back.append(step.argmax(axis=1))
            value[:k] = step.max(axis=1) + flat[starts[order[:k]] + t]
        out = [None] * len(sequences)
        for place, i in enumerate(order):
            y = [int((value[place] + self.moves[:, 0]).argmax())]
            for t in range(lengths[i] - 2, -1, -1):
                y.append(int(back[t][place, y[-1]]))
            out[i] = y[::-1]
        assert n == len(self.moves)
        return out


def _likelihood(moves, emit, length):
    """Log partition, label and transition marginals of one sequence."""
    def lse(a, axis):
        m = a.max(axis=axis, keepdims=True)
        return np.squeeze(m, axis) + np.log(np.exp(a - m).sum(axis=axis))
    alpha, beta = np.zeros_like(emit), np.zeros_like(emit)
    alpha[0] = moves[0] + emit[0]
    for t in range(1, length):
        alpha[t] = lse(alpha[t - 1][:, None] + moves, 0) + emit[t]
    beta[-1] = moves[:, 0]
    for t in range(length - 2, -1, -1):
        beta[t] = lse(moves + emit[t + 1] + beta[t + 1], 1)
    z = lse(alpha[-1] + beta[-1], 0)
    single = np.exp(alpha + beta - z)
    pair = np.zeros_like(moves)
    pair[0] += single[0]
    pair[:, 0] += single[-1]
    for t in range(1, length):
        pair += np.exp(alpha[t - 1][:, None] + moves + emit[t] + beta[t] - z)
    return single, pair


def train(rows=ROWS, rounds=60, rate=0.5, decay=0.002):
    """A field fitted to a table of labelled rows by AdaGrad on the log likelihood with a quadratic penalty."""
    data = [x for row in rows for x in parsed(row)]
    names = {f: i for i, f in enumerate(sorted({f for feats, _ in data for fs in feats for f in fs}))}
    n = len(LABELS)
    weights, moves = np.zeros((len(names), n)), np.zeros((n, n))
    # an inside label follows its own beginning or inside only
    allowed = np.array([[not b.startswith("I") or a[1:] == b[1:] for b in LABELS] for a in LABELS])
    moves[~allowed] = -50
    seen_w, seen_m = np.full_like(weights, 1e-6), np.full_like(moves, 1e-6)
    coded = [([[names[f] for f in fs] for fs in feats], y) for feats, y in data]
    for _ in range(rounds):
        gw, gm = -decay * weights * len(coded), -decay * moves * len(coded)
        for feats, y in coded:
            emit = np.stack([weights[fs].sum(axis=0) for fs in feats])
            single, pair = _likelihood(moves, emit, len(y))
            gm -= pair
            for a, b in zip([0, *y], [*y, 0], strict=True):
                gm[a, b] += 1
            for t, fs in enumerate(feats):
                gw[fs] -= single[t]
                gw[fs, y[t]] += 1
        gm[~allowed] = 0
        seen_w += gw**2
        seen_m += gm**2
        weights += rate * gw / np.sqrt(seen_w)
        moves += rate * gm / np.sqrt(seen_m)
    return Field(names, weights, moves)


def find_in(texts, field):
    """For each text (base spans, added spans), each a list of (kind, start, end) in order."""
    base = [base_spans(t) if t else [] for t in texts]
    sequences, owner = [], []
    for i, t in enumerate(texts):
        for words, spans, before, after in runs(t) if t else ():
            sequences.append(features(words, before, after))
            owner.append((i, spans))
    added = [defaultdict(list) for _ in texts]
    for (i, spans), labels in zip(owner, field.decode(sequences), strict=True):
        taken = base[i]
        now = None
        found = []
        for (s, e), y in zip(spans, labels, strict=True):
            name = LABELS[y]
            if name == "O":
                now = None
            elif name[0] == "B" or now is None:
                now = [name[2:], s, e]
                found.append(now)
            else:
                now[2] = e
        for kind, s, e in found:
            if not any(s < b and a < e for _, a, b in taken):
                added[i][kind].append((kind, s, e))
    return [(b, [x for k in KINDS for x in a[k]]) for b, a in zip(base, added, strict=True)]


SPAN = "array<struct<kind:string,start:int,end:int,base:boolean>>"


def find(docs, field=None, doc_id="doc_id", text="text"):
    """doc_id, text and spans (kind, start, end, base), by kind and then start."""
    field = field or train()

    def run(batches):
        for pdf in batches:
            rows = []
            for base, more in find_in(strings(pdf["text"]), field):
                both = [(*x, True) for x in base] + [(*x, False) for x in more]
                both.sort(key=lambda x: (KINDS.index(x[0]), x[1]))
                rows.append([{"kind": k, "start": s, "end": e, "base": b} for k, s, e, b in both])
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "text": pdf["text"],
                                "spans": pd.Series(rows, index=pdf.index, dtype=object)})

    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return d.mapInPandas(run, f"doc_id long, text string, spans {SPAN}")


def redact(docs, field=None, text="text"):
    """The documents with each span replaced by its kind in angle brackets; all columns are kept."""
    field = field or train()
    at = docs.columns.index(text)

    def run(batches):
        for pdf in batches:
            out = []
            texts = strings(pdf.iloc[:, at])
            for t, (base, more) in zip(texts, find_in(texts, field), strict=True):
                parts, free = [], 0
                for kind, s, e in sorted(base + more, key=lambda x: (x[1], -x[2])):
                    if s >= free:
                        parts += [t[free:s], f"<{kind}>"]
                    free = max(free, e)
                out.append(t if not parts else "".join(parts) + t[free:])
            pdf.isetitem(at, pd.Series(out, index=pdf.index, dtype=object))
            yield pdf

    return docs.mapInPandas(run, docs.schema)
