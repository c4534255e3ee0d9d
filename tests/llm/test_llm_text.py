"""Operators on documents against brute force, and their odd cases."""

import collections
import hashlib
import random
import zlib

import pytest

from forkline.llm import bpe, hyperminhash, langid, packing, pii, quality, queries, ring, substring

WORDS = "alpha beta gamma delta river stone light under over green small house table never seven often paper north south water".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, k1 int, spans string, w int"


def prose(rnd, n):
    return " ".join(rnd.choice(WORDS) + rnd.choice(["", "", "s", "ing", "er"]) for _ in range(n))


def corpus():
    """(doc_id, text) with copies, near copies, shared passages, nulls, empty, blank, long and repeated rows."""
    rnd = random.Random(3)
    rows = [(i, prose(rnd, rnd.randint(3, 200))) for i in range(40)]
    rows += [(100 + i, rows[i][1]) for i in range(0, 20, 2)]
    rows += [(200 + i, " ".join(w if rnd.random() > 0.02 else "zebra" for w in rows[i][1].split())) for i in range(20)]
    shared = prose(rnd, 60)
    rows += [(300 + i, f"{prose(rnd, 30)} {shared}\n{prose(rnd, 30)}") for i in range(12)]
    rows += [(400, None), (401, ""), (402, " \n\t "), (403, "the " * 3000), (404, prose(rnd, 20000)), (405, "a"), (406, "A\x0bb c\x85d")]
    rows += [(None, "no id here " * 5), (None, None), (407, rows[0][1]), (407, rows[0][1]), (408, "x" * 50000)]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "en", "s", None, 1, "x", 2) for i, t in corpus()], SCHEMA).repartition(5)


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def words(text):
    return (text or "").encode().split()


def empty(docs):
    return docs.limit(0)


def test_quality(docs):
    got = rows_of(quality.measure_lines(docs))
    assert len(got) == len(corpus())
    texts = dict(corpus())
    for r in got:
        if r["doc_id"] is None:
            continue
        text = texts[r["doc_id"]] or ""
        w = words(text)
        seen = collections.Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
        hit = {j for i in range(len(w) - 2) if seen[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
        assert (r["n_words"], r["n_repeat_words"]) == (len(w), len(hit)), r["doc_id"]
        assert r["word_chars"] == sum(len(x.decode()) for x in w)
        lines = [x for x in text.split("\n") if words(x)]
        assert r["n_dup_lines"] == len(lines) - len(set(lines))
        assert r["base_failed"] == (len(w) < 50 or 100 * len(hit) > 50 * len(w))
    assert rows_of(quality.measure_lines(empty(docs))) == []


def test_quality_lines_and_clean(spark):
    rnd = random.Random(9)
    good = " ".join(f"sentence {rnd.random()} says {rnd.random()} of {rnd.random()} today." for _ in range(20))
    more = " ".join(f"Then {rnd.random()} came {rnd.random()} again." for _ in range(20))
    rows = [(1, good + "\nHome | About | Login | Help\n" + more), (2, "\n".join(["Home | News | Shop"] * 40)),
            (3, "\n".join(["ab### cd$$$ ef%%% gh"] * 30)), (4, good + "\nAll rights reserved by us, 2020.")]
    df = spark.createDataFrame([(i, t, 5) for i, t in rows], "doc_id long, text string, clean_text int")
    out = {r["doc_id"]: r for r in rows_of(quality.clean(df))}
    assert set(out) == {1, 4} and out[1]["clean_text"] == 5
    assert "Home" not in out[1]["text"] and "reserved" not in out[4]["text"] and out[1]["text"].count("sentence") == 20 and more in out[1]["text"]


def brute_substring(rows):
    count = collections.Counter()
    for _, t in rows:
        w = words(t)
        count.update(tuple(w[i:i + 35]) for i in range(len(w) - 34))
    out = []
    for i, t in rows:
        w = words(t)
        gone = set()
        for k in range(len(w) - 34):
            if count[tuple(w[k:k + 35])] > 1:
                gone.update(range(k, k + 35))
        out.append((i, len(w), len(gone), b" ".join(x for j, x in enumerate(w) if j not in gone).decode()))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot,automaton", [(10_000, 20_000), (2, 20_000), (10_000, 30)])
def test_substring(docs, monkeypatch, hot, automaton):
    monkeypatch.setattr(substring, "HOT", hot)
    monkeypatch.setattr(substring, "AUTOMATON", automaton)
    got = sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in rows_of(substring.remove_repeats(docs))), key=str)
    assert got == brute_substring(corpus())
    assert rows_of(substring.remove_repeats(empty(docs))) == []


def test_substring_of_repetitive_long_texts(spark, monkeypatch):
    """A phrase on every line with a number: one anchor stands thousands of times in one text."""
    line = "the same ten words stand on every line of this"
    rows = [(i, "\n".join(f"{line} {k * (i + 1)}" for k in range(1500))) for i in range(2)] + [(9, line * 3)]
    rows += [(20 + i, " ".join(["again and again"] * 400)) for i in range(2)] + [(30, " ".join(f"n{i}" for i in range(30_000)))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for hot in (10_000, 100):
        monkeypatch.setattr(substring, "HOT", hot)
        got = sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in rows_of(substring.remove_repeats(df))), key=str)
        assert got == brute_substring(rows)


def test_a_shard_never_has_more_words_than_letters():
    """The bound on a shard: occurrences of an anchor, times the words that may stand around one."""
    assert substring.HOT * (2 * substring.WINDOW - substring.PHRASE) + substring.AUTOMATON + substring.WINDOW < 0x110000 - 0x800


def test_search_confirms_by_words(monkeypatch):
    """Windows whose hashes collide are told apart by the automaton."""
    import numpy as np
    a, b = ([f"{x}{i}" for i in range(35)] for x in "ab")
    monkeypatch.setattr(substring, "rolling", lambda h, width: np.zeros(max(0, len(h) - width + 1), np.uint64))
    assert substring._search([" ".join(a), " ".join(b)], [1, 1]) == [[], []]
    assert substring._search([" ".join(a)], [2]) == [[0, 35]]


@pytest.mark.parametrize("i,other", [(124928, "short n6585"), (None, None)])
def test_substring_of_texts_with_equal_short_hashes(spark, i, other):
    """Different texts without a doc_id whose 32-bit hashes are equal."""
    from pyspark.sql import functions as F
    p, q = (" ".join(f"{x}{k}" for k in range(40)) for x in "pq")
    if i is None:
        n = spark.range(400_000).select(F.col("id").cast("string").alias("n"))
        a, b = (n.select(F.concat(F.lit(f"{x} n"), "n").alias(c)) for x, c in ((p, "a"), (q, "b")))
        i, other = a.join(b, F.hash("a", F.lit(True)) == F.hash("b", F.lit(True))).orderBy("a").first()
    else:
        i = f"{p} n{i}"
    rows = [(None, i), (None, other), (1, p), (2, q), (None, i)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert df.filter("doc_id IS NULL").select(F.hash("text", F.lit(True))).distinct().count() == 1
    got = sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in rows_of(substring.remove_repeats(df))), key=str)
    assert got == brute_substring(rows)


def brute_links(rows):
    """Per row (doc_id, size, component id, kept), links between rows whatever their ids."""
    sets = [hyperminhash.shingles(t) for _, t in rows]
    up = list(range(len(rows)))
    def top(x):
        while up[x] != x:
            x = up[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                up[top(a)] = top(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[top(k)] = min(i, least.get(top(k), i))
    out = []
    for k, (i, _) in enumerate(rows):
        c = least.get(top(k)) if sets[k] else i
        out.append((i, len(sets[k]), c, i == c))
    return collections.Counter(out)


def linked(df):
    return collections.Counter((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in rows_of(hyperminhash.near_duplicates(df)))


@pytest.mark.parametrize("block", [1024, 2])
def test_near_duplicates(docs, monkeypatch, block):
    monkeypatch.setattr(hyperminhash, "BLOCK", block)
    assert linked(docs) == brute_links(corpus())
    assert rows_of(hyperminhash.near_duplicates(empty(docs))) == []


def shared_ids():
    """Rows that share an id, have none, or are joined only through one that has none."""
    rnd = random.Random(8)
    a, b, c = (prose(rnd, 120) for _ in range(3))
    chain = [f"w{i}" for i in range(300)]
    steps = [" ".join(chain[12 * k:] + [f"v{j}" for j in range(12 * k)]) for k in range(3)]
    return [(7, a), (7, b), (8, a), (None, c), (None, c), (None, c), (9, c + " more"), (None, "alone " + prose(rnd, 40)),
            (20, steps[0]), (None, steps[1]), (21, steps[2]), (30, "x y z"), (30, "x y z"), (30, "x y z"), (None, None), (5, ""), (5, " ")]


def test_near_duplicates_of_shared_and_missing_ids(spark):
    rows = shared_ids()
    df = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, c0 long").repartition(3)
    assert linked(df) == brute_links(rows)
    got = rows_of(hyperminhash.keep_one(df))
    # one of each group: 7a over 8a, 7b, 9 over the copies without an id, 20 of the chain, one of the repeated rows; rows without words
    kept = collections.Counter((r["doc_id"], r["text"]) for r in got)
    want = [rows[0], rows[1], rows[6], rows[7], rows[8], rows[11], *rows[14:]]
    assert kept == collections.Counter(want) and all(r.keys() == {"doc_id", "text", "c0"} for r in got)


def test_chain_of_near_copies_is_one_component(spark):
    """Each text is like its neighbours, the far ones are not alike at all."""
    rnd = random.Random(5)
    w = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(60):
        rows.append((1000 - i, " ".join(w)))
        w = w[12:] + [f"v{i}-{j}" for j in range(12)]
    rnd.shuffle(rows)
    got = {r["doc_id"]: r["component_id"] for r in rows_of(hyperminhash.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string")))}
    assert got == {i: c for i, _, c, _ in brute_links(rows)} and set(got.values()) == {941}


@pytest.mark.parametrize("i", [2681, 15849])
def test_pair_at_the_limit_with_a_low_estimate(spark, i):
    """Just 0.75 alike (3 of 4 shingles), but with an estimate below 0.6."""
    w = [f"w{i}-{j}" for j in range(8)]
    rows = [(1, " ".join(w)), (2, " ".join(w[:7]))]
    got = {r["doc_id"]: r["component_id"] for r in rows_of(hyperminhash.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string")))}
    assert got == {i: c for i, _, c, _ in brute_links(rows)} == {1: 1, 2: 1}


def test_estimate_corrects_collisions():
    import numpy as np
    minima = np.array([1, 2, 3, 2**63, 2**64 - 1, 0, 2**53 + 1], np.uint64)
    r = hyperminhash.registers(minima)
    assert [int(x) >> 10 for x in r] == [63, 62, 62, 0, 0, 63, 10]
    a = np.zeros((1, hyperminhash.BUCKETS), np.uint16)
    assert hyperminhash.estimate(a, a, np.array([50.0]), np.array([50.0]))[0] == pytest.approx(1)
    assert hyperminhash.estimate(a, a + 1, np.array([50.0]), np.array([50.0]))[0] < 0


@pytest.mark.parametrize("shards", [1, 7, 24, 200])
def test_ring(docs, shards):
    got = rows_of(ring.shard(docs, shards, nodes=8))
    n = collections.Counter(r["shard"] for r in got)
    assert len(got) == len(corpus()) and max(n.values()) - min([*n.values()] if len(n) == shards else [0]) <= 1
    assert set(n) <= set(range(shards))
    for s in n:
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(n[s]))
    want = sorted(((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in corpus()), key=str)
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in got), key=str) == want
    assert rows_of(ring.shard(empty(docs), shards)) == []


def plain_ring(rows, shards, nodes):
    """The ring walked document by document: {(point, doc_id, crc, size): Counter of shards}."""
    md5 = lambda *p: int(hashlib.md5("-".join(map(str, p)).encode()).hexdigest()[:8], 16)
    points = {}
    for s in range(shards):
        for k in range(nodes):
            h = md5("shard", s, k)
            points[h] = min(points.get(h, s), s)
    ends = sorted(points)
    owner = [points[h] for h in ends]
    bound = [len(rows) // shards + (s < len(rows) % shards) for s in range(shards)]
    arcs = [0] * len(ends)
    for i, _ in rows:
        p = md5("" if i is None else i)
        arcs[next((k for k, h in enumerate(ends) if h >= p), 0)] += 1
    # first each shard's own arcs, in the order of the ring
    room, left = list(bound), []
    for k, n in enumerate(arcs):
        own = min(n, room[owner[k]])
        room[owner[k]] -= own
        left.append(n - own)
    # then what is left of each arc goes on clockwise
    moved = collections.Counter()
    for k, n in enumerate(left):
        step = 0
        while n and step < len(ends):
            s = owner[(k + step) % len(ends)]
            take = min(n, room[s])
            if take:
                moved[k, s] += take
                room[s] -= take
                n -= take
            step += 1
        for s in range(shards):
            take = min(n, room[s])
            if take:
                moved[k, s] += take
                room[s] -= take
                n -= take
    total = collections.Counter(moved)
    for k, n in enumerate(arcs):
        if n - left[k]:
            total[k, owner[k]] += n - left[k]
    return ends, total


@pytest.mark.parametrize("n,shards,nodes", [(500, 7, 3), (2000, 24, 64), (40, 50, 1)])
def test_ring_against_a_plain_walk(spark, n, shards, nodes):
    # a third of the rows have no id and lie in one arc, which overflows far
    rows = [(i if i % 3 else None, f"text {i}") for i in range(n)]
    got = rows_of(ring.shard(spark.createDataFrame(rows, "doc_id long, text string"), shards, nodes=nodes))
    ends, want = plain_ring(rows, shards, nodes)
    md5 = lambda i: int(hashlib.md5(("" if i is None else str(i)).encode()).hexdigest()[:8], 16)
    arc = lambda i: next((k for k, h in enumerate(ends) if h >= md5(i)), 0)
    assert collections.Counter((arc(r["doc_id"]), r["shard"]) for r in got) == want


def test_ring_moves_little(spark):
    d = spark.range(20000).selectExpr("id AS doc_id", "'x' AS text")
    place = lambda n: {r["doc_id"]: r["shard"] for r in rows_of(ring.shard(d, n))}
    a, b = place(24), place(25)
    assert sum(a[i] != b[i] for i in a) < 0.1 * len(a)


def test_pii_base_and_added(docs, spark):
    text = ("Mail a.b@x.org,c@d.e.f or @no.x; ip 10.0.0.1 999.1.1.1 1.2.3.4.5 card 4111 1111-1111 1111, 4111111111111112 "
            "tel +1 (555) 010-9999 +12 call me at 555-867-5309 now, in 2020 or 12.5% of 1,250")
    base = pii.base_spans(text)
    assert [(k, text[s:e]) for k, s, e in base] == [
        ("email", "a.b@x.org"), ("email", "c@d.e.f"), ("ip", "10.0.0.1"), ("ip", "1.2.3.4"),
        ("card", "4111 1111-1111 1111"), ("phone", "+1 (555) 010-9999")]
    field = pii.train()
    (_, added), = pii.find_in([text], field)
    assert ("phone", "555-867-5309") in [(k, text[s:e]) for k, s, e in added]
    assert not any("2020" in text[s:e] or "12.5" in text[s:e] for _, s, e in added)
    got = rows_of(pii.find(docs, field))
    assert len(got) == len(corpus()) and all(r["spans"] == [] for r in got if not r["text"])
    one = spark.createDataFrame([(1, text, 7), (2, None, 8)], "doc_id long, text string, spans int")
    out = {r["doc_id"]: r for r in rows_of(pii.redact(one, field))}
    assert out[2] == {"doc_id": 2, "text": None, "spans": 8} and out[1]["text"].startswith("Mail <email>,<email> or @no.x; ip <ip>")
    assert rows_of(pii.find(empty(docs), field)) == []


def test_pii_patterns_against_plain_regular_expressions():
    import re
    rnd = random.Random(1)
    plain = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
             "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    def keep(kind, s):
        d = re.sub("[^0-9]", "", s)
        return (kind == "email" or kind == "ip" and all(int(p) <= 255 for p in s.split("."))
                or kind == "card" and 13 <= len(d) <= 19 and pii.luhn(d) or kind == "phone" and 9 <= len(d) <= 15)
    for _ in range(4000):
        t = "".join(rnd.choice("0123456789....--+@@ ab(),") for _ in range(rnd.randint(0, 60)))
        t = t.replace("a", rnd.choice(["a", "4111111111111111", "é", "10.1.2.3"]))
        want = [(k, *m.span()) for k, p in plain.items() for m in re.finditer(p, t) if keep(k, m[0])]
        assert pii.base_spans(t) == want, t


def test_field_learns_its_table():
    field = pii.train()
    pairs = [x for row in pii.ROWS for x in pii.parsed(row)]
    right = sum(field.decode([f])[0] == y for f, y in pairs)
    assert right >= 0.97 * len(pairs)
    assert field.decode([f for f, _ in pairs]) == [field.decode([f])[0] for f, _ in pairs]


def test_packing(docs):
    path = queries.tokenizer()
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(path)
    got = rows_of(packing.pack(docs, path, context=64))
    want = collections.Counter()
    for i, t in corpus():
        ids = [*lib.encode(t or "", add_special_tokens=False).ids, 0]
        want.update((i, s, min(64, len(ids) - s), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids[s:s + 64])), len(ids))
                    for s in range(0, len(ids), 64))
    assert collections.Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in got) == want
    sequences = collections.defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(sequences) == set(range(len(sequences)))
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 64
    assert rows_of(packing.pack(empty(docs), path)) == []


@pytest.mark.parametrize("text", ["a" + " " * 1_000_100 + "b", "a<|endoftext|>" + "\n" * 1_500_000 + " b"])
def test_packing_ids_of_very_long_blank_runs(text):
    path = queries.tokenizer()
    from tokenizers import Tokenizer
    ids, fast = Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids, packing.LibraryIds(path)
    assert fast.of(text) == b"".join(i.to_bytes(4, "little") for i in ids)
    assert bpe.Encoder(path).encode(text) == ids
    assert fast.of("the next") == b"".join(i.to_bytes(4, "little") for i in bpe.Encoder(path).encode("the next"))


def test_packing_of_a_very_long_blank_run(spark):
    d = spark.createDataFrame([(1, "a" + " " * 1_000_100 + "b"), (2, "a b")], "doc_id long, text string")
    got = {}
    for r in rows_of(packing.pack(d, queries.tokenizer())):
        got.setdefault(r["doc_id"], []).append((r["length"], r["doc_tokens"]))
    assert all(sum(n for n, _ in x) == x[0][1] for x in got.values()) and set(got) == {1, 2}


def test_shortest_pack_first():
    rnd = random.Random(2)
    for _ in range(50):
        h = {rnd.randint(1, 1024): rnd.randint(1, 50) for _ in range(rnd.randint(0, 200))}
        packs = packing.shortest_pack_first(h)
        placed = collections.Counter()
        for lengths, n in packs:
            assert sum(lengths) <= 1024
            placed.update({k: v * n for k, v in collections.Counter(lengths).items()})
        assert placed == h
    h = {n: 30 for n in range(1, 1024)}
    packs = packing.shortest_pack_first(h)
    assert sum(k * v for k, v in h.items()) / (1024 * sum(n for _, n in packs)) > 0.98


def test_bpe(docs):
    path = queries.tokenizer()
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(path)
    got = rows_of(bpe.encode_and_decode(docs, path))
    def row(i, t):
        ids = lib.encode(t or "", add_special_tokens=False).ids
        h = lambda s: hashlib.sha256(s.encode()).hexdigest()
        return i, len(ids), h(",".join(map(str, ids))), h(lib.decode(ids, skip_special_tokens=False))
    assert collections.Counter(tuple(r.values()) for r in got) == collections.Counter(row(i, t) for i, t in corpus())
    back = rows_of(bpe.decode(bpe.encode(docs, path), path))
    assert collections.Counter((r["doc_id"], r["text"]) for r in back) == collections.Counter((i, t or "") for i, t in corpus())
    assert rows_of(bpe.encode_and_decode(empty(docs), path)) == []


def test_bpe_and_packing_ids_on_odd_text():
    path = queries.tokenizer()
    from tokenizers import Tokenizer
    lib, own, fast = Tokenizer.from_file(path), bpe.Encoder(path, bound=50), packing.LibraryIds(path)
    pool = [*"abcXYZ éñßµª²³½Ⅷ١_'‘’“—…\t\n\r\x0b\x0c\x1c\x1f\x85\xa0\u3000中文字Ж0123456789!?.,#|<>😀\u200d\x00", "'s", "'ll", " the", "<|endoftext|>", "  "]
    rnd = random.Random(4)
    texts = ["".join(rnd.choice(pool) for _ in range(rnd.randint(0, 60))) for _ in range(1500)] + ["a" * 3000, "'" * 50]
    for t in texts:
        ids = lib.encode(t, add_special_tokens=False).ids
        assert own.encode(t) == ids and fast.of(t) == b"".join(i.to_bytes(4, "little") for i in ids)
        assert own.rows(t) == (len(ids), ",".join(map(str, ids)), lib.decode(ids, skip_special_tokens=False))


def test_language(spark):
    rnd = random.Random(6)
    parts = {"en": ["the", "tion", "ing", "and", "er", "wh", "th"], "de": ["der", "sch", "ung", "lich", "ß", "ü", "ein"],
             "ru": ["при", "ать", "ов", "ский", "на", "не"]}
    def text(lang, n):
        return " ".join("".join(rnd.choice(parts[lang]) for _ in range(rnd.randint(1, 3))) for _ in range(n))
    rows = [(i, text(k, 60), k) for i, k in enumerate(["en", "de", "ru"] * 40)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.langs == ["de", "en", "ru"]
    tests = [text(k, 25) for k in parts for _ in range(20)]
    assert [x[0] for x in model.predict(tests)] == [k for k in parts for _ in range(20)]
    mixed = text("en", 30) + ". " + text("de", 30) + " " + text("ru", 30)
    spans = model.spans(mixed)
    assert [x[2] for x in spans] == ["en", "de", "ru"] and abs(spans[0][1] - 30) <= 2
    assert model.predict([None, "", "12 34 !", "中文"])[:3] == [("und", 0.0)] * 3
    assert model.predict(["中文"])[0][0] in model.langs and all(0 <= s <= 1 for _, s in model.predict([*tests, mixed]))
    one = spark.createDataFrame([(1, "the thing and", "zz"), (None, None, None)], "doc_id long, text string, score string")
    assert len(rows_of(langid.predict(one, model))) == 2
    nothing = langid.fit(spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert nothing.predict(["abc"]) == [("und", 0.0)]


def test_language_of_long_texts_without_ids_and_many_languages(spark):
    """Every language is learned: one with long texts only, one without ids, and more than a byte can count."""
    rnd = random.Random(7)
    def word(k):
        # syllables of its own for each language, made of common letters
        a, b, c = chr(97 + k % 12), chr(97 + k // 12), "aeiouxyz"[k % 8]
        return "".join(rnd.choice([a + b + c, c + b + a, b + c + c]) for _ in range(rnd.randint(2, 4)))
    langs = [f"l{k:03d}" for k in range(140)]
    text = lambda k, n: " ".join(word(k) for _ in range(n))
    rows = [(k * 10 + j, text(k, 300 if k else 30_000), langs[k]) for k in range(140) for j in range(2)]
    rows += [(None, text(140, 200), "none") for _ in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r["l"] for r in rows_of(langid.draw(df, chars=50))} == {*langs, "none"}
    model = langid.fit(df)
    assert model.langs == sorted([*langs, "none"])
    tests = [(k, text(k, 40)) for k in range(141)]
    names = [*langs, "none"]
    assert sum(p[0] == names[k] for (k, _), p in zip(tests, model.predict([t for _, t in tests]), strict=True)) >= 135


def test_language_path_against_all_paths():
    """The path is the best of all label sequences, for several texts side by side."""
    import itertools

    import numpy as np
    rng = np.random.default_rng(1)
    model = langid.Model(["a", "b", "c"], np.zeros((langid.SIZE, 3)), np.ones((3, langid.N_SCRIPTS), bool))
    for _ in range(30):
        lengths = rng.integers(0, 7, 4)
        score = rng.normal(size=(lengths.sum(), 3)) * 4
        text_of = np.repeat(np.arange(4), lengths)
        path = model._path(score, text_of, 4)
        for k in range(4):
            rows = np.flatnonzero(text_of == k)
            value = lambda p: sum(score[r, x] for r, x in zip(rows, p)) - langid.SWITCH * sum(x != y for x, y in zip(p, p[1:]))
            assert value(path[rows]) == pytest.approx(max(map(value, itertools.product(range(3), repeat=len(rows)))))
