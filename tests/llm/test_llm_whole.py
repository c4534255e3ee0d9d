"""Line dedup, whitening and the Merkle manifest against plain Python."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from forkline.llm import lines, merkle, queries, whitening

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h1 long, shard int, owner string, tree string, pos int"
SPACE = " \t\n\x0b\x0c\r"


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---- line dedup

def line_corpus():
    rnd = random.Random(5)
    common = [f"Shared line number {i} of the corpus" for i in range(30)]
    rows = []
    for i in range(120):
        own = [f"only in {i} line {j} " + "x" * rnd.randint(0, 30) for j in range(rnd.randint(0, 5))]
        some = rnd.sample(common, rnd.randint(0, 6))
        text = own + [rnd.choice([s, s.upper(), f"  {s}\t", s + "\r"]) for s in some] + ["the footer that stands everywhere"] * rnd.randint(0, 2)
        rnd.shuffle(text)
        rows.append((i, "\n".join(text)))
    rows += [(200, None), (201, ""), (202, "\n\n\n"), (203, "short one\nshort one"), (204, "short one"), (205, "ten chars!"), (206, "TEN CHARS!"),
             (207, "äöüäöüäöü\nÄÖÜÄÖÜÄÖÜÄ"), (208, "äöüäöüäöü\näöüäöüäöüä"), (209, "äöüäöüäöüä"), (210, "x" * 300_000 + "\nlong line stands here"),
             (211, "x" * 300_000), (212, "  no-break space line"), (213, "  no-break space line"), (214, "in\x1c the middle of it\x85"),
             (215, "in\x1c the middle of it")]
    rows += [(None, common[0] + "\nnothing like it anywhere"), (None, "nothing like it anywhere"), (None, None)]
    rows += [(300, "one id two texts\nfirst"), (300, "one id two texts\nsecond"), (301, "one id two texts"), (5, rows[5][1]), (5, rows[5][1])]
    return rows


def plain_dedup(rows, least=10):
    last = 2**63 - 1
    lower = str.maketrans(merkle.UPPER, merkle.LOWER)
    key = lambda line: line.strip(SPACE).translate(lower)
    first = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            k = key(line)
            first[k] = min(first.get(k, last), last if i is None else i)
    out = []
    for i, t in rows:
        all_lines = (t or "").split("\n")
        kept = [x for x in all_lines if len(key(x)) < least or first[key(x)] == (last if i is None else i)]
        out.append((str(i), len(all_lines), len(all_lines) - len(kept), "\n".join(kept)))
    return sorted(out)


@pytest.mark.parametrize("shard_size", [lines.SHARD, 20])
def test_lines_against_plain_python(spark, shard_size):
    rows = line_corpus()
    docs = spark.createDataFrame([(i, t, "en", "s", None, 1, 2, "o", "t", 3) for i, t in rows], SCHEMA).repartition(5)
    got = rows_of(lines.drop_repeats(docs, carry=["owner"], shard_size=shard_size))
    assert sorted((str(r["doc_id"]), r["n_lines"], r["n_dropped"], r["kept_text"]) for r in got) == plain_dedup(rows)
    assert all(r["c0"] == "o" for r in got)
    assert rows_of(lines.drop_repeats(docs.limit(0))) == []


def test_perfect_hash():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 5000):
        h1, h2 = (rng.integers(0, 2**64, n, dtype=np.uint64) for _ in range(2))
        h1[: n // 2] = 7  # half the hash alike
        counts, owners = rng.integers(1, 400, n), rng.integers(0, 10**6, n)
        shard = lines.Shard(*lines.Shard.build(h1, h2, counts, owners))
        assert sorted(shard.slots(h1, h2)) == list(range(n))
        count, owner = shard.probe(h1, h2)
        assert (count == counts).all() and (owner[counts > 1] == owners[counts > 1]).all()
        foreign, _ = shard.probe(h1, h2 ^ np.uint64(1))
        assert (foreign == 0).all()


def test_hot_line_is_split(spark, monkeypatch):
    """A line of every document: its shard is copied, and the answer is the same."""
    rows = [(i, f"the line that stands in every document\nline of document {i}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r for r in rows_of(lines.drop_repeats(docs, shard_size=100))}
    assert got[0]["n_dropped"] == 0 and all(got[i]["kept_text"] == f"line of document {i}" for i in range(1, 3000))


# ---- whitening

def test_whitening_against_eigh(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(600, 24)) * np.linspace(2, 0.2, 24) + 3
    x[50:250] = x[7]  # a third of all rows are one vector
    bad = [(900, None), (901, [float("nan")] * 24), (902, [1.0] * 23 + [None]), (903, [float("-inf")] * 24), (904, []), (905, [1.0] * 5), (906, [1e300] * 24)]
    rows = [(i, v.tolist(), "e") for i, v in enumerate(x)] + [(i, v, "e") for i, v in bad] + [(None, x[3].tolist(), "e")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, component string").repartition(7)
    got = rows_of(whitening.whiten(df))
    q = np.floor(256 * x).astype(np.int64)
    fit = np.unique(q, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    c = fit - s / n
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1][:4], u[:, ::-1][:, :4]
    want = (q - s / n) @ u / np.sqrt(e)
    assert len(got) == 4 * 601 and {r["n"] for r in got} == {n}
    by = {(r["vec_id"], r["component"]): r for r in got}
    for k in range(4):
        mine = np.array([by[i, k + 1]["whitened"] for i in range(600)])
        sign = np.sign((mine * want[:, k]).sum())
        assert np.abs(mine - sign * want[:, k]).max() < 1e-9
        assert by[0, k + 1]["explained"] == pytest.approx(e[k] / np.trace(c.T @ c / n), rel=1e-12)
        assert by[None, k + 1]["whitened"] == by[3, k + 1]["whitened"]
    assert all(by[i, 1]["deviation"] == ((n * q[i] - s) ** 2).sum() for i in range(600))
    assert max(r["identity_error"] for r in got) < 1e-12


def test_whitening_without_variance(spark):
    schema = "vec_id long, embedding array<float>"
    assert rows_of(whitening.whiten(spark.createDataFrame([], schema))) == []
    assert rows_of(whitening.whiten(spark.createDataFrame([(1, None), (2, [])], schema))) == []
    assert rows_of(whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema))) == []
    # a line in three dimensions has one component
    got = rows_of(whitening.whiten(spark.createDataFrame([(i, [float(i), 2.0 * i, 1.0]) for i in range(5)], schema)))
    assert len(got) == 5 and {r["component"] for r in got} == {1} and got[0]["explained"] == pytest.approx(1)


def test_deviation_beyond_long():
    x = np.array([[2**40, 0], [0, 1]])
    assert whitening._deviations(np.array([[2**30, 1]]), 2, np.array([3, 4])).tolist() == [(2**31 - 3) ** 2 + 4]
    with pytest.raises(OverflowError):
        whitening._deviations(x, 2**20, x.sum(axis=0))


def test_leading_needs_no_gap():
    rng = np.random.default_rng(9)
    basis, _ = np.linalg.qr(rng.normal(size=(60, 60)))
    e = np.r_[5, 5, 3, 3 - 1e-9, np.linspace(2.9, 0.1, 56)]
    v = (basis * e) @ basis.T
    got, u, _ = whitening.leading(lambda q: v @ q, 60, 4)
    assert np.allclose(got, e[:4], rtol=1e-13) and np.abs(v @ u - u * got).max() < 1e-12


# ---- manifest

def plain_manifest(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r: sha("".join(map(field, r)))
    lower = str.maketrans(merkle.UPPER, merkle.LOWER)

    def tree(nodes):
        """(root, proof path of each leaf)."""
        paths, at = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            runs = [nodes[i:i + 8] for i in range(0, len(nodes), 8)]
            for k, place in enumerate(at):
                run, own = runs[place // 8], place % 8
                paths[k].append(("".join(run[:own]), "".join(run[own + 1:])))
            nodes, at = [sha("".join(r)) for r in runs], [p // 8 for p in at]
        return nodes[0], paths

    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    inner = {}
    for name in names:
        own = sorted(((r[0] is not None, r[0] or 0, leaf(r), r) for r in groups[name]), key=lambda x: x[:3])
        inner[name] = (own, *tree([x[2] for x in own]))
    root, above = tree([inner[name][1] for name in names])
    out = []
    for name, upper in zip(names, above, strict=True):
        own, subroot, paths = inner[name]
        for (_, _, digest, r), path in zip(own, paths, strict=True):
            claim = digest
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0:
                claim = leaf((*r[:4], r[4] and r[4].translate(lower)))
            for b, a in path + upper:
                claim = sha(b + claim + a)
            out.append((str(r[0]), digest, subroot, root, sha("".join(b + a for b, a in path + upper)), claim, claim == root))
    return sorted(out)


def documents(n=700):
    rnd = random.Random(6)
    langs = [None, "", "de", "en", "é", "z"]
    rows = [(i, rnd.choice(["web", None, "a:b"]), rnd.choice(langs + ["en"] * 8), rnd.choice([None, 3]), rnd.choice(["Ab c", "low", None, "", "ÄB"]) or None)
            for i in rnd.sample(range(-50, 5000), n)]
    return rows + [(None, None, None, None, None), (None, "s", "en", 1, "X"), rows[0], rows[0], (rows[1][0], "web", "en", 2, "Other"),
                   (9000, "s", "alone", 1, "One"), (9001, "s", "en", 1, "long " * 100_000)]


def checked(proofs):
    return sorted((str(r["id"]), r["leaf"], r["subroot"], r["root"], sha("".join(b + a for b, a in zip(r["before"], r["after"], strict=True))),
                   r["folded_root"], r["folded_root"] == r["root"]) for r in rows_of(proofs))


@pytest.mark.parametrize("levels", [2, 4])
def test_manifest_against_plain_python(spark, levels):
    rows = documents()
    docs = spark.createDataFrame([(i, t, lang, s, n, 1, 2, "o", "t", 3) for i, s, lang, n, t in rows], SCHEMA).repartition(6)
    m = merkle.manifest(docs, claim=merkle.tampered(), levels=levels)
    want = plain_manifest(rows)
    assert checked(m.prove("claim")) == want and m.root() == want[0][3]
    assert all(r["folded_root"] == m.root() for r in rows_of(m.prove().select("folded_root")))


def test_manifest_of_nothing_and_of_one(spark):
    docs = spark.createDataFrame([(1, "T", None, "s", 1, 1, 2, "o", "t", 3)], SCHEMA)
    empty = merkle.manifest(docs.limit(0))
    assert empty.root() is None and rows_of(empty.prove()) == []
    assert checked(merkle.manifest(docs, claim=merkle.tampered()).prove("claim")) == plain_manifest([(1, "s", None, 1, "T")])


def test_layout():
    for height in range(1, 7):
        places = merkle.address(height)
        assert [len(p) for p in places] == [8**k for k in range(height)]
        assert sorted(np.concatenate(places).tolist()) == list(range(sum(8**k for k in range(height))))
    # the first half of the levels, then each subtree below it in one piece
    four = merkle.address(4)
    assert sorted([*four[0], *four[1]]) == list(range(9))
    for k in range(8):
        piece = [int(four[2][k]), *four[3][8 * k:8 * k + 8].tolist()]
        assert sorted(piece) == list(range(9 + 9 * k, 18 + 9 * k))


# ---- the registered queries

@pytest.mark.parametrize("name", ["op11_perfect_hash_lines", "op12_chebyshev_whitening", "op13_merkle_manifest"])
def test_queries_against_plain_python(spark, name):
    got = rows_of(queries.QUERIES[name](spark, SF))
    if name.startswith("op12"):
        x = np.floor(256 * np.array([r["embedding"] for r in rows_of(spark.read.parquet(f"{SF}/embeddings.parquet"))], float))
        assert len(got) == 4 * len(x) and {r["n"] for r in got} == {len(np.unique(x, axis=0))}
        return
    docs = [(r["doc_id"], r["source"], r["lang"], r["n_chars"], r["text"]) for r in rows_of(spark.read.parquet(f"{SF}/documents.parquet"))]
    if name.startswith("op11"):
        want = [(i, n, d, sha(t)) for i, n, d, t in plain_dedup([(r[0], r[4]) for r in docs])]
        assert sorted((str(r["doc_id"]), r["n_lines"], r["n_dropped"], r["kept_sha256"]) for r in got) == want
    else:
        assert sorted((str(r["doc_id"]), *list(r.values())[1:]) for r in got) == plain_manifest(docs)
