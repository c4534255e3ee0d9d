"""Merkle manifest of a dataset, with trees in van Emde Boas layout.

Every row is a leaf.  The leaves of a tree (one tree per group) stand in order; while several nodes
remain, every `ARITY` consecutive ones become the hash of their digests.  The roots of the trees, by
the group's name, are the leaves of one more tree, whose root is that of the dataset.

A tree is cut into aligned blocks of `LEVELS` levels.  A block keeps its nodes in one array: the top
half of its levels first, then each subtree below it, both laid out the same way, so a walk from a leaf
to the block's root touches few places whatever the size of a page.  `address` says where a node lies;
building a block and reading siblings from it both go by that.  The roots of blocks are the nodes of
the next tier, cut into blocks again, until one block holds the rest; so a tree of any size is built
and proved by tasks that see one block each.

Cases: null fields are written as `-`; null texts stay null when tampered with; a lone leaf is its
tree's root; a null group is a tree of its own, the first.  Leaves of a tree ascend by id, nulls
first, then by digest; repeated rows are neighbours with proofs of their own.  Very long texts are
hashed whole.  Empty tables give no rows; other columns are not read.
"""

import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F

from forkline.llm.common import written

ARITY = 8
LEVELS = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
HEX = 64
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*fields):
    """Hash of fields: each its UTF-8 length, a colon and itself, or `-`."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t))
                             for t in texts]), 256)


# ---- layout of a block

@functools.cache
def address(height, arity=ARITY):
    """Per level, root first, the places of its nodes in a tree of `height` levels of nodes."""
    if height == 1:
        return [np.zeros(1, np.int64)]
    top = height // 2
    above, below = address(top, arity), address(height - top, arity)
    start, size = sum(map(len, above)), sum(map(len, below))
    out = list(above)
    for level, inner in enumerate(below):
        subtree = np.arange(arity**top, dtype=np.int64)
        out.append((start + subtree[:, None] * size + inner).ravel())
    return out


def height_of(n, arity=ARITY):
    """Levels above `n` leaves."""
    out = 0
    while n > 1:
        n, out = -(-n // arity), out + 1
    return out


def sizes_of(n, height, arity=ARITY):
    """Number of nodes of each level, root first."""
    out = [n]
    for _ in range(height):
        out.append(-(-out[-1] // arity))
    return out[::-1]


class Block:
    """One block: the number of its leaves, its levels above them, its digests in van Emde Boas order."""

    def __init__(self, n, height, nodes, arity=ARITY):
        self.arity, self.nodes = arity, nodes
        self.sizes, self.places = sizes_of(n, height, arity), address(height + 1, arity)

    @classmethod
    def build(cls, leaves, height, arity=ARITY):
        """From the bytes of digests in order."""
        out = cls(len(leaves), height, np.zeros((sum(map(len, address(height + 1, arity))), 32), np.uint8), arity)
        out.nodes[out.places[height][:len(leaves)]] = np.frombuffer(b"".join(leaves), np.uint8).reshape(-1, 32)
        for level in range(height - 1, -1, -1):
            below, run = out.level(level + 1), HEX * arity
            made = b"".join(hashlib.sha256(below[i:i + run]).digest() for i in range(0, len(below), run))
            out.nodes[out.places[level][:out.sizes[level]]] = np.frombuffer(made, np.uint8).reshape(-1, 32)
        return out

    def level(self, level):
        """The digests of a level in order, as hex text."""
        return self.nodes[self.places[level][:self.sizes[level]]].tobytes().hex().encode()

    def root(self):
        return self.nodes[self.places[0][0]].tobytes()

    def siblings(self):
        """For each leaf its siblings level by level: ([before, ...], [after, ...]), concatenated hex text."""
        run = HEX * self.arity
        levels = [self.level(k) for k in range(len(self.sizes) - 1, 0, -1)]
        for i in range(self.sizes[-1]):
            before, after = [], []
            for text in levels:
                own = HEX * i
                first = own - own % run
                before.append(text[first:own])
                after.append(text[own + HEX:first + run])
                i //= self.arity
            yield before, after


def fold(leaf, before, after):
    """The root that a leaf and its siblings lead to, as hex text."""
    for b, a in zip(before, after, strict=True):
        leaf = hashlib.sha256(b + leaf + a).hexdigest().encode()
    return leaf


# ---- order

def _numbered(batches):
    """Rows come sorted by tree: the place of each in its tree's run, and the number of the task."""
    part, last, seen = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        trees = batch.column("tree").to_pylist()
        at = np.empty(len(trees), np.int64)
        for i, tree in enumerate(trees):
            if tree != last:
                last, seen = tree, 0
            at[i] = seen
            seen += 1
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(len(trees), part), pa.int32()), pa.array(at)], [*batch.schema.names, "part", "at"])


def ranked(rows, order):
    """Rows with pos, their place in their tree by `order`, and m, the size of the tree.

    Ranges of the whole order are numbered by themselves; a table of one row per range and tree says how
    much came before.  So a tree may be as large as all rows.  Repeated rows may stand in several ranges.
    """
    keys = ["tree", *order, "_tie"]
    split = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie")
    schema = ", ".join(f"`{c}` {kind}" for c, kind in rows.dtypes) + ", part int, at long"
    local = written(rows.sparkSession, split.mapInArrow(_numbered, schema), "ranges")
    parts = local.groupBy("tree", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("tree", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skip"),
                         F.sum("n").over(Window.partitionBy("tree")).alias("m"))
    return local.join(parts, ["tree", "part"]).withColumn("pos", F.col("at") + F.col("skip")).drop("part", "at", "skip")


# ---- building

BLOCK = "tree string, block long, m long, n int, height int, root binary, nodes binary"


def _blocks(nodes, levels):
    """Nodes (tree, pos, m, node) of a tier as blocks."""
    size = ARITY**levels

    def build(key, table):
        table = table.sort_by("pos")
        m = table.column("m")[0].as_py()
        block = Block.build(table.column("node").to_pylist(), height_of(m) if m <= size else levels)
        return pa.table({"tree": [key[0].as_py()], "block": [key[1].as_py()], "m": [m], "n": pa.array([block.sizes[-1]], pa.int32()),
                         "height": pa.array([len(block.sizes) - 1], pa.int32()), "root": pa.array([block.root()], pa.binary()),
                         "nodes": pa.array([block.nodes.tobytes()], pa.binary())})

    return (nodes.select("tree", F.expr(f"pos div {size}").alias("block"), "pos", "m", "node")
            .groupBy("tree", "block").applyInArrow(build, BLOCK))


def tiers(nodes, levels=LEVELS):
    """The written tiers of blocks over the nodes of all trees, lowest first."""
    spark, size, out = nodes.sparkSession, ARITY**levels, []
    while True:
        out.append(written(spark, _blocks(nodes, levels), "blocks"))
        rest = out[-1].filter(F.col("m") > size)
        if rest.isEmpty():
            return out
        nodes = rest.select("tree", F.col("block").alias("pos"), F.ceil(F.col("m") / size).alias("m"), F.col("root").alias("node"))


def roots(blocks, levels=LEVELS):
    """(tree, root) of every tree."""
    tops = [t.filter(F.col("m") <= ARITY**levels).select("tree", "root") for t in blocks]
    return functools.reduce(lambda a, b: a.unionByName(b), tops)


# ---- proofs

PATH = "tree string, pos long, before array<string>, after array<string>"


def _texts(rows):
    """Lists of lists of hex text as an Arrow column."""
    ends = np.r_[0, np.cumsum([len(r) for r in rows])].astype(np.int32)
    flat = pa.array([x for r in rows for x in r], pa.binary())
    return pa.ListArray.from_arrays(pa.array(ends), flat.cast(pa.string()))


def _read(row):
    """A block and what its own root's siblings are, from a row of a tier."""
    nodes = np.frombuffer(row["nodes"], np.uint8).reshape(-1, 32)
    return Block(row["n"], row["height"], nodes), [x.encode() for x in row["before"]], [x.encode() for x in row["after"]]


def _descend(blocks, levels, more=()):
    """Each node below a block with its siblings up to the tree's root, and the texts that the block carries."""
    size = ARITY**levels

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                block, before, after = _read(row)
                found = [(b + before, a + after) for b, a in block.siblings()]
                at = row["block"] * size + np.arange(len(found))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["tree"]] * len(found)), pa.array(at), _texts([f[0] for f in found]), _texts([f[1] for f in found]),
                     *[pa.array([row[c]] * len(found), pa.string()) for c in more]], ["tree", "pos", "before", "after", *more])
    return blocks.mapInArrow(run, PATH + "".join(f", {c} string" for c in more))


def with_paths(blocks, tops, levels=LEVELS):
    """The lowest blocks with the siblings above them; `tops` has these (tree, before, after, ...) of each root.

    Only the one block at the top of a tree is joined by tree; all others by tree and place.
    """
    more, path = [c for c in tops.columns if c not in ("tree", "before", "after")], None
    for k in range(len(blocks) - 1, -1, -1):
        own = blocks[k].filter(F.col("m") <= ARITY**levels).join(tops, "tree")
        if path is not None:
            own = own.unionByName(blocks[k].filter(F.col("m") > ARITY**levels).join(path.withColumnRenamed("pos", "block"), ["tree", "block"]))
        if k:
            path = _descend(own, levels, more)
    return own


class Manifest:
    """The trees over the rows of a dataset: leaves, tiers of blocks, roots.

    `leaves` has tree, id, leaf (hex) and further columns to be handed on; `tree` names the group.
    """

    def __init__(self, leaves, levels=LEVELS):
        spark, self.levels = leaves.sparkSession, levels
        packed = leaves.withColumn("leaf", F.unhex("leaf"))
        self.leaves = ranked(packed, ["id", "leaf"])
        self.blocks = tiers(self.leaves.withColumnRenamed("leaf", "node"), levels)
        self.subroots = written(spark, roots(self.blocks, levels), "subroots")
        names = self.subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("root").alias("node"))
        self.names = ranked(names, ["name"])
        self.top = tiers(self.names, levels)

    def root(self):
        """The dataset's root as hex text, or None for an empty one."""
        row = roots(self.top, self.levels).select(F.lower(F.hex("root"))).first()
        return row and row[0]

    def prove(self, claim=None):
        """Each leaf with its proof: id, leaf, subroot, root, before and after (siblings by level, concatenated hex),
        and folded_root, what the column `claim` (hex; null or not given: the leaf itself) leads to with that proof.
        """
        levels, size = self.levels, ARITY**self.levels
        nothing = F.array().cast("array<string>")
        whole = roots(self.top, levels).select("tree", nothing.alias("before"), nothing.alias("after"))
        path = _descend(with_paths(self.top, whole, levels), levels)
        names = self.names.select("pos", F.col("name").alias("tree"), F.lower(F.hex("node")).alias("subroot"))
        tops = written(self.leaves.sparkSession, path.select("pos", "before", "after").join(names, "pos").drop("pos"), "paths")
        root = self.root()
        blocks = with_paths(self.blocks, tops, levels).drop("root", "m")
        kind = dict(self.leaves.dtypes)["id"]

        def run(left, right):
            left = left.sort_by("pos")
            row = right.to_pylist()[0]
            block, before, after = _read(row)
            found = [(b + before, a + after) for b, a in block.siblings()]
            leaf = [x.hex().encode() for x in left.column("leaf").to_pylist()]
            claims = left.column("claim").to_pylist()
            folded = [fold(c.encode() if c else own, *proof) for c, own, proof in zip(claims, leaf, found, strict=True)]
            text = lambda values: pa.array(values, pa.binary()).cast(pa.string())
            return pa.table({"id": left.column("id"), "leaf": text(leaf), "subroot": [row["subroot"]] * len(leaf),
                             "root": [root] * len(leaf), "before": _texts([f[0] for f in found]),
                             "after": _texts([f[1] for f in found]), "folded_root": text(folded)})

        claimed = self.leaves.select("tree", F.expr(f"pos div {size}").alias("block"), "pos", "id", "leaf",
                                     (F.lit(None).cast("string") if claim is None else F.col(claim)).alias("claim"))
        return claimed.groupBy("tree", "block").cogroup(blocks.groupBy("tree", "block")).applyInArrow(
            run, f"id {kind}, leaf string, subroot string, root string, before array<string>, after array<string>, folded_root string")


def manifest(docs, fields=FIELDS, group="lang", id="doc_id", claim=None, levels=LEVELS):
    """The manifest of `docs`, a tree for each value of `group`.  `claim` is a column expression with what a
    row's digest is said to be, carried along as `claim`."""
    name = F.col(group).cast("string")
    return Manifest(docs.select(F.when(name.isNull(), "").otherwise(F.concat(F.lit("="), name)).alias("tree"), F.col(id).alias("id"),
                                digest(*[F.col(f) for f in fields]).alias("leaf"),
                                (F.lit(None).cast("string") if claim is None else claim).alias("claim")), levels)


def tampered():
    """Of every third document the digest with A-Z of its text lower-cased; null for the others."""
    third = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    fields = [F.translate("text", UPPER, LOWER) if f == "text" else F.col(f) for f in FIELDS]
    return F.when(third, digest(*fields))


def _oracle(levels=7, top=3):
    """SQL with the levels unrolled: up to 8^levels leaves a tree and 8^top trees."""
    step = "list_reduce([xor(a, b), 1, 2, 3, 4, 5, 6, 7, 8], lambda c, i: xor(c >> 1, 3988292384 * (c & 1)))"
    crc = (f"xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), "
           f"lambda ch: CAST(ascii(ch) AS BIGINT))), lambda a, b: {step}))")
    part = lambda e: f"coalesce(strlen({e}) || ':' || {e}, '-')"
    plain = ", ".join(part(f"CAST({f} AS VARCHAR)") for f in FIELDS[:-1])
    low = f"translate(text, '{UPPER}', '{LOWER}')"
    out = [f"""docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce('=' || lang, '') AS tree, sha256(concat({plain}, {part('text')})) AS leaf,
  CASE WHEN {crc} % 3 = 0 THEN sha256(concat({plain}, {part(low)})) END AS claim FROM documents)""",
           """leaves AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS pos FROM docs)""",
           "a0 AS (SELECT tree, pos, leaf AS h FROM leaves)"]

    def climb(name, count):
        for k in range(count):
            out.append(f"""{name}r{k} AS (SELECT tree, pos // 8 AS run, list(h ORDER BY pos) AS hs,
  count(*) = 1 AND pos // 8 = 0 AS done FROM {name}{k} GROUP BY tree, pos // 8)""")
            out.append(f"""{name}{k + 1} AS (SELECT tree, run AS pos, CASE WHEN done THEN hs[1] ELSE sha256(array_to_string(hs, '')) END AS h
  FROM {name}r{k})""")

    def walk(name, count, first, rows):
        """Columns seen (siblings), cur (folded) after each level."""
        prev = first
        for k in range(count):
            cut = "CAST(p.place % 8 AS BIGINT)"
            b = f"array_to_string(q.hs[1:{cut}], '')"
            a = f"array_to_string(q.hs[{cut} + 2:], '')"
            out.append(f"""{rows}{k + 1} AS (SELECT p.* EXCLUDE (place, seen, cur), p.place // 8 AS place,
  CASE WHEN q.done THEN p.seen ELSE p.seen || {b} || {a} END AS seen,
  CASE WHEN q.done THEN p.cur ELSE sha256({b} || p.cur || {a}) END AS cur
  FROM {prev} p JOIN {name}r{k} q ON q.tree = p.{'tree' if rows == 'w' else 'whole'} AND q.run = p.place // 8)""")
            prev = f"{rows}{k + 1}"
        return prev

    climb("a", levels)
    out.append(f"subroots AS (SELECT tree AS name, h AS subroot, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos FROM a{levels})")
    out.append("b0 AS (SELECT '' AS tree, pos, subroot AS h FROM subroots)")
    climb("b", top)
    out.append("w0 AS (SELECT doc_id, tree, '' AS whole, leaf, pos AS place, '' AS seen, coalesce(claim, leaf) AS cur FROM leaves)")
    last = walk("a", levels, "w0", "w")
    out.append(f"""v0 AS (SELECT p.* EXCLUDE (place), s.subroot, s.pos AS place FROM {last} p JOIN subroots s ON s.name = p.tree)""")
    last = walk("b", top, "v0", "v")
    return "WITH " + ",\n".join(out) + f"""
SELECT doc_id, leaf, subroot, b.h AS root, sha256(seen) AS proof_sha256, cur AS folded_root, cur = b.h AS verified
FROM {last} CROSS JOIN b{top} b"""


ORACLE = _oracle()
