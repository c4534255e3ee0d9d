"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

Entries become whole numbers floor(256 c); each distinct vector counts once in the fit.  The leading
eigenvectors of the fit's covariance V come from a block Q of `BLOCK` columns for each wanted one:

1. Rayleigh-Ritz: the eigenvectors of QᵀVQ give the best approximations inside the block;
2. these are certified if the residual |V u - e u| of each wanted one is at the level of rounding;
3. else a Chebyshev polynomial of V, which is small on [0, c] and grows fast above it, is applied to
   the block by its three-term recurrence, c being the block's smallest Ritz value; then QR, and again.

V itself is never formed: each product V Q is a pass Xᵀ(XQ) / n over the fit table, whose rows are
centred before they are multiplied.  Only Q and the product, (dimension x block) numbers, meet the
driver, however many rows there are.

Cases: vectors that are null, empty, or hold a null, a non-finite number or one beyond long take no part.
Of vectors of several lengths only those of the most frequent one (ties: the shortest) do.  Null and
repeated ids are rows like any other.  A variance of zero has no component: n equal vectors give no
rows, a fit of rank r gives r components at most.  Empty tables give no rows; other columns are not
read.  Equal eigenvalues have no eigenvectors of their own; any basis of theirs is returned.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from forkline.llm.common import written

COMPONENTS = 4
#: Columns of the block for each wanted component, and the degree of the polynomial.
BLOCK, DEGREE = 8, 12
#: Residuals relative to the largest eigenvalue: certified below the first; below the second if they no longer fall.
CERTIFIED, SETTLED = 2e-15, 1e-12
ROUNDS = 200


class NotCertified(RuntimeError):
    """The residuals did not reach the level of rounding."""


def _quantised(batches):
    """vec_id and the whole numbers of each usable vector as bytes."""
    for batch in batches:
        lists = batch.column("v")
        ends = lists.offsets.to_numpy().astype(np.int64)
        flat = np.floor(256 * lists.values.to_numpy(zero_copy_only=False).astype(np.float64))
        # a comparison with NaN (null or not a number) is false
        bad = np.r_[0, np.cumsum(~(np.abs(flat) < 2.0**63))]
        use = (np.diff(ends) > 0) & (bad[ends[1:]] == bad[ends[:-1]]) & lists.is_valid().to_numpy(zero_copy_only=False)
        with np.errstate(invalid="ignore"):
            data = np.ascontiguousarray(flat.astype("<i8") + 0)
        x = pa.Array.from_buffers(pa.large_binary(), len(lists), [None, pa.py_buffer(ends * 8), pa.py_buffer(data)])
        mask = pa.array(use)
        yield pa.RecordBatch.from_arrays([batch.column("vec_id").filter(mask), x.filter(mask).cast(pa.binary())], ["vec_id", "x"])


def quantised(vectors, vec_id="vec_id", embedding="embedding"):
    """vec_id long, x binary: the usable vectors of the most frequent length, and that length (0: none)."""
    v = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("v"))
    x = v.mapInArrow(_quantised, "vec_id long, x binary")
    widths = x.groupBy((F.octet_length("x") / 8).cast("int").alias("d")).count()
    top = widths.orderBy(F.desc("count"), "d").first()
    return (x.filter(F.octet_length("x") == 8 * top["d"]), top["d"]) if top else (x, 0)


def matrix(column, width):
    """A column of equally long byte strings as rows of numbers."""
    start, size = column.offset, len(column)
    ends = np.frombuffer(column.buffers()[1], np.int32)[start:start + size + 1]
    return np.frombuffer(column.buffers()[2], "<i8", size * width, int(ends[0])).reshape(size, width) if size else np.zeros((0, width), "<i8")


def _summed(rows, kind):
    """Sums by place, as one array: as many rows as the array has places reach the driver."""
    found = rows.groupBy("i").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(len(found), kind)
    for r in found:
        out[r["i"]] = r["v"]
    return out


def _places(values):
    return pa.RecordBatch.from_arrays([pa.array(np.arange(len(values)), pa.int32()), pa.array(values)], ["i", "v"])


def totals(fit, width):
    """n and the exact sum of each dimension."""
    def run(batches):
        out = np.zeros(width + 1, np.int64)
        for batch in batches:
            x = matrix(batch.column("x"), width)
            out[0] += len(x)
            out[1:] += x.sum(axis=0)
        yield _places(out)
    out = _summed(fit.mapInArrow(run, "i int, v long"), np.int64)
    return (int(out[0]), out[1:]) if len(out) else (0, np.zeros(width, np.int64))


def product(fit, mean, q):
    """XᵀXQ and the sum of squares of X, the rows of the fit less their mean: one pass."""
    width, columns = q.shape

    def run(batches):
        out, squares = np.zeros((width, columns)), 0.0
        for batch in batches:
            x = matrix(batch.column("x"), width) - mean
            out += x.T @ (x @ q)
            squares += np.einsum("ij,ij->", x, x)
        yield _places(np.r_[out.ravel(), squares])
    out = _summed(fit.mapInArrow(run, "i int, v double"), np.float64)
    return out[:-1].reshape(width, columns), out[-1]


def leading(apply, width, wanted, degree=DEGREE, rounds=ROUNDS):
    """The largest eigenvalues of a positive semidefinite operator, their eigenvectors and V times these.

    `apply` multiplies a (width, columns) block by the operator.  Eigenvalues that are zero are left out.
    """
    size = min(width, BLOCK * wanted)
    q, _ = np.linalg.qr(np.random.default_rng(1).normal(size=(width, size)))
    best = np.inf
    for _ in range(rounds):
        y = apply(q)
        small = q.T @ y
        e, s = np.linalg.eigh((small + small.T) / 2)
        e, s = e[::-1], s[:, ::-1]
        u, vu = q @ s, y @ s
        some = min(wanted, int((e > 1e-12 * max(e[0], 0)).sum()))
        if e[0] <= 0 or some == 0:
            return e[:0], u[:, :0], vu[:, :0]
        residual = np.linalg.norm(vu - u * e, axis=0)[:some].max() / e[0]
        if residual <= CERTIFIED or residual > best / 4 and best <= SETTLED:
            return e[:some], u[:, :some], vu[:, :some]
        best = min(best, residual)
        cut = e[-1]
        if cut <= 1e-12 * e[0]:
            # the block holds all that is not zero; what is left is rounding
            y = vu
        else:
            # the map to [-1, 1]; columns are kept to length 1, which the recurrence bears column by column
            half = cut / 2
            before, y = u, vu / half - u
            for _ in range(degree - 1):
                scale = np.linalg.norm(y, axis=0)
                before, y = before / scale, y / scale
                before, y = y, 2 * (apply(y) / half - y) - before
        q, _ = np.linalg.qr(y / np.maximum(np.linalg.norm(y, axis=0), np.finfo(float).tiny))
    raise NotCertified(f"residual {best:.1e} after {rounds} rounds")


def _signed(u):
    """Each column with its largest entry above zero."""
    top = u[np.abs(u).argmax(axis=0), np.arange(u.shape[1])]
    return u * np.where(top < 0, -1.0, 1.0)


def _deviations(x, n, sums):
    """Exact sum of (n x - S)^2 of each row; an error where it is beyond long."""
    limit = max(float(np.abs(x).max(initial=0)) * n + float(np.abs(sums).max()), 1.0)
    if limit**2 * x.shape[1] < 2.0**62:
        y = n * x - sums
        return np.einsum("ij,ij->i", y, y)
    out = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    if max(out, default=0) >= 2**63:
        raise OverflowError("a deviation is beyond long")
    return np.array(out, np.int64)


SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors, components=COMPONENTS, vec_id="vec_id", embedding="embedding"):
    """One row per usable vector and component: SCHEMA."""
    spark = vectors.sparkSession
    x, width = quantised(vectors, vec_id, embedding)
    if not width:
        return spark.createDataFrame([], SCHEMA)
    fit = written(spark, x.select("x").distinct(), "vectors")
    n, sums = totals(fit, width)
    mean = sums / n
    seen = {}

    def apply(q):
        y, squares = product(fit, mean, q)
        seen["trace"] = squares / n
        return y / n

    e, u, vu = leading(apply, width, min(components, width))
    if not len(e):
        return spark.createDataFrame([], SCHEMA)
    # the covariance of the whitened fit, from a pass over it
    error = float(np.abs(u.T @ vu / np.sqrt(np.outer(e, e)) - np.eye(len(e))).max())
    u, explained = _signed(u) / np.sqrt(e), e / seen["trace"]

    def project(batches):
        for batch in batches:
            rows = matrix(batch.column("x"), width)
            k = len(explained)
            at = np.repeat(np.arange(len(rows)), k)
            repeat = lambda a, kind: pa.array(np.tile(a, len(rows)), kind)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(pa.array(at)), repeat(np.arange(1, k + 1), pa.int32()), pa.array(np.full(len(at), n), pa.int64()),
                 pa.array(_deviations(rows, n, sums)[at], pa.int64()), pa.array(((rows - mean) @ u).ravel()),
                 repeat(explained, pa.float64()), pa.array(np.full(len(at), error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return x.mapInArrow(project, SCHEMA)
