"""Embedding whitening through the singular values of the centred rows.

Vectors become the integer rows x = floor(scale * c) + shift. One pass counts
the rows and sums each dimension (exact integers); a second centres the rows
and reduces them block by block to one triangular factor R a task (QR of the
factor so far stacked on the next block), and the factors meet in a tree, FAN
at a time, so no task holds more than FAN of them. What is left is one matrix
of the vectors' width, whatever the number of rows. It is solved on the driver:
Householder reflections make R bidiagonal, the dqds iteration (differential
quotient-difference with shifts) finds the singular values to high relative
accuracy, and twisted factorisations of the bidiagonal's square give the
directions. A third pass measures the covariance of the whitened rows.

Defined results: rows whose vector is null or holds null or non-finite entries
are dropped, as are rows with an entry whose scaled value lies beyond the whole
numbers that a double holds (2^53); a null id stays; vectors of different lengths are whitened apart,
each length with its own n, sums and components; empty vectors have no
component and give no row; repeated rows count and are returned each for
itself; components whose singular value is below RANK times the largest (no
variance in that direction) are left out, so equal rows, or a single one, give
no row; an empty table gives an empty result. ``deviation`` is exact while it
fits a long and null beyond.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import hypot, sqrt

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FAN = 16  # triangular factors that one task of the tree stacks
BLOCK = 4096  # rows of one QR step
RANK = 1e-12  # a singular value below this part of the largest is no component
EPS = float(np.finfo(float).eps)
TINY = float(np.finfo(float).tiny) / EPS


# ---------------------------------------------------------------- the solver


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, superdiagonal, V) with r = U B V^T by Householder reflections."""
    a = np.array(r, float)
    n = a.shape[1]
    right = np.eye(n)
    for k in range(n):
        v = _reflector(a[k:, k])
        if v is not None:
            a[k:, k:] -= np.outer(2 * v, v @ a[k:, k:])
        if k < n - 2:
            v = _reflector(a[k, k + 1 :])
            if v is not None:
                a[k:, k + 1 :] -= np.outer(a[k:, k + 1 :] @ v, 2 * v)
                right[:, k + 1 :] -= np.outer(right[:, k + 1 :] @ v, 2 * v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), right


def _reflector(x: np.ndarray) -> np.ndarray | None:
    """Unit vector v such that (I - 2 v v^T) x is a multiple of the first axis."""
    if len(x) < 2 or not np.abs(x[1:]).max() > 0:
        return None
    v = x / np.abs(x).max()
    v[0] += np.copysign(np.linalg.norm(v), v[0])
    return v / np.linalg.norm(v)


def singular_values(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Singular values of an upper bidiagonal matrix by dqds, falling."""
    top = max([abs(float(x)) for x in (*diagonal, *above)], default=0.0)
    if top == 0:
        return np.zeros(len(diagonal))
    q = [(float(x) / top) ** 2 for x in diagonal]
    e = [(float(x) / top) ** 2 for x in above]
    found: list[float] = []
    blocks = [(q, e, 0.0)]  # (q, e, shift taken off so far)
    while blocks:
        q, e, taken = blocks.pop()
        while q:
            n = len(q)
            cut = _split(q, e, taken)
            if cut is not None:
                blocks.append((q[: cut + 1], e[:cut], taken))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            if n == 1:
                found.append(taken + q[0])
                break
            if n == 2:
                found += [taken + x for x in _pair(q[0], e[0], q[1])]
                break
            if q[0] < 0.25 * q[-1]:  # graded the other way: turn round, so that the smallest end is last
                q, e = _turned(q, e)
                continue
            q, e, step = _swept(q, e)
            taken += step
    return top * np.sqrt(np.sort(np.maximum(found, 0.0))[::-1])


def _split(q: list[float], e: list[float], taken: float) -> int | None:
    """The last place where the block falls apart: an off-diagonal that no longer counts."""
    for i in range(len(e) - 1, -1, -1):
        if e[i] <= EPS * EPS * (q[i] + q[i + 1] + taken) or e[i] < TINY:
            return i
    return None


def _pair(a: float, b: float, c: float) -> tuple[float, float]:
    """Both values of the two-row block (q, e, q), without cancellation."""
    half = 0.5 * ((a - c) + b)
    mean = a + b + c
    big = 0.5 * mean + hypot(half, sqrt(b * c)) if b * c > 0 else max(a + b, c)
    return big, (a * (c / big) if big > 0 else 0.0)


def _turned(q: list[float], e: list[float]) -> tuple[list[float], list[float]]:
    """The block of the same values read from its other end (a flipped qd array)."""
    return q[::-1], e[::-1]


def _sweep(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float] | None:
    """One dqds transform, with the least d; None if the shift was too large."""
    n = len(q)
    new_q, new_e = [0.0] * n, [0.0] * (n - 1)
    d = q[0] - shift
    least = d
    for i in range(n - 1):
        if d < 0:
            return None
        s = d + e[i]
        new_q[i] = s
        if s <= 0:
            new_e[i], ratio = 0.0, 0.0
            d = q[i + 1] - shift
        else:
            ratio = q[i + 1] / s
            new_e[i] = e[i] * ratio
            d = d * ratio - shift
        least = min(least, d)
    if d < 0:
        return None
    new_q[-1] = d
    return new_q, new_e, least


def _swept(q: list[float], e: list[float]) -> tuple[list[float], list[float], float]:
    """One accepted sweep with the largest of some trial shifts that keeps all values positive.

    The first trial is the smaller value of the last two rows reduced by their
    coupling, an estimate of the smallest value that is sharp near convergence.
    """
    small = _pair(q[-2], e[-1], q[-1])[1]
    coupling = e[-2] if len(e) > 1 else 0.0
    trial = min(small, q[-1]) - sqrt(max(0.0, coupling * small))
    if trial <= 0:
        trial = 0.25 * min(small, q[-1])
    for factor in (1.0, 1 - 1e-3, 0.75, 0.3, 0.05):
        shift = trial * factor
        done = _sweep(q, e, shift)
        if done is not None:
            return done[0], done[1], shift
    return (*_sweep(q, e, 0.0)[:2], 0.0)  # without a shift all stays positive


def directions(diagonal: np.ndarray, above: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Right singular vectors (columns) of the bidiagonal matrix for the given singular values.

    The matrix falls into blocks where an off-diagonal vanishes; a value belongs
    to a block whose twisted factorisation leaves the least residual. Vectors of
    values that are close together are made orthogonal to each other.
    """
    n = len(diagonal)
    top = max(float(np.abs(diagonal).max(initial=0)), float(np.abs(above).max(initial=0)))
    q, e = (diagonal / top) ** 2, (above / top) ** 2
    product = (diagonal[:-1] * above) / top**2  # off-diagonal of the square
    cut = np.flatnonzero(np.abs(product) <= EPS * np.sqrt(q[:-1] * q[1:] + EPS * EPS) * EPS + TINY)
    bounds = list(zip([0, *(cut + 1)], [*(cut + 1), n]))
    signs = np.sign(diagonal), np.sign(above)
    found = np.zeros((n, len(values)))
    square = [(values[j] / top) ** 2 for j in range(len(values))]
    main = q + np.concatenate(([0.0], e))  # diagonal of the square
    for j, value in enumerate(square):
        near = [i for i in range(j) if abs(square[i] - value) <= 1e-3 * max(square[i], value)]
        best = None
        for a, b in bounds:
            for vector in _twisted(q[a:b], e[a : b - 1], signs[0][a:b], signs[1][a : b - 1], value, main[a:b], product[a : b - 1]):
                full = np.zeros(n)
                full[a:b] = vector
                for _ in range(2):
                    full -= found[:, near] @ (found[:, near].T @ full)
                size = np.linalg.norm(full)
                if size < 0.1:  # this block gave that direction to a closer value already
                    continue
                full /= size
                rest = main * full
                rest[:-1] += product * full[1:]
                rest[1:] += product * full[:-1]
                residual = np.linalg.norm(rest - value * full)
                if best is None or residual < best[0]:
                    best = residual, full
        found[:, j] = best[1] if best is not None else _other(found[:, :j])
    return found


def _other(vectors: np.ndarray) -> np.ndarray:
    """A unit vector orthogonal to the given ones."""
    rest = np.eye(len(vectors)) - vectors @ vectors.T
    column = rest[:, np.argmax((rest**2).sum(axis=0))]
    return column / np.linalg.norm(column)


def _twisted(q, e, sign_q, sign_e, value, main, product) -> Iterator[np.ndarray]:
    """Unit vectors of the block for ``value``: from the twist of the least pivot and, should
    that direction be taken, from the next ones.

    Stationary qd from the top and progressive qd from the bottom give the two
    halves of the factorisation of B^T B - value; where they meet (the twist),
    the pivot gamma is the inverse of a diagonal entry of the inverse, and the
    vector follows by multiplications only.
    """
    n = len(q)
    if n == 1:
        yield np.ones(1)
        return
    lower = [0.0] * (n - 1)  # multipliers of the factorisation from the top
    upper = [0.0] * (n - 1)  # from the bottom
    s, p = [0.0] * n, [0.0] * n
    s[0] = -value
    for i in range(n - 1):
        pivot = _kept(q[i] + s[i])
        ratio = e[i] / pivot
        lower[i] = sqrt(q[i] * e[i]) / pivot
        s[i + 1] = s[i] * ratio - value
    p[n - 1] = q[n - 1] - value
    for i in range(n - 2, -1, -1):
        pivot = _kept(e[i] + p[i + 1])
        upper[i] = sqrt(q[i] * e[i]) / pivot
        p[i] = p[i + 1] * (q[i] / pivot) - value
    gamma = np.abs(np.array(s) + np.array(p) + value)
    turn = np.sign(product)  # the square's off-diagonal has the sign of diagonal times superdiagonal
    for twist in np.argsort(gamma, kind="stable")[:4].tolist():
        z = np.zeros(n)
        z[twist] = 1.0
        for i in range(twist - 1, -1, -1):
            z[i] = -lower[i] * turn[i] * z[i + 1]
        for i in range(twist, n - 1):
            z[i + 1] = -upper[i] * turn[i] * z[i]
        size = np.linalg.norm(z)
        if np.isfinite(size) and size > 0:
            yield z / size


def _kept(x: float) -> float:
    return x if abs(x) > TINY else TINY


def components_of(r: np.ndarray, n: int, most: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(eigenvalues, unit directions as columns, trace) of r^T r / n, the largest first."""
    diagonal, above, right = bidiagonal(r)
    values = singular_values(diagonal, above)
    trace = float((values**2).sum()) / n
    kept = int((values > RANK * max(values[0], TINY)).sum()) if len(values) and values[0] > 0 else 0
    values = values[: min(most, kept)]
    if not len(values):
        return values, np.zeros((len(diagonal), 0)), trace
    return values**2 / n, right @ directions(diagonal, above, values), trace


# ---------------------------------------------------------------- on Spark


def usable_rows(vectors: pa.Array, scale: float, shift: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By vector length: (places, long matrix of floor(scale * x) + shift) of the usable vectors."""
    if pa.types.is_fixed_size_list(vectors.type):
        vectors = vectors.cast(pa.list_(vectors.type.value_type))
    usable = vectors.is_valid().to_numpy(zero_copy_only=False)
    bounds = vectors.offsets.to_numpy().astype(np.int64)
    flat = vectors.values.cast(pa.float64()).to_numpy(zero_copy_only=False)  # null entries become NaN
    bad = np.concatenate(([0], np.cumsum(~np.isfinite(flat))))
    usable = usable & (bad[bounds[1:]] == bad[bounds[:-1]])
    size = np.diff(bounds)
    found = {}
    flat = np.where(np.isfinite(flat), flat, 0.0)
    for d in np.unique(size[usable & (size > 0)]).tolist():
        rows = np.flatnonzero(usable & (size == d))
        values = np.floor(scale * flat[bounds[rows][:, None] + np.arange(d)[None, :]])
        fits = (np.abs(values) <= 2.0**53).all(axis=1)
        found[d] = rows[fits], values[fits].astype(np.int64) + shift
    return found


def _blocks(batches: Iterator[pa.RecordBatch], scale: float, shift: int):
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK):
            part = batch.slice(start, BLOCK)
            for d, (rows, x) in usable_rows(part.column(part.num_columns - 1), scale, shift).items():
                if len(rows):
                    yield part, d, rows, x


def _triangle(stack: np.ndarray) -> np.ndarray:
    r = np.linalg.qr(stack, mode="r")
    return np.vstack((r, np.zeros((stack.shape[1] - len(r), stack.shape[1]))))


class _Sums:
    """Per vector length: how many rows, and the exact sum of each dimension."""

    def __init__(self, scale: float, shift: int):
        self.scale, self.shift = scale, shift

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: dict[int, int] = {}
        sums: dict[int, np.ndarray] = {}
        for _, d, rows, x in _blocks(batches, self.scale, self.shift):
            n[d] = n.get(d, 0) + len(rows)
            sums[d] = sums.get(d, 0) + x.sum(axis=0)
        for d in n:
            yield pa.RecordBatch.from_arrays(
                [pa.array([d] * d), pa.array(range(d)), pa.array([n[d]] * d), pa.array(sums[d])], names=["d", "i", "n", "s"]
            )


class Whitening:
    """What was learned of the vectors of one length."""

    def __init__(self, n: int, sums: np.ndarray, r: np.ndarray, most: int):
        self.n, self.sums = n, sums
        self.values, self.axes, self.trace = components_of(r, n, most)
        self.error = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        # n * x - S in whole numbers where it fits, so that centring rounds once
        if self.fits(x):
            return (self.n * x - self.sums) / float(self.n)
        return x - self.sums / float(self.n)

    def fits(self, x: np.ndarray) -> bool:
        most = max(int(np.abs(x).max(initial=0)), int(np.abs(self.sums).max(initial=0)) // max(1, self.n) + 1)
        return self.n * most < 1 << 61

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.axes / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n * x - S)^2, exact; None beyond a long."""
        if self.fits(x):
            y = self.n * x - self.sums
            if int(np.abs(y).max(initial=0)) ** 2 * max(1, y.shape[1]) < 1 << 63:
                return (y * y).sum(axis=1).tolist()
        exact = [sum((self.n * a - s) ** 2 for a, s in zip(row, self.sums.tolist())) for row in x.tolist()]
        return [v if v < 1 << 63 else None for v in exact]


def _means(spark: SparkSession, vectors: DataFrame, scale: float, shift: int) -> dict[int, tuple[int, np.ndarray]]:
    parts = vectors.select("v").mapInArrow(_Sums(scale, shift), "d long, i long, n long, s long")
    # one row a dimension comes to the driver
    rows = parts.groupBy("d", "i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("d", "i").collect()
    found: dict[int, tuple[int, list]] = {}
    for r in rows:
        found.setdefault(r["d"], (r["n"], []))[1].append(r["s"])
    return {d: (n, np.array(s, np.int64)) for d, (n, s) in found.items()}


def _factors(vectors: DataFrame, means: dict, scale: float, shift: int) -> dict[int, np.ndarray]:
    """R of the QR of the centred rows, by vector length."""

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        found: dict[int, np.ndarray] = {}
        for _, d, _, x in _blocks(batches, scale, shift):
            n, sums = means[d]
            rows = (n * x - sums) / float(n) if n * int(np.abs(x).max()) < 1 << 61 else x - sums / float(n)
            found[d] = _triangle(np.vstack((found[d], rows)) if d in found else rows)
        for d, r in found.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([d]), pa.array([task], pa.int64()), pa.array([r.tobytes()], pa.binary())], names=["d", "part", "r"]
            )

    def stack(key: tuple, table: pa.Table) -> pa.Table:
        """At most FAN factors into one."""
        d, part = key[0].as_py(), key[1].as_py()
        factors = [np.frombuffer(raw).reshape(d, d) for raw in table.column("r").to_pylist()]
        r = factors[0] if len(factors) == 1 else _triangle(np.vstack(factors))
        return pa.table({"d": pa.array([d], pa.int64()), "part": pa.array([part], pa.int64()), "r": pa.array([r.tobytes()], pa.binary())})

    schema = "d long, part long, r binary"
    parts = vectors.select("v").mapInArrow(reduce, schema)
    left = vectors.rdd.getNumPartitions()
    while left > 1:
        left = -(-left // FAN)
        up = parts.withColumn("part", F.floor(F.col("part") / FAN))
        parts = up.groupBy("d", "part").applyInArrow(stack, schema)
    return {row["d"]: np.frombuffer(bytes(row["r"])).reshape(row["d"], row["d"]) for row in parts.collect()}


def _errors(vectors: DataFrame, sent, scale: float, shift: int) -> dict[int, float]:
    """Largest entry of the whitened rows' covariance less the identity, by vector length."""

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for _, d, _, x in _blocks(batches, scale, shift):
            y = sent.value[d].whitened(x)
            y = np.hstack((y, np.ones((len(y), 1))))  # the last row and column: sums
            total[d] = total.get(d, 0) + y.T @ y
        for d, m in total.items():
            i, j = (a.ravel() for a in np.indices(m.shape))
            yield pa.RecordBatch.from_arrays([pa.array([d] * m.size), pa.array(i), pa.array(j), pa.array(m.ravel())], names=["d", "i", "j", "p"])

    rows = vectors.select("v").mapInArrow(products, "d long, i long, j long, p double")
    found: dict[int, np.ndarray] = {}
    for r in rows.groupBy("d", "i", "j").agg(F.sum("p").alias("p")).collect():
        k = len(sent.value[r["d"]].values)
        found.setdefault(r["d"], np.zeros((k + 1, k + 1)))[r["i"], r["j"]] = r["p"]
    errors = {}
    for d, m in found.items():
        n = sent.value[d].n
        mean = m[-1, :-1] / n
        covariance = m[:-1, :-1] / n - np.outer(mean, mean)
        errors[d] = float(np.abs(covariance - np.eye(len(mean))).max(initial=0.0))
    return errors


def whiten(
    embeddings: DataFrame,
    components: int = 8,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: float = 1024.0,
    shift: int = 100000,
) -> DataFrame:
    """(row, n, component, deviation, whitened, explained, identity_error) of each usable row and component.

    ``row`` is a struct of all columns but the vector. The driver holds one
    matrix of the vectors' width a length, never rows.
    """
    spark = embeddings.sparkSession
    others = [F.col(f"`{c}`") for c in embeddings.columns if c != vector_col]
    vectors = embeddings.select(
        F.struct(*others).alias("row") if others else F.struct(F.lit(None).alias(id_col)).alias("row"),
        F.col(f"`{vector_col}`").cast("array<double>").alias("v"),
    )
    means = _means(spark, vectors, scale, shift)
    schema = vectors.select("row").schema
    for name, kind in (("n", "long"), ("component", "integer"), ("deviation", "long"), ("whitened", "double")):
        schema = schema.add(name, kind)
    for name in ("explained", "identity_error"):
        schema = schema.add(name, "double")
    factors = _factors(vectors, means, scale, shift) if means else {}
    learned = {d: Whitening(n, sums, factors[d], components) for d, (n, sums) in means.items()}
    sent = spark.sparkContext.broadcast(learned)
    errors = _errors(vectors, sent, scale, shift) if means else {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, d, rows, x in _blocks(batches, scale, shift):
            fit = sent.value[d]
            k = len(fit.values)
            if not k:
                continue
            explained = fit.values / fit.trace
            deviation = pa.array(fit.deviations(x), pa.int64())
            each = np.repeat(np.arange(len(rows)), k)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).take(pa.array(rows[each])),
                    pa.array(np.full(len(each), fit.n, np.int64)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
                    deviation.take(pa.array(each)),
                    pa.array(fit.whitened(x).ravel()),
                    pa.array(np.tile(explained, len(rows))),
                    pa.array(np.full(len(each), errors.get(d, 0.0))),
                ],
                names=["row", "n", "component", "deviation", "whitened", "explained", "identity_error"],
            )

    return vectors.mapInArrow(run, schema)
