"""Embedding whitening by a bidiagonal qd solver.

Rows become whole numbers; their sums are exact, so the centred rows (n x - S)/n
are free of cancellation.  Blocks of centred rows are reduced by QR, in every
task and then in a tree over the tasks, to one small triangle R with
R'R = the centred rows' X'X.  Householder reflections turn R into a bidiagonal
B; the dqds iteration gives its singular values to high relative accuracy; a
twisted factorisation of B'B - s^2 (stationary from the top, progressive from
the bottom, joined where the pivot is least) gives the singular vector to each,
and the reflections carry it back to a whitening direction.  X'X is never
formed.  Only triangles of d x d numbers reach the driver.

With singular value s and n rows the eigenvalue of the covariance is s^2 / n.
Vectors of different lengths are fitted apart, each length by its own rows.
Rows whose vector is null, or holds null or non-finite entries, are dropped;
empty vectors have no component and give no row.  Entries beyond a long are
clamped to it.  A component without variance (a constant column, fewer rows than
components) has whitened 0 and explained 0 and does not count for
``identity_error``.  A deviation beyond a long is null.  Null and repeated ids are
rows like others; an empty table gives an empty result; labels and extra columns
are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import staged

EPS = float(np.finfo(np.float64).eps)
FAN_IN = 32                # triangles that one task stacks on the way up
BLOCK = 4096               # rows of one QR step
NO_VARIANCE = 1e-13        # singular values under this share of the largest one count as none, times the length


# ------------------------------------------------------------------ dense kernels on d x d triangles
def stack_qr(triangle: np.ndarray | None, rows: np.ndarray) -> np.ndarray:
    """The triangle of the rows of both."""
    both = rows if triangle is None else np.vstack([triangle, rows])
    return np.linalg.qr(both, mode="r")


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, superdiagonal, V) of a square matrix r = U B V' by Householder reflections; U is not kept."""
    a = np.array(r, np.float64)
    d = len(a)
    reflections = []

    def reflector(x):
        v = x.copy()
        scale = np.abs(x).max() if len(x) else 0.0
        if scale == 0.0 or not np.any(x[1:]):
            return None
        v /= scale
        v[0] += np.copysign(np.sqrt(v @ v), v[0])
        return v / np.sqrt(v @ v)

    for k in range(d):
        v = reflector(a[k:, k])
        if v is not None:
            a[k:, k:] -= 2.0 * np.outer(v, v @ a[k:, k:])
        if k < d - 2:
            w = reflector(a[k, k + 1:])
            if w is not None:
                a[k:, k + 1:] -= 2.0 * np.outer(a[k:, k + 1:] @ w, w)
                reflections.append((k + 1, w))
    right = np.eye(d)
    for k, w in reversed(reflections):
        right[k:, :] -= 2.0 * np.outer(w, w @ right[k:, :])
    return np.diag(a).copy(), np.diag(a, 1).copy(), right


def _dqds(q: np.ndarray, e: np.ndarray, shift: float):
    """One differential qd step with a shift: (q, e), or where a pivot turns negative (its place, its value)."""
    n = len(q)
    qs, es = [0.0] * n, [0.0] * (n - 1)
    q, e = q.tolist(), e.tolist()
    d = q[0] - shift
    for k in range(n - 1):
        if d < 0.0:
            return k, d
        qs[k] = d + e[k]
        if qs[k] == 0.0:
            return k, 0.0
        ratio = q[k + 1] / qs[k]
        es[k] = e[k] * ratio
        d = d * ratio - shift
    if d < 0.0:
        return n - 1, d
    qs[-1] = d
    return np.asarray(qs), np.asarray(es)


def _shift(q: np.ndarray, e: np.ndarray) -> float:
    """The least eigenvalue of the last two rows, less what their link to the row above can take from it."""
    n = len(q)
    a, c, b = q[-2] + (e[-2] if n > 2 else 0.0), q[-1] + e[-1], q[-2] * e[-1]
    half = (a - c) / 2.0
    root = np.hypot(half, np.sqrt(b))
    low = (a * c - b) / ((a + c) / 2.0 + root) if a + c > 0.0 else 0.0
    # of the unit eigenvector of the two rows, the share in the upper one is what the link acts on
    share = np.sqrt(b) / np.hypot(np.sqrt(b), abs(half) + root) if b > 0.0 else 0.0
    if half < 0.0:
        share = np.sqrt(max(0.0, 1.0 - share * share))
    link = np.sqrt(q[-3] * e[-2]) * share if n > 2 else 0.0
    return max(0.0, min(low, float(q.min())) * (1.0 - 8.0 * EPS) - link)


def singular_values_squared(diagonal: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """Squared singular values of an upper bidiagonal, falling, by the dqds iteration."""
    found: list[float] = []
    todo = [(diagonal.astype(np.float64) ** 2, upper.astype(np.float64) ** 2, 0.0)]
    while todo:
        q, e, total = todo.pop()
        steps, most = 0, 100 * len(q) + 100
        while len(q) > 1:
            # a squared off-diagonal far below rounding of the values beside it is none
            small = np.flatnonzero(e <= (16 * EPS) ** 2 * (total + np.minimum(q[:-1], q[1:])))
            if len(small):
                k = int(small[-1])
                todo.append((q[k + 1:], e[k + 1:], total))
                q, e = q[:k + 1], e[:k]
                continue
            if 1.5 * q[0] < q[-1]:
                q, e = q[::-1], e[::-1]                  # small values belong to the bottom, where they converge
            shift = _shift(q, e)
            for attempt in range(8):
                step = _dqds(q, e, shift)
                if not isinstance(step[0], int):
                    break
                # a failure in the last row tells by how much the shift is too large; an earlier one only that it is
                at, pivot = step
                late = at == len(q) - 1 and 0.0 < shift + pivot < shift and attempt < 2
                shift = (shift + pivot) * (1.0 - 8.0 * EPS) if late else shift / 4.0 if attempt < 5 else 0.0
            else:
                raise ArithmeticError("a qd step without shift failed")
            q, e = step
            total += shift
            steps += 1
            if steps > most:
                raise ArithmeticError("the dqds iteration does not converge")
        found.extend((q + total).tolist())
    return np.sort(np.maximum(found, 0.0))[::-1]


def twisted_vector(diagonal: np.ndarray, upper: np.ndarray, value: float, skip: int = 0) -> np.ndarray:
    """Right singular vector of an upper bidiagonal to the squared singular value ``value``.

    ``skip`` takes the twist at the place with the (skip + 1)-th least pivot.
    """
    n = len(diagonal)
    if n == 1:
        return np.ones(1)
    tiny = np.finfo(np.float64).tiny ** 0.5
    q = diagonal ** 2
    lower = upper / np.where(diagonal[:-1] == 0.0, tiny, diagonal[:-1])       # B'B = L D L'
    s, p = np.empty(n), np.empty(n)
    plus, minus = np.empty(n - 1), np.empty(n - 1)
    s[0] = -value
    for k in range(n - 1):
        pivot = s[k] + q[k]
        pivot = pivot if abs(pivot) > tiny else tiny
        plus[k] = q[k] * lower[k] / pivot
        s[k + 1] = plus[k] * lower[k] * s[k] - value
    p[-1] = q[-1] - value
    for k in range(n - 2, -1, -1):
        pivot = q[k] * lower[k] * lower[k] + p[k + 1]
        pivot = pivot if abs(pivot) > tiny else tiny
        minus[k] = q[k] * lower[k] / pivot
        p[k] = p[k + 1] * q[k] / pivot - value
    gamma = np.abs(s + p + value)
    r = int(np.argsort(np.where(np.isfinite(gamma), gamma, np.inf), kind="stable")[min(skip, n - 1)])
    z = np.zeros(n)
    z[r] = 1.0
    for k in range(r - 1, -1, -1):
        z[k] = -plus[k] * z[k + 1]
        if not np.isfinite(z[k]):
            z[k] = 0.0
    for k in range(r, n - 1):
        z[k + 1] = -minus[k] * z[k]
        if not np.isfinite(z[k + 1]):
            z[k + 1] = 0.0
    top = np.abs(z).max()
    z /= top
    return z / np.sqrt(z @ z)


def singular_pairs(diagonal: np.ndarray, upper: np.ndarray, close: float = 1e-6) -> tuple[np.ndarray, np.ndarray]:
    """Squared singular values, falling, and their right singular vectors as columns.

    Parts that zeros of the superdiagonal cut off are solved apart.  Vectors of values closer than ``close`` are
    made orthogonal; one that lies in the space of those before it is taken from another twist.
    """
    n = len(diagonal)
    top = float(max(np.abs(diagonal).max(), np.abs(upper).max(initial=0.0))) ** 2
    cut = np.abs(upper) <= EPS * np.minimum(np.abs(diagonal[:-1]) + np.finfo(float).tiny,
                                            np.abs(diagonal[1:]) + np.finfo(float).tiny)
    borders = [0, *(np.flatnonzero(cut) + 1).tolist(), n]
    pairs: list[tuple[float, np.ndarray]] = []
    for lo, hi in zip(borders, borders[1:]):
        own_d, own_u = diagonal[lo:hi], upper[lo:hi - 1]
        own = singular_values_squared(own_d, own_u)
        done: list[tuple[float, np.ndarray]] = []
        for value in own:
            group = [v for x, v in done if abs(x - value) <= close * max(abs(x), abs(value)) + EPS * EPS * top]
            for skip in range(hi - lo):
                z = twisted_vector(own_d, own_u, float(value), skip)
                for _ in range(2):
                    for v in group:
                        z = z - (v @ z) * v
                size = np.sqrt(z @ z)
                if size > 0.1 or not group:
                    break
            done.append((float(value), z / size))
        for value, z in done:
            full = np.zeros(n)
            full[lo:hi] = z
            pairs.append((value, full))
    pairs.sort(key=lambda t: -t[0])
    v = np.stack([z for _, z in pairs], axis=1)
    v = v @ (3.0 * np.eye(n) - v.T @ v) / 2.0            # what rounding left of other vectors goes
    return np.asarray([x for x, _ in pairs]), v


def directions(triangle: np.ndarray, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(squared singular values falling, right singular vectors as columns) of the triangle."""
    r = np.zeros((dim, dim))
    r[:len(triangle)] = triangle
    scale = np.abs(r).max() if r.size else 0.0
    if scale == 0.0:
        return np.zeros(dim), np.eye(dim)
    diagonal, upper, right = bidiagonalise(r / scale)
    # exact zeros on the diagonal stop the qd recurrences; far below rounding they change nothing that counts
    floor = EPS * EPS * max(np.abs(diagonal).max(), np.abs(upper).max() if dim > 1 else 0.0)
    diagonal = np.where(np.abs(diagonal) < floor, floor, diagonal)
    values, vectors = singular_pairs(diagonal, upper)
    return values * scale * scale, right @ vectors


# ------------------------------------------------------------------ Spark
def whole(x: np.ndarray, scale: float, offset: int) -> np.ndarray:
    """floor(scale * x) + offset as long."""
    y = np.floor(scale * np.asarray(x, np.float64))
    limit = 2.0 ** 62
    return np.where(np.abs(y) < limit, y, np.sign(y) * limit).astype(np.int64) + offset


def _vectors(batch: pa.RecordBatch, name: str, scale: float, offset: int):
    """(dim, places, whole numbers) of the batch's rows, by vector length."""
    vectors = batch.column(batch.schema.get_field_index(name))
    sizes = np.diff(vectors.offsets.to_numpy())
    values = vectors.flatten().to_numpy(zero_copy_only=False)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    for d in np.unique(sizes):
        at = np.flatnonzero(sizes == d)
        yield int(d), at, whole(values[starts[at][:, None] + np.arange(d)[None, :]], scale, offset)


def _sum_exact(x: np.ndarray) -> list[int]:
    """Column sums as Python integers: high and low halves cannot overflow in a batch."""
    high, low = x >> 32, x & 0xFFFFFFFF
    return [(int(h) << 32) + int(v) for h, v in zip(high.sum(axis=0), low.sum(axis=0))]


def _sums(scale: float, offset: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, tuple[int, list[int]]] = {}
        for b in batches:
            for d, _, x in _vectors(b, "embedding", scale, offset):
                n, s = total.get(d, (0, [0] * d))
                total[d] = n + len(x), [p + q for p, q in zip(s, _sum_exact(x))]
        from decimal import Decimal
        rows = [(d, n, k, Decimal(v)) for d, (n, s) in total.items() for k, v in enumerate(s)]
        cols = list(zip(*rows)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int32()),
                                          pa.array(cols[3], pa.decimal128(38, 0))], names=["dim", "n", "k", "s"])
    return run


class Centre:
    """Exact centring: n x - S, as whole numbers where they fit a long, else as Python integers."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums
        mean = [s // n for s in sums]                 # n x - S = n (x - m) - (S - n m), m near the mean
        self.mean = np.asarray(mean, np.int64)
        self.rest = [s - n * m for s, m in zip(sums, mean)]

    def deviations(self, x: np.ndarray) -> np.ndarray:
        near = x - self.mean if not len(x) or np.abs(x.astype(np.float64) - self.mean).max(initial=0) < 2.0 ** 62 else None
        if near is not None and np.abs(near).max(initial=0) < (2 ** 62) // max(1, self.n):
            return near * self.n - np.asarray(self.rest, np.int64)
        return x.astype(object) * self.n - np.asarray(self.sums, object)

    def centred(self, dev: np.ndarray) -> np.ndarray:
        return dev.astype(np.float64) / self.n


def squared_sum(dev: np.ndarray) -> list[int | None]:
    """Exact sum of squares of every row; null beyond a long."""
    if dev.dtype != object and (not dev.size or float(np.abs(dev).max()) ** 2 * dev.shape[1] < 2.0 ** 62):
        return (dev * dev).sum(axis=1).tolist()
    out = [sum(int(v) ** 2 for v in row) for row in dev]
    return [v if v < 2 ** 63 else None for v in out]


def _triangles(fits, scale: float, offset: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r: dict[int, np.ndarray] = {}
        for b in batches:
            for d, _, x in _vectors(b, "embedding", scale, offset):
                if d:
                    for at in range(0, len(x), BLOCK):
                        r[d] = stack_qr(r.get(d), fits.value[d].centred(fits.value[d].deviations(x[at:at + BLOCK])))
        yield _triangle_batch(r)
    return run


def _triangle_batch(r: dict[int, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(r), pa.int32()), pa.array([t.shape[0] for t in r.values()], pa.int32()),
         pa.array([np.ascontiguousarray(t).tobytes() for t in r.values()], pa.binary())], names=["dim", "height", "triangle"])


_TRIANGLE = "dim int, height int, triangle binary"


def _stack(table: pa.Table) -> pa.Table:
    r, d = None, table.column("dim")[0].as_py()
    for h, t in zip(table.column("height").to_pylist(), table.column("triangle").to_pylist()):
        r = stack_qr(r, np.frombuffer(t, np.float64).reshape(h, d))
    return pa.Table.from_batches([_triangle_batch({d: r})])


class Whitening:
    """A fit of one vector length: exact centre, directions and scales of the components kept."""

    def __init__(self, centre: Centre, triangle: np.ndarray, components: int):
        dim = len(centre.sums)
        values, vectors = directions(triangle, dim)
        keep = min(components, dim)
        floor = (NO_VARIANCE * dim) ** 2 * (values[0] if dim else 0.0)
        self.centre = centre
        self.values = np.where(values > floor, values, 0.0)[:keep]
        total = values.sum()
        self.explained = self.values / total if total > 0 else np.zeros(keep)
        with np.errstate(divide="ignore"):
            scale = np.where(self.values > 0, np.sqrt(centre.n) / np.sqrt(self.values), 0.0)
        self.project = vectors[:, :keep] * scale

    def apply(self, dev: np.ndarray) -> np.ndarray:
        return self.centre.centred(dev) @ self.project


def _moments(fits, scale: float, offset: int):
    """Sums and cross products of the whitened rows, per length: what their covariance needs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list[np.ndarray]] = {}
        for b in batches:
            for d, _, x in _vectors(b, "embedding", scale, offset):
                if d:
                    w = fits.value[d].apply(fits.value[d].centre.deviations(x))
                    old = total.get(d)
                    now = [w.sum(axis=0), w.T @ w]
                    total[d] = now if old is None else [p + q for p, q in zip(old, now)]
        keys = list(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int32()), pa.array([t[0].tolist() for t in total.values()], pa.list_(pa.float64())),
             pa.array([t[1].ravel().tolist() for t in total.values()], pa.list_(pa.float64()))], names=["dim", "s", "c"])
    return run


def _whiten(fits, errors: dict[int, float], scale: float, offset: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for d, at, x in _vectors(b, "embedding", scale, offset):
                fit = fits.value.get(d)
                if not d:
                    continue
                dev = fit.centre.deviations(x)
                w, k = fit.apply(dev), len(fit.values)
                ids = b.column(0).take(pa.array(np.repeat(at, k)))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))), pa.array(np.full(len(at) * k, fit.centre.n, np.int64)),
                     pa.array([v for v in squared_sum(dev) for _ in range(k)], pa.int64()), pa.array(w.ravel()),
                     pa.array(np.tile(fit.explained, len(at))), pa.array(np.full(len(at) * k, errors[d]))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return run


def _clean(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    v = F.col("embedding")
    good = v.isNotNull() & ~F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    return vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("embedding")).where(good)


def fit(rows: DataFrame, components: int, scale: float, offset: int) -> dict[int, Whitening]:
    """One whitening per vector length, from all rows of (vec_id, embedding)."""
    spark = rows.sparkSession
    vectors = rows.select("embedding")
    # one row per length and dimension
    sums = vectors.mapInArrow(_sums(scale, offset), "dim int, n long, k int, s decimal(38,0)") \
        .groupBy("dim", "k").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect()
    centres: dict[int, Centre] = {}
    for d in {r["dim"] for r in sums}:
        own = sorted((r for r in sums if r["dim"] == d), key=lambda r: r["k"])
        centres[d] = Centre(int(own[0]["n"]), [int(r["s"]) for r in own])
    if not centres:
        return {}
    known = spark.sparkContext.broadcast(centres)
    triangles = staged(vectors.mapInArrow(_triangles(known, scale, offset), _TRIANGLE), "whitening-triangles")
    while True:
        most = triangles.groupBy("dim").count().agg(F.max("count").alias("m")).first()["m"]
        if most <= 1:
            break
        groups = -(-most // FAN_IN)
        number = F.monotonically_increasing_id()
        dealt = triangles.withColumn("part", F.pmod(F.xxhash64(number), F.lit(groups)) if groups > 1 else F.lit(0))
        triangles = staged(dealt.groupBy("dim", "part").applyInArrow(_stack_part, _TRIANGLE), "whitening-triangles")
    out = {}
    for r in triangles.collect():                     # one triangle a length
        t = np.frombuffer(bytes(r["triangle"]), np.float64).reshape(r["height"], r["dim"])
        out[r["dim"]] = Whitening(centres[r["dim"]], t, components)
    return out


def _stack_part(table: pa.Table) -> pa.Table:
    return _stack(table.drop_columns(["part"]))


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 32,
           scale: float = 64.0, offset: int = 1_000_000) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of every row and component."""
    spark = vectors.sparkSession
    rows = _clean(vectors, id_col, vector_col)
    fits = fit(rows, components, scale, offset)
    shared = spark.sparkContext.broadcast(fits)
    errors: dict[int, float] = {d: 0.0 for d in fits}
    moments = rows.select("embedding").mapInArrow(_moments(shared, scale, offset), "dim int, s array<double>, c array<double>")
    for r in _fold(moments):
        f = fits[r["dim"]]
        k, n = len(f.values), f.centre.n
        mean = np.asarray(r["s"]) / n
        off = np.abs(np.asarray(r["c"]).reshape(k, k) / n - np.outer(mean, mean) - np.eye(k))
        on = np.flatnonzero(f.values > 0)
        errors[r["dim"]] = float(off[np.ix_(on, on)].max(initial=0.0))
    return rows.mapInArrow(_whiten(shared, errors, scale, offset),
                           "vec_id long, component int, n long, deviation long, whitened double, explained double, "
                           "identity_error double")


def _fold(moments: DataFrame):
    """Element-wise sums of the arrays, per length; one row a length reaches the driver."""
    flat = moments.select("dim", F.lit("s").alias("what"), F.posexplode("s")).unionByName(
        moments.select("dim", F.lit("c").alias("what"), F.posexplode("c")))
    summed = flat.groupBy("dim", "what", "pos").agg(F.sum("col").alias("v"))
    arrays = summed.groupBy("dim").agg(
        F.array_sort(F.collect_list(F.when(F.col("what") == "s", F.struct("pos", "v")))).alias("s"),
        F.array_sort(F.collect_list(F.when(F.col("what") == "c", F.struct("pos", "v")))).alias("c"))
    return arrays.select("dim", F.col("s.v").alias("s"), F.col("c.v").alias("c")).collect()
