"""Whitening of embeddings by the singular values of their centred rows.

The rows are reduced block by block to a triangle R by orthogonal transformations
(QR), and the blocks' triangles pairwise to one; no covariance is formed, so no
digits are lost to squares. Householder reflections make R bidiagonal. Its singular
values come from differential quotient-difference sweeps with shifts (dqds), which
find small ones to as many digits as large ones; a shift never exceeds what the
sweep before has proved to be below the least value. Twisted factorisations give
the directions: of all rows of the shifted matrix that the two factorisations can
meet in, the one with the least pivot is where the vector is largest.

Sums are whole numbers, so the means that rows are centred by are exact. What goes
through the driver is one triangle of the embedding's width, never a row.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, drop

SCALE = 256
COMPONENTS = 4
#: Quantised components are below; vectors with larger ones make the query fail.
BOUND = 1 << 31
#: Triangles that are reduced to one in one call.
FAN = 8
#: Numbers of rows that are reduced at a time.
CHUNK = 1 << 20
EPS = float(np.finfo(float).eps)
#: Squares of the bidiagonal's diagonal, scaled to 1, are at least so large: nothing is divided by zero.
FLOOR = 1e-200
#: Values of a relative distance below this are a cluster, whose vectors are made orthogonal.
CLUSTER = 1e-3


# ---------------------------------------------------------------- singular values and directions of a triangle


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal and superdiagonal (both not negative) of the bidiagonal form of a square matrix, and the orthogonal V for which (r V) has this form but for a rotation from the left."""
    a, n = np.array(r, float), len(r)
    v = np.eye(n)

    def reflector(x: np.ndarray) -> np.ndarray | None:
        size = np.linalg.norm(x)
        if size == 0 or not np.any(x[1:]):
            return None
        u = x / size
        u[0] += math.copysign(1.0, u[0])
        return u / np.linalg.norm(u)

    for k in range(n):
        if (u := reflector(a[k:, k].copy())) is not None:
            a[k:, k:] -= 2 * np.outer(u, u @ a[k:, k:])
        if k < n - 2 and (u := reflector(a[k, k + 1 :].copy())) is not None:
            a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ u, u)
            v[:, k + 1 :] -= 2 * np.outer(v[:, k + 1 :] @ u, u)
    diagonal, above = np.diag(a).copy(), np.diag(a, 1).copy()
    sign = 1.0
    for k in range(n):  # signs move into V
        v[:, k] *= sign
        if diagonal[k] * sign < 0:
            row = -1.0
        else:
            row = 1.0
        if k < n - 1:
            sign = row if above[k] >= 0 else -row
    return np.abs(diagonal), np.abs(above), v


def sweep(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float, float] | None:
    """One differential sweep: the qd array of the same values less the shift, the least pivot, and the sum of the pivots' reciprocals; None if the shift was above the least value."""
    d, out_q, out_e = q[0] - shift, [], []
    least, reciprocals = d, 0.0
    for k in range(len(e)):
        if d < 0:
            return None
        reciprocals += 1 / d if d > 0 else math.inf
        whole = d + e[k]
        if whole == 0:
            t = 0.0
        else:
            t = q[k + 1] / whole
        out_q.append(whole)
        out_e.append(e[k] * t)
        d = d * t - shift
        least = min(least, d)
    if d < 0:
        return None
    reciprocals += 1 / d if d > 0 else math.inf
    out_q.append(d)
    return out_q, out_e, least, reciprocals


def squares(q: np.ndarray, e: np.ndarray) -> list[float]:
    """The squared singular values of the bidiagonal whose squared entries are q and e, by dqds."""
    out: list[float] = []
    # what has been shifted is kept as a sum of two numbers: a shift may be far below its last digit
    todo = [(list(map(float, q)), list(map(float, e)), 0.0, 0.0)]
    small = (8 * EPS) ** 2
    while todo:
        q, e, moved, rest = todo.pop()
        turns = 0
        while q:
            n = len(q)
            if n == 1:
                out.append(moved + (rest + q[0]))
                break
            if n == 2:
                root = math.sqrt((q[0] - q[1]) ** 2 + 2 * e[0] * (q[0] + q[1]) + e[0] ** 2)
                large = (q[0] + q[1] + e[0] + root) / 2
                out += [moved + (rest + large), moved + (rest + (q[0] * (q[1] / large) if large > 0 else 0.0))]
                break
            last = EPS / 16 * moved
            # the last entry above the diagonal is gone, or moves the last value by less than its last digit
            if e[-1] <= small * (moved + q[-1]) or (q[-2] > 4 * q[-1] and e[-1] <= last) or q[-2] * e[-1] <= last * last:
                out.append(moved + (rest + q.pop()))
                e.pop()
                continue
            gap = next((k for k in range(n - 2, -1, -1) if e[k] <= small * (moved + min(q[k], q[k + 1]))), None)
            if gap is not None:
                todo.append((q[: gap + 1], e[:gap], moved, rest))
                q, e = q[gap + 1 :], e[gap + 1 :]
                continue
            if 1.5 * q[0] < q[-1]:  # the least values belong at the end
                q.reverse()
                e.reverse()
            turns += 1
            if turns > 60 * n + 600:
                raise ArithmeticError("the quotient-difference sweeps do not settle")
            q, e, _, reciprocals = sweep(q, e, 0.0)
            # 1 / reciprocals is no larger than the least value
            shift = 1 / reciprocals if reciprocals > 0 else 0.0
            while shift > 0:
                if (found := sweep(q, e, shift)) is not None:
                    q, e = found[:2]
                    total = moved + shift
                    rest += (moved - total) + shift
                    moved = total
                    break
                shift *= 0.5
    return out


def twisted(d: np.ndarray, l: np.ndarray, value: float) -> tuple[np.ndarray, float]:
    """The vector of value of L D L' by the twisted factorisation with the least pivot, of length one; and what the value is off by."""
    n = len(d)
    tiny = EPS * EPS * max(value, float(d.max()))
    s, p, low, up = np.zeros(n), np.zeros(n), np.zeros(max(n - 1, 0)), np.zeros(max(n - 1, 0))
    s[0] = -value
    for k in range(n - 1):
        pivot = s[k] + d[k]
        pivot = pivot if abs(pivot) > tiny else math.copysign(tiny, pivot)
        low[k] = d[k] * l[k] / pivot
        s[k + 1] = low[k] * l[k] * s[k] - value
    p[-1] = d[-1] - value
    for k in range(n - 2, -1, -1):
        pivot = d[k] * l[k] * l[k] + p[k + 1]
        pivot = pivot if abs(pivot) > tiny else math.copysign(tiny, pivot)
        t = d[k] / pivot
        up[k] = l[k] * t
        p[k] = p[k + 1] * t - value
    meet = s + p + value
    r = int(np.argmin(np.abs(meet)))
    z = np.zeros(n)
    z[r] = 1.0
    for k in range(r - 1, -1, -1):
        z[k] = -low[k] * z[k + 1]
    for k in range(r, n - 1):
        z[k + 1] = -up[k] * z[k]
    size = float(z @ z)
    return z / math.sqrt(size), meet[r] / size


def directions(a: np.ndarray, b: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """All squared singular values (falling) of the bidiagonal (a, b), and right vectors of the first k as columns."""
    top = max(float(a.max(initial=0)), float(b.max(initial=0)))
    if top == 0:
        return np.zeros(len(a)), np.zeros((len(a), 0))
    a, b = np.maximum(a / top, math.sqrt(FLOOR)), b / top
    # where the matrix falls apart, each part has its own values and vectors
    edges = np.r_[0, np.flatnonzero(b <= 4 * EPS * np.sqrt(a[:-1] * a[1:])) + 1, len(a)]
    found = []
    for x, y in zip(edges[:-1], edges[1:]):
        found += [(value, x, y) for value in squares(a[x:y] ** 2, b[x : y - 1] ** 2)]
    found.sort(key=lambda f: (-f[0], f[1]))
    vectors = np.zeros((len(a), min(k, len(found))))
    for n, (value, x, y) in enumerate(found[:k]):
        d, l = a[x:y] ** 2, b[x : y - 1] / a[x : y - 1]
        z, off = twisted(d, l, value)
        for _ in range(2):  # a corrected value is kept if it is off by less
            again, rest = twisted(d, l, value + off)
            if abs(rest) >= abs(off):
                break
            z, value, off = again, value + off, rest
        near = [vectors[x:y, m] for m in range(n) if found[m][1] == x and found[m][0] - found[n][0] <= CLUSTER * found[m][0]]
        if near:
            z = apart(d, l, value, z, np.stack(near, 1))
        vectors[x:y, n] = z
    return np.array([f[0] for f in found]) * top * top, vectors


def apart(d: np.ndarray, l: np.ndarray, value: float, z: np.ndarray, others: np.ndarray) -> np.ndarray:
    """A vector of the cluster that is orthogonal to the others of it: inverse iteration, orthogonal at each step."""
    t = np.diag(d + np.r_[0.0, d[:-1] * l * l]) + np.diag(d[:-1] * l, 1) + np.diag(d[:-1] * l, -1)
    less = lambda x: x - others @ (others.T @ x)
    if np.linalg.norm(less(z)) < 0.5:
        z = np.random.default_rng(len(d)).normal(size=len(d))
    # the shift lies beside the values of the cluster, but by a rounding error only
    shifted = t - value * (1 + 64 * EPS) * np.eye(len(d))
    z = less(less(z))
    for _ in range(4):
        z = np.linalg.solve(shifted, z / np.linalg.norm(z))
        z = less(less(z / np.linalg.norm(z)))
    return z / np.linalg.norm(z)


def principal(r: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """All squared singular values of the triangle r, falling, and right vectors of the first k that are not zero to working precision."""
    a, b, v = bidiagonal(r)
    values, inside = directions(a, b, k)
    real = values[: inside.shape[1]] > values[0] * (8 * EPS * len(r)) ** 2 if len(values) else np.zeros(0, bool)
    vectors = v @ inside[:, : int(real.sum())]
    return values, vectors / np.linalg.norm(vectors, axis=0)


# ---------------------------------------------------------------- rows


def quantised(vectors: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """(id, x) of the rows that take part, x = floor(256 c) filled up with zeros to one width; and the width."""
    v = F.col(vector_col)
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == F.lit(float("inf"))))
    rows = vectors.where(v.isNotNull() & ~bad)
    least, width = rows.agg(F.min(F.size(v)), F.max(F.size(v))).first()
    width = width or 0
    whole = lambda c: F.floor(c.cast("double") * SCALE)
    refused = F.raise_error(F.concat(F.lit("op11: component too large, id "), F.coalesce(F.col(id_col).cast("string"), F.lit("null")))).cast("array<int>")
    fits = ~F.exists(v, lambda c: F.abs(c.cast("double") * SCALE) >= float(BOUND - 1))
    x = F.when(fits, F.transform(v, lambda c: whole(c).cast("int"))).otherwise(refused)
    if least != width:
        x = F.concat(x, F.array_repeat(F.lit(0), F.lit(width) - F.size(v)))
    return rows.select(F.col(id_col).alias("id"), x.alias("x")), width


def matrices(batches, width: int):
    """Whole numbers (rows x width) of the batches' x, CHUNK numbers at a time; and the batches that they are of."""
    step = max(1, CHUNK // max(width, 1))
    for batch in batches:
        for k in range(0, batch.num_rows, step):
            part = batch.slice(k, step)
            yield part, np.asarray(part.column("x").flatten()).astype(np.int64).reshape(part.num_rows, width)


def sums(fit: DataFrame, width: int) -> tuple[int, np.ndarray]:
    """How many rows there are, and their exact sums: one row a dimension and task."""

    def run(batches):
        n, total = 0, np.zeros(width, np.int64)
        for _, x in matrices(batches, width):
            n, total = n + len(x), total + x.sum(0)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, width)), pa.array(np.r_[n, total])], ["at", "s"])

    found = dict(fit.mapInArrow(run, "at long, s long").groupBy("at").agg(F.sum("s").alias("s")).collect())
    return found.get(-1, 0), np.array([found.get(k, 0) for k in range(width)], np.int64)


def centred(x: np.ndarray, n: int, total: np.ndarray) -> np.ndarray:
    return (n * x - total) / n


def triangle(fit: DataFrame, width: int, n: int, total: np.ndarray) -> np.ndarray:
    """R of the centred rows: each task reduces its own, and FAN triangles become one until one is left."""

    def packed(r: np.ndarray) -> bytes:
        return np.pad(r, ((0, max(0, width - len(r))), (0, 0)))[:width].tobytes()

    def run(batches):
        r = np.zeros((0, width))
        for _, x in matrices(batches, width):
            r = np.linalg.qr(np.concatenate([r, centred(x, n, total)]), mode="r")
        if len(r):
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([packed(r)], pa.binary())], ["block", "r"])

    def merge(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table["block"].to_pylist(), table["r"].to_pylist()))
        r = np.concatenate([np.frombuffer(x).reshape(width, width) for _, x in rows])
        return pa.table({"block": pa.array([rows[0][0] // FAN], pa.int64()), "r": pa.array([packed(np.linalg.qr(r, mode="r"))], pa.binary())})

    blocks = cut(fit.mapInArrow(run, "block long, r binary"), "triangles")
    while blocks.count() > 1:
        more = cut(blocks.groupBy(F.floor(F.col("block") / FAN).alias("group")).applyInArrow(merge, "block long, r binary"), "triangles")
        drop(blocks)
        blocks = more
    out = np.frombuffer(blocks.first()["r"]).reshape(width, width)
    drop(blocks)
    return out


def identity_error(fit: DataFrame, width: int, n: int, total: np.ndarray, ways: np.ndarray) -> float:
    """The largest entry by which the covariance of the whitened rows of fit departs from the identity."""
    k = ways.shape[1]

    def run(batches):
        seen, found = 0, np.zeros((k + 1, k))
        for _, x in matrices(batches, width):
            w = centred(x, n, total) @ ways
            seen, found = seen + len(x), found + np.concatenate([w.sum(0)[None], w.T @ w])
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(found.size)), pa.array(found.ravel())], ["at", "s"])

    rows = dict(fit.mapInArrow(run, "at long, s double").groupBy("at").agg(F.sum("s").alias("s")).collect())
    found = np.array([rows[j] for j in range((k + 1) * k)]).reshape(k + 1, k) / n
    return float(np.abs(found[1:] - np.outer(found[0], found[0]) - np.eye(k)).max())


def deviations(x: np.ndarray, n: int, total: np.ndarray) -> np.ndarray:
    """The exact sum of (n x - total) ** 2 of each row."""
    moved = n * x - total
    most = int(np.abs(moved).max(initial=0))
    if most * most * max(x.shape[1], 1) < 1 << 62:
        return (moved * moved).sum(1)
    found = [sum(v * v for v in row) for row in moved.tolist()]
    if max(found) >= 1 << 63:
        raise ValueError("op11: a deviation does not fit 64 bits")
    return np.array(found, np.int64)


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """id_col, component, n, deviation, whitened, explained and identity_error for each row of vectors that takes part, and each component.

    Null vectors and vectors that hold null or non-finite components take no part;
    shorter vectors (empty ones too) are filled up with zeros; a component of 2^31
    or more, times 256, makes the query fail. Repeated vectors count once in the
    fit, and each of their rows has its results; a null id stays null. Components
    without variance, to working precision, do not appear, so that one distinct
    vector, or none, gives an empty result. Other columns are not read, so their
    names may be any.
    """
    rows, width = quantised(vectors, id_col, vector_col)
    schema = T.StructType([
        T.StructField(id_col, vectors.schema[id_col].dataType), T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("deviation", T.LongType()),
        T.StructField("whitened", T.DoubleType()), T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType()),
    ])
    nothing = vectors.sparkSession.createDataFrame([], schema)
    if not width:
        return nothing
    fit = cut(rows.select("x").distinct(), "fit")
    n, total = sums(fit, width)
    values, found = principal(triangle(fit, width, n, total), components)
    k = found.shape[1]
    if not k:
        drop(fit)
        return nothing
    e, trace = values[:k] / n, math.fsum(values) / n
    ways = found / np.sqrt(e)
    error = identity_error(fit, width, n, total, ways)
    drop(fit)

    def run(batches):
        for part, x in matrices(batches, width):
            m = len(x)
            w, off, of = centred(x, n, total) @ ways, deviations(x, n, total), np.repeat(np.arange(m), k)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("id").take(pa.array(of)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)), pa.array(off[of]),
                    pa.array(w.ravel()), pa.array(np.tile(e / trace, m)), pa.array(np.full(m * k, error)),
                ],
                schema.names,
            )

    return rows.mapInArrow(run, schema)
