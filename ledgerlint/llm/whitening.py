"""Embedding whitening (operator 11) by a bidiagonal qd solver.

The fit list (each distinct scaled vector once) is a written table.  Its centred rows
are reduced by blockwise QR: a task keeps one triangle R and folds every block of rows
into it, and the triangles of all tasks are folded in three rounds of bounded fan-in.
On the one R that is left, Householder reflections make a bidiagonal matrix, dqds finds
its singular values, and twisted factorisations of the tridiagonal matrix give the
directions, which the reflections carry back.

Defined results: rows whose vector is null, empty, or holds a null or non-finite entry
are dropped; so are vectors of another length than the commonest one (the longer of
equally common ones).  Repeated rows count once in the fit and are returned each; null
identifiers are kept.  Equal eigenvalues have any orthonormal directions.  A component
without variance has no whitened value and is not returned, so a single distinct vector
or an empty table gives no rows.  Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settle, stage

SCALE = 256
#: Rows of a block that is folded into a task's triangle.
BLOCK = 4096
#: Triangles that are left after each round of folding.
ROUNDS = (256, 16, 1)
EPS = sys.float_info.epsilon


def scaled(vector: Column) -> Column:
    """floor(SCALE * c) of every entry, as bigint."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * F.lit(float(SCALE))))


def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~F.coalesce(bad, F.lit(True))


def _matrix(column: pa.Array) -> np.ndarray:
    """The rows of a list column of equal lengths as int64."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def fold(r: np.ndarray | None, rows: np.ndarray) -> np.ndarray:
    """The triangle of the rows seen so far (``r``) and some more."""
    return np.linalg.qr(rows if r is None else np.vstack([r, rows]), mode="r")


# ---------------------------------------------------------------- the solver

def bidiagonalise(r: np.ndarray):
    """Diagonal, superdiagonal, and the right reflectors (start, vector) of an upper bidiagonal form of ``r``."""
    a = np.array(r, np.float64)
    rows, d = a.shape
    if rows < d:
        a = np.vstack([a, np.zeros((d - rows, d))])
    right = []

    def reflector(x):
        v = x.copy()
        size = np.linalg.norm(v)
        if size == 0 or not np.any(v[1:]):
            return None
        v[0] += size if v[0] >= 0 else -size
        return v / np.linalg.norm(v)

    for i in range(d):
        v = reflector(a[i:, i])
        if v is not None:
            a[i:, i:] -= 2 * np.outer(v, v @ a[i:, i:])
        if i < d - 1:
            v = reflector(a[i, i + 1:])
            if v is not None:
                a[i:, i + 1:] -= 2 * np.outer(a[i:, i + 1:] @ v, v)
                right.append((i + 1, v))
    return np.diag(a).copy(), np.diag(a, 1)[: d - 1].copy(), right


def _dqds(q: list, e: list, s: float):
    """One differential qd step with shift ``s``: (new q, new e, place of the first d below zero or None, that d, sum of 1/d)."""
    last, d, turned = len(q) - 1, q[0] - s, 0.0
    out_q, out_e = [0.0] * (last + 1), [0.0] * last
    for i in range(last):
        if d < 0:
            return out_q, out_e, i, d, turned
        turned += 1 / d if d else math.inf
        out_q[i] = d + e[i]
        if out_q[i] == 0:
            out_e[i], d = 0.0, q[i + 1] - s
            continue
        ratio = q[i + 1] / out_q[i]
        out_e[i] = e[i] * ratio
        d = d * ratio - s
    out_q[last] = d
    return out_q, out_e, (last if d < 0 else None), d, turned + (1 / d if d > 0 else math.inf)


def _trailing_guess(q: list, e: list) -> float:
    """The smaller eigenvalue of the last two rows of the tridiagonal matrix: a guess just above the least one."""
    a = q[-2] + (e[-2] if len(q) > 2 else 0.0)
    c, off = q[-1] + e[-1], q[-2] * e[-1]
    half = (a - c) / 2
    root = (half * half + off) ** 0.5
    return max(0.0, (a * c - off) / ((a + c) / 2 + root)) if a + c + root > 0 else 0.0


def _step(q: list, e: list):
    """(new q, new e, shift): the boldest of three shifts that leaves every d positive.

    The guess may lie above the least eigenvalue.  If only the last d shows it, adding that d
    corrects it; else the unshifted step's 1 / sum(1/d), the inverse of a trace, is a lower bound.
    """
    s = _trailing_guess(q, e)
    for correct in (True, False):
        new_q, new_e, at, d, _ = _dqds(q, e, s)
        if at is None:
            return new_q, new_e, s
        if at < len(q) - 1 or not correct or s + d <= 0:
            break
        s = (s + d) * (1 - 4 * EPS)
    plain_q, plain_e, _, _, turned = _dqds(q, e, 0.0)
    s = (1 - 1e-10) / turned if turned < math.inf else 0.0
    if s > 0:
        new_q, new_e, at, _, _ = _dqds(q, e, s)
        if at is None:
            return new_q, new_e, s
    return plain_q, plain_e, 0.0


def squared_singular_values(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squares of the singular values of a bidiagonal matrix by shifted dqds, falling."""
    found, tol = [], (100 * EPS) ** 2
    work = [([float(x) ** 2 for x in diagonal], [float(x) ** 2 for x in above], 0.0)]
    while work:
        q, e, moved = work.pop()
        steps, size = 0, 0
        while len(q) > 1:
            cut = next((i for i in range(len(e) - 1, -1, -1) if e[i] <= tol * (moved + min(q[i], q[i + 1]))), None)
            if cut is not None:
                if cut == len(e) - 1:
                    found.append(moved + q.pop())
                    e.pop()
                else:
                    work.append((q[: cut + 1], e[:cut], moved))
                    q, e = q[cut + 1:], e[cut + 1:]
                continue
            if len(q) != size and q[0] * 1.5 < q[-1]:  # upside down it has the same values, and the least one at its end
                q, e = q[::-1], e[::-1]
            size, steps = len(q), steps + 1 if len(q) == size else 1
            if steps > 1000:
                raise ArithmeticError("dqds did not converge")
            q, e, s = _step(q, e)
            moved += s
        found += [moved + x for x in q]
    return np.array(sorted(found, reverse=True))


def twisted(diagonal: np.ndarray, above: np.ndarray, value: float) -> np.ndarray:
    """A unit eigenvector of B'B for ``value``: factorisations from both ends meet where they leave the least remainder."""
    d = len(diagonal)
    main = diagonal ** 2
    main[1:] += above ** 2
    off = diagonal[: d - 1] * above
    tiny = EPS * EPS * (abs(main).max() + abs(value)) + 1e-300
    down, up = np.empty(d), np.empty(d)
    down[0], up[d - 1] = main[0] - value, main[d - 1] - value
    for i in range(1, d):
        down[i] = main[i] - value - off[i - 1] ** 2 / (down[i - 1] if abs(down[i - 1]) > tiny else tiny)
    for i in range(d - 2, -1, -1):
        up[i] = main[i] - value - off[i] ** 2 / (up[i + 1] if abs(up[i + 1]) > tiny else tiny)
    k = int(np.argmin(abs(down + up - (main - value))))
    z = np.zeros(d)
    z[k] = 1.0
    for i in range(k - 1, -1, -1):
        z[i] = -off[i] * z[i + 1] / (down[i] if abs(down[i]) > tiny else tiny)
    for i in range(k, d - 1):
        z[i + 1] = -off[i] * z[i] / (up[i + 1] if abs(up[i + 1]) > tiny else tiny)
    return z / np.linalg.norm(z)


def directions(r: np.ndarray, k: int):
    """(squared singular values, all of them; the first ``k`` right singular vectors as columns, without those of no size)."""
    diagonal, above, right = bidiagonalise(r)
    d = len(diagonal)
    values = squared_singular_values(diagonal, above)
    floor_ = (EPS * d) ** 2 * values[0] if len(values) else 0.0
    k = int(min(k, np.sum(values > floor_)))
    # rows between negligible superdiagonal entries are blocks of their own: equal values of two blocks have separate vectors
    borders = [0, *(np.flatnonzero(abs(above) <= EPS * (abs(diagonal[:-1]) + abs(diagonal[1:]))) + 1).tolist(), d]
    candidates = []
    for a, b in zip(borders, borders[1:]):
        candidates += [(v, a, b) for v in squared_singular_values(diagonal[a:b], above[a: b - 1])]
    candidates.sort(key=lambda c: -c[0])
    out = np.zeros((d, k))
    for j, (value, a, b) in enumerate(candidates[:k]):
        z = np.zeros(d)
        z[a:b] = twisted(diagonal[a:b], above[a: b - 1], value)
        close = [i for i in range(j) if candidates[i][0] - value <= 1e-3 * candidates[0][0]]
        for _ in range(2 if close else 0):  # near-equal values: orthogonal to the earlier ones of the cluster
            for i in close:
                z -= out[:, i] * (out[:, i] @ z)
            size = np.linalg.norm(z)
            if size < 0.1:  # the same direction again: start from what the others leave over in the block
                rest = np.zeros(d)
                rest[a:b] = np.cos(np.arange(1, b - a + 1) * (j + 1.0))
                z, size = _inverse_steps(diagonal, above, value, rest, out[:, close]), 1.0
            z /= size
        out[:, j] = z
    for start, v in reversed(right):
        out[start:] -= 2 * np.outer(v, v @ out[start:])
    out /= np.linalg.norm(out, axis=0)
    sign = np.sign(out[abs(out).argmax(0), np.arange(k)]) if k else np.ones(0)
    return values, out * sign


def _inverse_steps(diagonal, above, value, z, others):
    """Inverse iteration for ``value`` in what is orthogonal to ``others``."""
    d = len(diagonal)
    t = np.diag(diagonal ** 2)
    t[range(1, d), range(1, d)] += above ** 2
    t[range(d - 1), range(1, d)] = t[range(1, d), range(d - 1)] = diagonal[:-1] * above
    shifted = t - (value + 8 * EPS * max(abs(t).max(), 1e-300)) * np.eye(d)
    for _ in range(4):
        z = z - others @ (others.T @ z)
        z = np.linalg.lstsq(shifted, z / np.linalg.norm(z), rcond=None)[0]
        z = z / np.linalg.norm(z)
    z = z - others @ (others.T @ z)
    return z / np.linalg.norm(z)


# ---------------------------------------------------------------- the Spark jobs

def _triangle(fit: DataFrame, n: int, sums: np.ndarray) -> np.ndarray:
    """R of the centred fit list: blockwise in each task, then folded in rounds of bounded fan-in."""

    def reduce_rows(batches):
        r, waiting, held = None, [], 0
        for batch in batches:
            x = _matrix(batch.column("x"))
            waiting.append((n * x - sums) / n)
            held += len(x)
            if held >= BLOCK:
                r, waiting, held = fold(r, np.vstack(waiting)), [], 0
        if held:
            r = fold(r, np.vstack(waiting))
        if r is not None:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([r.tobytes()], pa.binary())],
                                             names=["slot", "r"])

    d = len(sums)

    def fold_all(key, table):
        r = None
        for raw in table.column("r").to_pylist():
            r = fold(r, np.frombuffer(raw).reshape(-1, d))
        return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([r.tobytes()], pa.binary())], names=["slot", "r"])

    parts = fit.mapInArrow(reduce_rows, "slot int, r binary")
    for slots in ROUNDS:
        parts = parts.withColumn("slot", F.col("slot") % slots).groupBy("slot").applyInArrow(fold_all, "slot int, r binary")
    return np.frombuffer(parts.select("r").first()[0]).reshape(-1, d)


def whiten(vectors: DataFrame, k: int = 4, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``key``, component, n, deviation, whitened, explained, identity_error, for each usable row and component up to ``k``."""
    spark = settle(vectors.sparkSession)
    kind = dict(vectors.dtypes)[key]
    schema = f"`{key}` {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    rows = vectors.select(F.col(f"`{key}`").alias("key"), F.col(f"`{vector}`").alias("v")).where(usable(F.col("v"))).select(
        "key", scaled(F.col("v")).alias("x"))
    lengths = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if lengths is None:
        return spark.createDataFrame([], schema)
    d = lengths[0]
    rows = rows.where(F.size("x") == d)
    fit = stage(rows.select("x").distinct(), "whitening-fit")

    def add_up(batches):
        total, count, top = np.zeros(d, np.int64), 0, 0.0
        for batch in batches:
            x = _matrix(batch.column("x"))
            top += float(abs(x).max(initial=0)) * len(x)
            if top > 9e18:
                raise ArithmeticError("the sums of the scaled vectors exceed 64 bits")
            total, count = total + x.sum(0), count + len(x)
        if count:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(d + 1, dtype=np.int32)), pa.array(np.append(total, count))], names=["i", "s"])

    added = {i: s for i, s in fit.mapInArrow(add_up, "i int, s bigint").groupBy("i").agg(F.sum("s")).collect()}  # d + 1 rows
    n, sums = added[d], np.array([added[i] for i in range(d)], np.int64)
    r = _triangle(fit, n, sums)
    values, found = directions(r, k)
    if not found.shape[1]:
        return spark.createDataFrame([], schema)
    made = found.shape[1]
    explained = values[:made] / float((r * r).sum())
    weights = found / np.sqrt(values[:made] / n)

    def check(batches):
        total = np.zeros((made + 1, made + 1))
        for batch in batches:
            w = ((n * _matrix(batch.column("x")) - sums) / n) @ weights
            w = np.column_stack([w, np.ones(len(w))])
            total += w.T @ w
        at = np.arange(total.size, dtype=np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel())], names=["i", "s"])

    moments = np.zeros((made + 1) ** 2)
    for i, s in fit.mapInArrow(check, "i int, s double").groupBy("i").agg(F.sum("s")).collect():  # 25 rows for k = 4
        moments[i] = s
    moments = moments.reshape(made + 1, made + 1) / n
    mean = moments[-1, :-1]
    error = float(abs(moments[:-1, :-1] - np.outer(mean, mean) - np.eye(made)).max())

    def project(batches):
        for batch in batches:
            x = _matrix(batch.column("x"))
            if float(n) * abs(x).max(initial=0) + abs(sums).max() > 9e18:
                raise ArithmeticError("n * x exceeds 64 bits")
            centred = n * x - sums
            if (centred.astype(float) ** 2).sum(1).max(initial=0) > 9e18:
                raise ArithmeticError("the deviation exceeds 64 bits")
            size = len(x)
            each = np.repeat(np.arange(size), made)
            yield pa.RecordBatch.from_arrays([
                batch.column("key").take(pa.array(each)), pa.array(np.tile(np.arange(1, made + 1, dtype=np.int32), size)),
                pa.array(np.full(size * made, n)), pa.array(np.repeat((centred * centred).sum(1), made)),
                pa.array((centred / n @ weights).ravel()), pa.array(np.tile(explained, size)), pa.array(np.full(size * made, error)),
            ], names=[key, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(project, schema)
