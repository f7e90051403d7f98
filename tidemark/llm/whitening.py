"""Whitening of embeddings: blockwise QR, bidiagonalisation, singular values by dqds, directions by twisted factorisations."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Entries are counted in steps of 1 / STEPS.
STEPS = 256
#: Triangles that are stacked and factorised in one task.
FAN_IN = 32
#: Numbers of a block that is factorised at a time.
_BLOCK = 1 << 20
_EPS = np.finfo(float).eps
#: Vectors of eigenvalues whose distance is below this share of them are made orthogonal.
_NEAR = 1e-3
_PARTS = pa.schema([("part", pa.int64()), ("r", pa.binary())])


def steps(vector: Column) -> Column:
    """``floor(256 * c)`` of every entry; null for a vector that is null or has an entry that is null or no number in range."""
    found = F.transform(vector, lambda c: c.cast("double") * F.lit(float(STEPS)))
    good = F.forall(found, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(float(1 << 62))), F.lit(False)))
    return F.when(good, F.transform(found, lambda c: F.floor(c).cast("long")))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, width)


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``x - sums / n``, from exact integers as long as they fit."""
    if n * max(1, int(np.abs(x).max(initial=0))) < 1 << 62 and max(map(abs, sums), default=0) < 1 << 62:
        return (n * x - np.array(sums, np.int64)) / n
    return x - np.array([s / n for s in sums])


def totals(fit: DataFrame, width: int) -> tuple[int, list[int]]:
    """Number of rows of ``fit`` and exact sums of the entries of ``x``, added up in tasks first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, np.zeros(width, object)
        for batch in batches:
            x = _matrix(batch.column(0), width)
            n += len(x)
            # Halves of 32 bits cannot overflow in a batch.
            sums += (x >> 32).sum(axis=0).astype(object) * (1 << 32) + (x & 0xFFFFFFFF).sum(axis=0).astype(object)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array([n] * width), pa.array(list(map(str, sums)))], names=["at", "n", "total"])

    found = fit.select("x").mapInArrow(run, "at int, n long, total string").groupBy("at").agg(
        F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).orderBy("at").collect()
    return (found[0].n, [int(r.total) for r in found]) if found else (0, [0] * width)


def _triangle(rows: np.ndarray) -> np.ndarray:
    return np.linalg.qr(rows, mode="r")


def triangle(fit: DataFrame, n: int, sums: list[int], keep: Callable[[DataFrame, str], DataFrame], fan_in: int = FAN_IN) -> np.ndarray:
    """R of the QR factorisation of the centred rows.

    Tasks factorise blocks, each below the R of the one before; the triangles of the tasks are stacked and
    factorised ``fan_in`` at a time until one is left. A triangle has at most as many rows as there are entries
    in a vector, so nothing that moves grows with the rows.
    """
    width = len(sums)

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r, waiting, held = np.zeros((0, width)), [], 0
        for batch in batches:
            waiting.append(_centred(_matrix(batch.column(0), width), n, sums))
            held += waiting[-1].size
            if held > max(_BLOCK, 4 * width * width):
                r, waiting, held = _triangle(np.concatenate([r, *waiting])), [], 0
        r = np.concatenate([r, *waiting])
        if len(r):
            yield pa.RecordBatch.from_pydict({"part": [TaskContext.get().partitionId()], "r": [_triangle(r).tobytes()]}, schema=_PARTS)

    def stacked(group: pa.Table) -> pa.Table:
        group = group.sort_by("part")
        r = np.concatenate([np.frombuffer(x).reshape(-1, width) for x in group.column("r").to_pylist()])
        return pa.table({"part": [group.column("part")[0].as_py() // fan_in], "r": [_triangle(r).tobytes()]}, schema=_PARTS)

    found = keep(fit.select("x").mapInArrow(local, "part long, r binary"), "triangles")
    while found.count() > 1:
        found = keep(found.groupBy(F.floor(F.col("part") / fan_in)).applyInArrow(stacked, "part long, r binary"), "triangles")
    rows = [np.frombuffer(x.r).reshape(-1, width) for x in found.collect()]
    return _triangle(np.concatenate([np.zeros((width, width)), *rows]))


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Householder reflections from both sides make ``r`` upper bidiagonal: diagonal, superdiagonal, and the
    product ``v`` of the reflections from the right, so that ``r = u @ b @ v.T``."""
    a, d = r.astype(float).copy(), r.shape[1]
    v = np.eye(d)

    def reflection(x: np.ndarray) -> np.ndarray:
        w = x.copy()
        w[0] += math.copysign(np.linalg.norm(x), x[0])
        size = np.linalg.norm(w)
        return w / size if size else w

    for k in range(d):
        w = reflection(a[k:, k])
        a[k:, k:] -= 2 * np.outer(w, w @ a[k:, k:])
        if k < d - 2:
            w = reflection(a[k, k + 1:])
            a[k:, k + 1:] -= 2 * np.outer(a[k:, k + 1:] @ w, w)
            v[:, k + 1:] -= 2 * np.outer(v[:, k + 1:] @ w, w)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v


def dqds(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squares of the singular values of an upper bidiagonal matrix, falling, by differential quotient-difference with shifts.

    A transform keeps all quotients positive as long as its shift is below the least eigenvalue; one that fails
    is done again with a smaller shift, at last with none, so every value is found to high relative accuracy.
    """
    scale = max(np.abs(diagonal).max(initial=0), np.abs(above).max(initial=0))
    if not scale:
        return np.zeros(diagonal.size)
    found: list[float] = []
    todo = [([float(x) for x in (diagonal / scale) ** 2], [float(x) for x in (above / scale) ** 2], 0.0)]
    tiny = _EPS * _EPS
    while todo:
        q, e, moved = todo.pop()
        least = 0.0
        while q:
            n = len(q)
            if n == 1:
                found.append(q[0] + moved)
                break
            if e[-1] <= tiny * (moved + q[-1]) or e[-1] <= tiny * tiny:
                found.append(q.pop() + moved)
                e.pop()
                least = 0.0
                continue
            cut = next((k for k in range(n - 2, -1, -1) if e[k] <= tiny * (moved + min(q[k], q[k + 1])) or e[k] <= tiny * tiny), None)
            if cut is not None:
                todo.append((q[:cut + 1], e[:cut], moved))
                q, e, least = q[cut + 1:], e[cut + 1:], 0.0
                continue
            # The least eigenvalue of the last two rows, when the sweep before made its lowest quotient there.
            a, b, c = q[-2], e[-1], q[-1]
            low = 2 * a * c / (a + b + c + math.sqrt(max(0.0, (a + b + c) ** 2 - 4 * a * c))) if a + b + c else 0.0
            shifts = [s for s in (min(low, least) * 0.98, min(low, least) / 4) if s > 0] + [0.0]
            for s in shifts:
                new = _sweep(q, e, s)
                if new is not None:
                    break
            q, e, least = new
            moved += s
    return np.sort(np.array(found))[::-1] * scale * scale


def _sweep(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float] | None:
    d, low, new_q, new_e = q[0] - shift, math.inf, [], []
    for k in range(len(e)):
        if d < 0:
            return None
        low = min(low, d)
        total = d + e[k]
        new_q.append(total)
        t = q[k + 1] / total if total else 0.0
        new_e.append(e[k] * t)
        d = d * t - shift
    if d < 0:
        return None
    return [*new_q, d], new_e, min(low, d)


class _Twisted:
    """``b.T @ b - value`` factorised from the top (``l d l.T``) and from the bottom (``u p u.T``), without forming it."""

    def __init__(self, diagonal: np.ndarray, above: np.ndarray, value: float, floor: float):
        n = diagonal.size
        q, e, off = diagonal ** 2, above ** 2, diagonal[:-1] * above

        def safe(pivot: float) -> float:
            return pivot if abs(pivot) > floor else -floor

        self.l, self.u = np.zeros(n - 1), np.zeros(n - 1)
        self.top, s = np.empty(n), np.empty(n)
        s[0] = -value
        for k in range(n):
            self.top[k] = safe(q[k] + s[k])
            if k < n - 1:
                self.l[k] = off[k] / self.top[k]
                s[k + 1] = e[k] / self.top[k] * s[k] - value
        p = np.empty(n)
        p[-1] = q[-1] - value
        for k in range(n - 2, -1, -1):
            pivot = safe(e[k] + p[k + 1])
            self.u[k] = off[k] / pivot
            p[k] = q[k] / pivot * p[k + 1] - value
        self.twist = s + p + value

    def vector(self) -> np.ndarray:
        """The vector that the two factorisations give, joined where the twist is smallest; only products, no differences."""
        n, at = self.top.size, int(np.argmin(np.abs(self.twist)))
        z = np.zeros(n)
        z[at] = 1.0
        for k in range(at - 1, -1, -1):
            z[k] = -self.l[k] * z[k + 1]
        for k in range(at, n - 1):
            z[k + 1] = -self.u[k] * z[k]
        return z / np.linalg.norm(z)

    def solve(self, x: np.ndarray) -> np.ndarray:
        x = x.copy()
        for k in range(x.size - 1):
            x[k + 1] -= self.l[k] * x[k]
        x /= self.top
        for k in range(x.size - 2, -1, -1):
            x[k] -= self.l[k] * x[k + 1]
        return x / np.linalg.norm(x)


def directions(diagonal: np.ndarray, above: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (columns) of ``b.T @ b`` for its largest eigenvalues ``values``, by twisted factorisations.

    Vectors of values that are nearly equal are made orthogonal; where they coincide, inverse iteration with
    the same factors finds another one.
    """
    n = diagonal.size
    out = np.zeros((n, values.size))
    if n == 1:
        return out + 1.0
    floor, rng = _EPS * _EPS * float(values[0]) if values.size else 0.0, np.random.default_rng(0)
    for j, value in enumerate(values.tolist()):
        factors = _Twisted(diagonal, above, value, floor)
        z = factors.vector()
        near = out[:, :j][:, np.abs(values[:j] - value) <= _NEAR * values[0]]
        if near.size:
            alone = z - near @ (near.T @ z)
            z = alone if np.linalg.norm(alone) > 0.5 else rng.standard_normal(n)
            for _ in range(4):
                z = factors.solve(z - near @ (near.T @ z))
                z -= near @ (near.T @ z)
                z -= near @ (near.T @ z)
                z /= np.linalg.norm(z)
        out[:, j] = z
    return out


def principal(r: np.ndarray, n: int, most: int) -> tuple[np.ndarray, np.ndarray, float]:
    """The largest eigenvalues of ``r.T @ r / n`` (``most`` at most), their unit vectors (rows), and its trace."""
    diagonal, above, v = bidiagonal(r)
    squares = dqds(diagonal, above)
    # What rounding of the rows leaves of a direction without any spread.
    real = squares[:most][squares[:most] > squares[:1].sum() * (squares.size * _EPS) ** 2]
    vectors = (v @ directions(diagonal, above, real)).T if real.size else np.zeros((0, squares.size))
    return real / n, vectors, float(squares.sum()) / n


_OUT = "id long, component int, n long, deviation long, whitened double, explained double"


def _projected(n: int, sums: list[int], values: np.ndarray, vectors: np.ndarray, trace: float, components: int):
    width, most = len(sums), max(map(abs, sums), default=0)
    known = values.size
    axes = (vectors / np.sqrt(values)[:, None]).T if known else np.zeros((width, 0))
    explained = [float(x) / trace for x in values] + [0.0 if trace else None] * (components - known)

    def deviations(x: np.ndarray) -> list[int | None]:
        top = n * int(np.abs(x).max(initial=0)) + most
        if width * top * top < 1 << 63:
            return ((n * x - np.array(sums, np.int64)) ** 2).sum(axis=1).tolist()
        found = ((n * x.astype(object) - np.array(sums, object)) ** 2).sum(axis=1)
        return [d if d < 1 << 63 else None for d in found]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fits = batch.column(1).value_lengths().to_numpy() == width
            x = _matrix(batch.column(1).filter(pa.array(fits)), width)
            whitened = np.full((len(fits), components), np.nan)
            whitened[fits, :known] = _centred(x, n, sums) @ axes
            missing = np.ones_like(whitened, bool)
            missing[fits, :known] = False
            deviation = np.full(len(fits), None, object)
            deviation[fits] = deviations(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(np.repeat(np.arange(len(fits)), components))), pa.array(np.tile(np.arange(1, components + 1, dtype=np.int32), len(fits))),
                 pa.array(np.full(whitened.size, n)), pa.array(np.repeat(deviation, components), pa.int64()),
                 pa.array(whitened.ravel(), mask=missing.ravel()), pa.array(explained * len(fits), pa.float64())],
                names=["id", "component", "n", "deviation", "whitened", "explained"])
    return run


def identity_error(fit: DataFrame, n: int, sums: list[int], values: np.ndarray, vectors: np.ndarray) -> float | None:
    """The largest absolute entry of the whitened rows' covariance minus the identity; null without a component."""
    k = values.size
    if not k:
        return None
    axes = (vectors / np.sqrt(values)[:, None]).T

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k + 1))
        for batch in batches:
            x = _matrix(batch.column(0), len(sums))
            w = np.concatenate([_centred(x, n, sums) @ axes, np.ones((len(x), 1))], axis=1)
            total += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array(range((k + 1) ** 2), pa.int32()), pa.array(total.ravel())], names=["at", "total"])

    rows = fit.select("x").mapInArrow(run, "at int, total double").groupBy("at").agg(F.sum("total").alias("total")).orderBy("at").collect()
    total = np.array([r.total for r in rows]).reshape(k + 1, k + 1)
    mean = total[k, :k] / n
    return float(np.abs(total[:k, :k] / n - np.outer(mean, mean) - np.eye(k)).max())


def whitened(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 4,
             keep: Callable[[DataFrame, str], DataFrame] | None = None, fan_in: int = FAN_IN) -> DataFrame:
    """``(id, component, n, deviation, whitened, explained, identity_error)`` of every row and component.

    Entries are taken as ``floor(256 * c)``. Rows whose vector is null, or has an entry that is null, not finite
    or beyond 2**62 steps, are left out. Each distinct vector of the commonest length (the smaller of two) is
    fitted once, however many rows repeat it: ``n`` vectors. The components are the eigenvectors of their
    covariance, ``whitened`` is a row's projection over the root of the eigenvalue, ``explained`` the
    eigenvalue's share of all, ``deviation`` the exact sum of ``(n * x - sums) ** 2``.

    There are no more components than entries. A component without spread (as many as are missing from the full
    rank) has null ``whitened``; vectors of another length have null ``whitened`` and ``deviation``; a
    ``deviation`` above a long is null. Rows that repeat an id or have none stay. An empty table, or one of
    empty vectors, gives no rows. ``keep`` writes rows and fit list (``common.stored``).
    """
    keep = keep or (lambda df, label: df)
    rows = keep(vectors.select(F.col(id_col).cast("long").alias("id"), steps(F.col(vector_col)).alias("x")).where("x is not null"), "steps")
    length = rows.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), "width").first()
    width = length.width if length else 0
    fit = keep(rows.where(F.size("x") == width).select("x").distinct(), "fit")
    n, sums = totals(fit, width) if width else (0, [])
    values, axes, trace = principal(triangle(fit, n, sums, keep, fan_in), n, components) if width else (np.zeros(0), np.zeros((0, 0)), 0.0)
    found = rows if width else rows.limit(0)
    error = identity_error(fit, n, sums, values, axes) if width else None
    return found.mapInArrow(_projected(n, sums, values, axes, trace, min(components, width)), _OUT).withColumn(
        "identity_error", F.lit(error).cast("double"))
