"""Embedding whitening by the leading components of a distributed covariance.

Entries become whole numbers (:class:`WhitenRules`), so that counts, sums and
deviations are exact. Three passes over the vectors: sums, covariance centred
at their mean, and projection. Each task reduces its vectors to one row; cells
of those rows are added up by Spark, so the driver only gets dimension squared
numbers. There the covariance is made tridiagonal by Householder reflections,
its leading eigenvalues are found by bisection with Sturm counts, and their
vectors by inverse iteration, made orthogonal again within clusters of close
eigenvalues. The components are a few vectors and travel to the tasks.

Cases: a vector that is null or has a null or non-finite entry is left out, as
is one whose length is not the most frequent length (of equally frequent ones,
the longest). A component without variance (equal vectors, or fewer vectors
than components) has null for ``whitened`` and 0 for ``explained``; the
identity is measured over the others. A deviation beyond a long is null.
Entries beyond 2**61 count as 2**61. Repeated rows count each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundburn.llm.base import carried, ddl, in_arrow, staged

_EPS = np.finfo(np.float64).eps
_FAR = 1 << 61


@dataclass(frozen=True)
class WhitenRules:
    components: int = 8
    scale: int = 1024       # x = floor(scale * entry) + shift
    shift: int = 100_000


@dataclass(frozen=True)
class Whitening:
    """What was fitted: counts and sums are exact whole numbers."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray       # leading eigenvalues, falling
    components: np.ndarray   # one row each, unit length
    trace: float
    rules: WhitenRules

    @property
    def scales(self) -> np.ndarray:
        """What a projection is multiplied by; NaN for a component without variance."""
        flat = (self.values <= max(*self.values[:1], 0.0) * len(self.sums) * _EPS) | (self.trace <= 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(flat, np.nan, 1 / np.sqrt(self.values))


# ---- vectors of a batch ----------------------------------------------------

def _usable(column: pa.Array, rules: WhitenRules) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, places in the batch, x as int64 rows) of the vectors without null or non-finite entries."""
    sizes = np.diff(column.offsets.to_numpy())
    present = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False) & (sizes > 0))
    for length in np.unique(sizes[present]):
        at = present[sizes[present] == length]
        entries = column.take(pa.array(at)).flatten().cast(pa.float64())
        c = entries.to_numpy(zero_copy_only=False).reshape(-1, length)  # a null entry is NaN
        whole = np.isfinite(c).all(axis=1)
        with np.errstate(over="ignore"):
            x = np.clip(np.floor(rules.scale * c[whole]), -_FAR, _FAR).astype(np.int64) + rules.shift
        yield int(length), at[whole], x


def _of_length(column: pa.Array, length: int, rules: WhitenRules) -> tuple[np.ndarray, np.ndarray]:
    for size, at, x in _usable(column, rules):
        if size == length:
            return at, x
    return np.empty(0, np.int64), np.empty((0, length), np.int64)


def _about(x: np.ndarray, n: int, sums: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """(x - floor(S/n), S mod n): the mean in whole numbers and what is left of it, as Python integers."""
    middle = np.array([s // n for s in sums], np.int64)
    return x - middle, np.array([s % n for s in sums], object)


def _centred(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    z, rest = _about(x, n, sums)
    return z - (rest / n).astype(np.float64)


def deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int | None]:
    """Sum over dimensions of (n*x - S) squared, exact; None beyond a long."""
    z, rest = _about(x, n, sums)
    if len(z) and int(np.abs(z).max()) ** 2 * z.shape[1] < 1 << 62 and int(np.abs(z).max()) * n * z.shape[1] < 1 << 62:
        r = rest.astype(np.int64)
        squares, products = (z * z).sum(axis=1).astype(object), (z @ r).astype(object)
    else:
        wide = z.astype(object)
        squares, products = (wide * wide).sum(axis=1), (wide * rest).sum(axis=1)
    out = n * n * squares - 2 * n * products + int((rest * rest).sum())
    return [v if v < 1 << 63 else None for v in out]


# ---- passes over all vectors -----------------------------------------------

def _summed_cells(rows: DataFrame, column: str) -> list[float]:
    """Sum of an array column over all rows, entry by entry."""
    cells = rows.select(F.posexplode(column).alias("cell", "v")).groupBy("cell").agg(F.sum("v").alias("v"))
    return [row["v"] for row in cells.orderBy("cell").collect()]  # as many as the array has entries


def _sums(vectors: DataFrame, rules: WhitenRules) -> tuple[int, list[int]]:
    """Vectors of the most frequent length, and their sums by dimension."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for length, _, x in _usable(batch.column(0), rules):
                total = held.setdefault(length, [0, np.zeros((2, length), np.int64)])
                total[0] += len(x)
                total[1] += ((x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0))  # neither half overflows
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.int32()), pa.array([t[0] for t in held.values()], pa.int64()),
             *(pa.array([t[1][half] for t in held.values()], pa.list_(pa.int64())) for half in (0, 1))],
            names=["length", "n", "high", "low"])

    parts = staged(in_arrow(vectors, run, "length int, n long, high array<long>, low array<long>"), "sums")
    most = parts.groupBy("length").agg(F.sum("n").alias("n")).where("n > 0").orderBy(F.desc("n"), F.desc("length")).first()
    if most is None:
        return 0, []
    own = parts.where(F.col("length") == most["length"])
    return most["n"], [(h << 32) + low for h, low in zip(_summed_cells(own, "high"), _summed_cells(own, "low"), strict=True)]


def _covariance(vectors: DataFrame, n: int, sums: tuple[int, ...], rules: WhitenRules) -> np.ndarray:
    d = len(sums)
    upper = np.triu_indices(d)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for batch in batches:
            y = _centred(_of_length(batch.column(0), d, rules)[1], n, sums)
            total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array([total[upper]], pa.list_(pa.float64()))], names=["cells"])

    parts = staged(in_arrow(vectors, run, "cells array<double>"), "covariance")
    out = np.zeros((d, d))
    out[upper] = _summed_cells(parts, "cells")
    return (out + np.triu(out, 1).T) / n


def fit(rows: DataFrame, rules: WhitenRules = WhitenRules(), vector: str = "embedding") -> Whitening | None:
    """The whitening of all usable vectors; None if there is none."""
    vectors = rows.select(F.col(vector).alias("v"))
    n, sums = _sums(vectors, rules)
    if not n:
        return None
    v = _covariance(vectors, n, tuple(sums), rules)
    values, components = leading(v, min(rules.components, len(sums)))
    return Whitening(n, tuple(sums), values, components, float(np.trace(v)), rules)


def _projected(x: np.ndarray, model: Whitening) -> np.ndarray:
    return _centred(x, model.n, model.sums) @ model.components.T * model.scales


def identity_error(rows: DataFrame, model: Whitening, vector: str = "embedding") -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the identity."""
    some = np.flatnonzero(~np.isnan(model.scales))
    k = len(some)
    if not k:
        return 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Each batch is centred at its own mean; what lies between the means is added.
        count, mean, cells = 0, np.zeros(k), np.zeros((k, k))
        for batch in batches:
            w = _projected(_of_length(batch.column(0), len(model.sums), model.rules)[1], model)[:, some]
            if not len(w):
                continue
            own = w.mean(axis=0)
            gap = own - mean
            cells += (w - own).T @ (w - own) + np.outer(gap, gap) * (count * len(w) / (count + len(w)))
            mean += gap * (len(w) / (count + len(w)))
            count += len(w)
        yield pa.RecordBatch.from_arrays(
            [pa.array([np.concatenate([count * mean, (cells + count * np.outer(mean, mean)).ravel()])], pa.list_(pa.float64()))],
            names=["cells"])

    found = np.array(_summed_cells(in_arrow(rows.select(F.col(vector).alias("v")), run, "cells array<double>"), "cells")) / model.n
    mean = found[:k]
    return float(np.abs(found[k:].reshape(k, k) - np.outer(mean, mean) - np.eye(k)).max())


def whitened(rows: DataFrame, model: Whitening | None, vector: str = "embedding", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all columns but the vector by default) with ``deviation`` and
    ``whitened`` array<double>, one entry per component, for each usable vector."""
    keep = carried(rows, [c for c in rows.columns if c != vector] if keep is None else keep, "_v deviation whitened")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches if model else ():
            at, x = _of_length(batch.column("_v"), len(model.sums), model.rules)
            w = _projected(x, model)
            values = pa.array(w.ravel(), mask=np.isnan(w.ravel()))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(pa.array(at)) for c in keep), pa.array(deviations(x, model.n, model.sums), pa.int64()),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1) * w.shape[1], pa.int32()), values)],
                names=[*keep, "deviation", "whitened"])

    return in_arrow(rows.select(*keep, F.col(vector).alias("_v")), run, f"{ddl(rows, keep)}deviation long, whitened array<double>")


def components_of(rows: DataFrame, rules: WhitenRules = WhitenRules(), vector: str = "embedding", keep: list[str] | None = None) -> DataFrame:
    """Fits on all usable vectors and returns, per vector and component: ``keep``,
    component (from 1), n, deviation, whitened, explained, identity_error."""
    model = fit(rows, rules, vector)
    trace = model.trace if model else 0.0
    shares = [0.0 if np.isnan(s) or trace <= 0 else float(e / trace) for e, s in zip(model.values, model.scales, strict=True)] if model else []
    error = identity_error(rows, model, vector) if model else 0.0
    found = whitened(rows, model, vector, keep)
    kept = found.columns[:-2]
    shared = F.array(*map(F.lit, shares)) if shares else F.array().cast("array<double>")
    return found.select(*kept, "deviation", F.posexplode("whitened").alias("_k", "whitened")).select(
        *kept, (F.col("_k") + 1).alias("component"), F.lit(model.n if model else 0).cast("long").alias("n"), "deviation",
        "whitened", F.get(shared, F.col("_k")).alias("explained"), F.lit(error).alias("identity_error"))


# ---- eigenvalues and vectors of a symmetric matrix --------------------------

def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, off-diagonal, q): a = q @ t @ q.T, by Householder reflections."""
    a = a.copy()
    d = len(a)
    q = np.eye(d)
    for k in range(d - 2):
        column = a[k + 1:, k]
        size = np.linalg.norm(column)
        if not np.any(column[1:]):
            continue
        v = column / size
        v[0] += np.copysign(1.0, v[0])
        v /= np.linalg.norm(v)
        rest = a[k + 1:, k + 1:]
        p = rest @ v
        w = 2 * (p - (v @ p) * v)
        rest -= np.outer(v, w) + np.outer(w, v)
        a[k + 1, k] = a[k, k + 1] = -np.copysign(size, column[0])
        a[k + 2:, k] = a[k, k + 2:] = 0
        q[:, k + 1:] -= 2 * np.outer(q[:, k + 1:] @ v, v)
    return a.diagonal().copy(), a.diagonal(1).copy(), q


def sturm_count(diagonal: np.ndarray, off: np.ndarray, x: np.ndarray) -> np.ndarray:
    """How many eigenvalues of the tridiagonal matrix lie below each x."""
    least = np.finfo(np.float64).tiny * max(1.0, float((off * off).max(initial=0)))
    squares = np.concatenate([[0.0], off * off])
    pivot, below = np.ones(len(x)), np.zeros(len(x), np.int64)
    for a, b in zip(diagonal, squares, strict=True):
        pivot = a - x - b / pivot
        pivot = np.where(np.abs(pivot) < least, -least, pivot)
        below += pivot < 0
    return below


def largest_values(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, each bisected down to neighbouring numbers."""
    radius = np.abs(np.concatenate([off, [0]])) + np.abs(np.concatenate([[0], off]))
    reach = float(max(np.abs(diagonal).max() + radius.max(), np.finfo(np.float64).tiny)) * (1 + 4 * _EPS)
    low, high = np.full(k, -reach), np.full(k, reach)
    wanted = len(diagonal) - np.arange(1, k + 1)  # eigenvalues below the one sought
    floor = _EPS * _EPS * reach
    while True:
        middle = low + (high - low) / 2
        if np.all((middle <= low) | (middle >= high) | (high - low <= floor)):
            return middle
        above = sturm_count(diagonal, off, middle) <= wanted
        low, high = np.where(above, middle, low), np.where(above, high, middle)


def _solved(diagonal: np.ndarray, off: np.ndarray, value: float, b: np.ndarray, least: float) -> np.ndarray:
    """(t - value) y = b by elimination with row exchanges; a vanished pivot counts as ``least``."""
    d = len(diagonal)
    rows = np.zeros((d, 3))  # from the diagonal to the right
    rows[:, 0] = diagonal - value
    rows[:-1, 1] = off
    y = b.copy()
    for i in range(d - 1):
        lower = off[i]
        under = np.array([rows[i + 1, 0], rows[i + 1, 1]])
        if abs(rows[i, 0]) >= abs(lower):
            if abs(rows[i, 0]) < least:
                rows[i, 0] = least
            factor = lower / rows[i, 0]
            rows[i + 1, 0] = under[0] - factor * rows[i, 1]
            rows[i + 1, 1] = under[1] - factor * rows[i, 2]
            y[i + 1] -= factor * y[i]
        else:
            factor = rows[i, 0] / lower
            upper = rows[i].copy()
            rows[i] = [lower, under[0], under[1]]
            rows[i + 1, 0] = upper[1] - factor * under[0]
            rows[i + 1, 1] = upper[2] - factor * under[1]
            y[i], y[i + 1] = y[i + 1], y[i] - factor * y[i + 1]
    if abs(rows[-1, 0]) < least:
        rows[-1, 0] = least
    for i in range(d - 1, -1, -1):
        if i + 1 < d:
            y[i] -= rows[i, 1] * y[i + 1]
        if i + 2 < d:
            y[i] -= rows[i, 2] * y[i + 2]
        y[i] /= rows[i, 0]
        far = np.abs(y[i:]).max()
        if far > 1e100:  # only the direction counts; what is still to come is scaled alike
            y /= far
    return y


def vectors_of(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors, one row each, by inverse iteration. Those of a cluster
    of close eigenvalues are made orthogonal to each other in every round."""
    d = len(diagonal)
    norm = float(np.abs(diagonal).max(initial=0) + 2 * np.abs(off).max(initial=0)) or 1.0
    start = np.random.default_rng(12)  # fixed: equal matrices give equal components
    out = np.zeros((len(values), d))
    cluster = 0
    for k, value in enumerate(values):
        if k and values[k - 1] - value > 1e-3 * norm:
            cluster = k
        y = start.standard_normal(d)
        # Equal eigenvalues are set apart by a few units in the last place.
        shifted = value - (k - cluster) * 2 * _EPS * norm if k > cluster and values[k - 1] - value < 10 * _EPS * norm else value
        for _ in range(5):
            y = _solved(diagonal, off, shifted, y / np.linalg.norm(y), _EPS * norm)
            y /= np.abs(y).max()
            for _ in range(2):
                for before in out[cluster:k]:
                    y -= (before @ y) * before
            y /= np.linalg.norm(y)
        out[k] = y
    return out


def leading(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues of a symmetric matrix, falling, and unit eigenvectors, one row each."""
    size = float(np.abs(a).max(initial=0)) or 1.0
    diagonal, off, q = tridiagonal(a / size)
    values = largest_values(diagonal, off, k)
    components = vectors_of(diagonal, off, values) @ q.T
    return values * size, components / np.linalg.norm(components, axis=1, keepdims=True)
