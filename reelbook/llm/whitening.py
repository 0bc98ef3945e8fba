"""Whitening of embeddings on their leading components, found by contour integration (FEAST).

Covariances are sums of whole numbers, hence exact whatever the order of the rows. The
eigenvalues wanted are cut out by an interval; the quadrature of shifted solves around it
projects random vectors onto its eigenspace, Rayleigh-Ritz takes the components out of
that space, and counts of inertia at the ends of the interval prove that none is missing.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Entries become ``floor(SCALE * c) + OFFSET``, kept within ``OFFSET`` plus or minus LARGEST.
SCALE = 1024
OFFSET = 100_000
LARGEST = 1 << 40
#: Gauss-Legendre nodes on the upper half of the contour.
NODES = 16
#: An eigenvalue below this share of the trace counts as none.
LEAST_SHARE = 1e-12
#: Largest product sum that is surely exact in doubles.
_EXACT = float(1 << 52)


# the vectors


def fit_rows(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id`` and ``x``, the whole numbers of each usable vector.

    Rows whose vector is null, empty, or holds a null or a non-finite entry are left out.
    """
    x = F.col(vector)
    number = F.transform(x, lambda c: c.cast("double"))
    sound = F.forall(number, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = F.transform(
        number,
        lambda c: F.floor(F.greatest(F.least(c * SCALE, F.lit(float(LARGEST))), F.lit(-float(LARGEST)))) + OFFSET,
    )
    # a condition on the entries, not a filter above the numbers: null vectors never reach them
    rows = vectors.where(x.isNotNull() & (F.size(x) > 0) & F.coalesce(sound, F.lit(False)))
    return rows.select(F.col(key).alias("vec_id"), whole.alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    """Lists of one length as rows."""
    return column.flatten().to_numpy().reshape(len(column), -1)


def _products(y: np.ndarray) -> list[list[int]]:
    """Exact sums of products of the columns."""
    if y.size == 0 or float(np.abs(y).max()) ** 2 * len(y) < _EXACT:
        d = y.astype(np.float64)
        return (d.T @ d).astype(np.int64).tolist()
    wide = y.astype(object)
    return (wide.T @ wide).tolist()


def _exact_sums(rows: DataFrame, d: int, centre: list[int] | None = None) -> tuple[int, list[int], list[list[int]]]:
    """Number of rows, column sums, and with a centre the sums of products about it.

    A task hands on one row of sums for each dimension, whatever its rows; these are added
    as decimals, so nothing overflows, and ``d`` sums (with products ``d`` times ``d``)
    come to the driver.
    """
    wide = "decimal(38,0)"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, products = 0, [0] * d, None
        for batch in batches:
            y = _matrix(batch.column(0)) - (np.array(centre, np.int64) if centre else 0)
            n += len(y)
            part = y.sum(axis=0, dtype=np.int64).tolist()
            sums = [a + b for a, b in zip(sums, part, strict=True)]
            if centre:
                made = np.array(_products(y), dtype=object)
                products = made if products is None else products + made
        if n:
            about = products.tolist() if centre else [[]] * d
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(d), pa.int32()),
                    pa.array([n] * d, pa.int64()),
                    pa.array([str(s) for s in sums]),
                    pa.array([[str(p) for p in line] for line in about], pa.list_(pa.string())),
                ],
                names=["i", "n", "total", "about"],
            )

    parts = rows.select("x").mapInArrow(run, "i int, n long, total string, about array<string>")
    parts = parts.select("i", F.posexplode(F.concat(F.array(F.col("n").cast("string"), "total"), "about")).alias("j", "v"))
    summed = parts.groupBy("i", "j").agg(F.sum(F.col("v").cast(wide)).alias("v")).collect()
    table: list[list[int]] = [[0] * (2 + (d if centre else 0)) for _ in range(d)]
    for row in summed:
        table[row.i][row.j] = int(row.v)
    return table[0][0] if d else 0, [line[1] for line in table], [line[2:] for line in table]


# eigenvalues of a symmetric matrix


def negatives(a: np.ndarray) -> int:
    """How many eigenvalues of a symmetric matrix are below zero: the inertia of its LDL^T.

    Pivots of one or two rows (Bunch and Parlett), the largest entry left deciding.
    """
    a = a.astype(np.float64).copy()
    count = 0
    while a.size:
        flat = int(np.abs(a).argmax())
        i, j = divmod(flat, a.shape[0])
        on_line = np.abs(np.diag(a))
        k = int(on_line.argmax())
        if on_line[k] == 0 and a[i, j] == 0:
            return count
        if on_line[k] >= 0.6403882 * abs(a[i, j]):
            chosen = [k]
            count += int(a[k, k] < 0)
        else:
            chosen = [i, j]
            count += 1  # the block's determinant is negative: one eigenvalue on each side
        rest = np.setdiff1d(np.arange(a.shape[0]), chosen)
        column = a[np.ix_(rest, chosen)]
        a = a[np.ix_(rest, rest)] - column @ np.linalg.solve(a[np.ix_(chosen, chosen)], column.T)
        a = (a + a.T) / 2
    return count


def _above(a: np.ndarray, shift: float) -> int:
    """How many eigenvalues are above ``shift``."""
    return len(a) - negatives(a - shift * np.eye(len(a)))


def _interval(a: np.ndarray, k: int) -> tuple[float, float, int]:
    """An interval that holds at least the ``k`` largest eigenvalues, ends with a gap, and their number.

    Bisection on the inertia looks for a lower end with ``k`` values above, first of all
    in the widest gap near it; equal values stay together and may make the number larger.
    """
    reach = float(np.abs(a).sum(axis=1).max())
    low, high = -reach * 1e-3 - reach * 1e-9, reach * (1 + 1e-9)
    if _above(a, low) <= k:
        return low, high, _above(a, low)
    top = high
    while high - low > reach * 1e-13:
        middle = (low + high) / 2
        found = _above(a, middle)
        if found == k:
            # the ends of the gap: down to the next value, up to the k-th
            below, inside = low, middle
            upper, outside = high, middle
            for _ in range(12):
                trial = (below + inside) / 2
                below, inside = (below, trial) if _above(a, trial) == k else (trial, inside)
                trial = (outside + upper) / 2
                outside, upper = (trial, upper) if _above(a, trial) == k else (outside, trial)
            return (inside + outside) / 2, top, k
        low, high = (middle, high) if found > k else (low, middle)
    return low, top, _above(a, low)


def feast(a: np.ndarray, low: float, high: float, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenvalues of a symmetric matrix between ``low`` and ``high``, falling, and their vectors.

    Each round sums shifted solves over the quadrature nodes of a circle around the
    interval and takes Ritz pairs out of the sums. Raises if the rounds end with another
    number of values inside than the inertia gave.
    """
    n = len(a)
    size = min(n, count + max(4, count // 2))
    middle, radius = (high + low) / 2, (high - low) / 2
    basis = np.random.default_rng(1).standard_normal((n, size))
    scale = float(np.abs(a).max())
    best: tuple[float, np.ndarray, np.ndarray] | None = None
    worse = 0
    for turn_no in range(30):
        # values close outside the ends fade slowly: then more nodes
        nodes, weights = np.polynomial.legendre.leggauss(NODES << turn_no // 6)
        space = np.zeros((n, size))
        for turn, weight in zip(np.exp(-0.5j * np.pi * (nodes - 1)), weights, strict=True):
            solved = np.linalg.solve((middle + radius * turn) * np.eye(n) - a, basis)
            space += (weight / 2) * (radius * turn * solved).real
        q, _ = np.linalg.qr(space)
        values, mixed = np.linalg.eigh(q.T @ a @ q)
        basis = q @ mixed
        inside = np.flatnonzero((values > low) & (values < high))[::-1]
        if len(inside) != count:
            continue
        vectors = basis[:, inside]
        rest = float(np.abs(a @ vectors - vectors * values[inside]).max())
        if best is None or rest < best[0]:
            best, worse = (rest, values[inside], vectors), 0
        else:
            worse += 1
        if worse >= 2 and best[0] <= scale * n * 1e-14:
            break
    if best is None:
        raise RuntimeError(f"contour holds other than {count} eigenvalues")
    return best[1], best[2]


def leading(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues and their unit vectors; fewer if the others are as good as zero."""
    k = min(k, len(a))
    if not k or not np.trace(a) > 0:
        return np.zeros(0), np.zeros((len(a), 0))
    # scaled to a trace of one, so that ends and residuals mean the same for any data
    trace = float(np.trace(a))
    values, vectors = feast(a / trace, *_interval(a / trace, k))
    some = np.flatnonzero(values > LEAST_SHARE)[:k]
    return values[some] * trace, vectors[:, some]


# the operator


@dataclass(frozen=True)
class Whitening:
    """``sums`` of ``n`` fitted vectors; ``values`` and ``axes`` (a column each) of their components."""

    n: int
    sums: list[int]
    trace: float
    values: np.ndarray
    axes: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``x - sums / n`` to the last place: the whole part of the mean goes off first."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([(s % self.n) / self.n for s in self.sums])
        return (x - whole) - rest

    def apply(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.axes / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums of ``(n * x - sums) ** 2``; null beyond what a long holds."""
        far = (x - np.array([s // self.n for s in self.sums], np.int64)).astype(object) * self.n
        far -= np.array([s % self.n for s in self.sums], dtype=object)
        return [v if v < 1 << 63 else None for v in (far * far).sum(axis=1).tolist()]


def _usable(vectors: DataFrame, key: str, vector: str) -> tuple[DataFrame, int]:
    """Usable rows of the commonest length (of equally common ones the longest), and that length."""
    rows = fit_rows(vectors, key, vector)
    lengths = rows.groupBy(F.size("x").alias("d")).count()
    first = lengths.orderBy(F.desc("count"), F.desc("d")).first()
    d = first.d if first else 0
    return rows.where(F.size("x") == d), d


def fit(vectors: DataFrame, components: int = 8, key: str = "vec_id", vector: str = "embedding") -> Whitening:
    """The whitening of all usable vectors (see :func:`whiten` for odd rows).

    Two passes: sums first, then products about the whole part of the mean.
    """
    rows, d = _usable(vectors, key, vector)
    return _fit(rows, d, components)


def _fit(rows: DataFrame, d: int, components: int) -> Whitening:
    n, sums, _ = _exact_sums(rows, d)
    if not n:
        return Whitening(0, sums, 0.0, np.zeros(0), np.zeros((d, 0)))
    centre = [s // n for s in sums]
    _, off, products = _exact_sums(rows, d, centre)
    # n * n times the covariance as whole numbers, divided once
    exact = [[n * products[i][j] - off[i] * off[j] for j in range(d)] for i in range(d)]
    covariance = np.array([[float(Fraction(v, n * n)) for v in line] for line in exact])
    values, axes = leading(covariance, components)
    trace = float(Fraction(sum(exact[i][i] for i in range(d)), n * n))
    return Whitening(n, sums, trace, values, axes)


def _identity_error(rows: DataFrame, model: Whitening) -> float:
    """Largest entry of the whitened rows' covariance minus the identity, from the rows themselves."""
    k = len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, products = 0, np.zeros(k), np.zeros((k, k))
        for batch in batches:
            w = model.apply(_matrix(batch.column(0)))
            n += len(w)
            sums += w.sum(axis=0)
            products += w.T @ w
        if n:
            values = np.concatenate([sums, products.ravel()])
            yield pa.RecordBatch.from_arrays([pa.array(range(values.size), pa.int32()), pa.array(values)], names=["i", "v"])

    parts = rows.select("x").mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    flat = np.zeros(k + k * k)
    for row in parts:
        flat[row.i] = row.v
    mean = flat[:k] / model.n
    covariance = flat[k:].reshape(k, k) / model.n - np.outer(mean, mean)
    return float(np.abs(covariance - np.eye(k)).max()) if k else 0.0


def whiten(vectors: DataFrame, components: int = 8, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per usable vector and component.

    ``vec_id``, ``component`` (from 1, by falling eigenvalue), ``n`` (fitted vectors),
    ``deviation`` (sum of ``(n * x - sums) ** 2``; null if a long cannot hold it),
    ``whitened``, ``explained`` (share of the trace) and ``identity_error``.

    Rows whose vector is null, empty or holds a null or a non-finite entry are left out,
    as are those of another length than the commonest; entries beyond 2^40 / 1024 count as
    that. A null key stays null; repeated rows each count and each give rows; equal
    eigenvalues keep any of their axes, the same for all rows. There are as many
    components as eigenvalues that are not zero, so equal vectors, a single one or an
    empty table give no rows. Other columns are not read, whatever their names. Memory
    and the driver's share depend on the dimensions alone (their square); nothing is
    shuffled but one partial sum a task.
    """
    rows, d = _usable(vectors, key, vector)
    model = _fit(rows, d, components)
    k = len(model.values)
    error = _identity_error(rows, model) if k else 0.0
    share = model.values / model.trace if k else model.values

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = len(batch)
            x = _matrix(batch.column(1))
            far = model.deviations(x)
            of = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(of),
                    pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                    pa.array(np.full(m * k, model.n)),
                    pa.array(far, pa.int64()).take(of),
                    pa.array(model.apply(x).ravel()),
                    pa.array(np.tile(share, m)),
                    pa.array(np.full(m * k, error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = (
        f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    )
    return rows.where(F.lit(k > 0)).mapInArrow(run, schema)


def whitening_digest(vectors: DataFrame) -> DataFrame:
    return whiten(vectors.select("vec_id", "embedding"), 8)
