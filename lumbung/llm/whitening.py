"""Whitening of embeddings, their components found by contour integration of the covariance (FEAST).

The covariance comes from one pass of partial sums over centred vectors; its size is that of a vector
squared, whatever the table. Its upper spectrum is cut into intervals where inertia counts of the
shifted matrix (signs of the pivots of a symmetric factorisation) prove a gap. Each interval is one
task: quadrature over a circle around it, with a complex shifted solve per node, projects a random
subspace onto the interval's eigenspace; Rayleigh-Ritz extracts the pairs; this repeats until
residuals vanish and as many pairs stand in the interval as the inertia counts say, so that none is
missed.

Defined results: rows whose vector is NULL, empty, or holds NULL or non-finite entries are dropped;
rows that repeat a vec_id, or lack one, are rows of their own. Vectors of one length are fitted among
themselves. Components whose eigenvalue is zero to double precision are not returned, so that a
table of one vector, or of equal ones, gives no rows. `deviation` is NULL where it does not fit a long.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumbung.llm.common import ship

_EPS = float(np.finfo(float).eps)


def inertia(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues of a symmetric matrix are above `shift`.

    Counts positive pivots of a symmetric factorisation with complete pivoting, in which a two by two
    pivot has one eigenvalue on either side (Bunch and Parlett, 1971).
    """
    rest = matrix - shift * np.eye(len(matrix))
    above = 0
    while len(rest):
        diagonal = np.abs(np.diagonal(rest))
        one = int(diagonal.argmax())
        off = np.abs(rest)
        np.fill_diagonal(off, 0)
        p, q = divmod(int(off.argmax()), len(rest))
        if off[p, q] == 0 and diagonal[one] == 0:
            break  # eigenvalues at the shift itself are not above it
        if diagonal[one] >= 0.6404 * off[p, q]:
            above += bool(rest[one, one] > 0)
            chosen = [one]
        else:
            above += 1
            chosen = [p, q]
        others = np.delete(np.arange(len(rest)), chosen)
        edge = rest[np.ix_(others, chosen)]
        rest = rest[np.ix_(others, others)] - edge @ np.linalg.solve(rest[np.ix_(chosen, chosen)], edge.T)
    return above


def cuts(matrix: np.ndarray, wanted: int, per_interval: int = 8) -> list[tuple[float, int]]:
    """(shift, eigenvalues above it), falling, in gaps of the spectrum; the last has `wanted` above or more.

    Where eigenvalues stand so close that no shift safely parts them, the interval takes all of them.
    """
    top = float(np.abs(matrix).sum(axis=1).max()) * (1 + 1e-9)
    least = 32 * _EPS * top
    narrow = 1e-11 * top

    def reach(shift: float, above: int, sign: int, step: float) -> float:
        """How far the gap around `shift` goes that way, to within a factor of two."""

        def free(step: float) -> bool:
            return inertia(matrix, shift + sign * step) == above

        if free(step):
            while step < 2 * top and free(2 * step):
                step *= 2
            return step
        while step > least and not free(step):
            step /= 2
        return step if step > least else 0.0

    found = [(top, 0)]
    goal = 0
    while found[-1][1] < wanted:
        goal = max(goal, min(found[-1][1] + per_interval, wanted))
        low, high, above = -1e-3 * top, found[-1][0], len(matrix)
        while above != goal and high - low > least:
            middle = (low + high) / 2
            count = inertia(matrix, middle)
            if count >= goal:
                low, above = middle, count
            else:
                high = middle
        step = max((high - low) / 4, least)
        down, up = reach(low, above, -1, step), reach(low, above, 1, step)
        if up + down < narrow:
            goal = max(above + 1, inertia(matrix, low - narrow))
        else:
            found.append((low + (up - down) / 2, above))
    return found


def feast(
    matrix: np.ndarray, low: float, high: float, count: int, nodes: int = 12, rounds: int = 6, seed: int = 11
) -> tuple[np.ndarray, np.ndarray]:
    """The `count` eigenvalues between `low` and `high`, falling, and their unit vectors as columns.

    A subspace that has not settled after `rounds` is widened: eigenvalues crowd outside the circle.
    """
    size = len(matrix)
    scale = float(np.abs(matrix).sum(axis=1).max())
    middle, radius = (low + high) / 2, (high - low) / 2
    points, weights = np.polynomial.legendre.leggauss(nodes)
    turns = np.exp(1j * np.pi * (1 + points) / 2) * radius
    draw = np.random.default_rng(seed)
    basis = draw.standard_normal((size, min(size, count + max(6, count // 2))))
    for at in range(10 * rounds):
        if at and at % rounds == 0:
            more = min(size - basis.shape[1], basis.shape[1])
            basis = np.hstack([basis, draw.standard_normal((size, more))])
        projected = np.zeros_like(basis)
        for turn, weight in zip(turns, weights):
            shifted = (middle + turn) * np.eye(size) - matrix
            projected += weight / 2 * (turn * np.linalg.solve(shifted, basis)).real
        basis, _ = np.linalg.qr(projected if np.isfinite(projected).all() else basis)
        values, turned = np.linalg.eigh(basis.T @ matrix @ basis)
        basis = basis @ turned
        inside = (values > low) & (values < high)
        off = np.linalg.norm(matrix @ basis - basis * values, axis=0)
        if inside.sum() == count and off[inside].max(initial=0) <= 64 * _EPS * scale * np.sqrt(size):
            return values[inside][::-1], basis[:, inside][:, ::-1]
    raise ArithmeticError(f"{count} eigenvalues between {low} and {high}, {int(inside.sum())} found")


def eigenpairs(spark, matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest `wanted` eigenvalues, falling, and unit eigenvectors as columns: an interval a task."""
    ship(spark)
    scale = float(np.abs(matrix).sum(axis=1).max(initial=0))
    wanted = min(wanted, inertia(matrix, 4 * len(matrix) * _EPS * scale)) if scale > 0 else 0
    if not wanted:
        return np.empty(0), np.empty((len(matrix), 0))
    places = cuts(matrix, wanted)
    intervals = [
        (place, low, high, below - above)
        for place, ((high, above), (low, below)) in enumerate(zip(places, places[1:]))
    ]

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                values, vectors = feast(matrix, row["low"], row["high"], row["count"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values), pa.array(vectors.T.tolist(), pa.list_(pa.float64()))], names=["value", "vector"]
                )

    tasks = spark.createDataFrame(intervals, "place int, low double, high double, count int")
    found = tasks.repartition(len(intervals), "place").mapInArrow(solve, "value double, vector array<double>").collect()
    found.sort(key=lambda pair: -pair.value)
    vectors = np.array([pair.vector for pair in found]).T
    # Vectors of different intervals are orthogonal but for rounding; the last Rayleigh-Ritz removes that.
    basis, _ = np.linalg.qr(vectors)
    values, turned = np.linalg.eigh(basis.T @ matrix @ basis)
    return values[::-1][:wanted], (basis @ turned)[:, ::-1][:, :wanted]


@dataclass(frozen=True)
class Whitening:
    """Fit of one vector length: rows, sums per dimension, and components by falling eigenvalue."""

    rows: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """n * x - S in whole numbers, and x - S / n."""
        apart = self.rows * x - self.sums
        return apart, apart / self.rows

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x)[1] @ self.vectors / np.sqrt(self.values)


def prepare(vectors: DataFrame, scale: int = 64, shift: int = 1_000_000) -> DataFrame:
    """Columns vec_id, width and c (doubles) of the rows that can be fitted."""
    odd = F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    whole = F.transform("embedding", lambda v: F.floor(v.cast("double") * scale) + F.lit(shift).cast("long"))
    return vectors.where(F.col("embedding").isNotNull() & ~odd & (F.size("embedding") > 0)).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.size("embedding").alias("width"), whole.alias("x")
    )


def _matrix(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy().reshape(batch.num_rows, width)


def _added(df: DataFrame, function, size: int, kind: str) -> np.ndarray:
    """Sum over all rows of the array of `size` numbers that `function` gives for a batch.

    A task hands over one partial sum, entry by entry, and Spark adds those up.
    """
    ship(df.sparkSession)
    dtype = np.int64 if kind == "long" else np.float64

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype)
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                total += function(batch.slice(start, 1024))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size), pa.int32()), pa.array(total)], names=["at", "v"])

    summed = df.mapInArrow(over, f"at int, v {kind}").groupBy("at").agg(F.sum("v").alias("v"))
    total = np.zeros(size, dtype)
    for row in summed.collect():
        total[row["at"]] = row["v"]
    return total


def _covariance(df: DataFrame, function, size: int, rows: int) -> np.ndarray:
    """Covariance, divisor `rows`, of the vectors that `function` gives; they are centred before."""
    upper = np.triu_indices(size)

    def products(batch: pa.RecordBatch) -> np.ndarray:
        held = function(batch)
        return (held.T @ held)[upper]

    found = np.zeros((size, size))
    found[upper] = _added(df, products, len(upper[0]), "double") / rows
    return found + np.triu(found, 1).T


def fit(rows: DataFrame, width: int, components: int = 32) -> Whitening:
    """`rows` as `prepare` returns them, all of one width."""
    counts = rows.count()
    sums = _added(rows.select("x"), lambda batch: _matrix(batch, width).sum(axis=0), width, "long")
    empty = Whitening(counts, sums, np.empty(0), np.empty((width, 0)), 0.0)
    if not counts:
        return empty
    covariance = _covariance(rows.select("x"), lambda batch: empty.centred(_matrix(batch, width))[1], width, counts)
    values, vectors = eigenpairs(rows.sparkSession, covariance, components)
    return Whitening(counts, sums, values, vectors, float(np.trace(covariance)))


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the identity."""
    width, size = len(model.sums), len(model.values)
    if not size:
        return 0.0

    def whitened(batch: pa.RecordBatch) -> np.ndarray:
        return model.whitened(_matrix(batch, width))

    mean = _added(rows.select("x"), lambda batch: whitened(batch).sum(axis=0), size, "double") / model.rows
    covariance = _covariance(rows.select("x"), lambda batch: whitened(batch) - mean, size, model.rows)
    return float(np.abs(covariance - np.eye(size)).max())


def transform(rows: DataFrame, model: Whitening) -> DataFrame:
    """vec_id, deviation and whitened (array<double>) of rows of the model's width."""
    ship(rows.sparkSession)
    width = len(model.sums)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                part = batch.slice(start, 4096)
                apart, _ = model.centred(_matrix(part, width))
                fits = (apart.astype(np.float64) ** 2).sum(axis=1) < 2.0**62
                exact = (apart * apart).sum(axis=1)
                found = model.whitened(_matrix(part, width))
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(found) + 1) * found.shape[1], pa.int32()), pa.array(found.ravel())
                )
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id"), pa.array(exact, pa.int64(), mask=~fits), lists],
                    names=["vec_id", "deviation", "whitened"],
                )

    return rows.select("vec_id", "x").mapInArrow(over, "vec_id long, deviation long, whitened array<double>")


def whiten(vectors: DataFrame, components: int = 32) -> DataFrame:
    """A row per vector and component: component, n, deviation, whitened, explained, identity_error."""
    rows = prepare(vectors)
    schema = (
        "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    )
    parts = [vectors.sparkSession.createDataFrame([], schema)]
    for (width,) in sorted(rows.select("width").distinct().collect()):
        own = rows.where(F.col("width") == width)
        model = fit(own, width, components)
        if not len(model.values):
            continue
        error = identity_error(own, model)
        explained = F.array(*[F.lit(float(value / model.trace)) for value in model.values])
        parts.append(
            transform(own, model).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
            .select(
                "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.rows).cast("long").alias("n"),
                "deviation", "whitened", F.get(explained, F.col("at")).alias("explained"),
                F.lit(error).alias("identity_error"),
            )
        )
    return reduce(DataFrame.union, parts[1:] or parts)
