"""Embedding near-dedup by counted collisions on one-dimensional projections.

Unit vectors are projected on many random lines. Each line keeps, sorted, the vectors that project
into its upper tail; around each of them a window of fixed width marks its collisions. A pair that
collides on enough lines is verified by its cosine in double precision. The tail and the count are
set by calculation so that a pair at the threshold is found with at least the wanted probability
(`Settings.calibrated`); the number of lines grows with the table, so that a line's list keeps its
length.

A pair meets on several lines but is handled once, on the first it shares. Lists are cut into squares
of bounded size, compared inside tasks, which return a count of links per vector and the links that
connect them, never all pairs. Equal vectors fold into one before.

Vectors of one length are compared with each other, a length at a time. Lines are projected in single
precision, cosines are taken of the stored components in double precision.

Defined results: vectors that are NULL, empty or zero, or that hold NULL or non-finite components, link
with nothing, and no vector links with one of another length. Rows that repeat a vec_id are one vector each; equal rows
link with each other. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from lumbung.functions.storage import materialize
from lumbung.llm.common import components, ship

_LINES_AT_ONCE = 1024
FOUND = "a long, b long, links long"


@dataclass(frozen=True)
class Settings:
    """Lines, tail bound and window (in standard deviations of a projection), least collisions."""

    threshold: float
    lines: int
    tail: float
    window: float
    count: int
    expected_recall: float
    seed: int = 5
    square: int = 768

    @staticmethod
    def calibrated(
        rows: int, threshold: float = 0.9, recall: float = 0.995, per_list: int = 40, count: int = 2
    ) -> Settings:
        """The shortest tail with which a pair at `threshold` collides `count` times with `recall`.

        Two projections of such a pair are normal with correlation `threshold`, so the chance that
        both reach the tail within the window of each other is an integral, and collisions over
        independent lines are binomial.
        """
        window = 3.0 * math.sqrt(2 * (1 - threshold))
        expected = 8.0
        while True:
            lines = max(512, math.ceil(rows * expected / per_list))
            chance = expected / lines
            tail = NormalDist().inv_cdf(1 - chance)
            both = _both(tail, window, threshold)
            missed = sum(math.comb(lines, k) * both**k * (1 - both) ** (lines - k) for k in range(count))
            if 1 - missed >= recall:
                return Settings(threshold, lines, tail, window, count, 1 - missed)
            expected *= 1.1

    def directions(self, block: int, width: int) -> np.ndarray:
        """Lines block * 1024 and following, one to a column."""
        draw = np.random.default_rng((self.seed, block))
        count = min(_LINES_AT_ONCE, self.lines - block * _LINES_AT_ONCE)
        return draw.standard_normal((width, count), np.float32)


def _both(tail: float, window: float, correlation: float) -> float:
    """Chance that two standard normals so correlated are above `tail` and within `window`."""
    x = np.linspace(tail, tail + 6, 4001)
    density = np.exp(-x * x / 2) / math.sqrt(2 * math.pi)
    spread = math.sqrt(1 - correlation**2)
    cdf = np.vectorize(NormalDist().cdf)
    low = np.maximum(tail, x - window)
    inside = cdf((x + window - correlation * x) / spread) - cdf((low - correlation * x) / spread)
    return float(np.trapezoid(density * inside, x))


def postings(vectors: DataFrame, settings: Settings, width: int) -> DataFrame:
    """For every vector (id, copies, vector), all of one length, a row per line whose tail it reaches.

    Each row holds all lines of the vector and its values there, so that a pair can be counted
    wherever its two vectors meet.
    """
    ship(vectors.sparkSession)
    kind = vectors.schema["vector"].dataType.simpleString()
    schema = f"line int, id long, copies long, vector {kind}, lines array<int>, values array<float>"

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                part = batch.slice(start, 2048)
                if part.num_rows:
                    yield post(part)

    def post(batch: pa.RecordBatch) -> pa.RecordBatch:
        flat = batch.column("vector").flatten().to_numpy().reshape(-1, width).astype(np.float64)
        units = (flat / np.linalg.norm(flat, axis=1, keepdims=True)).astype(np.float32)
        who, where, value = [], [], []
        for block in range(-(-settings.lines // _LINES_AT_ONCE)):
            found = units @ settings.directions(block, width)
            rows, columns = np.nonzero(found >= settings.tail)
            who.append(rows), where.append(columns + block * _LINES_AT_ONCE), value.append(found[rows, columns])
        rows, lines, values = np.concatenate(who), np.concatenate(where), np.concatenate(value)
        order = np.argsort(rows, kind="stable")
        rows, lines, values = rows[order], lines[order].astype(np.int32), values[order]
        edges = np.searchsorted(rows, np.arange(batch.num_rows + 1))
        each = [lines[a:b] for a, b in zip(edges, edges[1:])]
        there = [values[a:b] for a, b in zip(edges, edges[1:])]
        taken = batch.take(pa.array(rows))
        columns = [
            pa.array(lines, pa.int32()), taken.column("id"), taken.column("copies"), taken.column("vector"),
            pa.array([each[r] for r in rows], pa.list_(pa.int32())),
            pa.array([there[r] for r in rows], pa.list_(pa.float32())),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["line", "id", "copies", "vector", "lines", "values"])

    return vectors.select("id", "copies", "vector").mapInArrow(over, schema)


def _compare(rows: pa.Table, width: int, settings: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray, list]:
    """ids, links of each with others by copies, whether any, and connecting links of one square."""
    line, i, j = (rows.column(c)[0].as_py() for c in ("line", "i", "j"))
    ids, copies, own = (rows.column(c).to_numpy() for c in ("id", "copies", "own"))
    flat = rows.column("vector").combine_chunks().flatten().to_numpy().reshape(-1, width).astype(np.float64)
    units = flat / np.linalg.norm(flat, axis=1, keepdims=True)
    lists = rows.column("lines").combine_chunks()
    begins = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    sizes = np.diff(begins)
    values = rows.column("values").combine_chunks().flatten().to_numpy()
    used, place = np.unique(lists.flatten().to_numpy(), return_inverse=True)
    owner = np.repeat(np.arange(len(ids)), sizes)
    held = np.full((len(ids), len(used)), np.nan, np.float32)
    held[owner, place] = values
    one, two = np.flatnonzero(own == i), np.flatnonzero(own == j)
    links = np.zeros(len(ids), np.int64)
    edges: list[tuple[int, int]] = []
    root: dict[int, int] = {}

    def top(at: int) -> int:
        while root.get(at, at) != at:
            at = root[at]
        return at

    for at in one:
        others = two[two > at] if i == j else two
        if not len(others):
            continue
        # A window centred at the query on each of its lines; NaN, no tail, never collides.
        mine = place[begins[at] : begins[at + 1]]
        met = np.abs(held[np.ix_(others, mine)] - held[at, mine]) <= settings.window
        first = ~met[:, used[mine] < line].any(axis=1) & met[:, used[mine] == line].any(axis=1)
        others = others[first & (met.sum(axis=1) >= settings.count)]
        if not len(others):
            continue
        others = others[units[others] @ units[at] >= settings.threshold]
        links[at] += copies[others].sum()
        links[others] += copies[at]
        for other in others.tolist():
            a, b = top(int(at)), top(other)
            if a != b:
                root[max(a, b)] = min(a, b)
                edges.append((int(ids[at]), int(ids[other])))
    return ids, links, links > 0, edges


def linked(posted: DataFrame, settings: Settings, width: int) -> DataFrame:
    """Rows (a, b, links): with b NULL, links that a has in one square; else a connecting link."""
    ship(posted.sparkSession)
    sizes = posted.groupBy("line").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / settings.square).cast("int")
    squares = (
        posted.join(sizes, "line")
        .withColumn("blocks", blocks)
        .withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "line", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own",
            "id", "copies", "vector", "lines", "values",
        )
    )

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            marks = np.stack([batch.column(c).to_numpy() for c in ("line", "i", "j")])
            starts = [0, *(np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1), batch.num_rows]
            done = []
            for begin, end in zip(starts, starts[1:]):
                mark = tuple(marks[:, begin])
                if mark != last and held:
                    done.append(_compare(pa.Table.from_batches(held), width, settings))
                    held = []
                held.append(batch.slice(begin, end - begin))
                last = mark
            yield _found(done)
        if held:
            yield _found([_compare(pa.Table.from_batches(held), width, settings)])

    ordered = squares.repartition("line", "i", "j").sortWithinPartitions("line", "i", "j", "own")
    return ordered.mapInArrow(over, FOUND)


def _found(squares: list) -> pa.RecordBatch:
    a, b, links = [], [], []
    for ids, count, any_, edges in squares:
        a += ids[any_].tolist() + [edge[0] for edge in edges]
        b += [None] * int(any_.sum()) + [edge[1] for edge in edges]
        links += count[any_].tolist() + [0] * len(edges)
    return pa.RecordBatch.from_arrays(
        [pa.array(column, pa.int64()) for column in (a, b, links)], names=["a", "b", "links"]
    )


def near_duplicates(rows: DataFrame, threshold: float = 0.9, recall: float = 0.995) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of `rows` (vec_id, embedding)."""
    usable = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = (
        F.col("embedding").isNotNull() & F.col("vec_id").isNotNull() & ~usable
        & F.exists("embedding", lambda x: x != 0)
    )
    single = isinstance(rows.schema["embedding"].dataType.elementType, FloatType)
    cast = F.col("embedding").cast("array<float>" if single else "array<double>")
    valid = rows.where(good).select("vec_id", cast.alias("vector"))
    # Equal vectors are one, with as many copies.
    folded = materialize(
        valid.groupBy("vector").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies")), "vectors"
    )
    sizes = folded.groupBy(F.size("vector").alias("width")).agg(F.count(F.lit(1)).alias("n")).collect()
    parts = []
    for width, n in sorted(map(tuple, sizes)):
        settings = Settings.calibrated(n, threshold, recall)
        own = folded.where(F.size("vector") == width)
        posted = materialize(postings(own, settings, width), "postings")
        parts.append(materialize(linked(posted, settings, width), "links"))
    found = reduce(DataFrame.union, parts) if parts else rows.sparkSession.createDataFrame([], FOUND)
    counts = found.where("b IS NULL").groupBy(F.col("a").alias("id")).agg(F.sum("links").alias("links"))
    labels = components(found.where("b IS NOT NULL"))
    classes = (
        folded.join(counts, "id", "left").join(labels, "id", "left")
        .select("vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("found"),
                F.coalesce("component", "id").alias("component"))
    )
    every = rows.select("vec_id", F.when(good, cast).alias("vector"))
    return every.join(classes, "vector", "left").select(
        "vec_id",
        F.coalesce("found", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"),
        F.coalesce("component", "vec_id").eqNullSafe(F.col("vec_id")).alias("kept"),
    )
