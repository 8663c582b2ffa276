"""Helpers that the operators share: shipping code, text batches, fold of a document, components."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

import lumbung
from lumbung.functions.storage import materialize

_shipped: set[str] = set()
_MIXERS = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))


def give_back() -> None:
    """Return freed memory to the machine: a Python worker lives on for other tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library, which gives back by itself
        pass


def string_hashes(strings: pa.Array, seed: int) -> np.ndarray:
    """A 64-bit hash of every string, computed over all their bytes at once."""
    strings = strings.cast(pa.large_string())
    ends = np.frombuffer(strings.buffers()[1], np.int64)[strings.offset : strings.offset + len(strings) + 1]
    data = np.frombuffer(strings.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    ends = ends - ends[0]
    draw = np.random.default_rng(seed)
    table = draw.integers(0, 1 << 64, 256, np.uint64)
    step = int(draw.integers(0, 1 << 61)) * 8 + 3
    up, down = (np.full(len(data) + 1, base, np.uint64) for base in (step, pow(step, -1, 1 << 64)))
    up[0] = down[0] = 1
    up, down = np.cumprod(up), np.cumprod(down)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(table[data] * up[:-1], out=total[1:])
    values = (total[ends[1:]] - total[ends[:-1]]) * down[ends[:-1]] + np.diff(ends).astype(np.uint64)
    for mixer in _MIXERS:
        values = (values ^ (values >> np.uint64(33))) * mixer
    return values ^ (values >> np.uint64(33))


def ship(spark: SparkSession) -> None:
    """Send this package's code to the Python workers, once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(lumbung.__file__).resolve().parent
    target = os.path.join(tempfile.mkdtemp(prefix="lumbung-code-"), "lumbung_code.zip")
    with zipfile.ZipFile(target, "w") as bundle:
        for path in sorted(root.rglob("*.py")):
            bundle.write(path, str(path.relative_to(root.parent)))
    spark.sparkContext.addPyFile(target)
    _shipped.add(app)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def held_out(doc_id: Column) -> Column:
    """Whether a document belongs to the fold that nothing is learned from; never NULL."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def map_rows(
    df: DataFrame, function: Callable[[pa.RecordBatch], dict[str, object]], schema: str
) -> DataFrame:
    """Apply `function` to every Arrow batch; it returns the columns of `schema` by name.

    A batch is bounded by Spark's Arrow batch settings, so memory does not depend on the table.
    """
    ship(df.sparkSession)
    arrow = _arrow_schema(df.sparkSession, schema)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                columns = function(batch)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[f.name], type=f.type) for f in arrow], schema=arrow
                )
        give_back()

    return df.mapInArrow(over, schema)


def columns_of(rows: list[tuple], *names: str) -> dict[str, object]:
    """Columns by name of rows, none of them if there are no rows."""
    return dict(zip(names, zip(*rows))) if rows else dict.fromkeys(names, ())


def text_slices(batch: pa.RecordBatch, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """A batch with a column `text` in slices of at most `most` bytes of text, or of one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy()
    start, held = 0, 0
    for row, size in enumerate(sizes.tolist()):
        if held and held + size > most:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += size + 1
    if batch.num_rows > start:
        yield batch.slice(start)


def map_batches(
    df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: StructType
) -> DataFrame:
    """Apply `function`, which returns a batch of `schema`, to every Arrow batch."""
    ship(df.sparkSession)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield function(batch)
        give_back()

    return df.mapInArrow(over, schema)


def filter_rows(df: DataFrame, keep: Callable[[pa.RecordBatch], list[bool]]) -> DataFrame:
    """The rows of `df`, all columns as they are, for which `keep` says so."""
    return map_batches(
        df, lambda batch: batch.filter(pa.array(keep(batch), type=pa.bool_())), df.schema
    )


def in_squares(
    rows: DataFrame, key: str, member: str, size: str, side: int, compare: Callable[[pa.Table], tuple],
    schema: str,
) -> DataFrame:
    """Compare the members of groups of any size with each other, in squares inside tasks.

    `size` is the group's number of rows. Members are dealt into blocks of about `side`, and every
    pair of blocks is a square with the columns of `rows` and `i`, `j` (its blocks) and `own` (the
    row's block). `compare` takes a square as a table and returns the columns of `schema`. A task
    holds one square at a time, whatever the group's size.
    """
    ship(rows.sparkSession)
    arrow = _arrow_schema(rows.sparkSession, schema)
    blocks = F.ceil(F.col(size) / side).cast("int")
    squares = (
        rows.withColumn("blocks", blocks)
        .withColumn("own", F.pmod(F.xxhash64(member), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
        .drop("blocks", "other", size)
    )
    marks = (key, "i", "j")

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None

        def done() -> pa.RecordBatch:
            columns = compare(pa.Table.from_batches(held).combine_chunks())
            arrays = [pa.array(c, type=f.type) for c, f in zip(columns, arrow)]
            return pa.RecordBatch.from_arrays(arrays, schema=arrow)

        for batch in batches:
            if not batch.num_rows:
                continue
            at = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in marks])
            starts = [0, *(np.flatnonzero((at[:, 1:] != at[:, :-1]).any(axis=0)) + 1), batch.num_rows]
            finished = []
            for begin, end in zip(starts, starts[1:]):
                mark = tuple(at[:, begin])
                if mark != last and held:
                    finished.append(done())
                    held = []
                held.append(batch.slice(begin, end - begin))
                last = mark
            if finished:
                yield pa.Table.from_batches(finished).combine_chunks().to_batches()[0] if any(
                    f.num_rows for f in finished
                ) else finished[0]
        if held:
            yield done()
        give_back()

    return squares.repartition(*marks).sortWithinPartitions(*marks).mapInArrow(over, schema)


def spanning(
    ids: np.ndarray, labels: np.ndarray, one: np.ndarray, two: np.ndarray, same: bool,
    near: Callable[[int, np.ndarray], Iterator[int]],
) -> list[tuple[int, int]]:
    """Links that join the groups `labels` of a square's rows, as few as join them.

    `near(at, others)` yields those of `others` that row `at` links with; it is asked only about
    rows of other groups, and groups that a link has joined count as one from then on.
    """
    labels = np.unique(labels, return_inverse=True)[1]
    found = []
    for at in one.tolist():
        others = two[labels[two] != labels[at]]
        others = others[others > at] if same else others
        for other in near(at, others) if len(others) else ():
            if labels[other] != labels[at]:
                found.append((int(ids[at]), int(ids[other])))
                labels[labels == labels[other]] = labels[at]
    return found


def _arrow_schema(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(schema))


def partitions_for(rows: int, per_partition: int) -> int:
    """Number of partitions of at most about `per_partition` rows each."""
    return max(1, -(-rows // per_partition))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components: columns (id, component), component being the smallest id reachable.

    `edges` has two long columns `a` and `b`; NULLs and loops are ignored, repeats are harmless, no
    edges give no rows. Alternates large-star and small-star steps (Kiveris et al., 2014): each
    hangs neighbours of a vertex under their minimum, so the edges never grow in number and the
    rounds grow with the logarithm of the longest path. Only the number of unfinished vertices
    reaches the driver.
    """
    pairs = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u <> v")
    current = materialize(
        pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "edges",
    )
    for _ in range(max_rounds):
        both = current.union(current.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(
            F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e")
        )
        current = materialize(
            small.select(F.col("e.u").alias("u"), F.col("e.m").alias("v")).where("u <> v").distinct(),
            "edges",
        )
        # A forest of stars: every vertex has one edge, to a vertex that has none.
        many = current.groupBy("u").count().where("count > 1").limit(1).count()
        if not many and not current.join(
            current.select(F.col("u").alias("v")).distinct(), "v", "left_semi"
        ).limit(1).count():
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = current.select(F.col("v").alias("id")).distinct()
    return current.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
        roots.select("id", F.col("id").alias("component"))
    )
