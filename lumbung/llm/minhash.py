"""b-bit MinHash near-duplicates: bands propose, packed low bits estimate, full sets confirm.

A document's set are its distinct shingles of five words (ASCII lower case, split at ASCII white
space), each a 64-bit hash; a shorter document has one shingle, its whole sequence of words. Equal
sets fold into one representative first, so exact copies cost one row each. Bands of minima then
gather representatives: every member of a band's bucket is compared with the bucket's smallest
member, which is linear in the bucket; buckets whose other members are still in several components
afterwards have the pairs across components estimated in square blocks, inside tasks, on packed
b-bit signatures. Components that the estimates may link become a cluster with all their members, and
the pairs of a cluster that are still in several components are compared on the full sets, in square blocks again, of which only the
links that join components come back. Every link is confirmed on the full sets.

Defined results: NULL or empty texts and texts without words have no shingles and link with nothing.
Rows that share a doc_id are one document that links where any of its texts does. Rows without a
doc_id are kept and have no component. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumbung.functions.storage import materialize
from lumbung.llm.common import components, in_squares, map_rows, spanning, text_slices

WORDS = 5
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
#: Words whose hashes are kept while a batch is read.
_MEMO = 100_000
#: Bytes of sets that count as one row when the members of a cluster are dealt into blocks.
_ROW_BYTES = 16_384


@dataclass(frozen=True)
class Settings:
    """`bands` bands of `rows` minima out of `minima`, of each of which `bits` low bits are kept.

    The defaults find a pair of similarity 0.75 with a probability above 0.9997. `slack` is what an
    estimate may fall short of the threshold before a pair is dropped: more than four standard
    deviations of the estimate.
    """

    percent: int = 75
    minima: int = 256
    bands: int = 42
    rows: int = 6
    bits: int = 2
    slack: float = 0.16
    block: int = 1024
    seed: int = 7

    def permutations(self) -> tuple[np.ndarray, np.ndarray]:
        rng = np.random.default_rng(self.seed)
        draw = rng.integers(0, 1 << 32, size=(2, self.minima), dtype=np.uint64).astype(np.uint32)
        return draw[0] | np.uint32(1), draw[1]


def _mix(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(32))


def shingles(text: str | None, memo: dict[bytes, int]) -> np.ndarray:
    """Sorted distinct shingle hashes of a text; `memo` keeps word hashes between calls."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(memo) > _MEMO:
        memo.clear()
    hashes = []
    for word in words:
        value = memo.get(word)
        if value is None:
            value = memo[word] = xxhash.xxh3_64_intdigest(word)
        hashes.append(value)
    values = np.array(hashes, np.uint64)
    width = min(WORDS, len(values))
    folded = values[: len(values) - width + 1] + np.uint64(width)
    for place in range(1, width):
        folded = folded * _FACTOR + values[place : len(values) - width + 1 + place]
    return np.unique(_mix(folded))


def _minima(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    low = (values >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(a), 0xFFFFFFFF, np.uint32)
    for start in range(0, len(low), 512):
        block = low[start : start + 512, None] * a
        block += b
        np.minimum(least, block.min(axis=0), out=least)
    return least


def signatures(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, n_shingles, digest (of the set), bands (keys), packed (low bits of the minima)."""

    def sign(batch: pa.RecordBatch) -> dict[str, object]:
        a, b = settings.permutations()
        bands, rows = settings.bands, settings.rows
        memo: dict[bytes, int] = {}
        sizes, digests, minima = [], [], []
        for part in text_slices(batch):
            for text in part.column("text").to_pylist():
                values = shingles(text, memo)
                sizes.append(len(values))
                digests.append(xxhash.xxh3_128_digest(values.tobytes()) if len(values) else None)
                minima.append(_minima(values, a, b))
        table = np.stack(minima)
        keys = np.empty((len(table), bands), np.uint64)
        for band in range(bands):
            key = np.full(len(table), band + 1, np.uint64)
            for row in range(rows):
                key = _mix(key * _FACTOR + table[:, band * rows + row])
            keys[:, band] = key
        signed, sized = keys.view(np.int64), np.array(sizes)
        offsets = np.arange(0, (len(table) + 1) * bands, bands, dtype=np.int32)
        return {
            "doc_id": batch.column("doc_id"), "n_shingles": sized, "digest": digests,
            "bands": pa.ListArray.from_arrays(offsets, signed.ravel()),
            "packed": [bytes(row) for row in pack(table, settings.bits)],
        }

    return map_rows(
        docs.select("doc_id", "text"), sign,
        "doc_id long, n_shingles long, digest binary, bands array<long>, packed binary",
    )


def pack(minima: np.ndarray, bits: int) -> np.ndarray:
    """The low `bits` bits of every minimum, one row of bytes each."""
    mixed = _mix(minima.astype(np.uint64))
    planes = [((mixed >> np.uint64(bit)) & np.uint64(1)).astype(np.uint8) for bit in range(bits)]
    return np.concatenate([np.packbits(plane, axis=1) for plane in planes], axis=1)


def estimate(left: np.ndarray, right: np.ndarray, minima: int, bits: int) -> np.ndarray:
    """Similarity of packed rows, corrected for minima that differ but share their low bits."""
    differ = left ^ right
    width = differ.shape[-1] // bits
    any_bit = differ[..., :width]
    for bit in range(1, bits):
        any_bit = any_bit | differ[..., bit * width : (bit + 1) * width]
    same = 1.0 - np.bitwise_count(any_bit).sum(axis=-1, dtype=np.int64) / minima
    chance = 2.0**-bits
    return (same - chance) / (1.0 - chance)


def _matrix(column: pa.Array) -> np.ndarray:
    items = column.to_pylist()
    return np.frombuffer(b"".join(items), np.uint8).reshape(len(items), -1)


def _estimated(pairs: DataFrame, packed: DataFrame, settings: Settings) -> DataFrame:
    """Pairs (a, b) whose estimate does not rule the threshold out."""

    def passing(batch: pa.RecordBatch) -> dict[str, object]:
        found = estimate(
            _matrix(batch.column("pa")), _matrix(batch.column("pb")), settings.minima, settings.bits
        )
        keep = pa.array(found >= settings.percent / 100 - settings.slack)
        return {name: batch.column(name).filter(keep) for name in ("a", "b")}

    left = packed.select(F.col("doc_id").alias("a"), F.col("packed").alias("pa"))
    right = packed.select(F.col("doc_id").alias("b"), F.col("packed").alias("pb"))
    return map_rows(pairs.join(left, "a").join(right, "b"), passing, "a long, b long").distinct()


def _linked(x: np.ndarray, y: np.ndarray, settings: Settings) -> bool:
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= settings.percent * (len(x) + len(y) - common)


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """id and items (shingles) of the documents whose doc_id is in `wanted`.

    The list of ids grows with the table, so it is merged with the documents, never broadcast.
    """
    def sets(batch: pa.RecordBatch) -> dict[str, object]:
        memo: dict[bytes, int] = {}
        return {
            "id": batch.column("doc_id"),
            "items": [shingles(text, memo).view(np.int64) for text in batch.column("text").to_pylist()],
        }

    chosen = docs.select("doc_id", "text").join(wanted.distinct().hint("merge"), "doc_id", "left_semi")
    return map_rows(chosen, sets, "id long, items array<long>")


def _confirmed(pairs: DataFrame, docs: DataFrame, settings: Settings) -> DataFrame:
    """Pairs (a, b) with 100 * intersection >= percent * union on the full sets."""

    def confirm(batch: pa.RecordBatch) -> dict[str, object]:
        keep = [
            _linked(x.values.to_numpy(), y.values.to_numpy(), settings)
            for x, y in zip(batch.column("ia"), batch.column("ib"))
        ]
        return {name: batch.column(name).filter(pa.array(keep)) for name in ("a", "b")}

    wanted = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b"))
    held = materialize(_sets(docs, wanted), "sets")
    left = held.select(F.col("id").alias("a"), F.col("items").alias("ia"))
    right = held.select(F.col("id").alias("b"), F.col("items").alias("ib"))
    return map_rows(pairs.join(left, "a").join(right, "b"), confirm, "a long, b long").distinct()


def _sides(square: pa.Table) -> tuple[np.ndarray, np.ndarray, bool]:
    """Rows of a square's two blocks, and whether they are the same block."""
    own = square.column("own").to_numpy()
    i, j = square.column("i")[0].as_py(), square.column("j")[0].as_py()
    return np.flatnonzero(own == i), np.flatnonzero(own == j), i == j


def _likely(buckets: DataFrame, settings: Settings) -> DataFrame:
    """Links (a, b) that join whatever the estimate may link across components in a bucket."""
    threshold, minima, bits = settings.percent / 100 - settings.slack, settings.minima, settings.bits

    def compare(square: pa.Table) -> tuple:
        labels = square.column("component").to_numpy()
        if labels.min() == labels.max():
            return (), ()
        packed = _matrix(square.column("packed"))

        def near(at: int, others: np.ndarray) -> np.ndarray:
            return others[estimate(packed[at], packed[others], minima, bits) >= threshold]

        links = spanning(square.column("id").to_numpy(), labels, *_sides(square), near)
        return [a for a, _ in links], [b for _, b in links]

    found = in_squares(buckets, "key", "id", "n", settings.block, compare, "a long, b long")
    return found.distinct()


def _exact(clusters: DataFrame, settings: Settings) -> DataFrame:
    """Links (a, b), confirmed on the full sets, that join components within a cluster."""
    threshold, minima, bits = settings.percent / 100 - settings.slack, settings.minima, settings.bits

    def compare(square: pa.Table) -> tuple:
        labels = square.column("component").to_numpy()
        if labels.min() == labels.max():
            return (), ()
        packed = _matrix(square.column("packed"))
        lists = square.column("items").combine_chunks()
        values, ends = lists.flatten().to_numpy(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
        sets = [values[a:b] for a, b in zip(ends, ends[1:])]

        def near(at: int, others: np.ndarray) -> Iterator[int]:
            likely = estimate(packed[at], packed[others], minima, bits) >= threshold
            return (int(other) for other in others[likely] if _linked(sets[at], sets[other], settings))

        links = spanning(square.column("id").to_numpy(), labels, *_sides(square), near)
        return [a for a, _ in links], [b for _, b in links]

    found = in_squares(clusters, "cluster", "id", "n", settings.block, compare, "a long, b long")
    return found.distinct()


def near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of `docs`."""
    signed = materialize(signatures(docs, settings), "signatures")
    linked = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    folded = materialize(linked.groupBy("digest").agg(F.min("doc_id").alias("id")), "folded")
    heads = materialize(
        linked.join(folded.withColumnRenamed("id", "doc_id"), ["digest", "doc_id"], "left_semi")
        .dropDuplicates(["digest", "doc_id"])
        .select("doc_id", "n_shingles", "bands", "packed"),
        "heads",
    )
    members = heads.select("doc_id", F.explode("bands").alias("key")).distinct()
    sizes = members.groupBy("key").agg(F.min("doc_id").alias("centre"), F.count(F.lit(1)).alias("n"))
    buckets = materialize(
        members.join(sizes.where("n > 1"), "key").where("doc_id <> centre"), "buckets"
    )
    packed = heads.select("doc_id", "packed")
    stars = buckets.select(F.col("doc_id").alias("a"), F.col("centre").alias("b")).distinct()
    links = materialize(_confirmed(materialize(_estimated(stars, packed, settings), "pairs"), docs, settings), "links")

    # Two texts under one doc_id are one document, so every fold under it is linked too.
    labels = components(links)
    labelled = buckets.where("n > 2").join(
        labels.select(F.col("id").alias("doc_id"), "component"), "doc_id", "left"
    ).withColumn("component", F.coalesce("component", "doc_id"))
    open_ = labelled.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"))
    likely = materialize(
        _likely(
            labelled.join(open_.where("x <> y").select("key"), "key", "left_semi")
            .join(packed, "doc_id")
            .select("key", F.col("doc_id").alias("id"), "component", "packed", "n"),
            settings,
        ),
        "likely",
    )
    # An estimated link stands for all pairs of the components it joins, so a cluster takes in every
    # member of a confirmed component it touches: whatever else may be linked lies within a cluster.
    # Those with an estimated link are compared on the full sets; the others are one component.
    joined = components(likely.union(links)).withColumnRenamed("component", "cluster")
    touched = joined.join(likely.select(F.col("a").alias("id")), "id", "left_semi").select("cluster")
    clusters = materialize(joined.join(touched.distinct(), "cluster", "left_semi"), "clusters")
    # Blocks are bounded by rows and by bytes: long sets count as several rows.
    bytes_ = F.ceil(F.sum(F.col("n_shingles") * 8) / _ROW_BYTES)
    weights = (
        clusters.join(heads.select(F.col("doc_id").alias("id"), "n_shingles"), "id")
        .groupBy("cluster").agg(F.greatest(F.count(F.lit(1)), bytes_).cast("int").alias("n"))
    )
    sized = clusters.join(weights, "cluster")
    members = (
        sized.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
        .join(packed.withColumnRenamed("doc_id", "id"), "id")
        .join(_sets(docs, clusters.select(F.col("id").alias("doc_id"))), "id")
    )
    more = materialize(_exact(members, settings), "links")

    copies = linked.join(folded, "digest").select(F.col("doc_id").alias("a"), F.col("id").alias("b"))
    several = copies.groupBy("a").agg(F.min("b").alias("x"), F.max("b").alias("y")).where("x <> y")
    shared = copies.join(several.select("a"), "a", "left_semi")
    final = components(links.union(more).union(shared))
    by_fold = folded.join(final, "id", "left").select(
        "digest", F.coalesce("component", "id").alias("fold")
    )
    rows = signed.select("doc_id", "n_shingles", "digest").join(by_fold, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("fold", "doc_id"))
    return rows.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        component.eqNullSafe(F.col("doc_id")).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows and columns of `docs`, one document of each group: that with the smallest doc_id."""
    others = materialize(
        near_duplicates(docs, settings).where("NOT kept").select(F.col("doc_id").alias("_lb_other")).distinct(),
        "copies",
    )
    return docs.join(others, F.col("doc_id") == F.col("_lb_other"), "left_anti")
