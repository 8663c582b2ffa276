"""Hard negatives by exact integer scores, multiplied in a residue number system.

Vectors are whole numbers. A block of anchors and a block of rows are multiplied once per small prime,
in float32 on centred residues, which is exact as long as no sum passes 2^24. Chinese remaindering
puts the residues together to the signed score; as many primes are taken as the largest norm demands.
Blocks of bounded size meet inside tasks, which return only the best few of each anchor, so neither
scores nor groups of a label are ever held whole. The first pass finds the positives of an anchor, the
second the negatives whose score lies in the window that each positive opens.

Defined results: rows without a vec_id, a label or a vector, or with a NULL or non-finite component,
take no part. Rows equal in vec_id, label and vector are one row; rows that only share a vec_id are
rows of their own, and none is "other" to its own vec_id. Vectors are compared with vectors of their
length, empty ones score 0. Scores of 2^55 and more in size are refused with an error. An empty table
gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumbung.functions.storage import materialize
from lumbung.llm.common import ship

#: float32 holds every whole number up to here.
_EXACT = 1 << 24
#: Scores times 100 still fit a long below this.
_LARGEST = 1 << 55


class Residues:
    """Products of whole-number matrices whose entries stay within `bound` in size."""

    def __init__(self, bound: int):
        self.primes: list[int] = []
        product, candidate = 1, 256
        while product <= 2 * bound:
            candidate -= 1
            if all(candidate % k for k in range(2, math.isqrt(candidate) + 1)):
                self.primes.append(candidate)
                product *= candidate
        self.modulus = product

    def split(self, matrix: np.ndarray) -> list[np.ndarray]:
        """Centred residues of the matrix, one float32 matrix per prime."""
        parts = []
        for prime in self.primes:
            part = matrix % prime
            part -= prime * (part > prime // 2)
            parts.append(part.astype(np.float32))
        return parts

    def product(self, left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
        """left @ right.T of two split matrices, exact, as int64."""
        value = np.zeros((len(left[0]), len(right[0])), np.int64)
        scale = 1
        for prime, a, b in zip(self.primes, left, right):
            digit = (self._residue(prime, a, b) - value) % prime
            value += digit * pow(scale, -1, prime) % prime * scale
            scale *= prime
        value[value > scale // 2] -= scale
        return value

    @staticmethod
    def _residue(prime: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        step = _EXACT // (prime // 2) ** 2
        total = np.zeros((len(a), len(b)), np.int64)
        for start in range(0, a.shape[1], step):
            total += (a[:, start : start + step] @ b[:, start : start + step].T).astype(np.int64)
        return total


def prepare(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """Columns vec_id, label and x, the components as whole numbers floor(scale * component)."""
    odd = F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return (
        vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull())
        .where(F.col("embedding").isNotNull() & ~odd)
        .select(
            F.col("vec_id").cast("long").alias("vec_id"),
            F.col("label").cast("long").alias("label"),
            F.transform("embedding", lambda v: F.floor(v.cast("double") * scale)).alias("x"),
        )
    )


def best(score: np.ndarray, places: np.ndarray, count: int) -> np.ndarray:
    """Those `count` of `places` with the highest scores, highest first, ties by place."""
    if len(places) > count:
        held = score[places]
        places = places[held >= np.partition(held, len(held) - count)[-count]]
    return places[np.argsort(-score[places], kind="stable")][:count]


def _matrix(table: pa.Table, width: int) -> np.ndarray:
    return table.column("x").combine_chunks().flatten().to_numpy().reshape(table.num_rows, width)


def _blocks(rows: DataFrame, count: int, own: str, other: str, others: int) -> DataFrame:
    """Rows dealt into `count` blocks (`own`), each meeting every block of the other side (`other`)."""
    return rows.withColumn(own, F.pmod(F.xxhash64("vec_id", "version"), F.lit(count)).cast("int")).withColumn(
        other, F.explode(F.sequence(F.lit(0), F.lit(others - 1)))
    )


def mine(
    rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
    block: int = 1 << 22,
) -> DataFrame:
    """Negatives of every anchor and positive: rank from 1, with both scores.

    `rows` are as `prepare` returns them and `anchor` says which of them are anchors. Positives are
    the best `positives` rows of the anchor's label; negatives, of other labels, have a score between
    `low` and `high` hundredths of the positive's. `block` is the most components in a block.
    """
    spark = rows.sparkSession
    ship(spark)
    held = materialize(
        rows.select("vec_id", "label", "x").distinct()
        .select("*", F.size("x").alias("width"), F.xxhash64("label", "x").alias("version"),
                F.coalesce(anchor, F.lit(False)).alias("anchor")),
        "whole-numbers",
    )
    norm = F.aggregate("x", F.lit(0.0), lambda total, v: total + v.cast("double") * v.cast("double"))
    seen = held.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if("anchor").alias("anchors"),
        F.max("width").alias("width"), F.max(norm).alias("norm"),
    ).first()
    bound = seen.norm or 0.0
    if not bound < _LARGEST:
        raise ValueError(f"scores of up to {bound:.3g} do not fit; scale the vectors down")
    system = Residues(int(bound * 1.000001) + 1)
    per_block = max(1, block // max(1, seen.width or 1))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Four blocks a task at least, so that tasks are even.
    row_blocks = max(-(-seen.rows // per_block), 4 * parts)
    anchor_blocks = max(1, -(-seen.anchors // per_block))
    square = ("width", "i", "j")
    right = _blocks(held.drop("anchor"), row_blocks, "j", "i", anchor_blocks).groupBy(*square)

    def scores(anchors: pa.Table, others: pa.Table, width: int):
        """Anchor by anchor: its place, and its scores with `others`."""
        one, two = system.split(_matrix(anchors, width)), system.split(_matrix(others, width))
        step = max(1, (1 << 21) // max(1, others.num_rows))
        for start in range(0, anchors.num_rows, step):
            found = system.product([part[start : start + step] for part in one], two)
            yield from enumerate(found, start)

    def near(key: tuple, anchors: pa.Table, others: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if anchors.num_rows and others.num_rows:
            others = others.sort_by("vec_id")
            ids, labels = others.column("vec_id").to_numpy(), others.column("label").to_numpy()
            who = anchors.select(["vec_id", "version", "label"]).to_pylist()
            for at, score in scores(anchors, others, key[0].as_py()):
                own = who[at]
                same = np.flatnonzero((labels == own["label"]) & (ids != own["vec_id"]))
                for place in best(score, same, positives):
                    out.append((own["vec_id"], own["version"], int(ids[place]), int(score[place])))
        return _table(out, anchor_id=pa.int64(), version=pa.int64(), positive_id=pa.int64(), positive_score=pa.int64())

    left = held.where("anchor").drop("anchor")
    found = (
        _blocks(left, anchor_blocks, "i", "j", row_blocks).groupBy(*square).cogroup(right)
        .applyInArrow(near, "anchor_id long, version long, positive_id long, positive_score long")
    )
    order = Window.partitionBy("anchor_id", "version").orderBy(F.desc("positive_score"), "positive_id")
    chosen = (
        found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives)
        .groupBy(F.col("anchor_id").alias("vec_id"), "version")
        .agg(F.sort_array(F.collect_list(F.struct("place", "positive_id", "positive_score"))).alias("positives"))
    )
    opened = materialize(left.join(chosen, ["vec_id", "version"]), "positives")

    def hard(key: tuple, anchors: pa.Table, others: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if anchors.num_rows and others.num_rows:
            others = others.sort_by("vec_id")
            ids, labels = others.column("vec_id").to_numpy(), others.column("label").to_numpy()
            who = anchors.select(["vec_id", "version", "label", "positives"]).to_pylist()
            for at, score in scores(anchors, others, key[0].as_py()):
                own = who[at]
                rest = np.flatnonzero(labels != own["label"])
                hundred = 100 * score[rest]
                for one in own["positives"]:
                    limit = one["positive_score"]
                    inside = rest[(hundred >= low * limit) & (hundred <= high * limit)]
                    for place in best(score, inside, negatives):
                        out.append((
                            own["vec_id"], own["version"], one["place"], one["positive_id"], limit,
                            int(ids[place]), int(score[place]),
                        ))
        return _table(
            out, anchor_id=pa.int64(), version=pa.int64(), place=pa.int32(), positive_id=pa.int64(),
            positive_score=pa.int64(), negative_id=pa.int64(), negative_score=pa.int64(),
        )

    pairs = (
        _blocks(opened, anchor_blocks, "i", "j", row_blocks).groupBy(*square).cogroup(right)
        .applyInArrow(
            hard,
            "anchor_id long, version long, place int, positive_id long, positive_score long, "
            "negative_id long, negative_score long",
        )
    )
    order = Window.partitionBy("anchor_id", "version", "place").orderBy(F.desc("negative_score"), "negative_id")
    return (
        pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )


def _table(rows: list[tuple], **kinds: pa.DataType) -> pa.Table:
    columns = list(zip(*rows)) or [()] * len(kinds)
    return pa.table([pa.array(c, kind) for c, kind in zip(columns, kinds.values())], names=list(kinds))
