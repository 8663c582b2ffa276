"""SpotSigs fingerprints: chains of content words after common-word anchors.

Every occurrence of a common word is an anchor; with the next `CHAIN` words that are not common it
forms a signature, hashed to 64 bits. A fingerprint is the set of a text's signatures; a text that
has words but no full chain has one signature, its whole sequence of words. Likeness is the Jaccard
similarity of two fingerprints.

Defined results: a NULL text is an empty one; a text without words has the empty fingerprint, which
is like itself alone (1) and like no other (0). The next document is the one with the next smaller
doc_id, after the last the first; rows that repeat a doc_id follow by a hash of their text, rows
without a doc_id come last. A single row is its own next.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumbung.functions.storage import materialize
from lumbung.llm.common import map_rows, partitions_for, ship

#: Common words of English, French, German and Spanish (fixed values).
ANCHORS = frozenset(
    "the of and to in is was that for with as by on at it are be this from or an a "
    "le la les de des du un une et est que qui en au aux pour dans sur par avec "
    "der die das und zu von ist den dem ein eine mit sich auf als auch nicht im "
    "el los las y es una con por para se lo del al su como no".split()
)
CHAIN = 2
_STRIP = ".,;:!?\"'()[]{}<>|#$%&*-_=+~^/\\"
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_LEAST_ID = -(1 << 63)
_ROW = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _mix(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(29))


def fingerprints(texts: list[str]) -> list[np.ndarray]:
    """Sorted distinct signatures of each text."""
    if not texts:
        return []
    words = pc.ascii_split_whitespace(pc.utf8_lower(pa.array(texts, pa.large_string())))
    coded = words.flatten().dictionary_encode()
    plain = [word.strip(_STRIP) for word in coded.dictionary.to_pylist()]
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in plain), np.uint64, len(plain))
    kinds = np.fromiter(((0 if not w else 1 if w in ANCHORS else 2) for w in plain), np.int8, len(plain))
    codes = coded.indices.to_numpy()
    bounds = words.offsets.to_numpy() - words.offsets[0].as_py()
    kind, value = kinds[codes], hashes[codes]
    content = np.flatnonzero(kind == 2)
    anchors = np.flatnonzero(kind == 1)
    first = np.searchsorted(content, anchors)
    whole = first + CHAIN <= len(content)
    anchors, first = anchors[whole], first[whole]
    owner = np.searchsorted(bounds, anchors, side="right") - 1
    if len(anchors):
        inside = content[first + CHAIN - 1] < bounds[owner + 1]
        anchors, first, owner = anchors[inside], first[inside], owner[inside]
    signature = value[anchors] + np.uint64(1)
    for step in range(CHAIN):
        signature = _mix(signature * _FACTOR + value[content[first + step]])
    edges = np.searchsorted(owner, np.arange(len(texts) + 1))
    found = []
    for row in range(len(texts)):
        own = np.unique(signature[edges[row] : edges[row + 1]])
        if not len(own):
            rest = value[bounds[row] : bounds[row + 1]][kind[bounds[row] : bounds[row + 1]] > 0]
            rest = rest if len(rest) else value[bounds[row] : bounds[row + 1]]
            if len(rest):
                own = np.array([xxhash.xxh3_64_intdigest(rest.tobytes())], np.uint64)
        found.append(own)
    return found


def likeness(one: np.ndarray, two: np.ndarray) -> float:
    """Jaccard similarity of two sorted signature sets; two empty ones are alike."""
    if not len(one) or not len(two):
        return float(len(one) == len(two))
    common = len(np.intersect1d(one, two, assume_unique=True))
    return common / (len(one) + len(two) - common)


def digest(signatures: np.ndarray) -> str:
    """A fingerprint as text: the size of the set and a hash of it."""
    return f"{len(signatures)}:{hashlib.blake2b(signatures.tobytes(), digest_size=16).hexdigest()}"


def signature_sets(docs: DataFrame) -> DataFrame:
    """doc_id and signatures (sorted, distinct) of every text."""

    def over(batch: pa.RecordBatch) -> dict[str, object]:
        found = fingerprints([text or "" for text in batch.column("text").to_pylist()])
        return {"doc_id": batch.column("doc_id"), "signatures": [s.view(np.int64) for s in found]}

    return map_rows(docs.select("doc_id", "text"), over, "doc_id long, signatures array<long>")


def similar_pairs(docs: DataFrame, threshold: float = 0.75) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b, likeness) of classes at least `threshold` alike, and the classes' members.

    A class is a set of documents with equal fingerprints, named by its smallest doc_id; members are
    rows (doc_id, class_id). Fingerprints of n signatures can only be alike to those of `threshold`
    times n or more, so they are parted by length into ranges, of which only neighbours meet, and two
    such sets share one of their rarest signatures, which are the join keys.
    """
    sets = materialize(
        signature_sets(docs).where("doc_id IS NOT NULL AND size(signatures) > 0")
        .withColumn("n", F.size("signatures")).withColumn("key", F.sha2(F.to_json("signatures"), 256)),
        "signatures",
    )
    classes = materialize(sets.groupBy("key").agg(F.min("doc_id").alias("class_id")), "classes")
    members = sets.join(classes, "key").select("doc_id", "class_id")
    heads = sets.join(classes, "key").where("doc_id = class_id").dropDuplicates(["key"])
    single = heads.select("class_id", "n", F.explode("signatures").alias("s"))
    counts = single.groupBy("s").agg(F.count(F.lit(1)).alias("often"))
    ranked = single.join(counts, "s").groupBy("class_id", "n").agg(
        F.array_sort(F.collect_list(F.struct("often", "s"))).alias("ordered")
    )
    keep = F.col("n") - F.ceil(F.col("n") * threshold).cast("int") + 1
    part = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1 / threshold))).cast("long")
    short = ranked.select(
        "class_id", "n", part.alias("part"), F.explode(F.slice("ordered", 1, keep)).alias("o")
    ).select("class_id", "n", "part", F.col("o.s").alias("s"))
    near = short.withColumn("part", F.explode(F.array(F.col("part"), F.col("part") + 1)))
    one = near.select("s", "part", F.col("class_id").alias("a"), F.col("n").alias("na"))
    two = short.select("s", "part", F.col("class_id").alias("b"), F.col("n").alias("nb"))
    # The shorter set stands left; its own range and the next hold all that are long enough.
    met = one.join(two, ["s", "part"]).where(
        (F.col("na") >= F.col("nb") * threshold)
        & ((F.col("na") < F.col("nb")) | (F.col("na") == F.col("nb")) & (F.col("a") < F.col("b")))
    )
    pairs = met.select("a", "b").distinct()
    held = heads.select("class_id", "signatures")
    both = pairs.join(held.toDF("a", "x"), "a").join(held.toDF("b", "y"), "b")
    common = F.size(F.array_intersect("x", "y"))
    alike = common / (F.size("x") + F.size("y") - common)
    return both.select("a", "b", alike.alias("likeness")).where(F.col("likeness") >= threshold), members


def edited_likeness(docs: DataFrame, per_block: int = 500, most_blocks: int = 20_000) -> DataFrame:
    """Each document against its edited text and against the next one; columns of `_ROW`.

    Documents are dealt into blocks of doc_ids; the first of each block also goes to the block
    before, as what follows its last. A task walks its blocks in order and holds one Arrow batch and
    one document more, so a block's size does not bound it. Only the cuts reach the driver.
    """
    spark = docs.sparkSession
    ship(spark)
    key = F.coalesce("doc_id", F.lit(_LEAST_ID))
    ids = docs.select(key.alias("key"))
    blocks = min(most_blocks, partitions_for(ids.count(), per_block))
    shares = [i / blocks for i in range(1, blocks)]
    cuts = ids.agg(F.percentile_approx("key", shares, 10_000)).first()[0] if shares else []
    cuts = np.unique(np.array(cuts or [], np.int64))

    @F.pandas_udf("int")
    def block_of(values: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, values.to_numpy(np.int64)).astype(np.int32))

    firsts = sorted(
        (row.block, row.first)
        for row in ids.groupBy(block_of("key").alias("block")).agg(F.max("key").alias("first")).collect()
    )
    above = {first: firsts[(place + 1) % len(firsts)][0] for place, (_, first) in enumerate(firsts)}

    @F.pandas_udf("array<struct<block:int,extra:int>>")
    def places(values: pd.Series) -> pd.Series:
        own = np.searchsorted(cuts, values.to_numpy(np.int64)).tolist()
        return pd.Series(
            [
                [{"block": b, "extra": 0}] + ([{"block": above[v], "extra": 1}] if v in above else [])
                for b, v in zip(own, values.tolist())
            ]
        )

    text = F.coalesce("text", F.lit(""))
    dealt = (
        docs.select("doc_id", text.alias("text"), key.alias("key"), F.xxhash64(text).alias("h"))
        .withColumn("p", F.explode(places("key")))
        .select("doc_id", "text", "key", "h", F.col("p.block").alias("block"), F.col("p.extra").alias("extra"))
        .repartition(max(1, len(cuts) + 1), "block")
        .sortWithinPartitions("block", "extra", F.desc("key"), F.desc("h"))
    )

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch if held is None else pa.concat_batches([held, batch])
            yield compare(rows)
            held = rows.slice(rows.num_rows - 1)

    def compare(rows: pa.RecordBatch) -> pa.RecordBatch:
        """Every row but the last against the row after it, which is in the same block."""
        texts, ids = rows.column("text").to_pylist(), rows.column("doc_id").to_pylist()
        own = [at for at, extra in enumerate(rows.column("extra").to_pylist()[:-1]) if not extra]
        edited = [texts[at][: len(texts[at]) - len(texts[at]) // 3] + texts[at + 1][: len(texts[at]) // 3] for at in own]
        plain, changed = fingerprints(texts), fingerprints(edited)
        columns = [
            [ids[at] for at in own],
            [len(texts[at]) for at in own],
            [hashlib.sha256(text.encode()).hexdigest() for text in edited],
            [digest(plain[at]) for at in own],
            [digest(signatures) for signatures in changed],
            [likeness(plain[at], other) for at, other in zip(own, changed)],
            [likeness(plain[at], plain[at + 1]) for at in own],
        ]
        names = [part.split()[0] for part in _ROW.split(", ")]
        types = [pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return dealt.mapInArrow(over, _ROW)
