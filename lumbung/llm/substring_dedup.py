"""Substring dedup on fixed-block anchors: words of passages that an earlier document holds go.

A passage counts from `window` words on. Reference blocks are the non-overlapping blocks of half a
window of every document, so that each window, wherever it stands, holds one whole. Blocks are
indexed by hash, and every rolling window of a block's length in every document probes the index. A
hit is extended: of the windows around it, fingerprints of 128 bits are compared with those around
all other hits, and consecutive matches make up the maximal exact repeats. Repeats are judged on the
input, so a word stays if no window over it begins in a document with a smaller doc_id.

Texts are packed once into compressed groups, a row each. A group asks about its hashes bucket by
bucket: it sends the sorted distinct hashes of a bucket as one binary, and gets one bit for each
back. So a passage of any frequency is one entry per group, and a bucket's size follows from the
number of buckets, which grows with the text. Which bits belong to which words is found by reading
the group again.

Defined results: a NULL text has no words and stays NULL, an empty one stays empty. Documents shorter
than the window keep everything and remove nothing. Rows that share a doc_id do not remove from each
other. Rows without a doc_id keep everything and remove nothing. Memory of a task grows with the
longest single text, not with the table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumbung.functions.storage import materialize
from lumbung.llm.common import map_rows, ship, text_slices

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_DRAW = np.random.default_rng(20_11)
#: Two independent fingerprints: a random number per byte, an odd multiplier per byte and per word.
_BYTES = _DRAW.integers(0, 1 << 64, (2, 256), np.uint64)
_STEP = _DRAW.integers(0, 1 << 61, (2, 2), np.uint64) * np.uint64(8) + np.uint64(3)
_AT_ONCE = 1 << 20

GROUP = "group long"
ASK = "bucket int, group long, one binary, two binary, three binary"
ANSWER = "group long, bucket int, bits binary"


def _powers(lane: int, level: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The multiplier's powers from 0 on, and those of its inverse modulo 2^64."""
    step = int(_STEP[lane, level])
    both = []
    for base in (step, pow(step, -1, 1 << 64)):
        line = np.full(count, base, np.uint64)
        line[:1] = 1
        both.append(np.cumprod(line))
    return both[0], both[1]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class Words:
    """The words of a group of texts: byte ranges, document of each, and rolling fingerprints."""

    def __init__(self, data: np.ndarray, ends: np.ndarray):
        self.data = data
        solid = ~_SPACE[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[ends] = True
        edge[0] = True
        before = np.r_[True, ~solid[:-1]] if len(data) else solid
        after = np.r_[~solid[1:], True] if len(data) else solid
        self.starts = np.flatnonzero(solid & (before | edge[:-1]))
        self.stops = np.flatnonzero(solid & (after | edge[1:])) + 1
        self.doc = np.searchsorted(ends, self.starts, "right").astype(np.int32)
        #: First word of each document, and one past the last word of all.
        self.first = np.searchsorted(self.doc, np.arange(len(ends) + 1))

    def hashes(self, lane: int) -> np.ndarray:
        """A fingerprint of every word, a slice of the bytes at a time."""
        out = np.empty(len(self.starts), np.uint64)
        begin = 0
        while begin < len(out):
            base = self.starts[begin]
            end = max(begin + 1, int(np.searchsorted(self.stops, base + _AT_ONCE, "right")))
            part = self.data[base : self.stops[end - 1]]
            up, down = _powers(lane, 0, len(part) + 1)
            total = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(_BYTES[lane][part] * up[:-1], out=total[1:])
            a, b = self.starts[begin:end] - base, self.stops[begin:end] - base
            out[begin:end] = _mixed((total[b] - total[a]) * down[a] + (b - a).astype(np.uint64))
            begin = end
        return out

    def rolling(self, word_hashes: np.ndarray, lane: int, size: int) -> np.ndarray:
        """A fingerprint of the `size` words from each word on that many follow."""
        count = max(0, len(word_hashes) - size + 1)
        up, down = _powers(lane, 1, len(word_hashes) + 1)
        total = np.zeros(len(word_hashes) + 1, np.uint64)
        np.cumsum(word_hashes * up[:-1], out=total[1:])
        return _mixed((total[size : size + count] - total[:count]) * down[:count])

    def within(self, size: int) -> np.ndarray:
        """Whether the `size` words from a word on are of one document."""
        count = max(0, len(self.doc) - size + 1)
        return self.doc[:count] == self.doc[size - 1 : size - 1 + count]


class Probes:
    """What a group asks first: its rolling blocks, the reference blocks among them marked."""

    def __init__(self, words: Words, buckets: int, block: int):
        self.words, self.block = words, block
        self.lane = words.hashes(0)
        rolled = words.rolling(self.lane, 0, block)
        self.at = np.flatnonzero(words.within(block))
        rolled = rolled[self.at]
        bucket = (rolled >> np.uint64(32)) % np.uint64(buckets)
        key = (bucket << np.uint64(32)) | (rolled & np.uint64(0xFFFFFFFF))
        aligned = (self.at - words.first[words.doc[self.at]]) % block == 0
        self.keys, self.back, counts = np.unique(key, return_inverse=True, return_counts=True)
        self.many = counts > 1
        self.aligned = np.zeros(len(self.keys), bool)
        self.aligned[self.back[aligned]] = True
        self.bucket = (self.keys >> np.uint64(32)).astype(np.int64)

    def cells(self) -> Iterator[tuple]:
        for number, a, b in _stretches(self.bucket):
            yield (
                number, self.keys[a:b].astype(np.uint32).tobytes(), np.packbits(self.aligned[a:b]).tobytes(),
                np.packbits(self.many[a:b]).tobytes(),
            )

    def hits(self, answers: dict[int, bytes]) -> np.ndarray:
        """Of every word, whether a block that begins there hit the index."""
        live = np.zeros(len(self.words.starts), bool)
        live[self.at] = _bits(self.bucket, answers)[self.back]
        return live


class Extensions:
    """What a group asks next: the windows that hold a hit, each with its smallest doc_id here."""

    def __init__(self, probes: Probes, hits: np.ndarray, ids: np.ndarray, known: np.ndarray, buckets: int, window: int):
        words = probes.words
        inside = words.within(window)
        seen = np.r_[0, np.cumsum(hits)]
        reach = window - probes.block + 1
        count = len(inside)
        held = inside & (seen[reach : reach + count] > seen[:count]) & known[words.doc[:count]]
        self.at = np.flatnonzero(held)
        one = words.rolling(probes.lane, 0, window)[self.at]
        two = words.rolling(words.hashes(1), 1, window)[self.at]
        self.ids = ids[words.doc[self.at]]
        bucket = (one >> np.uint64(32)) % np.uint64(buckets)
        order = np.lexsort((self.ids, two, one, bucket))
        one, two, bucket = one[order], two[order], bucket[order]
        new = np.ones(len(order), bool)
        new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        self.back = np.empty(len(order), np.int64)
        self.back[order] = np.cumsum(new) - 1
        self.one, self.two, self.least = one[new], two[new], self.ids[order][new]
        self.bucket = bucket[new].astype(np.int64)

    def cells(self) -> Iterator[tuple]:
        for number, a, b in _stretches(self.bucket):
            yield number, self.one[a:b].tobytes(), self.two[a:b].tobytes(), self.least[a:b].tobytes()

    def repeated(self, answers: dict[int, bytes]) -> np.ndarray:
        """First words of the windows that begin in a document with a smaller doc_id, too."""
        earlier = _bits(self.bucket, answers)[self.back] | (self.ids > self.least[self.back])
        return self.at[earlier]


def _stretches(bucket: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(value, start, end) of each run of equal values."""
    edges = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(bucket)]
    for a, b in zip(edges, edges[1:]):
        if b > a:
            yield int(bucket[a]), a, b


def _bits(bucket: np.ndarray, answers: dict[int, bytes]) -> np.ndarray:
    """The answered bits in the order of what was asked; a bucket without an answer has none set."""
    out = np.zeros(len(bucket), bool)
    for number, a, b in _stretches(bucket):
        if number in answers:
            out[a:b] = np.unpackbits(np.frombuffer(answers[number], np.uint8), count=b - a)
    return out


def _joined(asked: pa.Table, column: str, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """All cells' entries of a column in one array, and where each cell begins in it."""
    parts = [np.frombuffer(cell, kind) for cell in asked.column(column).to_pylist()]
    return np.concatenate(parts), np.r_[0, np.cumsum([len(part) for part in parts])]


def _answer(asked: pa.Table, found: np.ndarray, begins: np.ndarray) -> pa.Table:
    groups, numbers = asked.column("group").to_pylist(), asked.column("bucket").to_pylist()
    rows = [
        (group, number, np.packbits(found[a:b]).tobytes())
        for group, number, a, b in zip(groups, numbers, begins, begins[1:])
        if found[a:b].any()
    ]
    columns = list(zip(*rows)) or [(), (), ()]
    kinds = (pa.int64(), pa.int32(), pa.binary())
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=["group", "bucket", "bits"])


def probe(asked: pa.Table) -> pa.Table:
    """Of a bucket's hashes, those of a reference block that occur more than once."""
    value, begins = _joined(asked, "one", np.uint32)
    sizes = np.diff(begins)
    flags = [
        np.concatenate([
            np.unpackbits(np.frombuffer(cell, np.uint8), count=size)
            for cell, size in zip(asked.column(name).to_pylist(), sizes)
        ]).astype(bool)
        for name in ("two", "three")
    ]
    _, back, counts = np.unique(value, return_inverse=True, return_counts=True)
    indexed, many = np.zeros(len(counts), bool), counts > 1
    indexed[back[flags[0]]] = True
    many[back[flags[1]]] = True
    return _answer(asked, (indexed & many)[back], begins)


def earliest(asked: pa.Table) -> pa.Table:
    """Of a bucket's windows, those that a smaller doc_id of another group has."""
    one, begins = _joined(asked, "one", np.uint64)
    two, _ = _joined(asked, "two", np.uint64)
    ids, _ = _joined(asked, "three", np.int64)
    order = np.lexsort((ids, two, one))
    new = np.ones(len(order), bool)
    new[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
    least = ids[order][new][np.cumsum(new) - 1]
    found = np.empty(len(order), bool)
    found[order] = ids[order] > least
    return _answer(asked, found, begins)


def pack(docs: DataFrame) -> DataFrame:
    """Documents in groups of a few megabytes: a row holds compressed texts, their ends and doc_ids."""

    def over(batch: pa.RecordBatch) -> dict[str, object]:
        coder = zstandard.ZstdCompressor(level=1)
        out: dict[str, list] = {name: [] for name in ("ids", "empty", "ends", "bytes", "data")}
        for part in text_slices(batch):
            texts = [None if text is None else text.encode() for text in part.column("text").to_pylist()]
            data = b"".join(text or b"" for text in texts)
            out["ids"].append(part.column("doc_id").to_pylist())
            out["empty"].append([text is None for text in texts])
            out["ends"].append(np.cumsum([len(text or b"") for text in texts]))
            out["bytes"].append(len(data))
            out["data"].append(coder.compress(data))
        return out

    schema = "ids array<long>, empty array<boolean>, ends array<long>, bytes long, data binary"
    packed = map_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), over, schema)
    return packed.withColumn("group", F.monotonically_increasing_id())


def _words(row: dict) -> Words:
    data = zstandard.ZstdDecompressor().decompress(row["data"], max_output_size=max(1, row["bytes"]))
    return Words(np.frombuffer(data, np.uint8), np.array(row["ends"], np.int64))


def _ids(row: dict) -> tuple[np.ndarray, np.ndarray]:
    ids = row["ids"]
    return np.array([i or 0 for i in ids], np.int64), np.array([i is not None for i in ids], bool)


def _asked(row: dict, cells: Iterator[tuple]) -> pa.Table:
    columns = list(zip(*((number, row["group"], *rest) for number, *rest in cells))) or [()] * 5
    kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
    names = ("bucket", "group", "one", "two", "three")
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=list(names))


def _answers(told: pa.Table, step: int) -> dict[int, bytes]:
    return {row["bucket"]: row["bits"] for row in told.to_pylist() if row["step"] == step}


def dedup(docs: DataFrame, window: int = 50, bucket_bytes: int = 8 << 20) -> DataFrame:
    """A row per row of `docs`: doc_id, n_words, n_removed, text (the kept words, joined by one space).

    `removed` holds the maximal runs of removed words as (first, end). `bucket_bytes` is about how much
    text a bucket of hashes stands for.
    """
    spark = docs.sparkSession
    ship(spark)
    block = window // 2
    packed = materialize(pack(docs), "packed")
    size = packed.agg(F.sum("bytes")).first()[0] or 0
    # Two buckets a task at least, so that tasks are even.
    buckets = max(-(-size // bucket_bytes), 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))

    def ask_probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                yield from _asked(row, Probes(_words(row), buckets, block).cells()).to_batches()

    hit = materialize(
        packed.mapInArrow(ask_probes, ASK).groupBy("bucket").applyInArrow(probe, ANSWER)
        .withColumn("step", F.lit(1)),
        "hits",
    )

    def extended(row: dict, told: pa.Table) -> tuple[Words, Extensions]:
        words = _words(row)
        probes = Probes(words, buckets, block)
        return words, Extensions(probes, probes.hits(_answers(told, 1)), *_ids(row), buckets, window)

    def ask_windows(group: pa.Table, told: pa.Table) -> pa.Table:
        parts = [_asked(row, extended(row, told)[1].cells()) for row in group.to_pylist() if told.num_rows]
        return pa.concat_tables(parts) if parts else _asked({}, iter(()))

    asked = packed.groupBy("group").cogroup(hit.groupBy("group")).applyInArrow(ask_windows, ASK)
    matched = materialize(
        asked.groupBy("bucket").applyInArrow(earliest, ANSWER).withColumn("step", F.lit(2)), "matches"
    )

    def remove(group: pa.Table, told: pa.Table) -> pa.Table:
        out: list[tuple] = []
        for row in group.to_pylist():
            words, asked = extended(row, told)
            starts = asked.repeated(_answers(told, 2))
            change = np.zeros(len(words.starts) + 1, np.int64)
            change[starts] += 1
            change[starts + window] -= 1
            gone = np.cumsum(change)[:-1] > 0
            data, begin = words.data.tobytes(), 0
            for at, end in enumerate(row["ends"]):
                held = data[begin:end].split()
                begin = end
                cut = gone[words.first[at] : words.first[at + 1]]
                spans = []
                if cut.any():
                    held = [word for word, went in zip(held, cut.tolist()) if not went]
                    edges = np.flatnonzero(np.diff(np.r_[0, cut, 0]))
                    spans = [{"first": int(a), "end": int(b)} for a, b in zip(edges[::2], edges[1::2])]
                text = None if row["empty"][at] else b" ".join(held).decode()
                out.append((row["ids"][at], len(cut), int(cut.sum()), text, spans))
        span = pa.struct([("first", pa.int64()), ("end", pa.int64())])
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(span))
        columns = list(zip(*out)) or [()] * 5
        names = ["doc_id", "n_words", "n_removed", "text", "removed"]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    told = hit.union(matched)
    return packed.groupBy("group").cogroup(told.groupBy("group")).applyInArrow(
        remove, "doc_id long, n_words long, n_removed long, text string, removed array<struct<first long, end long>>"
    )
