"""Vector best-fit packing of tokenized documents into sequences.

A document is its token ids and one closing id; only documents longer than a sequence are cut, into
full pieces and a last shorter one. A bin has three capacities: tokens, documents and attention cost
(the sum of squared piece lengths). Pieces, longest first, go to the open bin that fits under every
capacity and scores best: by the smallest weighted norm of what would be left, or by the largest
weighted dot product of piece and residual. Pieces are dealt in turn to tasks of `per_task` pieces,
so a task's memory is bounded and at most one bin per task is short of pieces to fill it.

Defined results: NULL texts are empty; an empty document is one piece of its closing id. An empty
table gives an empty result. Repeated rows are packed each, as documents of their own.
"""

from __future__ import annotations

import functools
import itertools
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StructField, StructType
from tokenizers import Tokenizer

from lumbung.functions.storage import materialize
from lumbung.llm.common import columns_of, map_rows, partitions_for, ship, string_hashes, text_slices

#: Characters beyond plain Latin text (and the one whose lower case is two characters).
_OTHER = r"[^\t-\r\x20-\x7e\x{a0}-\x{12f}\x{131}-\x{24f}]"
#: Words that a worker remembers at most, at about 40 bytes each.
_MEMO = 1_000_000


@dataclass(frozen=True)
class Capacity:
    """What a bin holds at most, and how much each part weighs when bins are compared."""

    tokens: int = 4096
    documents: int = 4096
    attention: int = 4096 * 4096
    weights: tuple[float, float, float] = (1.0, 0.05, 0.05)
    rule: str = "norm"  # or "dot"

    def __post_init__(self) -> None:
        if self.rule not in ("norm", "dot"):
            raise ValueError(f"unknown rule {self.rule}")
        if min(self.tokens, self.documents) < 1 or self.attention < self.tokens**2:
            raise ValueError("a full piece must fit into an empty bin")


class KnownWords:
    """Token ids of words by two 64-bit hashes, in plain arrays: some forty bytes a word."""

    def __init__(self) -> None:
        self.one, self.two = np.empty(0, np.uint64), np.empty(0, np.uint64)
        self.starts, self.sizes = np.empty(0, np.int64), np.empty(0, np.int32)
        self.flat, self.used = np.empty(1 << 16, np.uint32), 0

    def find(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Place of each word, -1 for those not known."""
        if not len(self.one):
            return np.full(len(one), -1)
        place = np.minimum(np.searchsorted(self.one, one), len(self.one) - 1)
        return np.where((self.one[place] == one) & (self.two[place] == two), place, -1)

    def add(self, one: np.ndarray, two: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> None:
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        self.flat[self.used : self.used + len(ids)] = ids
        starts = self.used + np.cumsum(sizes) - sizes
        self.used += len(ids)
        order = np.argsort(one)
        at = np.searchsorted(self.one, one[order])
        self.starts = np.insert(self.starts, at, starts[order])
        self.sizes = np.insert(self.sizes, at, sizes[order])
        self.two = np.insert(self.two, at, two[order])
        self.one = np.insert(self.one, at, one[order])


class WordEncoder:
    """Token ids as the tokenizers library gives them, keeping the ids of words it has met.

    No token of this kind of tokenizer spans white space, so the ids of a text are those of the
    runs between white space, and each distinct run is encoded once. Texts that hold the content of
    an added token, such as an end mark, are encoded whole.
    """

    def __init__(self, path: str) -> None:
        self.whole = Tokenizer.from_file(path)
        added = [token.content for token in self.whole.get_added_tokens_decoder().values() if token.content]
        self.added = "|".join(map(re.escape, added))
        self.known = KnownWords()  # a worker keeps it for long

    def ids(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text; NULL texts have none."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if not len(texts):
            return []
        whole: dict[int, np.ndarray] = {}
        if self.added:
            marked = pc.match_substring_regex(texts, self.added, ignore_case=True)
            for at in np.flatnonzero(marked.to_numpy(zero_copy_only=False)).tolist():
                found = self.whole.encode(texts[at].as_py(), add_special_tokens=False).ids
                whole[at] = np.array(found, np.uint32)
            if whole:
                texts = pc.if_else(marked, "", texts)
        # The tokenizer folds case itself; doing so here where it is plain leaves fewer runs.
        other = pc.match_substring_regex(texts, _OTHER)
        words = pc.ascii_split_whitespace(pc.if_else(other, texts, pc.utf8_lower(texts)))
        coded = words.flatten().dictionary_encode()
        known, places = self._known(coded.dictionary)
        starts, sizes, flat = known.starts[places], known.sizes[places], known.flat
        codes = coded.indices.to_numpy()
        counts = sizes[codes]
        before = np.concatenate([[0], np.cumsum(counts)])
        place = np.repeat(starts[codes] - before[:-1], counts) + np.arange(before[-1])
        tokens = flat[place]
        bounds = before[words.offsets.to_numpy() - words.offsets[0].as_py()]
        return [whole.get(at, tokens[a:b]) for at, (a, b) in enumerate(zip(bounds, bounds[1:]))]

    def _known(self, words: pa.Array) -> tuple[KnownWords, np.ndarray]:
        """What is known, with all of `words` among it, and the place of each."""
        one, two = string_hashes(words, 1), string_hashes(words, 2)
        if len(self.known.one) + len(words) > _MEMO:
            self.known = KnownWords()
        new = np.flatnonzero(self.known.find(one, two) < 0)
        for begin in range(0, len(new), 1 << 16):
            part = new[begin : begin + (1 << 16)]
            texts = words.take(pa.array(part)).to_pylist()
            ids = [coded.ids for coded in self.whole.encode_batch_fast(texts, add_special_tokens=False)]
            sizes = np.fromiter(map(len, ids), np.int32, len(ids))
            flat = np.fromiter(itertools.chain.from_iterable(ids), np.uint32, int(sizes.sum()))
            self.known.add(one[part], two[part], sizes, flat)
        return self.known, self.known.find(one, two)


@functools.lru_cache(maxsize=1)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def tokenized(
    docs: DataFrame, tokenizer: str, length: int = 4096, closing: int = 1, keep_ids: bool = False
) -> DataFrame:
    """Pieces: doc_id, piece, start, length, ids_crc32 and, if asked for, the ids themselves."""

    def over(batch: pa.RecordBatch) -> dict[str, object]:
        coder = encoder(tokenizer)
        rows: list[tuple] = []
        # Some bytes at a time: the arrays over words and tokens are many times as large as the text.
        for part in text_slices(batch):
            for doc_id, found in zip(part.column("doc_id").to_pylist(), coder.ids(part.column("text"))):
                ids = np.append(found, np.uint32(closing)).astype("<u4")
                for piece, start in enumerate(range(0, len(ids), length)):
                    cut = ids[start : start + length]
                    row = (doc_id, piece, start, len(cut), zlib.crc32(cut.tobytes()))
                    rows.append((*row, cut.astype(np.int32)) if keep_ids else row)
        return columns_of(rows, *names)

    names = ("doc_id", "piece", "start", "length", "ids_crc32", *(("ids",) if keep_ids else ()))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return map_rows(docs.select("doc_id", "text"), over, schema + (", ids array<int>" if keep_ids else ""))


def best_fit(lengths: np.ndarray, capacity: Capacity) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece, all within the capacity of a bin."""
    total = np.array([capacity.tokens, capacity.documents, capacity.attention], float)
    weights = np.array(capacity.weights)
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    smallest = int(lengths.min()) if len(lengths) else 0
    left = np.empty((1024, 3))  # residuals of the open bins
    name = np.empty(1024, np.int64)
    n_open = made = 0
    for item in order:
        size = int(lengths[item])
        need = np.array([size, 1.0, float(size) * size])
        chosen = -1
        if n_open:
            residual = left[:n_open]
            fits = np.flatnonzero(
                (residual[:, 0] >= need[0]) & (residual[:, 1] >= need[1]) & (residual[:, 2] >= need[2])
            )
            if len(fits):
                if capacity.rule == "norm":
                    rest = (residual[fits] - need) / total
                    chosen = fits[np.argmin((rest * rest) @ weights)]
                else:
                    chosen = fits[np.argmax((residual[fits] / total) @ (weights * need / total))]
        if chosen < 0:
            if n_open == len(left):
                left = np.concatenate([left, np.empty_like(left)])
                name = np.concatenate([name, np.empty_like(name)])
            chosen, left[n_open], name[n_open] = n_open, total, made
            n_open += 1
            made += 1
        bins[item], offsets[item] = name[chosen], total[0] - left[chosen, 0]
        left[chosen] -= need
        rest = left[chosen]
        if rest[0] < smallest or rest[1] < 1 or rest[2] < float(smallest) ** 2:
            n_open -= 1  # no piece fits any more: the last open bin takes its place
            left[chosen], name[chosen] = left[n_open], name[n_open]
    return bins, offsets


def pack(pieces: DataFrame, capacity: Capacity = Capacity(), per_task: int = 40_000) -> DataFrame:
    """`pieces` with sequence_id and offset (place in the sequence, without gaps from 0).

    `pieces` is read twice, to count and to pack; write it before where it is costly.
    """
    ship(pieces.sparkSession)
    tasks = partitions_for(pieces.count(), per_task)
    added = (StructField("sequence_id", LongType()), StructField("offset", LongType()))
    schema = StructType([*pieces.schema.fields, *added])

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held = [batch for batch in batches if batch.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held).combine_chunks()
        first = TaskContext.get().partitionId() << 40
        bins, offsets = best_fit(table.column("length").to_numpy(), capacity)
        out = table.append_column("sequence_id", pa.array(first + bins))
        yield from out.append_column("offset", pa.array(offsets)).to_batches(max_chunksize=10_000)

    # Dealt in turn, so that rows that repeat are spread as well.
    return pieces.repartition(tasks).mapInArrow(over, schema)


def pack_documents(
    docs: DataFrame, tokenizer: str, capacity: Capacity = Capacity(), keep_ids: bool = False
) -> DataFrame:
    """Pieces of all documents with their sequence and offset."""
    pieces = tokenized(docs, tokenizer, capacity.tokens, keep_ids=keep_ids)
    return pack(materialize(pieces, "pieces"), capacity)
