"""Byte-level BPE with the tiktoken library and a local rank file.

Long texts are cut before encoding, only between a character that is no white space and an ASCII
white-space character: no match of the split pattern spans such a place (white space stands at most
at the start of a token, or in a token of its own), and its look-ahead sees the same next character,
so the ids of the pieces joined are the ids of the whole. Decoding joins the raw bytes of the ids.

Defined results: a NULL text is encoded as an empty one, which has no ids and no bytes. Repeated rows
are encoded alike; extra columns are ignored.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

from lumbung.llm.common import map_rows

PIECE_CHARS = 50_000
_BOUNDARY = re.compile(r"(?<=[^\s\x1c-\x1f\x85])(?=[ \t\n\r])")


@functools.lru_cache(maxsize=2)
def encoding(rank_file: str, pattern: str) -> tiktoken.Encoding:
    """The encoding of a rank file: lines of a base64 token and its rank."""
    with open(rank_file, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, most: int = PIECE_CHARS) -> list[str]:
    """`text` cut at safe boundaries at least `most` characters apart."""
    found, start = [], 0
    while len(text) - start > most:
        place = _BOUNDARY.search(text, start + most)
        if not place:
            break
        found.append(text[start : place.start()])
        start = place.start()
    return [*found, text[start:]]


def encode_text(text: str, coder: tiktoken.Encoding) -> list[int]:
    if len(text) <= PIECE_CHARS:
        return coder.encode_ordinary(text)
    return [token for piece in pieces(text) for token in coder.encode_ordinary(piece)]


def encode(docs: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """doc_id and ids (array of int) of every text."""

    def over(batch: pa.RecordBatch) -> dict[str, object]:
        coder = encoding(rank_file, pattern)
        ids = [encode_text(text or "", coder) for text in batch.column("text").to_pylist()]
        return {"doc_id": batch.column("doc_id"), "ids": ids}

    return map_rows(docs.select("doc_id", "text"), over, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """doc_id and the raw bytes (`content`) of every row's ids; NULL ids give no bytes."""

    def over(batch: pa.RecordBatch) -> dict[str, object]:
        coder = encoding(rank_file, pattern)
        content = [coder.decode_bytes(ids or []) for ids in batch.column("ids").to_pylist()]
        return {"doc_id": batch.column("doc_id"), "content": content}

    return map_rows(encoded.select("doc_id", "ids"), over, "doc_id long, content binary")


def round_trip(docs: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encoded, then decoded, in one pass."""

    def over(batch: pa.RecordBatch) -> dict[str, object]:
        coder = encoding(rank_file, pattern)
        decimal = [str(number) for number in range(coder.n_vocab)]
        counts, ids_digests, digests = [], [], []
        for text in batch.column("text").to_pylist():
            ids = encode_text(text or "", coder)
            counts.append(len(ids))
            ids_digests.append(hashlib.sha256(",".join([decimal[i] for i in ids]).encode()).hexdigest())
            digests.append(hashlib.sha256(coder.decode_bytes(ids)).hexdigest())
        return {
            "doc_id": batch.column("doc_id"), "n_tokens": counts, "ids_sha256": ids_digests,
            "decoded_sha256": digests,
        }

    return map_rows(
        docs.select("doc_id", "text"), over,
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
    )
