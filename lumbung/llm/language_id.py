"""Language ID by compression: the language whose dictionary shortens a text most.

Fitting takes, per language, a bounded sample of training texts (one per hash bucket, the one with
the smallest hash; a bounded part of a long one where a bucket has no other) as a raw-content
zstandard dictionary. A text is compressed with each
dictionary, in pieces of `PIECE` bytes that each begin with the dictionary alone, so that what it
saves is a share of any length; the smallest sum wins, ties go to the language with more training
documents and then to the lesser name. The margin is the excess of the second-best language as a
share of its size, or where one language is learned, that of no dictionary at all.

Defined results: NULL texts and texts without a letter are `und` with score 0; so are all texts
when nothing can be learned. Repeated rows are scored alike, extra columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumbung.llm.common import filter_rows, held_out, map_rows

UNDETERMINED = "und"
SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double, margin double"
PIECE = 4096
#: A text whose margin is less is of no learned language; see the README for the calibration.
MIN_MARGIN = 0.02
_NO_LETTERS = re.compile(r"[\W\d_]+")


def plain(text: str) -> str:
    """Lower case with one space for each run of anything but letters, so that layout costs nothing."""
    return _NO_LETTERS.sub(" ", text.lower())


@dataclass(frozen=True)
class LanguageModel:
    """Dictionaries in tie order: languages with more training documents first."""

    dictionaries: tuple[tuple[str, bytes], ...]
    level: int = 6


def fit(
    docs: DataFrame,
    samples: int = 96,
    max_sample_chars: int = 20_000,
    dictionary_bytes: int = 32_768,
    max_languages: int = 500,
    level: int = 6,
) -> LanguageModel:
    """Learn dictionaries from the training fold of `docs` (doc_id, text, lang).

    The sample is bounded by `samples` texts of at most `max_sample_chars` characters for each of at
    most `max_languages` languages, whatever the table's size; more languages are an error. A longer
    text stands only for a bucket without a shorter one, by its first `max_sample_chars` characters,
    so every language of the training fold is learned.
    """
    training = docs.where(
        ~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull()
    ).select("text", "lang", F.xxhash64("text").alias("h"))
    chosen = (
        training.groupBy("lang", F.pmod("h", F.lit(samples)).alias("bucket"))
        .agg(
            F.min(F.struct(F.length("text") > max_sample_chars, "h"))["h"].alias("h"),
            F.count(F.lit(1)).alias("n"),
        )
        .limit(samples * max_languages + 1)
        .collect()
    )
    counts: dict[str, int] = {}
    for row in chosen:
        counts[row.lang] = counts.get(row.lang, 0) + row.n
    if len(counts) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    hashes = sorted({row.h for row in chosen})
    texts = (
        training.where(F.col("h").isin(hashes))
        .select("lang", "h", F.substring("text", 1, max_sample_chars).alias("text")).distinct().collect()
        if hashes
        else []
    )
    by_language: dict[str, list[tuple[int, str]]] = {}
    picked = {(row.lang, row.h) for row in chosen}
    for row in texts:
        if (row.lang, row.h) not in picked:
            continue
        by_language.setdefault(row.lang, []).append((row.h, row.text))
    order = sorted(by_language, key=lambda name: (-counts[name], name))
    return LanguageModel(
        tuple(
            (name, " ".join(plain(text) for _, text in sorted(by_language[name])).encode()[-dictionary_bytes:])
            for name in order
        ),
        level,
    )


def predict_texts(
    texts: list[str | None], model: LanguageModel, min_score: float, min_margin: float = 0.0
) -> tuple[list[str], list[float], list[float]]:
    """Language, score and margin of each text."""
    names = [name for name, _ in model.dictionaries]
    coders = []
    for _, data in model.dictionaries:
        held = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        held.precompute_compress(level=model.level)
        coders.append(
            zstandard.ZstdCompressor(
                level=model.level, dict_data=held, write_content_size=False, write_dict_id=False
            )
        )
    if len(coders) == 1:
        coders.append(zstandard.ZstdCompressor(level=model.level, write_content_size=False))
    found, scores, margins = [], [], []
    for text in texts:
        letters = plain(text or "")
        if not coders or not any(map(str.isalpha, letters)):
            found.append(UNDETERMINED)
            scores.append(0.0)
            margins.append(0.0)
            continue
        data = letters.encode()
        parts = [data[start : start + PIECE] for start in range(0, len(data), PIECE)]
        sums = [sum(len(coder.compress(part)) for part in parts) for coder in coders]
        sizes = sums[: len(names)]
        least = min(sizes)
        score = 1.0 / sum(2.0 ** -min(size - least, 1000) for size in sizes)
        second = min(size for at, size in enumerate(sums) if at != sizes.index(least))
        margin = max(0.0, (second - least) / second)
        told = score >= min_score and margin >= min_margin
        found.append(names[sizes.index(least)] if told else UNDETERMINED)
        scores.append(score)
        margins.append(margin)
    return found, scores, margins


def predict(
    docs: DataFrame, model: LanguageModel, min_score: float = 0.0, min_margin: float = 0.0
) -> DataFrame:
    """Columns of `SCHEMA` for every row of `docs`; predictions below a least value become `und`.

    `score` weighs each language by 2 to the power of minus its excess bytes; `margin` is the
    excess of the second-best language, or of no dictionary if there is one language, as a share.
    """

    def classify(batch: pa.RecordBatch) -> dict[str, object]:
        found, scores, margins = predict_texts(
            batch.column("text").to_pylist(), model, min_score, min_margin
        )
        return {
            "doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"),
            "lang_pred": found, "score": scores, "margin": margins,
        }

    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return map_rows(rows, classify, SCHEMA)


def keep_identified(docs: DataFrame, model: LanguageModel, min_margin: float = MIN_MARGIN) -> DataFrame:
    """The rows and columns of `docs` whose language is told; those of a margin below `min_margin` go."""
    return filter_rows(
        docs,
        lambda batch: [
            name != UNDETERMINED
            for name in predict_texts(batch.column("text").to_pylist(), model, 0.0, min_margin)[0]
        ],
    )
