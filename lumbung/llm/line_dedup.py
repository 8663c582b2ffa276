"""Line dedup: every run of lines that an earlier run of lines equals goes.

Content-defined chunks of lines are the seeds: a rolling hash over line hashes chooses boundaries that
inserted lines do not shift. Chunks of two grains are counted over all documents, those between the
chosen boundaries and, for repeated runs that hold no whole one, chunks of one line. Seeds that occur
more than once are grown: where they touch, they join to the longest stretch of lines that may repeat,
and what repeats inside is decided by comparing bytes.

A run counts from `min_lines` lines and `min_chars` characters on. Of the runs that are equal byte by
byte the first by (doc_id, place) stays, and every other goes that does not overlap it. Compared are
the shortest runs of a stretch that count, from each line on and up to each line: every repeated run
is made up of them, however long it is, and equal runs have equal ones.

Defined results: a NULL text stays NULL and an empty one empty; with `min_lines` above 1, texts
without line breaks stay. A removed line always has an equal that stays. Rows that repeat a doc_id are
ordered by a hash of their text; identical rows count as one row and fare alike. Rows without a doc_id
come first in the order.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumbung.functions.storage import materialize
from lumbung.llm.common import columns_of, map_batches, map_rows

_MASK = (1 << 64) - 1
_MULTIPLIER = 0x9E3779B97F4A7C15


def chunks(text: str, window: int = 2, divisor: int = 3) -> list[tuple[int, int, int, int]]:
    """(start, end, lines, hash) of each content-defined chunk, without its last line break.

    A rolling hash over the last `window` line hashes ends a chunk where it is divisible by `divisor`;
    a divisor of 1 makes every line a chunk.
    """
    found, start, place, hashes = [], 0, 0, []
    previous: list[int] = []
    for line in text.split("\n"):
        end = place + len(line)
        item = xxhash.xxh64_intdigest(line.encode())
        hashes.append(item)
        previous = [*previous, item][-window:]
        rolling = 0
        for value in previous:
            rolling = (rolling * _MULTIPLIER + value) & _MASK
        place = end + 1
        if place > len(text) or len(previous) == window and (rolling >> 17) % divisor == 0:
            digest = 0
            for value in hashes:
                digest = ((digest ^ value) * _MULTIPLIER + 1) & _MASK
            found.append((start, end, len(hashes), digest - (1 << 63)))
            start, hashes = place, []
    return found


def seeds(text: str) -> list[tuple[int, int, int]]:
    """(start, end, hash) of the chunks of several lines and of those of one, empty lines apart."""
    found = [(start, end, h) for start, end, lines, h in chunks(text) if lines > 1]
    return found + [(start, end, h) for start, end, _, h in chunks(text, 1, 1) if end > start]


def grown(text: str, spans: list[dict]) -> list[list[tuple[int, int]]]:
    """Stretches of (start, end) of lines that lie in repeated seeds; empty lines repeat anywhere."""
    held = united(spans)
    stretches: list[list[tuple[int, int]]] = [[]]
    at = place = 0
    for line in text.split("\n"):
        start, end = place, place + len(line)
        place = end + 1
        while at < len(held) and held[at]["end"] < end:
            at += 1
        if start == end or at < len(held) and held[at]["start"] <= start:
            stretches[-1].append((start, end))
        elif stretches[-1]:
            stretches.append([])
    return stretches


def runs(lines: list[tuple[int, int]], min_lines: int = 2, min_chars: int = 40) -> list[tuple[int, int]]:
    """(start, end) of the shortest runs of consecutive lines that count, from and up to each line."""
    count, last = len(lines), 0
    found = set()
    for first in range(count):
        last = max(last, first + min_lines - 1)
        while last < count and lines[last][1] - lines[first][0] < min_chars:
            last += 1
        if last >= count:
            break
        found.add((lines[first][0], lines[last][1]))
    first = 0
    for last in range(count):
        if last - first + 1 < min_lines or lines[last][1] - lines[first][0] < min_chars:
            continue
        while last - first >= min_lines and lines[last][1] - lines[first + 1][0] >= min_chars:
            first += 1
        found.add((lines[first][0], lines[last][1]))
    return sorted(found)


def repeated_runs(docs: DataFrame, min_lines: int = 2, min_chars: int = 40) -> DataFrame:
    """Runs to remove, which may overlap: doc_id, version (hash of the text), start, end in code points.

    Seeds choose candidates and only their text moves; equality is decided on the bytes, grouped
    by text with partial aggregates, so a passage of any frequency is one row per task.
    """

    def cut(batch: pa.RecordBatch) -> dict[str, object]:
        ids, versions = batch.column("doc_id").to_pylist(), batch.column("version").to_pylist()
        out: list[tuple] = []
        for doc_id, version, text in zip(ids, versions, batch.column("text").to_pylist()):
            out += [(doc_id, version, *seed) for seed in seeds(text)]
        return columns_of(out, "doc_id", "version", "start", "end", "h")

    texts = docs.where("text IS NOT NULL").select("doc_id", _version().alias("version"), "text")
    rows = materialize(
        map_rows(texts, cut, "doc_id long, version long, start long, end long, h long"), "seeds"
    )
    # Rows that repeat are counted, too; that makes candidates at most, as each is its own first.
    often = rows.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h")
    wanted = rows.join(often, "h", "left_semi").groupBy("doc_id", "version").agg(
        F.collect_list(F.struct("start", "end")).alias("spans")
    )

    def read(batch: pa.RecordBatch) -> dict[str, object]:
        out: list[tuple] = []
        for doc_id, version, text, spans in zip(
            *(batch.column(name).to_pylist() for name in ("doc_id", "version", "text", "_lb_spans"))
        ):
            for lines in grown(text, spans):
                for start, end in runs(lines, min_lines, min_chars):
                    content = text[start:end].encode()
                    digest = hashlib.blake2b(content, digest_size=16).digest()
                    out.append((doc_id, version, start, end, content, digest))
        return columns_of(out, "doc_id", "version", "start", "end", "content", "digest")

    held = materialize(
        map_rows(
            _with_lists(texts, wanted, "inner"),
            read,
            "doc_id long, version long, start long, end long, content binary, digest binary",
        ),
        "repeated",
    )
    place = F.struct("doc_id", "version", "start", "end")
    # Two texts of one digest would be two rows here; then neither is touched.
    groups = materialize(
        held.groupBy("digest", "content").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
        .groupBy("digest")
        .agg(F.min("first").alias("first"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("texts"))
        .where("n > 1 AND texts = 1").select("digest", "first"),
        "firsts",
    )
    same = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("version") == F.col("first.version"))
    return (
        held.select("digest", "doc_id", "version", "start", "end")
        .join(groups, "digest")  # read from a table, so that a frequent passage is split by the skew join
        .where(~(same & (F.col("start") <= F.col("first.end"))))
        .select("doc_id", "version", "start", "end")
        .distinct()
    )


def remove_runs(docs: DataFrame, removed: DataFrame, drop_emptied: bool = False) -> DataFrame:
    """`docs` without the runs of `removed`, n_chars set anew where there is such a column.

    With `drop_emptied`, documents all of whose content stands elsewhere go.
    """
    lists = removed.groupBy("doc_id", "version").agg(
        F.collect_list(F.struct("start", "end")).alias("spans")
    )
    columns = docs.columns
    joined = _with_lists(docs.withColumn("_lb_version", _version()), lists, "left", "_lb_version")

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, spans = batch.column("text").to_pylist(), batch.column("_lb_spans").to_pylist()
        new = [without(text, united(held)) if held else text for text, held in zip(texts, spans)]
        keep = [not (drop_emptied and held and not text.strip()) for text, held in zip(new, spans)]
        arrays = []
        for name in columns:
            array = batch.column(name)
            if name == "text":
                array = pa.array(new, type=array.type)
            elif name == "n_chars":
                lengths = [
                    len(text) if held else old
                    for text, held, old in zip(new, spans, array.to_pylist())
                ]
                array = pa.array(lengths, type=array.type)
            arrays.append(array)
        return pa.RecordBatch.from_arrays(arrays, names=columns).filter(pa.array(keep, pa.bool_()))

    return map_batches(joined, cut, docs.schema)


def united(spans: list[dict]) -> list[dict]:
    """The spans in order, those that overlap made one."""
    out: list[dict] = []
    for span in sorted(spans, key=lambda s: s["start"]):
        if out and span["start"] <= out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], span["end"])
        else:
            out.append({"start": span["start"], "end": span["end"]})
    return out


def without(text: str, spans: list[dict]) -> str:
    """`text` without the given runs of whole lines and without the line breaks that ended them."""
    parts, place = [], 0
    for span in sorted(spans, key=lambda s: s["start"]):
        parts.append(text[place : span["start"]])
        place = span["end"] + 1
    rest = text[place:]
    if not rest and place > len(text) and parts:
        return "".join(parts).removesuffix("\n")
    return "".join(parts) + rest


def dedup_lines(docs: DataFrame, drop_emptied: bool = False, **options: int) -> DataFrame:
    """The documents, columns as they are, without repeated runs of lines."""
    return remove_runs(docs, materialize(repeated_runs(docs, **options), "removed"), drop_emptied)


def _version() -> Column:
    return F.xxhash64("text")


def _with_lists(
    texts: DataFrame, lists: DataFrame, how: str, version: str = "version"
) -> DataFrame:
    """`texts` with the spans of each row, as `_lb_spans`.

    The lists grow with the table, so they are merged with the texts, never broadcast.
    """
    named = lists.select(
        F.col("doc_id").alias("_lb_id"), F.col("version").alias("_lb_hash"), F.col("spans").alias("_lb_spans")
    )
    same = F.col("doc_id").eqNullSafe(F.col("_lb_id")) & (F.col(version) == F.col("_lb_hash"))
    return texts.join(named.hint("merge"), same, how).drop("_lb_id", "_lb_hash")
