"""WARC archives and their merged capture index.

Pages become WARC records that Spark's text writer puts into archive files (a record's closing line
breaks are the writer's line separator, all else of a record is UTF-8). Reading takes each archive as
a whole, follows the Content-Length fields, and sorts its entries: one locally sorted run per archive.
The runs are dealt by ranges of (URL key, time, page), and within a range a loser tree merges the
pieces of the runs, so the slices in order are one globally ordered capture history.

Defined results: a NULL html is an empty payload, a NULL url an empty one. Among equal payloads the
largest page_id is the response and the others revisit it; rows that repeat that page_id are responses
too, and so are pages without a page_id. Archive files hold about `file_bytes`, a larger page one more.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumbung.functions.storage import materialize, scratch_path
from lumbung.llm.common import columns_of, map_rows, partitions_for, ship

#: RFC 4648, the digits of base 32 (fixed values).
_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: Epoch seconds of page 0 and the span of the times that pages without one get.
FIRST_CAPTURE, CAPTURE_SPAN = 1_600_000_000, 100_000_000
_END = "\r\n\r\n"
#: Parts that the pages of one digest are spread over.
_SALTS = 16
ENTRY = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
    "url string, url_key string, captured_at string, archive string, record_offset long, record_length long"
)


def base32_sha1(content: Column) -> Column:
    """Upper-case base-32 SHA-1 of binary content: every five hex digits are four of base 32."""
    digest = F.sha1(content)
    parts = [F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 10).cast("long") for i in range(8)]
    return F.concat(
        *[
            F.substring(F.lit(_DIGITS), F.shiftright(part, shift).bitwiseAND(31).cast("int") + 1, F.lit(1))
            for part in parts
            for shift in (15, 10, 5, 0)
        ]
    )


def records(pages: DataFrame, files: int, least_revisit_bytes: int = 0) -> DataFrame:
    """One WARC record per page, without its closing line breaks, dealt into `files` partitions.

    A page moves once, to the partition of its digest and of a salt that spreads a digest that many
    pages share; what is joined to it there is one row per repeated digest
    and salt.
    """
    payload = F.coalesce("html", F.lit("")).cast("binary")
    seconds = F.lit(FIRST_CAPTURE) + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(CAPTURE_SPAN))
    known = pages.select(
        "page_id",
        F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20\x7f]", "%20").alias("url"),
        F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("at"),
        F.coalesce("html", F.lit("")).alias("html"),
        F.octet_length(payload).alias("bytes"),
        base32_sha1(payload).alias("digest"),
    )
    first = known.where(F.col("bytes") >= least_revisit_bytes).groupBy("digest").agg(
        F.max("page_id").alias("response"), F.count(F.lit(1)).alias("n")
    ).where("n > 1").drop("n")
    salt = F.pmod(F.xxhash64("page_id", "url"), F.lit(_SALTS)).cast("int")
    dealt = known.withColumn("salt", salt).repartition(files, "digest", "salt")
    salted = first.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    both = dealt.join(salted.hint("merge"), ["digest", "salt"], "left")
    revisit = F.col("page_id") < F.col("response")
    urn = lambda page: F.concat(F.lit("<urn:page:"), page.cast("string"), F.lit(">"))
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("bytes"), F.lit(_END),
    )
    block = F.when(revisit, F.lit("")).otherwise(F.concat(head, F.col("html")))
    lines = F.concat_ws(
        "\r\n",
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), urn(F.col("page_id"))),
        F.concat(F.lit("WARC-Date: "), F.col("at")),
        F.concat(F.lit("WARC-Target-URI: "), F.col("url")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.concat(F.lit("X-Payload-Bytes: "), F.col("bytes")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), urn(F.col("response")))),
        F.when(
            revisit,
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
        ),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block)),
    )
    return both.select(F.concat(lines, F.lit(_END), block).alias("record"))


def write(pages: DataFrame, path: str, file_bytes: int = 16 << 20, least_revisit_bytes: int = 0) -> None:
    """Write the archive files of `pages` under `path`, gzipped as a whole."""
    size = pages.agg(F.sum(F.coalesce(F.octet_length("html"), F.lit(0)) + 600)).first()[0] or 0
    dealt = records(pages, partitions_for(size, file_bytes), least_revisit_bytes)
    dealt.write.option("lineSep", _END).text(path, compression="gzip")


def parse(archive: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """Offset, length, header fields and block of each record of an archive."""
    place = 0
    while place < len(archive):
        end = archive.index(b"\r\n\r\n", place)
        lines = archive[place:end].decode().split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError(f"no record at byte {place}")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        start = end + 4
        stop = start + int(fields["Content-Length"])
        if archive[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError(f"record at byte {place} does not end where it says")
        yield place, stop + 4 - place, fields, archive[start:stop]
        place = stop + 4


def url_key(url: str) -> str:
    """Sortable key of a URL: host parts in reverse, then port, path and query, in lower case."""
    scheme, mark, rest = url.lower().partition("://")
    rest = rest if mark else scheme
    host, tail = re.match(r"([^/?#]*)(.*)", rest, re.S).groups()
    name, colon, port = host.rpartition("@")[2].partition(":")
    return ",".join(reversed(name.removeprefix("www.").split("."))) + colon + port + ")" + (tail or "/")


def _page(urn: str | None) -> int | None:
    return int(urn.removeprefix("<urn:page:").removesuffix(">")) if urn else None


def read(path_of: DataFrame) -> DataFrame:
    """Entries of gzipped archives (path, content), each archive's in order of key, time and page.

    Offsets are those in the archive's text.

    The digest of every response is computed anew from the payload read; a difference is an error.
    """

    def entries(batch: pa.RecordBatch) -> dict[str, object]:
        rows = []
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
            found = []
            for offset, length, fields, block in parse(gzip.decompress(content)):
                digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
                size = int(fields["X-Payload-Bytes"])
                if kind == "response":
                    payload = block.partition(b"\r\n\r\n")[2]
                    own = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                    if own != digest or len(payload) != size:
                        raise ValueError(f"payload of {fields.get('WARC-Record-ID')} is damaged")
                url = fields["WARC-Target-URI"]
                found.append(
                    (_page(fields.get("WARC-Record-ID")), size, digest, kind,
                     _page(fields.get("WARC-Refers-To")), url, url_key(url), fields["WARC-Date"],
                     path, offset, length)
                )
            rows += sorted(found, key=_order)
        return columns_of(rows, *(part.split()[0] for part in ENTRY.split(", ")))

    return map_rows(path_of.select("path", "content"), entries, ENTRY)


def _order(row: tuple) -> tuple:
    return row[6], row[7], -1 if row[0] is None else row[0], row[8], row[9]


class LoserTree:
    """k-way merge of sorted runs: a tournament whose inner nodes keep the loser of their match."""

    def __init__(self, runs: list[list[tuple]]) -> None:
        self.runs, self.k = runs, len(runs)
        self.at = [0] * self.k
        self.loser = [-1] * self.k
        for run in range(self.k):
            self._play(run)

    def _key(self, run: int) -> tuple | None:
        return self.runs[run][self.at[run]] if self.at[run] < len(self.runs[run]) else None

    def _before(self, one: int, two: int) -> bool:
        """Whether the head of run `one` comes first; an ended run comes last."""
        a, b = self._key(one), self._key(two)
        return b is None or a is not None and (a, one) <= (b, two)

    def _play(self, run: int) -> None:
        winner, node = run, (run + self.k) // 2
        while node > 0:
            held = self.loser[node]
            if held < 0:  # the other side has not come up yet
                self.loser[node] = winner
                return
            if self._before(held, winner):
                self.loser[node], winner = winner, held
            node //= 2
        self.loser[0] = winner

    def __iter__(self) -> Iterator[tuple]:
        while self.k:
            winner = self.loser[0]
            head = self._key(winner)
            if head is None:
                return
            yield head
            self.at[winner] += 1
            self._play(winner)


def merge(entries: DataFrame, per_slice: int = 50_000) -> DataFrame:
    """The runs merged: entries with `slice` and `place`, which together are the global order."""
    ship(entries.sparkSession)
    slices = partitions_for(entries.count(), per_slice)
    columns = entries.columns
    key = [columns.index(c) for c in ("url_key", "captured_at", "page_id", "archive", "record_offset")]
    schema = ENTRY + ", slice int, place long"

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held = [batch for batch in batches if batch.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        values = [table.column(i).to_pylist() for i in key]
        values[2] = [-1 if page is None else page for page in values[2]]
        runs: dict[str, list[tuple]] = {}
        for row, item in enumerate(zip(*values)):
            runs.setdefault(item[3], []).append((*item, row))
        merged = [item[-1] for item in LoserTree(list(runs.values()))]
        out = table.take(pa.array(merged))
        part = TaskContext.get().partitionId()
        out = out.append_column("slice", pa.array([part] * len(merged), pa.int32()))
        out = out.append_column("place", pa.array(range(len(merged)), pa.int64()))
        yield from out.combine_chunks().to_batches(max_chunksize=10_000)

    dealt = entries.repartitionByRange(slices, "url_key", "captured_at", "page_id")
    # Pieces of a run are brought together, each in its own order; the merge is the loser tree's.
    runs = dealt.sortWithinPartitions("archive", "url_key", "captured_at", "page_id", "record_offset")
    return runs.mapInArrow(over, schema)


def capture_history(pages: DataFrame, least_revisit_bytes: int = 0) -> DataFrame:
    """Write the archives of `pages`, read them back and merge their indexes."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write(pages, path, least_revisit_bytes=least_revisit_bytes)
    archives = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return merge(materialize(read(archives), "runs"))
