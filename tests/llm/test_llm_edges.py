"""Defined results on awkward input: nulls, empty and very long texts, ties, repeats, empty tables."""

from __future__ import annotations

import hashlib

import public_tokenizers
import pytest
from pyspark.sql import types as T

import corpus_pipeline
from lumbung.llm import (
    bpe, embeddings, language_id, line_dedup, minhash, packing, quality, secret_scan, spotsigs, warc,
)
from lumbung.llm.queries import BYTE_RANKS, WORD_TOKENIZER

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, spans string, version long"
LONG = "long words that go on and on " * 4000
PASSAGE = "\n".join(f"line {i} of a passage that several documents share" for i in range(12))
ROWS = [
    (1, None), (2, ""), (3, " \n\t "), (4, "word"), (5, "Some words of a text."), (5, "Some words of a text."),
    (6, "Some words of a text."), (7, LONG), (None, "no id here"), (8, f"own start\n{PASSAGE}\nown end"),
    (9, f"another start\n{PASSAGE}\nanother end"), (10, "12345 !!! ---"), (11, "日本語 テスト password = abcdef123"),
]


def frame(spark, rows=ROWS, lang="en"):
    return spark.createDataFrame(
        [(i, t, lang, "s", len(t) if t is not None else None, "clash", 0) for i, t in rows], SCHEMA
    )


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return frame(spark, [])


def test_language_id(docs, none):
    model = language_id.fit(docs)
    found = [(r.doc_id, r.lang_pred, r.score) for r in language_id.predict(docs, model).collect()]
    assert len(found) == len(ROWS)
    assert {(i, p) for i, p, _ in found if i in (1, 2, 3, 10)} == {(i, "und") for i in (1, 2, 3, 10)}
    assert all(0 <= s <= 1 for _, _, s in found)
    assert language_id.predict(none, language_id.fit(none)).count() == 0
    assert {r.lang_pred for r in language_id.predict(docs, language_id.fit(none)).collect()} == {"und"}


def test_line_dedup(docs, none):
    left = line_dedup.dedup_lines(docs, min_chars=10)
    assert left.columns == docs.columns
    found = sorted((r.doc_id or 0, r.text or "") for r in left.collect())
    assert len(found) == len(ROWS)
    by_id = dict(found)
    assert by_id[8] == f"own start\n{PASSAGE}\nown end"  # the first occurrence stays
    assert "passage" in by_id[8] and len(by_id[9]) < len(f"another start\n{PASSAGE}\nanother end")
    assert by_id[9].startswith("another start") and by_id[9].endswith("another end")
    assert by_id[7] == LONG
    assert line_dedup.dedup_lines(none).count() == 0


def test_near_duplicates(docs, none):
    found = minhash.near_duplicates(docs).collect()
    assert len(found) == len(ROWS)
    component = {r.doc_id: r.component_id for r in found}
    assert component[5] == component[6] == 5 and component[None] is None
    assert {i for i in component if i and component[i] == i} == {1, 2, 3, 4, 5, 7, 8, 9, 10, 11} - (
        {9} if component[9] == 8 else set()
    )
    sizes = {r.doc_id: r.n_shingles for r in found}
    assert (sizes[1], sizes[2], sizes[3], sizes[4], sizes[5], sizes[7]) == (0, 0, 0, 1, 1, 7)
    kept = minhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and kept.where("doc_id = 6").count() == 0
    assert minhash.near_duplicates(none).count() == 0


def test_secret_scan(docs, none):
    found = {r.doc_id: r.secret_spans for r in secret_scan.scan(docs).collect()}
    assert [tuple(s) for s in found[11]] == [(8, 0, "assign", 28)]
    assert not any(spans for i, spans in found.items() if i != 11)
    redacted = secret_scan.redact(docs)
    assert redacted.columns == docs.columns and redacted.count() == len(ROWS)
    assert redacted.where("doc_id = 11").first().text == "日本語 テスト [secret]"
    assert secret_scan.scan(none).count() == 0


def test_packing(docs, none):
    pieces = packing.pack_documents(docs, WORD_TOKENIZER, keep_ids=True).collect()
    assert sum(r.length for r in pieces if r.doc_id in (1, 2, 3)) == 3
    assert len({r.doc_id for r in pieces}) == len({i for i, _ in ROWS})
    assert packing.pack_documents(none, WORD_TOKENIZER).count() == 0


def test_bpe(docs, none):
    found = bpe.round_trip(docs, BYTE_RANKS, public_tokenizers.PATTERN).collect()
    digests = {r.doc_id: r.decoded_sha256 for r in found}
    assert all(digests[i] == hashlib.sha256((t or "").encode()).hexdigest() for i, t in ROWS)
    decoded = bpe.decode(bpe.encode(docs, BYTE_RANKS, public_tokenizers.PATTERN), BYTE_RANKS, public_tokenizers.PATTERN)
    assert sorted(bytes(r.content) for r in decoded.collect()) == sorted((t or "").encode() for _, t in ROWS)
    assert bpe.round_trip(none, BYTE_RANKS, public_tokenizers.PATTERN).count() == 0


def test_quality(spark, docs, none):
    stats = quality.statistics(docs)
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    found = quality.score(stats, quality.fit(stats, empty)).collect()
    assert len(found) == len(ROWS) and {round(r.score, 6) for r in found} == {0.5}
    one = spark.createDataFrame([(i, 1, None) for i in range(1, 12)] + [(None, None, None)], empty.schema)
    assert all(r.score > 0.99 for r in quality.score(stats, quality.fit(stats, one)).collect())
    assert not stats.where(" OR ".join(f"`{c}` IS NULL" for c in stats.columns if c != "doc_id")).count()
    assert quality.score(quality.statistics(none), quality.fit(quality.statistics(none), empty)).count() == 0


def test_spotsigs(docs, none):
    found = spotsigs.edited_likeness(docs).collect()
    assert len(found) == len(ROWS)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)
    prints = {r.doc_id: r.fingerprint for r in found}
    assert prints[5] == prints[6] and prints[1] == prints[2] == spotsigs.digest(spotsigs.fingerprints([""])[0])
    assert spotsigs.edited_likeness(none).count() == 0
    pairs, members = spotsigs.similar_pairs(docs)
    assert {(r.doc_id, r.class_id) for r in members.collect()} >= {(5, 5), (6, 5)}
    assert all(r.likeness >= 0.75 for r in pairs.collect())


def test_warc(spark):
    schema = "page_id long, url string, html string, record_type string"
    rows = [
        (1, "http://a.example/x", "<p>same</p>", ""), (2, "http://b.example/", "<p>same</p>", ""), (3, None, None, ""),
        (4, "https://www.A.example:8080/Q?z=1", "", ""), (5, "bad url\r\nwith breaks", "a\r\n\r\nWARC/1.1\r\n\r\nb", ""),
        (5, "http://a.example/x", "é" * 50_000, ""), (None, "http://a.example/x", "<p>same</p>", ""),
    ]
    found = warc.capture_history(spark.createDataFrame(rows, schema)).orderBy("slice", "place").collect()
    assert len(found) == len(rows)
    keys = [(r.url_key, r.captured_at, -1 if r.page_id is None else r.page_id) for r in found]
    assert keys == sorted(keys)
    kinds = {(r.page_id, r.payload_bytes): (r.record_type, r.refers_to) for r in found}
    assert kinds[1, 11] == ("revisit", 2) and kinds[2, 11] == ("response", None)
    assert kinds[3, 0] == ("revisit", 4) and kinds[4, 0] == ("response", None)
    assert kinds[5, 100_000] == ("response", None) and kinds[None, 11] == ("response", None)
    assert warc.capture_history(spark.createDataFrame([], schema)).count() == 0


def test_embeddings(spark):
    nan, inf = float("nan"), float("inf")
    base = [1.0, 0.5, -0.25, 2.0]
    rows = [
        (1, base, 0), (2, base, 0), (3, [x * 3 for x in base], 1), (4, [x + 0.01 for x in base], 1), (5, None, 1),
        (6, [0.0] * 4, 1), (7, [nan, 1.0, 1.0, 1.0], 1), (8, [inf, 1.0, 1.0, 1.0], 1), (9, [None, 1.0, 1.0, 1.0], 1),
        (10, [-x for x in base], 1), (11, [1.0, 2.0], 1), (12, [], 1), (None, base, 1),
    ]
    schema = T.StructType([
        T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("n_links", T.IntegerType()),
    ])
    found = {r.vec_id: r for r in embeddings.near_duplicates(spark.createDataFrame(rows, schema)).collect()}
    assert len(found) == len(rows)
    assert {i: r.n_links for i, r in found.items() if r.n_links} == {1: 3, 2: 3, 3: 3, 4: 3}
    assert {i for i, r in found.items() if not r.kept} == {2, 3, 4} and found[4].component_id == 1
    assert embeddings.near_duplicates(spark.createDataFrame([], schema)).count() == 0


def test_pipeline_stages_return_their_columns(spark, docs, tmp_path):
    path = str(tmp_path / "documents.parquet")
    docs.drop("version").write.parquet(path)
    held = spark.read.parquet(path)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        held = stage(spark, held, str(tmp_path))
        assert held.columns == docs.drop("version").columns, name
        held.write.parquet(str(tmp_path / name))
        held = spark.read.parquet(str(tmp_path / name))
    last = corpus_pipeline.STAGES[-1][1](spark, held, str(tmp_path))
    assert {r.doc_id for r in last.collect()} == {r.doc_id for r in held.select("doc_id").collect()}
