"""Queries on the smallest tables against SQL, brute force or held-out labels."""

from __future__ import annotations

import collections
import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

import corpus_pipeline
from compare import connect, difference
from lumbung.llm import bpe, embeddings, language_id, line_dedup, minhash, packing, queries, secret_scan, spotsigs, warc

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet").orderBy("doc_id").toPandas()


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_its_sql(spark, connection, name):
    problem, count = difference(spark, connection, name, SF_DIR)
    assert problem is None and count > 0


def brute_lines(rows, min_lines=2, min_chars=40):
    """Texts by doc_id without the lines of runs that an earlier run equals, and whether any went.

    A run is followed from every pair of equal lines as far as both texts agree.
    """
    texts = [(doc_id, text.split("\n")) for doc_id, text in sorted(rows)]
    places, out = {}, {}
    for at, (doc_id, lines) in enumerate(texts):
        gone = set()
        for i, line in enumerate(lines):
            for other, j in places.get(line, []) + [(at, j) for j in range(i) if lines[j] == line]:
                earlier = texts[other][1]
                if i and j and lines[i - 1] == earlier[j - 1]:
                    if other != at:
                        continue  # found from the line before
                most = min(len(lines) - i, len(earlier) - j, i - j if other == at else len(lines))
                n = 0
                while n < most and lines[i + n] == earlier[j + n]:
                    n += 1
                if n >= min_lines and len("\n".join(lines[i : i + n])) >= min_chars:
                    gone.update(range(i, i + n))
        for i, line in enumerate(lines):
            places.setdefault(line, []).append((at, i))
        out[doc_id] = ("\n".join(line for i, line in enumerate(lines) if i not in gone), bool(gone))
    return out


def brute_groups(rows):
    """Smallest doc_id reachable over links of similarity 0.75, by document."""
    def words(text):
        return re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))

    sets = {}
    for doc_id, text in rows:
        w = words(text)
        sets[doc_id] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    root = {doc_id: doc_id for doc_id in sets}

    def top(doc_id):
        while root[doc_id] != doc_id:
            doc_id = root[doc_id]
        return doc_id

    ids = sorted(sets)
    for at, a in enumerate(ids):
        for b in ids[at + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {doc_id: top(doc_id) for doc_id in ids}, {doc_id: len(s) for doc_id, s in sets.items()}


def brute_spans(text):
    found = []
    for rank, rule in enumerate(secret_scan.RULES):
        for match in re.finditer(rule.pattern, text, re.I | re.A if rule.ignore_case else 0):
            if len(match[rule.group]) >= rule.least:
                found.append((match.start(), rank, rule.name, match.end()))
    return sorted(found)


def test_line_dedup(spark, docs):
    want = brute_lines(zip(docs.doc_id, docs.text))
    got = {r.doc_id: r for r in queries.op2_line_dedup(spark, SF_DIR).collect()}
    assert len(got) == len(docs) and any(went for _, went in want.values())
    for doc_id, (text, _) in want.items():
        assert got[doc_id].text_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert got[doc_id].chars_after == len(text)


def test_chunks_cover_and_resist_shifts():
    lines = [f"line {i * i % 97} of text" for i in range(60)]
    text = "\n".join(lines)
    spans = line_dedup.chunks(text)
    assert [s for s, *_ in spans] == [0, *[e + 1 for _, e, *_ in spans[:-1]]] and spans[-1][1] == len(text)
    shifted = line_dedup.chunks("new first line\n" + text)
    own, other = ({h for *_, h in found} for found in (spans, shifted))
    assert len(own & other) >= len(own) - 2


def test_near_duplicates(spark, docs):
    groups, sizes = brute_groups(zip(docs.doc_id, docs.text))
    for r in queries.op8_minhash(spark, SF_DIR).collect():
        assert (r.component_id, r.n_shingles) == (groups[r.doc_id], sizes[r.doc_id])
        assert r.kept == (r.doc_id == groups[r.doc_id])


def test_near_duplicates_in_a_chain_of_one_bucket(spark):
    """Members that the bucket's smallest member misses are still linked with each other."""
    words = [f"w{i}" for i in range(400)]
    rows = [(step, " ".join(words[step * 20 : step * 20 + 200])) for step in range(8)]
    rows += [(100 + i, " ".join(words[:180] + [f"x{i}{k}" for k in range(6)])) for i in range(60)]
    groups, _ = brute_groups(rows)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in minhash.near_duplicates(frame, minhash.Settings(block=8)).collect()}
    assert found == groups


def test_estimate_corrects_for_chance():
    rng = np.random.default_rng(1)
    common, own = rng.integers(0, 1 << 63, 3000, np.uint64), rng.integers(0, 1 << 63, (2, 500), np.uint64)
    settings = minhash.Settings()
    a, b = settings.permutations()
    packed = [
        minhash.pack(minhash._minima(np.concatenate([common, part]), a, b)[None, :], settings.bits) for part in own
    ]
    found = minhash.estimate(packed[0], packed[1], settings.minima, settings.bits)[0]
    assert abs(found - 0.75) < 0.12


def test_packing(spark, docs):
    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = queries.op6_packing(spark, SF_DIR).toPandas()
    for doc_id, text in zip(docs.doc_id, docs.text):
        ids = np.array([*whole.encode(text, add_special_tokens=False).ids, 1], "<u4")
        own = rows[rows.doc_id == doc_id].sort_values("piece")
        assert own.length.tolist() == [len(ids[s : s + 4096]) for s in range(0, len(ids), 4096)]
        assert own.start.tolist() == list(range(0, len(ids), 4096))
        assert own.ids_crc32.tolist() == [zlib.crc32(ids[s : s + 4096].tobytes()) for s in range(0, len(ids), 4096)]
    for _, bin_ in rows.sort_values("offset").groupby("sequence_id"):
        assert bin_.offset.tolist() == [0, *bin_.length.cumsum().tolist()[:-1]] and bin_.length.sum() <= 4096
    assert rows.sequence_id.nunique() <= rows.length.sum() / 4096 * 1.02 + 1


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_best_fit_keeps_every_capacity(rule):
    lengths = np.random.default_rng(3).integers(1, 101, 500)
    capacity = packing.Capacity(tokens=100, documents=4, attention=10_000, rule=rule)
    bins, offsets = packing.best_fit(lengths, capacity)
    for one in range(bins.max() + 1):
        held = np.flatnonzero(bins == one)
        assert 0 < len(held) <= 4 and lengths[held].sum() <= 100 and (lengths[held] ** 2).sum() <= 10_000
        order = held[np.argsort(offsets[held])]
        assert offsets[order].tolist() == [0, *np.cumsum(lengths[order])[:-1].tolist()]


def test_word_encoder_gives_the_ids_of_the_library():
    odd = ["İstanbul KÅ x́é", "don't we'll ²½ ªº", "<|endoftext|> a", "a\x85b\x1cc d", "", "  \n\t", "日本語 テスト", "Σας ΟΔΟΣ", "\v\xa0a\xa0bǅ"]
    import pyarrow as pa

    coder = packing.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    assert [i.tolist() for i in coder.ids(pa.array(odd))] == [coder.whole.encode(o, add_special_tokens=False).ids for o in odd]


def test_bpe(spark, docs):
    coder = bpe.encoding(queries.BYTE_RANKS, public_tokenizers.PATTERN)
    assert isinstance(coder, tiktoken.Encoding)
    got = {r.doc_id: r for r in queries.op9_bpe(spark, SF_DIR).collect()}
    for doc_id, text in zip(docs.doc_id, docs.text):
        ids = coder.encode_ordinary(text)
        assert got[doc_id].n_tokens == len(ids)
        assert got[doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[doc_id].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert [i for piece in bpe.pieces(text, 40) for i in coder.encode_ordinary(piece)] == ids


def test_language_id_on_the_held_out_fold(spark, docs):
    found = queries.op10_language_id(spark, "/root/testdata/sf0.01").toPandas()
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").toPandas()
    both = found.merge(docs, on="doc_id")
    assert len(both) == len(docs) and both.held_out.mean() < 0.3
    held = both[both.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.97
    assert all(zlib.crc32(str(i).encode()) % 5 == 0 for i in held.doc_id)


def test_quality_on_the_held_out_fold(spark):
    sf_dir = "/root/testdata/sf0.01"
    found = queries.op1_quality(spark, sf_dir).toPandas()
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").toPandas()
    held = found.merge(labels, on="doc_id")
    held = held[held.held_out]
    good, bad = held[held.quality == 1].score.to_numpy(), held[held.quality == 0].score.to_numpy()
    assert (good[:, None] > bad).mean() > 0.95
    assert (held.predicted == held.quality).mean() > 0.95
    assert ((found.score >= 0.3) == (found.predicted == 1)).all()


def plain_signatures(text):
    words = [w.strip(spotsigs._STRIP) for w in text.lower().split()]
    words = [w for w in words if w]
    found = set()
    for at, word in enumerate(words):
        if word in spotsigs.ANCHORS:
            chain = [w for w in words[at + 1 :] if w not in spotsigs.ANCHORS][: spotsigs.CHAIN]
            if len(chain) == spotsigs.CHAIN:
                found.add((word, *chain))
    return found or ({tuple(words)} if words else set())


def test_spotsigs(spark, docs):
    rows = list(zip(docs.doc_id, docs.text))[::-1]
    got = {r.doc_id: r for r in spotsigs.edited_likeness(spark.read.parquet(f"{SF_DIR}/documents.parquet"), per_block=9).collect()}
    short = [place for place, (_, text) in enumerate(rows) if len(text) < 4000]
    assert len(got) == len(rows)

    def alike(a, b):
        return len(a & b) / len(a | b) if a and b else float(not a and not b)

    for place in short:
        doc_id, text = rows[place]
        after = rows[(place + 1) % len(rows)][1]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        row = got[doc_id]
        assert (row.n_chars, row.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        own = plain_signatures(text)
        assert row.near_edited == pytest.approx(alike(own, plain_signatures(edited)))
        if len(after) < 4000:
            assert row.near_next == pytest.approx(alike(own, plain_signatures(after)))


def test_spotsigs_pairs(spark, docs):
    part = docs[docs.n_chars < 1500]
    frame = spark.createDataFrame(part[["doc_id", "text"]])
    pairs, members = spotsigs.similar_pairs(frame, 0.6)
    sets = {i: frozenset(s.tolist()) for i, s in zip(part.doc_id, spotsigs.fingerprints(part.text.tolist()))}
    smallest = {}
    for doc_id, s in sorted(sets.items()):
        smallest.setdefault(s, doc_id)
    heads = sorted(smallest.values())
    want = {
        (a, b) for at, a in enumerate(heads) for b in heads[at + 1 :]
        if len(sets[a] & sets[b]) >= 0.6 * len(sets[a] | sets[b])
    }
    assert {tuple(sorted((r.a, r.b))) for r in pairs.collect()} == want and want
    assert {r.doc_id: r.class_id for r in members.collect()} == {i: smallest[s] for i, s in sets.items()}


def test_warc_archives_are_readable_and_merged_in_order(spark):
    got = warc.capture_history(spark.read.parquet(f"{SF_DIR}/pages.parquet")).orderBy("slice", "place").collect()
    keys = [(r.url_key, r.captured_at, r.page_id) for r in got]
    assert keys == sorted(keys)


def test_loser_tree_merges_any_number_of_runs():
    rng = np.random.default_rng(2)
    for count in (0, 1, 2, 3, 7, 16):
        runs = [sorted((int(x), run) for x in rng.integers(0, 20, rng.integers(0, 9))) for run in range(count)]
        assert list(warc.LoserTree(runs)) == sorted(item for run in runs for item in run)


def test_embeddings_recall(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((300, 32))
    noise = rng.standard_normal((900, 32)) * 0.45
    rows = np.concatenate([base, np.repeat(base, 3, axis=0) + noise]).astype(np.float32)
    frame = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(rows)], "vec_id long, embedding array<float>")
    units = rows.astype(float) / np.linalg.norm(rows.astype(float), axis=1, keepdims=True)
    want = ((units @ units.T) >= 0.9).sum(axis=1) - 1
    got = embeddings.near_duplicates(frame).toPandas().set_index("vec_id").sort_index().n_links.to_numpy()
    assert (got <= want).all() and got.sum() >= 0.98 * want.sum() > 100


def test_trigram_queries():
    assert secret_scan.trigram_query(r"[0-9a-f]{24,}") == []
    assert secret_scan.trigram_query(r"AKIA[A-Z0-9]+") == [[frozenset({"aki", "kia"})]]
    assert secret_scan.trigram_query(r"(abc|xy)z") == [[frozenset({"abc", "bcz"}), frozenset({"xyz"})]]
    assert secret_scan.trigram_query(r"a.bcd") == [[frozenset({"bcd"})]]


def test_pipeline(spark, docs):
    """Every stage by brute force on what the one before kept."""
    model = language_id.fit(spark.read.parquet(f"{SF_DIR}/documents.parquet"))
    named = language_id.predict_texts(docs.text.tolist(), model, 0.3)[0]
    held = [(i, t) for i, t, name in zip(docs.doc_id, docs.text, named) if name != "und"]
    held = [(i, text) for i, (text, went) in brute_lines(held).items() if text.strip() or not went]
    groups, _ = brute_groups(held)
    held = [(i, text) for i, text in held if groups[i] == i]
    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = collections.Counter()
    for doc_id, text in held:
        parts, at = [], 0
        for start, _, _, end in brute_spans(text):
            if start >= at:
                parts += [text[at:start], "[secret]"]
            at = max(at, end)
        ids = np.array([*whole.encode("".join(parts) + text[at:], add_special_tokens=False).ids, 1], "<u4")
        for piece, start in enumerate(range(0, len(ids), 4096)):
            part = ids[start : start + 4096]
            want[doc_id, piece, start, len(part), zlib.crc32(part.tobytes())] += 1
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
