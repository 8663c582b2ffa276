"""Cases in which an operator once did less than the whole job."""

from __future__ import annotations

import random

import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from lumbung.llm import language_id, line_dedup, minhash, packing


def test_members_of_a_touched_component_are_compared_on_full_sets(spark):
    """The only link of `r` is to a member of a component that another of its members stands for."""
    rows = []
    for family in range(4):
        words = [f"f{family}w{i}" for i in range(500)]
        base = family * 100
        rows += [(base + i, " ".join([*words, *(f"f{family}p{i}t{k}" for k in range(3))])) for i in range(60)]
        rows += [(base + 60, " ".join(words[:480])), (base + 61, " ".join(words[:370]))]
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in found} == {i: i // 100 * 100 for i, _ in rows}


def test_texts_with_added_tokens_have_the_ids_of_the_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    whole = Tokenizer.from_file(path)
    texts = [
        "x <|endoftext|> a", "X<|startoftext|>y", "no mark", "<|ENDOFTEXT|> b", None, "", "<|endoftext|>",
        "Two <|endoftext|>\n<|endoftext|> İ", "cut <|endof text|>",
    ]
    got = [ids.tolist() for ids in packing.WordEncoder(path).ids(pa.array(texts))]
    assert got == [whole.encode(text or "", add_special_tokens=False).ids for text in texts]
    assert got[0] == [343, 49407, 320]


def brute_runs(rows, min_lines, min_chars):
    """Texts without the lines of maximal runs, found line by line, that equal an earlier run."""
    texts = [(doc_id, text.split("\n")) for doc_id, text in sorted(rows)]
    out = {}
    for at, (doc_id, lines) in enumerate(texts):
        gone = set()
        for other, earlier in texts[: at + 1]:
            for i in range(len(lines)):
                for j in range(i if other == doc_id else len(earlier)):
                    n, most = 0, i - j if other == doc_id else len(lines)
                    while n < most and i + n < len(lines) and j + n < len(earlier) and lines[i + n] == earlier[j + n]:
                        n += 1
                    if n >= min_lines and len("\n".join(lines[i : i + n])) >= min_chars:
                        gone.update(range(i, i + n))
        out[doc_id] = "\n".join(line for i, line in enumerate(lines) if i not in gone)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_line_dedup_finds_every_repeated_run(spark, seed):
    rng = random.Random(seed)
    pool = ["", "x", "ab", "some words", "a line of some length here", "another line that is longer than forty characters"]
    rows = [
        (i, "\n".join(rng.choice(pool) if rng.random() < 0.8 else f"own line {i} {k}" for k in range(rng.randint(1, 14))))
        for i in range(30)
    ]
    rows += [(100, "head\nfirst shared line of the pair\nsecond shared line of it\ntail")]
    rows += [(101, "other\nfirst shared line of the pair\nsecond shared line of it\nend")]
    left = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = brute_runs(rows, 2, 40)
    assert {r.doc_id: r.text for r in left} == want and want[101] == "other\nend"


def spoken(rng, syllables, words):
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) for _ in range(words))


@pytest.mark.parametrize("languages", [1, 2, 4])
def test_narrow_margins_go_whatever_the_length_and_the_languages(spark, languages):
    rng = random.Random(3)
    own = [["ka", "ro", "mi", "tu"], ["ble", "sch", "und", "ing"], ["oux", "ça", "é", "vre"], ["ñe", "dor", "lla", "aci"]][:languages]
    rows = [(i, spoken(rng, own[i % languages], 120), f"l{i % languages}", False) for i in range(200)]
    rows += [(1000 + i, spoken(rng, own[i % languages], 30_000), f"l{i % languages}", False) for i in range(4)]
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows += [(2000 + i, spoken(rng, letters, words), None, True) for i, words in enumerate([400, 2000, 30_000])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, odd boolean")
    model = language_id.fit(docs)
    assert len(model.dictionaries) == languages
    kept = {r.doc_id for r in language_id.keep_identified(docs, model).collect()}
    assert kept == {i for i, _, _, odd in rows if not odd}


def test_language_of_long_texts_only_has_a_dictionary(spark):
    rng = random.Random(4)
    rows = [(i, spoken(rng, ["ka", "ro", "mi", "tu"], 60), "short") for i in range(60)]
    rows += [(100 + i, spoken(rng, ["ble", "sch", "und", "ing"], 9000), "long") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert min(len(text) for _, text, lang in rows if lang == "long") > 20_000
    model = language_id.fit(docs)
    assert {name for name, _ in model.dictionaries} == {"short", "long"}
    assert all(0 < len(data) <= 32_768 for _, data in model.dictionaries)
    found = {r.doc_id: r.lang_pred for r in language_id.predict(docs, model).collect()}
    assert found == {i: lang for i, _, lang in rows}
