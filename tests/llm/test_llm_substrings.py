"""Substring dedup against windows compared one by one."""

from __future__ import annotations

import random

import pytest

from lumbung.llm import substring_dedup

SCHEMA = "doc_id long, text string, `group` string, words string, bucket string"


def brute(rows, window):
    """(doc_id, words, removed, text) by the definition: every window looked up by its words."""
    held = [(i, (text or "").encode().split()) for i, text in rows]
    first = {}
    for i, words in held:
        for at in range(len(words) - window + 1):
            key = tuple(words[at : at + window])
            if i is not None:
                first[key] = min(first.get(key, i), i)
    out = []
    for (i, text), (_, words) in zip(rows, held):
        gone = set()
        for at in range(len(words) - window + 1):
            if i is not None and first[tuple(words[at : at + window])] < i:
                gone.update(range(at, at + window))
        kept = b" ".join(word for at, word in enumerate(words) if at not in gone).decode()
        out.append((i, len(words), len(gone), None if text is None else kept))
    return sorted(out, key=str)


def found(spark, rows, **options):
    df = spark.createDataFrame([(i, text, "clash", "clash", "clash") for i, text in rows], SCHEMA)
    left = substring_dedup.dedup(df.repartition(4), **options).collect()
    return sorted([(r.doc_id, r.n_words, r.n_removed, r.text) for r in left], key=str), left


@pytest.mark.parametrize("seed", range(4))
def test_every_repeated_window_goes(spark, seed):
    rng = random.Random(seed)
    pool = [[rng.choice("abc") if rng.random() < 0.3 else f"w{rng.randint(0, 400)}" for _ in range(rng.randint(5, 40))] for _ in range(12)]
    rows = []
    for i in rng.sample(range(1000), 60):
        words = []
        for _ in range(rng.randint(0, 7)):
            words += rng.choice(pool) if rng.random() < 0.6 else [f"own{rng.randint(0, 10**6)}" for _ in range(rng.randint(1, 15))]
        rows.append((i, rng.choice([" ", "\n", " \t ", "\x0b"]).join(words)))
    rows += [(i, " ".join(["same"] * rng.randint(5, 60))) for i in (2000, 2001, 2002)]
    want = brute(rows, 12)
    assert found(spark, rows, window=12)[0] == want and sum(r[2] for r in want) > 100


def test_awkward_rows(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    no_break = passage.replace(" ", " ")  # no white space in the sense of the words
    rows = [
        (1, None), (2, ""), (3, " \n "), (4, "short text"), (4, f"a {passage}"), (4, f"b {passage}"), (5, f"c {passage} d"),
        (5, f"c {passage} d"), (None, passage), (None, None), (6, passage), (7, " ".join(passage.split()[:49])),
        (8, no_break), (9, no_break), (10, "é" * 200_000 + " " + passage), (11, " ".join(["日本"] * 30_000)), (12, " ".join(["日本"] * 55)),
    ]
    got, left = found(spark, rows)
    assert got == brute(rows, 50)
    assert {(r.doc_id, tuple(map(tuple, r.removed))) for r in left if r.removed} == {
        (5, ((1, 61),)), (6, ((0, 60),)), (10, ((1, 61),)), (12, ((0, 55),)),
    }
    assert found(spark, []) == ([], [])


def test_fingerprints_do_not_depend_on_slices(monkeypatch):
    import numpy as np

    texts = [b"some words of a text", b"", b"  more\tof them\n", b"x" * 300, b"last one"]
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(text) for text in texts])
    words = substring_dedup.Words(data, ends)
    cut = [data[a:b].tobytes() for a, b in zip(words.starts, words.stops)]
    assert cut == [word for text in texts for word in text.split()]
    whole = [words.hashes(lane) for lane in (0, 1)]
    monkeypatch.setattr(substring_dedup, "_AT_ONCE", 7)
    for lane in (0, 1):
        assert (words.hashes(lane) == whole[lane]).all()
        assert len(set(whole[lane].tolist())) == len(set(cut))
