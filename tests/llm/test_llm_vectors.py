"""Whitening and hard negatives against plain numpy, on the given tables and on awkward ones."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumbung.llm import embeddings, hard_negatives, queries, whitening

SF_DIR = "/root/testdata/sf0.001"
NAN, INF = float("nan"), float("inf")


def schema(kind=None):
    return T.StructType([
        T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(kind or T.FloatType())),
        T.StructField("label", T.IntegerType()), T.StructField("x", T.StringType()), T.StructField("n", T.StringType()),
    ])


def spectra():
    draw = np.random.default_rng(0)
    turn, _ = np.linalg.qr(draw.standard_normal((40, 40)))
    tall = draw.standard_normal((300, 40))
    few = draw.standard_normal((12, 40))
    return {
        "spread": tall.T @ tall / 300,
        "equal": np.eye(40),
        "two values": np.diag(np.r_[np.full(10, 5.0), np.ones(30)]),
        "one large": turn @ np.diag(np.r_[1e6, np.ones(20), 1 + 1e-9 * np.arange(19)]) @ turn.T,
        "falling": turn @ np.diag(0.5 ** np.arange(40)) @ turn.T,
        "low rank": few.T @ few,
        "one": np.array([[3.0]]),
        "indefinite pivots": np.array([[0.0, 1.0], [1.0, 0.0]]) + 2 * np.eye(2),
    }


@pytest.mark.parametrize("name", sorted(spectra()))
def test_intervals_hold_as_many_eigenpairs_as_inertia_says(name):
    matrix = (spectra()[name] + spectra()[name].T) / 2
    want = np.linalg.eigvalsh(matrix)[::-1]
    for shift in (want[0] * 1.01, want.mean() + 1e-7, (want[0] + want[-1]) / 2 + 1e-7):
        assert whitening.inertia(matrix, shift) == (want > shift).sum()
    places = whitening.cuts(matrix, min(12, len(matrix)))
    got = []
    for (high, above), (low, below) in zip(places, places[1:]):
        values, vectors = whitening.feast(matrix, low, high, below - above)
        assert np.abs(matrix @ vectors - vectors * values).max() <= 1e-12 * want[0]
        got += values.tolist()
    assert len(got) >= min(12, len(matrix))
    assert np.allclose(got, want[: len(got)], rtol=0, atol=1e-13 * want[0])


def test_whitening_equals_a_plain_eigendecomposition(spark):
    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").orderBy("vec_id").collect()
    x = np.floor(64 * np.array([r.embedding for r in rows], float)).astype(np.int64) + 1_000_000
    apart = len(x) * x - x.sum(axis=0)
    centred = apart / len(x)
    values, vectors = np.linalg.eigh(centred.T @ centred / len(x))
    values, vectors = values[::-1][:32], vectors[:, ::-1][:, :32]
    want = centred @ vectors / np.sqrt(values)
    found = queries.op11_whitening(spark, SF_DIR).orderBy("vec_id", "component").collect()
    assert [(r.vec_id, r.component) for r in found] == [(r.vec_id, c) for r in rows for c in range(1, 33)]
    got = np.array([r.whitened for r in found]).reshape(want.shape)
    assert np.allclose(got * np.sign((got * want).sum(axis=0)), want, rtol=0, atol=1e-9)
    trace = (centred**2).sum() / len(x)
    assert np.allclose([r.explained for r in found[:32]], values / trace, rtol=1e-9)
    assert [r.deviation for r in found[::32]] == (apart * apart).sum(axis=1).tolist()
    assert {r.n for r in found} == {len(x)} and {r.identity_error for r in found}.pop() < 1e-9


def test_whitening_of_awkward_rows(spark):
    draw = np.random.default_rng(1)
    good = [(i, [float(v) for v in draw.standard_normal(3)] + [0.5], 1) for i in range(20)]
    odd = [(30, None, 1), (31, [NAN, 1.0, 1.0, 1.0], 1), (32, [1.0, None, 1.0, 1.0], 1), (33, [INF, 0.0, 0.0, 0.0], 1), (34, [], 1)]
    twice = [good[0], (None, good[1][1], None)]
    other = [(40, [1.0, 2.0], 1), (41, [2.0, 1.0], 1), (42, [5.0], 1)]
    rows = [(*row, "clash", "clash") for row in good + odd + twice + other]
    found = whitening.whiten(spark.createDataFrame(rows, schema(T.DoubleType())).repartition(3)).collect()
    count = {}
    for r in found:
        count[r.vec_id] = count.get(r.vec_id, 0) + 1
    # The fourth dimension never varies; two vectors of length two vary along one line; one vector does not vary.
    assert count == {**{i: 3 for i in range(1, 20)}, 0: 6, None: 3, 40: 1, 41: 1}
    assert {r.n for r in found if r.vec_id not in (40, 41)} == {22}
    assert all(r.identity_error < 1e-9 for r in found)
    assert whitening.whiten(spark.createDataFrame([], schema())).count() == 0
    equal = [(i, [1.0, 2.0], 1, None, None) for i in range(5)]
    assert whitening.whiten(spark.createDataFrame(equal, schema())).count() == 0


@pytest.mark.parametrize("bound", [1, 40, 7000, 10**6])
def test_residue_products_are_exact(bound):
    draw = np.random.default_rng(bound)
    left, right = (draw.integers(-bound, bound + 1, (5, 1500)) for _ in range(2))
    right[0], left[0] = bound, -bound  # the largest score in size
    system = hard_negatives.Residues(1500 * bound * bound)
    assert (system.product(system.split(left), system.split(right)) == left @ right.T).all()
    assert all(prime < 256 for prime in system.primes) and system.modulus > 3000 * bound * bound


def brute(rows, anchors, positives=5, negatives=3):
    """rows: (id, label, whole vector)."""
    out = []
    for a, label, x in rows:
        if a not in anchors:
            continue
        scored = sorted(((-sum(p * q for p, q in zip(x, y)), b, other) for b, other, y in rows if b != a and len(y) == len(x)))
        for limit, positive, _ in [s for s in scored if s[2] == label][:positives]:
            inside = [s for s in scored if s[2] != label and 50 * -limit <= 100 * -s[0] <= 95 * -limit]
            out += [(a, positive, rank, b, -limit, -score) for rank, (score, b, _) in enumerate(inside[:negatives], 1)]
    return sorted(out)


def test_hard_negatives_with_ties_and_few_rows_of_a_label(spark):
    draw = np.random.default_rng(2)
    rows = [(i, int(draw.integers(0, 4)), draw.integers(-3, 6, 5).tolist()) for i in range(120)]
    rows += [(200 + i, 9, [4, 4, 4, 4, 4]) for i in range(3)] + [(300, 8, [1, 1, 1, 1, 1]), (301, 7, [2, 2]), (302, 6, [2, 2])]
    rows += [(400 + i, 5, [2, 2, 2, 2, 2]) for i in range(8)]
    df = spark.createDataFrame([(i, label, x) for i, label, x in rows], "vec_id long, label long, x array<long>")
    anchors = {i for i, _, _ in rows if i % 10 == 0 or i >= 200}
    found = hard_negatives.mine(df.repartition(5), F.col("vec_id").isin(*anchors), block=60)
    want = brute(rows, anchors)
    assert sorted(map(tuple, found.collect())) == want and any(r[0] >= 200 for r in want)


def test_hard_negatives_of_awkward_rows(spark):
    base = [(i, [float(1 + (i * k) % 5) for k in range(1, 5)], i % 3) for i in range(40)]
    odd = [
        (100, None, 1), (150, [NAN, 1.0, 1.0, 1.0], 1), (200, [1.0, None, 1.0, 1.0], 1), (250, [1.0, 1.0, 1.0, 1.0], None),
        (None, [9.0, 9.0, 9.0, 9.0], 1), (300, [], 0), (301, [], 0),
    ]
    rows = [(*row, "clash", "clash") for row in base + base[:5] + odd]
    df = spark.createDataFrame(rows, schema())
    found = hard_negatives.mine(hard_negatives.prepare(df), F.col("vec_id") % 10 == 0)
    whole = [(i, label, [int(256 * v) for v in x]) for i, x, label in base]
    assert sorted(map(tuple, found.collect())) == brute(whole, {0, 10, 20, 30})
    none = hard_negatives.prepare(spark.createDataFrame([], schema()))
    assert hard_negatives.mine(none, F.col("vec_id") % 10 == 0).count() == 0
    huge = spark.createDataFrame([(0, [1e12], 0, None, None)], schema())
    with pytest.raises(ValueError, match="scale the vectors down"):
        hard_negatives.mine(hard_negatives.prepare(huge), F.lit(True))


@pytest.mark.parametrize("kind", [T.FloatType(), T.DoubleType()])
def test_links_of_all_lengths_in_the_stored_precision(spark, kind):
    draw = np.random.default_rng(5)
    stored = np.float32 if isinstance(kind, T.FloatType) else np.float64
    rows = []
    for width in (2, 5, 16):
        centres = draw.standard_normal((6, width))
        for at in range(40):
            rows.append((100 * width + at, (centres[at % 6] + 0.25 * draw.standard_normal(width)).astype(stored)))
        rows += [(100 * width + 50, rows[-1][1]), (100 * width + 51, rows[-2][1] * 2)]
    # Cosines of 0.9 but for a part in 10^12, which single precision cannot tell apart.
    for at, cosine in ((1, 0.9 - 1e-12), (2, 0.9 + 1e-12)):
        side = float(np.sqrt(1 - cosine**2))
        rows += [(9000 + 10 * at, np.array([1e3, 0, 0], stored)), (9001 + 10 * at, np.array([cosine, side, 0], stored))]
    df = spark.createDataFrame([(i, [float(v) for v in x], 0, None, None) for i, x in rows], schema(kind))
    links = {i: set() for i, _ in rows}
    for a, x in rows:
        for b, y in rows:
            if a != b and len(x) == len(y):
                p, q = x.astype(float), y.astype(float)
                if p / np.linalg.norm(p) @ (q / np.linalg.norm(q)) >= 0.9:
                    links[a].add(b)
    found = {r.vec_id: r for r in embeddings.near_duplicates(df).collect()}
    assert {i: r.n_links for i, r in found.items()} == {i: len(held) for i, held in links.items()}
    assert all(found[i].component_id == min(found[j].component_id for j in held | {i}) for i, held in links.items())
