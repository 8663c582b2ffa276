from __future__ import annotations

import random

from conftest import rows
from lumbung.functions.ranking import rank_desc


def brute(data):
    """1 + the rows of the group that come strictly before; NULL comes first."""
    def order(v):
        return float("inf") if v is None else v

    ranked = [
        (g, v, i, 1 + sum(order(w) > order(v) for h, w, _ in data if h == g)) for g, v, i in data
    ]
    return sorted(ranked, key=str)


def sample(n, hot):
    rng = random.Random(7)
    data = []
    for i in range(n):
        group = "hot" if rng.random() < hot else rng.choice(["a", "b", None])
        value = None if rng.random() < 0.05 else rng.choice([0, 0, 0, rng.randrange(-40, 40)])
        data.append((group, value, i))
    return data


def test_ranks_equal_brute_force(spark):
    data = sample(600, 0.5)
    df = spark.createDataFrame(data, "g string, v int, i int").repartition(5)
    expected = brute(data)
    for slots in (2, 7, 64):
        ranked = rank_desc(df, ["g"], "v", "rank", slots)
        assert ranked.columns == ["g", "v", "i", "rank"]
        assert sorted(rows(ranked), key=str) == expected


def test_a_group_far_larger_than_the_rest(spark):
    data = [("hot", v // 2, v) for v in range(6000)] + [("small", 1, -1), ("none", None, -2)]
    df = spark.createDataFrame(data, "g string, v int, i int")
    ranked = rank_desc(df, ["g"], "v", "rank")
    found = dict(rows(ranked.where("g = 'hot'"), "i", "rank"))
    assert found == {v: 6000 - 2 * (v // 2) - 1 for v in range(6000)}
    windows = [
        line for line in ranked._jdf.queryExecution().optimizedPlan().toString().splitlines()
        if "Window [" in line
    ]
    # One window within slots, one over the slot totals.
    assert len(windows) == 2
    assert any("_slot" in line.split("]")[1] for line in windows)


def test_no_job_runs_while_the_plan_is_built(spark):
    spark.sparkContext.setJobGroup("planning", "planning")
    rank_desc(spark.range(10).selectExpr("id % 2 AS g", "id AS v"), ["g"], "v", "rank")
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("planning")
    spark.sparkContext.setJobGroup("tests", "tests")


def test_empty_input(spark):
    df = spark.createDataFrame([], "g string, v int")
    assert rank_desc(df, ["g"], "v", "rank").count() == 0


def test_slots_are_found_inside_codegen(spark):
    df = spark.createDataFrame(sample(50, 0.5), "g string, v int, i int")
    plan = rank_desc(df, ["g"], "v", "rank")._jdf.queryExecution().optimizedPlan().toString()
    assert "lambdafunction" not in plan
    nan = float("nan")
    data = [("a", v, i) for i, v in enumerate([nan, 2.0, None, -0.0, 0.0, nan, float("inf"), -1.5])]
    ranked = rank_desc(spark.createDataFrame(data, "g string, v double, i int"), ["g"], "v", "rank", 4)
    assert dict(rows(ranked, "i", "rank")) == {2: 1, 0: 2, 5: 2, 6: 4, 1: 5, 3: 6, 4: 6, 7: 8}
