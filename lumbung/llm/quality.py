"""Quality classifier: a sparse ensemble of rules over text statistics.

Statistics of every text are Spark expressions. Shallow random trees over the labelled training fold
give rules, one per node: the conjunction of the comparisons on its path. A lasso-penalised logistic
regression over the rules keeps few of them, and those are compiled into one Spark column expression.

Defined results: a NULL text counts as empty, whose statistics are all 0. Labels outside 0 and 1 are
not learned from. With no labelled row, or one class alone, every score is the share of label 1 (0.5
without rows). Repeated rows are scored alike; extra columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumbung.functions.storage import materialize
from lumbung.llm.common import held_out, partitions_for

#: A rule: comparisons (statistic, whether at most, bound) that must all hold.
Rule = tuple[tuple[str, bool, float], ...]


@dataclass(frozen=True)
class RuleModel:
    intercept: float
    rules: tuple[tuple[Rule, float], ...]


def _share(part: Column, whole: Column) -> Column:
    return F.coalesce(part / F.nullif(whole, F.lit(0)), F.lit(0.0)).cast("double")


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of each text, all DOUBLE and never NULL."""
    text = F.coalesce("text", F.lit(""))
    base = docs.select(
        "doc_id", text.alias("text"), F.length(text).alias("n"),
        F.filter(F.split(text, r"\s+"), lambda w: w != "").alias("words"),
        F.filter(F.split(text, "\n"), lambda w: w != "").alias("lines"),
    )
    n, words, lines = F.col("n"), F.size("words"), F.size("lines")

    def count(pattern: str) -> Column:
        return F.regexp_count("text", F.lit(pattern))

    def without(marks: str) -> Column:
        return n - F.length(F.translate("text", marks, ""))

    return base.select(
        "doc_id",
        F.log1p(n).alias("log_chars"),
        F.log1p(words).alias("log_words"),
        F.log1p(lines).alias("log_lines"),
        _share(n, words).alias("chars_per_word"),
        _share(words, lines).alias("words_per_line"),
        _share(F.size(F.array_distinct("words")), words).alias("distinct_words"),
        _share(F.size(F.array_distinct("lines")), lines).alias("distinct_lines"),
        _share(count(r"\p{Lu}"), n).alias("upper"),
        _share(without("0123456789"), n).alias("digits"),
        _share(without("!?"), n).alias("marks"),
        _share(without(".,;:"), n).alias("stops"),
        _share(without("#$%&*@~^<>{}[]\\|_=+"), n).alias("symbols"),
        _share(without("|"), n).alias("bars"),
        _share(
            F.size(F.filter("words", lambda w: F.length(w) <= 3)), words
        ).alias("short_words"),
        _share(F.aggregate(
            "words", F.struct(F.lit("").alias("last"), F.lit(0).alias("same")),
            lambda s, w: F.struct(w.alias("last"), (s["same"] + (s["last"] == w).cast("int")).alias("same")),
            lambda s: s["same"],
        ), words).alias("stutter"),
    )


def fit(
    stats: DataFrame, labels: DataFrame, max_rows: int = 200_000, trees: int = 24, depth: int = 3,
    penalty: float = 5e-4, seed: int = 11,
) -> RuleModel:
    """Learn from the training fold of `labels` (doc_id, quality), at most about `max_rows` rows.

    Beyond `max_rows` labelled rows a share of them is taken by a hash of doc_id.
    """
    names = [name for name in stats.columns if name != "doc_id"]
    marked = labels.where(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"))).select(
        "doc_id", F.col("quality").cast("double").alias("label")
    )
    totals = marked.agg(F.count(F.lit(1)).alias("n"), F.avg("label").alias("mean")).first()
    if totals.n > max_rows:
        part = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * max_rows / totals.n)
        marked = marked.where(part)
    joined = stats.join(marked, "doc_id").select("label", *names)
    rows = materialize(
        joined.repartition(partitions_for(min(totals.n, max_rows), 25_000)), "training"
    )
    classes = rows.select("label").distinct().count()
    if classes < 2:
        mean = totals.mean if totals.mean is not None else 0.5
        return RuleModel(_logit(mean), ())
    vector = array_to_vector(F.array(*names)).alias("features")
    forest = RandomForestClassifier(
        numTrees=trees, maxDepth=depth, maxBins=64, subsamplingRate=0.5, seed=seed,
        featureSubsetStrategy="onethird", minInstancesPerNode=3,
    ).fit(rows.select("label", vector))
    found: dict[Rule, None] = {}
    for tree in forest.trees:
        _paths(tree._call_java("rootNode"), names, (), found)
    rules = list(found)
    if not rules:
        return RuleModel(_logit(totals.mean), ())
    held = array_to_vector(F.array(*[_holds(rule).cast("double") for rule in rules]))
    lasso = LogisticRegression(
        elasticNetParam=1.0, regParam=penalty, maxIter=60, standardization=False
    ).fit(rows.select("label", held.alias("features")))
    weights = lasso.coefficients.toArray()
    kept = tuple((rule, float(weight)) for rule, weight in zip(rules, weights) if weight)
    return RuleModel(float(lasso.intercept), kept)


def _logit(share: float) -> float:
    share = min(max(share, 1e-6), 1 - 1e-6)
    return math.log(share / (1 - share))


def _paths(node, names: list[str], path: Rule, found: dict[Rule, None]) -> None:
    """Add the rule of every node below a tree's root."""
    if path:
        found[tuple(sorted(set(path)))] = None
    if node.getClass().getSimpleName() == "InternalNode":
        split = node.split()
        name, bound = names[split.featureIndex()], float(split.threshold())
        _paths(node.leftChild(), names, (*path, (name, True, bound)), found)
        _paths(node.rightChild(), names, (*path, (name, False, bound)), found)


def _holds(rule: Rule) -> Column:
    condition = F.lit(True)
    for name, at_most, bound in rule:
        condition &= (F.col(name) <= bound) if at_most else (F.col(name) > bound)
    return condition


def score_column(model: RuleModel) -> Column:
    """The compiled model: an expression over the columns of `statistics`."""
    total = F.lit(model.intercept)
    for rule, weight in model.rules:
        total += F.when(_holds(rule), weight).otherwise(0.0)
    return 1.0 / (1.0 + F.exp(-total))


def score(stats: DataFrame, model: RuleModel, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    scored = stats.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score_column(model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
