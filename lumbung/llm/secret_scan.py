"""Secret scans through a trigram inverted index, in DataFrame functions alone.

Each rule's pattern is turned into a Boolean query over trigrams: an AND of groups, each an OR of
trigram sets, one of which any matching text must contain in full. The index holds, for each
trigram that some rule asks for, the documents whose lower-cased text contains it; intersecting
postings gives each rule's candidate documents, and only those are searched with the pattern itself.
A rule without a mandatory trigram (long hexadecimal runs) scans every document.

Spans are leftmost and non-overlapping per rule, in code points, ends exclusive. Defined results: a
NULL or empty text has no span. Rows that share a doc_id share candidates, and each is searched in
its own text, NULL doc_ids included.
"""

from __future__ import annotations

import re._constants as sre
import re._parser as sre_parse
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumbung.functions.storage import materialize


@dataclass(frozen=True)
class Rule:
    """A pattern; matches shorter than `least` (of `group`, 0 being the whole) are dropped."""

    name: str
    pattern: str
    ignore_case: bool = False
    group: int = 0
    least: int = 0

    @property
    def java(self) -> str:
        return f"(?i){self.pattern}" if self.ignore_case else self.pattern


BASE = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        ignore_case=True, group=2, least=6,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=20),
    # Greedy runs: the runs of at least 24 are the long ones among all runs.
    Rule("hex", r"[0-9a-f]{24,}"),
)
# Published formats of common credentials.
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY( BLOCK)?-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)
RULES = BASE + MORE
_MOST_STRINGS = 64
_MOST_BITS = 62


def trigram_query(pattern: str) -> list[list[frozenset[str]]]:
    """Mandatory trigrams, lower-cased: every group must have one alternative present in full."""
    groups: list[list[frozenset[str]]] = []

    def flush(strings: set[str]) -> None:
        found = [frozenset(s[i : i + 3].lower() for i in range(len(s) - 2)) for s in sorted(strings)]
        if all(found):
            # An alternative that contains another one is met only where that one is.
            least = [a for a in set(found) if not any(b < a for b in found)]
            groups.append(sorted(least, key=sorted))

    def join(left: set[str], right: set[str] | None) -> set[str]:
        if right is None or len(left) * len(right) > _MOST_STRINGS:
            flush(left)
            return right if right is not None and len(right) <= _MOST_STRINGS else {""}
        return {a + b for a in left for b in right}

    def strings(items) -> set[str] | None:
        """All strings that `items` match, or None if they are too many to list."""
        known: set[str] = {""}
        for kind, value in items:
            more = options(kind, value)
            if more is None or len(known) * len(more) > _MOST_STRINGS:
                return None
            known = {a + b for a in known for b in more}
        return known

    def options(kind, value) -> set[str] | None:
        if kind is sre.LITERAL:
            return {chr(value)}
        if kind is sre.IN and all(k is sre.LITERAL for k, _ in value):
            return {chr(v) for _, v in value}
        if kind is sre.SUBPATTERN:
            return strings(value[-1])
        if kind is sre.BRANCH:
            each = [strings(branch) for branch in value[1]]
            return None if None in each else set().union(*each)
        if kind is sre.MAX_REPEAT and value[1] <= 2:
            once = strings(value[2])
            if once is not None:
                repeated, all_ = {""}, set()
                for count in range(value[1] + 1):
                    all_ |= repeated if count >= value[0] else set()
                    repeated = {a + b for a in repeated for b in once}
                return all_ if len(all_) <= _MOST_STRINGS else None
        return None

    known: set[str] = {""}
    for kind, value in sre_parse.parse(pattern):
        known = join(known, options(kind, value))
    flush(known)
    return groups


def build_index(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Postings (trigram, doc_id) of every trigram that a rule's query names."""
    named = sorted({t for rule in rules for group in trigram_query(rule.pattern) for alt in group for t in alt})
    low = F.lower("text")
    present = F.array_compact(F.array(*[F.when(F.contains(F.col("low"), F.lit(t)), F.lit(t)) for t in named]))
    return (
        docs.select("doc_id", low.alias("low"))
        .select("doc_id", F.explode(present if named else F.array().cast("array<string>")).alias("trigram"))
    )


def candidates(postings: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, rules): the indexed rules whose trigram query the postings of a document satisfy."""
    clauses = []
    for rule in rules:
        groups = trigram_query(rule.pattern)
        for g, group in enumerate(groups):
            for a, alternative in enumerate(group):
                asked = sorted(alternative)[:_MOST_BITS]  # fewer trigrams only admit more candidates
                for place, trigram in enumerate(asked):
                    clauses.append(
                        (rule.name, len(groups), g, a, trigram, 1 << place, (1 << len(asked)) - 1)
                    )
    schema = "rule string, groups int, g int, a int, trigram string, bit long, full long"
    table = postings.sparkSession.createDataFrame(clauses, schema)
    met = (
        postings.join(F.broadcast(table), "trigram")  # as many rows as the rules have trigrams
        .groupBy("doc_id", "rule", "groups", "g", "a")
        .agg(F.bit_or("bit").alias("bits"), F.first("full").alias("full"))
        .where("bits = full")
    )
    return (
        met.groupBy("doc_id", "rule", "groups")
        .agg(F.bit_or(F.expr("shiftleft(1L, g)")).alias("met"))
        .where("met = shiftleft(1L, groups) - 1")
        .groupBy("doc_id")
        .agg(F.collect_set("rule").alias("rules"))  # at most one per rule
    )


def spans_of(rule: Rule, order: int, text: Column) -> Column:
    """Array of (start, rank, kind, end) of the rule's matches in `text`.

    The pieces between matches and the matches alternate, so running sums of their lengths are the
    places of the matches.
    """
    matches = F.regexp_extract_all(text, F.lit(rule.java), F.lit(0))
    held = (
        F.regexp_extract_all(text, F.lit(rule.java), F.lit(rule.group)) if rule.group else matches
    )
    gaps = F.split(text, rule.java, -1)
    pieces = F.arrays_zip(
        F.slice(gaps, 1, F.size(matches)).alias("gap"), matches.alias("match"), held.alias("held")
    )
    step = F.aggregate(
        pieces,
        F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("found")),
        lambda state, piece: F.struct(
            (state["at"] + F.length(piece["gap"]) + F.length(piece["match"])).alias("at"),
            F.when(
                F.length(piece["held"]) >= rule.least,
                F.concat(
                    state["found"],
                    F.array(
                        F.struct(
                            (state["at"] + F.length(piece["gap"])).alias("start"),
                            F.lit(order).alias("rank"),
                            F.lit(rule.name).alias("kind"),
                            (state["at"] + F.length(piece["gap"]) + F.length(piece["match"])).alias("end"),
                        )
                    ),
                ),
            ).otherwise(state["found"]).alias("found"),
        ),
    )["found"]
    return F.when(F.size(matches) > 0, step).otherwise(F.array().cast(_SPANS))


_SPANS = "array<struct<start:int,rank:int,kind:string,end:int>>"


def scan(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, postings: DataFrame | None = None,
    into: str = "secret_spans",
) -> DataFrame:
    """`docs` with a column `into`: (start, rank, kind, end), ordered by start, then rule.

    `postings` may be an index that was built before over the same documents.
    """
    if postings is None:
        postings = materialize(build_index(docs, rules), "postings")
    chosen = candidates(postings, rules).select(
        F.col("doc_id").alias("_lb_id"), F.col("rules").alias("_lb_rules")
    )
    joined = docs.join(chosen, F.col("doc_id").eqNullSafe(F.col("_lb_id")), "left")
    text = F.coalesce("text", F.lit(""))
    each = []
    for order, rule in enumerate(rules):
        spans = spans_of(rule, order, text)
        if trigram_query(rule.pattern):
            spans = F.when(F.array_contains("_lb_rules", rule.name), spans).otherwise(
                F.array().cast(_SPANS)
            )
        else:
            spans = F.when(F.regexp_like(text, F.lit(rule.java)), spans).otherwise(F.array().cast(_SPANS))
        each.append(spans)
    return joined.select(
        *[docs[name] for name in docs.columns], F.array_sort(F.concat(*each)).alias(into)
    )


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mark: str = "[secret]") -> DataFrame:
    """`docs` with every secret replaced by `mark` (overlapping spans by one), n_chars set anew."""
    columns = docs.columns
    found = scan(docs, rules, into="_lb_spans")
    state = F.aggregate(
        "_lb_spans",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts")),
        lambda s, span: F.when(
            span["start"] >= s["at"],
            F.struct(
                span["end"].alias("at"),
                F.concat(
                    s["parts"],
                    F.array(
                        F.substring(F.col("text"), s["at"] + 1, span["start"] - s["at"]),
                        F.lit(mark),
                    ),
                ).alias("parts"),
            ),
        ).otherwise(
            F.struct(F.greatest(s["at"], span["end"]).alias("at"), s["parts"].alias("parts"))
        ),
        lambda s: F.concat(
            F.array_join(s["parts"], ""), F.substring(F.col("text"), s["at"] + 1, F.length("text"))
        ),
    )
    text = F.when(F.size("_lb_spans") > 0, state).otherwise(F.col("text"))
    changed = found.withColumn("_lb_text", text)
    return changed.select(
        *[
            F.col("_lb_text").alias("text") if name == "text"
            else F.when(F.size("_lb_spans") > 0, F.length("_lb_text").cast(docs.schema[name].dataType))
            .otherwise(F.col(name)).alias(name) if name == "n_chars"
            else F.col(name)
            for name in columns
        ]
    )
