"""License scans by ordered signature rules (native functions only).

A text is lower-cased (A-Z) and cut into words; rules are regular expressions over the words
(``license_rules``).  A keyword prefilter gates them: one pass over the words finds which keywords
occur, and only rules whose keyword does are searched, so most texts meet no expression at all.

Each word carries its number behind a mark, and a rule's spaces are compiled to match the mark and number,
so the first and last number inside a match are the words where it begins and ends; no position is ever
computed from lengths.  One rule's matches do not overlap each other.

Overlaps between rules: detections are sorted by (first word, longest first, level, rule), and one that lies
inside another of the same or a stronger level is suppressed (equal spans: the earlier in that order stays).
What holds a detection comes before it in the sort, so "some earlier span of my level or stronger ends at
or behind my end" is a running maximum; it is taken in blocks, so texts with very many detections stay cheap.
Detections that only cross stay.  Base phrases keep their label and all their places even where suppressed.

``score`` is 1 - the product over the distinct labels that stay of (1 - weight of the strongest level): 0 for
no finding, 1 for license wording.

Defined results: a null or empty text, or one without words, has no findings, score 0 and empty labels; texts
are scanned whole however long; null doc_ids, repeated rows and ties are kept row by row (nothing is grouped); an
empty table gives no rows; other columns are returned unchanged whatever their names (the result is one struct
column whose name is a parameter).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty
from .license_rules import Rule, default_rules

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
MARK = "\x01"  # never part of a word
NUMBER = rf"{MARK}\d+"
LEVELS = (1, 2, 3, 4)
WEIGHTS = (1.0, 0.9, 0.7, 0.3)
BLOCK = 64
NO_SPANS = "array<struct<first:int,last:int,label:string,level:int,rule:int>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """The words of a text with A-Z lowered.

    ``lower`` maps one letter beyond ASCII into ASCII (the Kelvin sign); it is put out of the way first.
    """
    lowered = F.lower(F.replace(text, F.lit("K"), F.lit("ĸ")))
    return F.array_remove(F.split(lowered, SEPARATORS), "")


def compiled(pattern: str) -> str:
    """A rule's pattern over numbered words: every space (an optional one as well) follows a word and its number."""
    numbered = re.sub(r" (\?)?", lambda m: f"(?:{NUMBER} )?" if m[1] else f"{NUMBER} ", pattern)
    return f"(?<= )(?:{numbered}){NUMBER} "


def _rule_table(rules: Sequence[Rule]) -> Column:
    return F.array(*[F.struct(F.lit(r.keyword).alias("keyword"), F.lit(compiled(r.pattern)).alias("regex"),
                              F.lit(r.label).alias("label"), F.lit(r.level).alias("level"), F.lit(i).alias("rule"))
                     for i, r in enumerate(rules)])


def _detections(tokens: Column, hits: Column, rules: Sequence[Rule]) -> Column:
    """Every match of every gated rule: (first, behind, level, rule, label), sorted."""
    numbered = F.concat(F.lit(" "), F.array_join(F.transform(
        tokens, lambda w, i: F.concat(w, F.lit(MARK), i.cast("string"))), " "), F.lit(" "))

    def search(text: Column) -> Column:
        gated = F.filter(_rule_table(rules), lambda r: F.array_contains(hits, r["keyword"]))
        found = F.transform(gated, lambda r: F.transform(
            F.regexp_extract_all(text, r["regex"], F.lit(0)),
            lambda m: F.struct(F.substring_index(F.substring_index(m, " ", 1), MARK, -1).cast("int").alias("first"),
                               (-F.trim(F.substring_index(m, MARK, -1)).cast("int")).alias("minus_last"),
                               r["level"].alias("level"), r["rule"].alias("rule"), r["label"].alias("label"))))
        return F.array_sort(F.flatten(found))

    return let(numbered, search)


def _item(i: int) -> Callable[[Column], Column]:
    return lambda x: x[i]


def _unsuppressed(spans: Column) -> Column:
    """The sorted spans that lie in no earlier span of their level or a stronger one."""

    def top(some: Column, level: Column | int) -> Column:
        return F.array_max(F.transform(some, lambda x: F.when(x["level"] <= level, -x["minus_last"])))

    starts = F.sequence(F.lit(0), F.call_function("div", F.size(spans) - 1, F.lit(BLOCK)).cast("int"))

    def block(c: Column) -> Column:
        return F.slice(spans, c * BLOCK + 1, F.lit(BLOCK))

    tops = F.transform(starts, lambda c: let(block(c), lambda s: F.array(*[top(s, p) for p in LEVELS])))

    def sift(t: Column) -> Column:
        def one(c: Column) -> Column:
            before = F.array(*[F.array_max(F.transform(F.slice(t, F.lit(1), c), _item(i))) for i in range(len(LEVELS))])
            return let(before, lambda carry: let(block(c), lambda s: F.filter(s, lambda x, i: ~F.coalesce(
                F.greatest(F.element_at(carry, x["level"]), top(F.slice(s, F.lit(1), i), x["level"])) >= -x["minus_last"],
                F.lit(False)))))
        return F.flatten(F.transform(starts, one))

    return F.when(F.size(spans) > 0, let(tops, sift)).otherwise(spans)


def _spans(found: Column) -> Column:
    return F.transform(found, lambda x: F.struct(
        x["first"].alias("first"), (-x["minus_last"]).alias("last"), x["label"].alias("label"),
        x["level"].alias("level"), x["rule"].alias("rule")))


def scan(docs: DataFrame, text: str = "text", result: str = "license", rules: Sequence[Rule] | None = None) -> DataFrame:
    """``docs`` with one struct column: n_words, base (every place of a base phrase: first, last, label, level, rule)
    and spans (the detections that stay); words count from 0."""
    rules = list(default_rules() if rules is None else rules)
    keywords = F.array(*[F.lit(k) for k in sorted({r.keyword for r in rules})])
    base_rules = [i for i, r in enumerate(rules) if r.base]

    def sort_out(found: Column) -> Column:
        is_base = F.filter(found, lambda x: x["rule"].isin(base_rules)) if base_rules else F.slice(found, F.lit(1), F.lit(0))
        return F.struct(_spans(is_base).alias("base"), _spans(_unsuppressed(found)).alias("spans"))

    def look(tokens: Column) -> Column:
        nothing = F.struct(F.array().cast(NO_SPANS).alias("base"), F.array().cast(NO_SPANS).alias("spans"))
        findings = let(F.array_intersect(tokens, keywords), lambda hits: F.when(
            F.size(hits) > 0, let(_detections(tokens, hits, rules), sort_out)).otherwise(nothing))
        return let(findings, lambda f: F.struct(F.size(tokens).cast("long").alias("n_words"), f["base"].alias("base"),
                                                f["spans"].alias("spans")))

    return docs.withColumn(result, let(words(text_or_empty(text)), look))


def label_list(*spans: Column) -> Column:
    """The distinct labels, sorted and joined by commas."""
    labels = [F.transform(s, lambda x: x["label"]) for s in spans]
    return F.array_join(F.array_sort(F.array_distinct(F.concat(*labels))), ",")


def score(base: Column, spans: Column) -> Column:
    """1 - product over labels of (1 - weight of the label's strongest level)."""
    weight = F.array(*[F.lit(w) for w in WEIGHTS])

    def total(every: Column) -> Column:
        labels = F.array_sort(F.array_distinct(F.transform(every, lambda x: x["label"])))
        left = F.transform(labels, lambda name: F.lit(1.0) - F.element_at(
            weight, F.array_min(F.transform(F.filter(every, lambda x: x["label"] == name), lambda x: x["level"]))))
        return F.lit(1.0) - F.aggregate(left, F.lit(1.0), lambda a, b: a * b)

    return let(F.concat(base, spans), total)
