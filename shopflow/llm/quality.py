"""Quality classifier: a sparse rule ensemble over text statistics, compiled to Spark columns.

``statistics`` are column expressions over the whole text.  Shallow boosted trees are grown on
them; every path from a root to a node below it becomes a conjunctive rule (a set of
``statistic <= / > threshold`` conditions).  A lasso logistic regression over the rules sets most
weights to zero; the rules that remain, with their weights, are the model.  ``score_column``
compiles it to one column expression, so scoring is a projection: no join, shuffle or Python.

Trees and lasso are fitted on at most ``FIT_ROWS`` labelled rows (the ones of smallest id hash, a
documented bound), with classes weighted equally.  Labels, lang, source and doc_id are no inputs.

Defined results: a null text counts as empty and is scored like any text; long texts are read whole; labels that are null, not
0 or 1, or without a document are left out; repeated rows are scored each; if only one class has
labels the model is that class's constant; an empty table gives no rows; other columns are kept
untouched by ``with_score`` (whose own column names are given by the caller).
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold, text_or_empty, written

FIT_ROWS = 20_000
TREES, DEPTH, LASSO = 12, 3, 0.002


def statistics(text: Column) -> dict[str, Column]:
    """Named statistics (doubles, never null) of a text column without nulls."""
    chars = F.char_length(text).cast("double")
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split(text, r"\n"), lambda x: x != "")
    n_words = F.size(words).cast("double")

    def per(count: Column, total: Column) -> Column:
        return count.cast("double") / F.greatest(total, F.lit(1.0))

    return {
        "log_words": F.log1p(n_words),
        "word_length": per(chars, n_words),
        "distinct_words": per(F.size(F.array_distinct(words)), n_words),
        "distinct_lines": per(F.size(F.array_distinct(lines)), F.size(lines).cast("double")),
        "words_per_line": per(n_words, F.size(lines).cast("double")),
        "symbols": per(F.regexp_count(text, F.lit(r"[^\p{L}\p{N}\s.,]")), chars),
        "symbol_runs": per(F.regexp_count(text, F.lit(r"[^\p{L}\p{N}\s]{2,}")), n_words),
        "stops": per(F.regexp_count(text, F.lit(r"[.!?]")), n_words),
        "commas": per(F.regexp_count(text, F.lit(",")), n_words),
        "digits": per(F.regexp_count(text, F.lit(r"\p{N}")), chars),
        "capitals": per(F.regexp_count(text, F.lit(r"\p{Lu}")), n_words),
        "all_capitals": per(F.regexp_count(text, F.lit(r"\p{Lu}{3,}")), n_words),
        "short_words": per(F.regexp_count(text, F.lit(r"(?<!\S)\S{1,3}(?!\S)")), n_words),
    }


@dataclass(frozen=True)
class Rule:
    """Conditions (statistic, below, threshold) that must all hold, and the weight if they do."""

    conditions: tuple[tuple[str, bool, float], ...]
    weight: float = 0.0

    def holds(self, values: dict[str, Column]) -> Column:
        out = F.lit(True)
        for name, below, threshold in self.conditions:
            out = out & ((values[name] <= F.lit(threshold)) if below else (values[name] > F.lit(threshold)))
        return out


@dataclass(frozen=True)
class RuleEnsemble:
    bias: float
    rules: tuple[Rule, ...]

    def score_column(self, values: dict[str, Column]) -> Column:
        total = F.lit(self.bias)
        for rule in self.rules:
            total = total + F.when(rule.holds(values), F.lit(rule.weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))

    def with_score(self, docs: DataFrame, text: str = "text", into: str = "score") -> DataFrame:
        """``docs`` with the score of each whole text; statistics are computed once per row."""
        stats = statistics(text_or_empty(text))
        held = docs.withColumn(into, F.struct(*[c.alias(k) for k, c in stats.items()]))
        return held.withColumn(into, self.score_column({k: F.col(into)[k] for k in stats}))


def tree_rules(debug: str, names: list[str]) -> list[Rule]:
    """All root-to-node paths of a tree ensemble's printed form (public ``toDebugString``)."""
    rules, path = {}, []
    for line in debug.splitlines():
        if re.match(r"\s*Tree \d+", line):
            path = []
            continue
        found = re.match(r"(\s*)(If|Else) \(feature (\d+) (<=|>) ([-\d.eE]+)\)", line)
        if not found:
            continue
        indent = len(found[1])
        path = [p for p in path if p[0] < indent]
        path.append((indent, names[int(found[3])], found[4] == "<=", float(found[5])))
        rules[_merged([p[1:] for p in path])] = None
    return [Rule(c) for c in rules]


def _merged(path: list[tuple[str, bool, float]]) -> tuple[tuple[str, bool, float], ...]:
    """The tightest bound for each statistic and direction, in a fixed order."""
    bounds: dict[tuple[str, bool], float] = {}
    for name, below, threshold in path:
        old = bounds.get((name, below))
        bounds[name, below] = threshold if old is None else (min if below else max)(old, threshold)
    return tuple(sorted((n, b, t) for (n, b), t in bounds.items()))


def labelled(docs: DataFrame, labels: DataFrame, label: str, fold_of: int, held_out: int,
             rows: int) -> DataFrame:
    """text and y of at most ``rows`` training documents: the ones of smallest hash of the id.  Labels without a
    document are left out before the bound is applied, so they take no other's place."""
    chosen = (labels.select(F.col("doc_id").alias("doc_id"), F.col(label).cast("int").alias("y"))
              .where(F.col("y").isin(0, 1) & F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), fold_of) != held_out))
              .join(docs.select(F.col("doc_id").alias("doc_id")), "doc_id", "left_semi")
              .orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(rows))
    # at most ``rows`` ids: small enough to send to every task, so no text is shuffled
    return docs.select(F.col("doc_id").alias("doc_id"), text_or_empty().alias("text")).join(F.broadcast(chosen), "doc_id")


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", fold_of: int = 4, held_out: int = 2,
        rows: int = FIT_ROWS) -> RuleEnsemble:
    sample = labelled(docs, labels, label, fold_of, held_out, rows)
    stats = statistics(F.col("text"))
    names = list(stats)
    table = written(sample.select("y", *[c.alias(k) for k, c in stats.items()]), "quality-fit")
    count = {r["y"]: r["n"] for r in table.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(count) < 2:
        return RuleEnsemble(20.0 if count.get(1) else -20.0 if count.get(0) else 0.0, ())
    total = sum(count.values())
    weight = F.when(F.col("y") == 1, total / 2 / count[1]).otherwise(total / 2 / count[0])
    train = VectorAssembler(inputCols=names, outputCol="features").transform(
        table.withColumn("weight", weight)).coalesce(4).cache()
    trees = GBTClassifier(labelCol="y", weightCol="weight", maxIter=TREES, maxDepth=DEPTH, seed=7,
                          minInstancesPerNode=5).fit(train)
    rules = tree_rules(trees.toDebugString, names)
    values = {k: F.col(k) for k in names}
    hits = train.select("y", "weight", array_to_vector(
        F.array(*[r.holds(values).cast("double") for r in rules])).alias("rules")).cache()
    lasso = LogisticRegression(featuresCol="rules", labelCol="y", weightCol="weight", elasticNetParam=1.0,
                               regParam=LASSO, maxIter=60, standardization=False).fit(hits)
    kept = tuple(Rule(r.conditions, float(w)) for r, w in zip(rules, lasso.coefficients, strict=True) if abs(w) > 1e-9)
    train.unpersist()
    hits.unpersist()
    return RuleEnsemble(float(lasso.intercept), kept)
