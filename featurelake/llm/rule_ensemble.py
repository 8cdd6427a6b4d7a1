"""Operator 3, quality classifier: a sparse rule ensemble.

1. ``statistics`` of whole texts are Spark column expressions (no Python).
2. A small forest of shallow trees is fitted on a bounded sample of labelled documents; every path from a root to a
   node below it is a rule, a conjunction of bounds on statistics.
3. A lasso logistic regression over the rules as 0/1 columns keeps few of them.
4. The kept rules compile into one column expression, which scores any table in one pass.

The sample has at most ``sample_rows`` labelled documents, chosen by a hash of the id over the whole label table; it
is broadcast as ids and labels, whose number is that bound.
"""

from __future__ import annotations

import functools
import math
import operator
import re
from typing import NamedTuple

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featurelake.llm.common import keep

SAMPLE_ROWS, TREES, DEPTH, LASSO = 20_000, 24, 3, 0.002
STATISTICS = ("log_words", "word_length", "upper", "digits", "symbols", "bangs", "pipes", "stops", "distinct_words", "distinct_lines", "line_words")
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


class Rule(NamedTuple):
    """A conjunction of (statistic, "<=" or ">", bound)."""
    terms: tuple[tuple[str, str, float], ...]

    def column(self) -> Column:
        return functools.reduce(operator.and_, [F.col(s) <= b if op == "<=" else F.col(s) > b for s, op, b in self.terms])


class Ensemble(NamedTuple):
    """score = 1 / (1 + exp(-(intercept + the weights of the rules that hold)))"""
    intercept: float
    rules: tuple[tuple[Rule, float], ...]

    def score(self) -> Column:
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + F.when(rule.column(), F.lit(weight)).otherwise(F.lit(0.0))
        return 1.0 / (1.0 + F.exp(-total))


def statistics(docs: DataFrame) -> DataFrame:
    """docs' columns but ``text``, and STATISTICS of each whole text; NULL counts as empty, and an empty text has 0 everywhere.

    Columns of docs with those names give way.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    without = lambda chars: F.length(text) - F.length(F.translate(text, chars, ""))
    words = F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x != "")
    counts = [F.length(text).alias("chars__"), F.transform(F.array(words), lambda w: F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("d")))[0].alias("words__"),
              F.transform(F.array(lines), lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("d")))[0].alias("lines__"),
              *[without(c).alias(n) for n, c in (("upper", _UPPER), ("digits", "0123456789"), ("symbols", "#*$%&<>@=^~"), ("bangs", "!?"), ("pipes", "|"), ("stops", ".,;:"))]]
    carried = [c for c in docs.columns if c not in ("text", *STATISTICS)]
    got = docs.select(*carried, *counts)
    per = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    n = F.col("words__.n")
    return got.select(*carried, F.log(n + F.lit(1.0)).alias("log_words"), per(F.col("chars__"), n).alias("word_length"),
                      *[per(F.col(c), F.col("chars__")).alias(c) for c in ("upper", "digits")], *[per(F.col(c), n).alias(c) for c in ("symbols", "bangs", "pipes", "stops")],
                      per(F.col("words__.d"), n).alias("distinct_words"), per(F.col("lines__.d"), F.col("lines__.n")).alias("distinct_lines"),
                      per(n, F.col("lines__.n")).alias("line_words"))


def rules_of(described: str, names: tuple[str, ...] = STATISTICS) -> list[Rule]:
    """The rules of a fitted forest, read from its ``toDebugString``: each distinct path below a root, its bounds merged."""
    found: dict[Rule, None] = {}
    path: list[tuple[int, tuple[str, str, float]]] = []
    for line in described.splitlines():
        depth = len(line) - len(line.lstrip())
        if "Tree " in line:
            path = []
        if m := re.match(r"\s*(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line):
            path = [p for p in path if p[0] < depth] + [(depth, (names[int(m[1])], m[2], float(m[3])))]
            bounds: dict[tuple[str, str], float] = {}
            for _, (s, op, b) in path:
                old = bounds.get((s, op), b)
                bounds[s, op] = min(old, b) if op == "<=" else max(old, b)
            found[Rule(tuple(sorted((s, op, b) for (s, op), b in bounds.items())))] = None
    return list(found)


def sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(statistics, label) of at most ``rows`` labelled documents. Of repeated labels the least counts; NULLs teach nothing."""
    labels = labels.filter("doc_id IS NOT NULL AND label IS NOT NULL").groupBy("doc_id").agg(F.min("label").cast("double").alias("label"))
    chosen = labels.orderBy(F.xxhash64(F.lit("quality sample"), "doc_id"), "doc_id").limit(rows)
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return statistics(texts).drop("doc_id")


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, trees: int = TREES, depth: int = DEPTH, lasso: float = LASSO, seed: int = 7) -> Ensemble:
    """Learn from docs (doc_id, text) and labels (doc_id, label 0 or 1). With one label or none, the score is a constant."""
    scanned = keep(sample(docs, labels, rows), "statistics")  # by as many tasks as the scan has; what follows is small
    known = keep(scanned.repartition(8, *STATISTICS).sortWithinPartitions(*STATISTICS, "label"), "sample")
    ones, n = known.agg(F.sum("label"), F.count(F.lit(1))).first()
    prior = ((ones or 0.0) + 1) / (n + 2)
    constant = Ensemble(math.log(prior / (1 - prior)), ())
    if not n or ones in (0, n):
        return constant
    weighted = known.withColumn("weight", F.when(F.col("label") == 1, n / (2 * ones)).otherwise(n / (2 * (n - ones))))
    vectors = VectorAssembler(inputCols=list(STATISTICS), outputCol="features").transform(weighted).select("features", "label", "weight")
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, weightCol="weight", seed=seed, maxBins=64).fit(vectors)
    rules = rules_of(forest.toDebugString)
    if not rules:
        return constant
    held = F.array(*[F.when(r.column(), 1.0).otherwise(0.0) for r in rules])
    matrix = keep(known.select(held.alias("held"), "label"), "rules").select(array_to_vector("held").alias("features"), "label")
    lasso_fit = LogisticRegression(elasticNetParam=1.0, regParam=lasso, maxIter=60, standardization=True).fit(matrix)
    weights = [(r, float(w)) for r, w in zip(rules, lasso_fit.coefficients.toArray()) if abs(w) > 1e-9]
    return Ensemble(float(lasso_fit.intercept), tuple(weights))


def score(docs: DataFrame, ensemble: Ensemble) -> DataFrame:
    """docs' columns but ``text``, STATISTICS and ``score`` (0 to 1, higher: label 1 likelier) of each whole text.

    NULL counts as empty; repeated rows give repeated results; no rows: no rows. A column named score gives way.
    """
    got = statistics(docs.drop("score"))
    return got.withColumn("score", ensemble.score())
