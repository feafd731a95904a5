"""Quality classifier: a sparse ensemble of rules over text statistics.

Statistics are column expressions. Shallow trees are grown on labelled rows; every path from a root to a node is
a conjunctive rule; a lasso-penalised logistic regression weighs the rules, and most weights become zero. What is left is
compiled to one column expression, so scoring is a projection. Trees and regression are Spark ML's.

Edge cases: a null or empty text has all statistics zero and gets the score of those. Labels other than 0 and 1, null labels
and null ids are not learned from, nor is a document labelled both ways. With no rows of one label the score is the share of
label 1 (0.5 without any). Repeated rows score alike. Other columns are ignored. No rows give no rows.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brisa.llm.batches import only
from brisa.session import write_out

# Labelled rows to learn from, at most, chosen by a hash of their ids.
SAMPLE = 20_000
TREES, DEPTH, PENALTY = 24, 3, 0.002
FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3


def _count(text: Column, characters: str) -> Column:
    """How often any of some characters occurs."""
    return F.length(text) - F.length(F.translate(text, characters, ""))


def statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the statistics of each whole text, as doubles."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = only(docs, "doc_id", "text").select("doc_id", text.alias("text"))
    rows = rows.select(
        "doc_id", "text", F.array_remove(F.split("text", "[ \\t-\\r]+"), "").alias("words"), F.array_remove(F.split("text", "\n"), "").alias("lines")
    )
    chars, words, lines = F.length("text"), F.size("words"), F.size("lines")

    def per(value: Column, whole: Column) -> Column:
        return F.when(whole > 0, value / whole).otherwise(0.0).cast("double")

    return rows.select(
        "doc_id",
        F.log1p(words).alias("log_words"),
        per(chars, words).alias("chars_per_word"),
        per(chars, lines).alias("chars_per_line"),
        per(F.size(F.array_distinct("words")), words).alias("distinct_words"),
        per(F.size(F.array_distinct("lines")), lines).alias("distinct_lines"),
        *[
            per(_count(F.col("text"), characters), words).alias(name)
            for name, characters in {
                "capitals": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                "digits": "0123456789",
                "pipes": "|",
                "marks": "!?",
                "stops": ".",
                "commas": ",",
                "symbols": "#*$%&<>@^~{}[]\\=+_",
                "quotes": "\"'`()",
                "slashes": "/:;",
            }.items()
        ],
    )


@dataclass(frozen=True)
class Rule:
    """All of ``(statistic, at_most, bound)``: a value at most the bound, or above it."""

    parts: tuple[tuple[str, bool, float], ...]

    def column(self) -> Column:
        out = F.lit(True)
        for name, at_most, bound in self.parts:
            out = out & ((F.col(name) <= bound) if at_most else (F.col(name) > bound))
        return out.cast("double")


_LINE = re.compile(r"( *)(If|Else) \(feature (\d+) (<=|>) (\S+)\)")


def paths(printed: str, names: list[str]) -> set[Rule]:
    """The rules of a printed tree: every path from its root to a node."""
    rules, path = set(), []
    for line in printed.splitlines():
        if m := _LINE.match(line):
            depth = len(m[1])
            while path and path[-1][0] >= depth:
                path.pop()
            path.append((depth, (names[int(m[3])], m[4] == "<=", float(m[5]))))
            rules.add(Rule(tuple(sorted(part for _, part in path))))
    return rules


@dataclass
class Ensemble:
    rules: list[tuple[Rule, float]]
    bias: float

    def score(self) -> Column:
        """The compiled ensemble."""
        margin = F.lit(self.bias)
        for rule, weight in self.rules:
            margin = margin + rule.column() * weight
        return 1 / (1 + F.exp(-margin))


def fold(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(FOLDS))


def fit(stats: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Ensemble:
    """Learn from labelled rows outside the held-out fold."""
    names = [c for c in stats.columns if c != "doc_id"]
    clear = only(labels, "doc_id", "quality").where("doc_id is not null and quality in (0, 1)").where(fold(F.col("doc_id")) != HELD_OUT)
    clear = clear.groupBy("doc_id").agg(F.min("quality").cast("double").alias("label"), F.max("quality").alias("other")).where("label = other")
    order = F.xxhash64(F.col("doc_id").cast("string"))
    chosen = clear.orderBy(order, "doc_id").limit(sample).select("doc_id", "label")
    # One sorted partition of bounded size: sums, and so trees and weights, come out the same each time.
    rows = stats.join(chosen, "doc_id").orderBy(order, "doc_id", *names).limit(sample)
    rows = write_out(rows.select("label", *names), "labelled").coalesce(1)
    seen = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(seen) < 2:
        return Ensemble([], 0.0 if not seen else 20.0 if 1.0 in seen else -20.0)
    vectors = VectorAssembler(inputCols=names, outputCol="features").transform(rows).select("label", "features")
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, subsamplingRate=0.7, featureSubsetStrategy="onethird", minInstancesPerNode=5, seed=17)
    found: set[Rule] = set()
    for tree in forest.fit(vectors).trees:
        found |= paths(tree.toDebugString, names)
    rules = sorted(found, key=lambda rule: rule.parts)
    if not rules:
        share = seen[1.0] / sum(seen.values())
        return Ensemble([], math.log(share / (1 - share)))
    held = rows.select("label", *[rule.column().alias(f"rule_{i}") for i, rule in enumerate(rules)])
    held = VectorAssembler(inputCols=[f"rule_{i}" for i in range(len(rules))], outputCol="features").transform(held)
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=PENALTY, maxIter=60).fit(held.select("label", "features"))
    weighed = [(rule, float(w)) for rule, w in zip(rules, lasso.coefficients) if w]
    return Ensemble(weighed, float(lasso.intercept))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` per document."""
    # Written once: learning and scoring both read the statistics, a hundredth of the text.
    stats = write_out(statistics(docs), "statistics")
    score = fit(stats, labels).score()
    scored = stats.select("doc_id", F.coalesce(fold(F.col("doc_id")) == HELD_OUT, F.lit(False)).alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
