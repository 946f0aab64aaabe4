"""A quality classifier made of rules: paths of small trees, weighted by lasso logistic regression.

Trees are grown on a bounded sample of labelled documents over statistics of their texts. Every path from a root to a node is a
conjunction of comparisons; a logistic regression with an L1 penalty gives most of them weight
zero. What is left is one Spark expression, so scoring all documents is a projection (after Friedman and Popescu 2008)."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, sampled_labels
from tidemark.llm.text_stats import add_text_stats

COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_distinct_words", "n_upper", "n_bangs", "n_digits", "n_ended_lines", "n_repeat_words")
#: Labelled rows of each class that the trees and weights are fitted on, about.
SAMPLE_ROWS = 6_000


def features() -> dict[str, Column]:
    """Statistics by name, as shares that do not grow with the text. Empty texts give 0."""

    def share(part: str, whole: str) -> Column:
        return F.col(part) / F.greatest(F.col(whole), F.lit(1))

    return {
        "log_words": F.log1p(F.col("n_words").cast("double")), "mean_word": share("word_chars", "n_words"), "symbols": share("n_symbols", "word_chars"),
        "line_copies": share("n_dup_lines", "n_lines"), "distinct_words": share("n_distinct_words", "n_words"), "upper": share("n_upper", "word_chars"),
        "bangs": share("n_bangs", "n_words"), "digits": share("n_digits", "word_chars"), "ended_lines": share("n_ended_lines", "n_lines"), "repeats": share("n_repeat_words", "n_words"),
    }


@dataclass(frozen=True)
class Rule:
    """All of (feature, is_at_most, value) hold."""

    terms: tuple[tuple[str, bool, float], ...]

    def column(self) -> Column:
        out = F.lit(True)
        for name, most, value in self.terms:
            out = out & (F.col(f"_f_{name}") <= value if most else F.col(f"_f_{name}") > value)
        return out


@dataclass(frozen=True)
class RuleModel:
    rules: tuple[Rule, ...]
    weights: tuple[float, ...]
    bias: float

    def probability(self) -> Column:
        odds = F.lit(self.bias)
        for rule, weight in zip(self.rules, self.weights, strict=True):
            odds = odds + F.when(rule.column(), F.lit(weight)).otherwise(0.0)
        return 1 / (1 + F.exp(-odds))


def tree_rules(description: str, names: list[str]) -> list[Rule]:
    """Every path of a forest, from Spark's text of its trees: a rule for each node below a root."""
    rules: list[Rule] = []
    path: list[tuple[int, tuple[str, bool, float]]] = []
    for line in description.splitlines():
        found = re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) (-?[0-9.eE+-]+)\)", line)
        if not found:
            if re.match(r" *Tree \d+", line):
                path = []
            continue
        depth = len(found[1])
        path = [p for p in path if p[0] < depth] + [(depth, (names[int(found[2])], found[3] == "<=", float(found[4])))]
        rules.append(Rule(_shortest(t for _, t in path)))
    return rules


def _shortest(terms) -> tuple[tuple[str, bool, float], ...]:
    """Comparisons of one feature in one direction become the narrowest of them."""
    kept: dict[tuple[str, bool], float] = {}
    for name, most, value in terms:
        old = kept.get((name, most))
        kept[name, most] = value if old is None else (min(old, value) if most else max(old, value))
    return tuple((n, m, v) for (n, m), v in sorted(kept.items()))


def with_features(docs: DataFrame, text: str = "text") -> DataFrame:
    return add_text_stats(docs, text, COUNTS).withColumns({f"_f_{n}": c for n, c in features().items()})


def learn(docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "quality", key: str = "doc_id", trees: int = 20, depth: int = 3, l1: float = 0.001) -> RuleModel:
    """Fit on a bounded sample: about SAMPLE_ROWS labelled documents of each class, chosen by a hash of their key.

    Both classes weigh by their share among the labels. Without labels the model gives 0.5; with one class
    only, the smoothed share of it. A document with several labels counts once for each. The forest has at most
    trees * (2 ** (depth + 1) - 2) different paths; all of them are rules, and the lasso chooses."""
    chosen, rate = sampled_labels(labels, label, SAMPLE_ROWS, key)
    names = list(features())
    rows = with_features(docs.select(key, F.col(text).alias("text")).join(F.broadcast(chosen), key), "text")
    sample = materialize(rows.select(*[f"_f_{n}" for n in names], F.col(label).cast("double").alias("y"), F.xxhash64(F.col(key).cast("string")).alias("h")).repartition(1).sortWithinPartitions("h"), "sample")
    seen = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(seen) < 2:
        share = (seen.get(1.0, 0) + 1) / (sum(seen.values()) + 2)
        return RuleModel((), (), math.log(share / (1 - share)))
    sample = sample.withColumn("w", F.when(F.col("y") == 1, 1 / rate[1]).otherwise(1 / rate[0]))
    ready = VectorAssembler(inputCols=[f"_f_{n}" for n in names], outputCol="x").transform(sample)
    forest = RandomForestClassifier(featuresCol="x", labelCol="y", weightCol="w", numTrees=trees, maxDepth=depth, featureSubsetStrategy="onethird", subsamplingRate=0.7, seed=7).fit(ready)
    rules = list(dict.fromkeys(tree_rules(forest.toDebugString, names)))
    fired = sample.select("y", "w", *[r.column().cast("double").alias(f"r{i}") for i, r in enumerate(rules)])
    fired = VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="x").transform(fired).select("x", "y", "w")
    lasso = LogisticRegression(featuresCol="x", labelCol="y", weightCol="w", elasticNetParam=1.0, regParam=l1, standardization=False, maxIter=60).fit(fired)
    used = [(r, float(w)) for r, w in zip(rules, lasso.coefficients.toArray(), strict=True) if abs(w) > 1e-9]
    return RuleModel(tuple(r for r, _ in used), tuple(w for _, w in used), float(lasso.intercept))


def score(docs: DataFrame, model: RuleModel, text: str = "text") -> DataFrame:
    """`docs` with score (0 to 1) of every whole text. Null and empty texts have all statistics 0 and get a score from them.
    Repeated rows get equal scores; an empty table stays empty. Other columns stay, whatever their names; a column `score` is replaced."""
    row = F.struct(*[F.col(c) for c in docs.columns if c.lower() != "score"])
    scored = with_features(docs.select(row.alias("row"), F.col(text).alias("text")), "text")
    return scored.withColumn("score", model.probability()).select("row.*", "score")
