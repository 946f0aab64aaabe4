"""Quality rules by weak supervision. DataFrame functions only; the driver sees one table of vote patterns."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialize
from tidemark.llm.text_stats import add_text_stats

STATS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_lower", "n_bangs", "n_ended_lines")
#: A rule is never trusted beyond one vote in this many that goes the wrong way, so no single vote decides alone at any size.
SUREST = 100


def _share(part: Column, whole: Column) -> Column:
    return part / F.greatest(whole, F.lit(1))


def _vote(bad: Column, good: Column) -> Column:
    """-1 bad, 1 good, 0 abstains."""
    return F.when(bad, -1).when(good, 1).otherwise(0)


def rules() -> dict[str, Column]:
    """The votes over the statistics, by name. Each speaks for and against a document, and abstains between its two limits.

    Several look at the same fault from different sides: symbols, letters and line ends; repeats and copies of lines; capitals and
    exclamation marks. `letters` abstains on texts mostly in scripts without case. At most nine, so at most 3**9 patterns exist."""
    words, chars, lines = F.col("n_words"), F.col("word_chars"), F.col("n_lines")
    cased = F.col("n_upper") + F.col("n_lower")
    symbols, letters, upper, bangs = (_share(part, chars) for part in (F.col("n_symbols"), cased, F.col("n_upper"), F.col("n_bangs")))
    repeats, mean = _share(F.col("n_repeat_words"), words), _share(chars, words)
    copies, ended = _share(F.col("n_dup_lines"), lines), _share(F.col("n_ended_lines"), lines)
    return {
        "symbols": _vote(symbols > 0.06, symbols < 0.02),
        "letters": _vote(letters.between(0.3, 0.85), letters > 0.92),
        "line_ends": _vote(ended < 0.3, ended > 0.9),
        "repeats": _vote(repeats > 0.4, repeats < 0.15),
        "line_copies": _vote((copies > 0.5) & (lines > 2), copies < 0.1),
        "upper_case": _vote(upper > 0.3, upper < 0.1),
        "bangs": _vote(bangs > 0.1, bangs < 0.03),
        "word_length": _vote((mean < 2) | (mean > 15), mean.between(2.5, 12)),
    }


@dataclass(frozen=True)
class LabelModel:
    """Prior of a good document; of each rule, how often it votes -1, 0 and 1 on bad and on good documents, and how often a vote is right."""

    prior: float
    accuracy: dict[str, float]
    rates: dict[str, tuple[tuple[float, float, float], tuple[float, float, float]]]

    def log_odds(self, vote: dict[str, Column]) -> Column:
        odds = F.lit(math.log(self.prior / (1 - self.prior)))
        for name, column in vote.items():
            against, silent, favour = (math.log(good / bad) for bad, good in zip(*self.rates[name], strict=True))
            odds = odds + F.when(column < 0, against).when(column > 0, favour).otherwise(silent)
        return odds


def fit_label_model(votes: DataFrame, names: list[str], prior: float = 0.8, accuracy: float = 0.9, rounds: int = 100) -> LabelModel:
    """Expectation-maximisation over the counts of vote patterns of all rows.

    The patterns are a sufficient statistic of at most 3**len(names) rows. Given the class rules count as independent, and
    each has rates of its own for voting against, abstaining and voting in favour, so silence counts as well. The start says what rules are
    for: they seldom speak against a good document (0.03) and often miss a bad one (0.3 against, 0.5 in favour); so the classes
    are "faults found" and "no faults". The start counts as ten rows of each class; `accuracy` as ten votes of each rule. Rates stay above
    1 / SUREST, the prior within 0.05 and 0.95. No rows: the start values."""
    if len(names) > 9:
        raise ValueError("more than nine rules: the table of patterns is no longer small")
    patterns = sorted((tuple(r[n] for n in names), r["count"]) for r in votes.groupBy(*names).count().collect())
    start = ((0.3, 0.2, 0.5), (0.03, 0.17, 0.8))
    rates, right = [start] * len(names), [accuracy] * len(names)
    total = sum(c for _, c in patterns)
    for _ in range(rounds if total else 0):
        mass = [0.0, 0.0]
        seen = [[[10 * p for p in side] for side in start] for _ in names]
        hits, cast = [10 * accuracy] * len(names), [10.0] * len(names)
        for pattern, count in patterns:
            odds = math.log(prior / (1 - prior)) + sum(math.log(r[1][v + 1] / r[0][v + 1]) for v, r in zip(pattern, rates, strict=True))
            good = 1 / (1 + math.exp(-odds))
            part = (count * (1 - good), count * good)
            for k in (0, 1):
                mass[k] += part[k]
                for i, v in enumerate(pattern):
                    seen[i][k][v + 1] += part[k]
            for i, v in enumerate(pattern):
                if v:
                    cast[i] += count
                    hits[i] += part[v > 0]
        prior = min(0.95, max(0.05, (mass[1] + 1) / (total + 2)))
        rates = [tuple(tuple(max(1 / SUREST, n / (10 + m)) for n in side) for side, m in zip(rule, mass, strict=True)) for rule in seen]
        right = [h / c for h, c in zip(hits, cast, strict=True)]
    return LabelModel(prior, dict(zip(names, right, strict=True)), dict(zip(names, rates, strict=True)))


def quality_votes(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with the statistics, base_failed and one `vote_<rule>` each (-1, 0 or 1).

    base_failed: under 50 words, or more than half of the words in repeated 3-word windows. Null and empty
    texts have no words and fail. Columns of the result's names are replaced, others stay."""
    votes = {f"vote_{n}": c for n, c in rules().items()}
    out = add_text_stats(docs.drop(*votes, "base_failed"), text, STATS).withColumns(votes)
    return out.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def judge_votes(voted: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The votes with quality_probability and kept: not base_failed, and a posterior of at least the threshold.

    The accuracies are estimated over all rows, repeated ones included. The votes are written once, as
    they are needed twice. An empty table stays empty."""
    voted = materialize(voted.drop("quality_probability", "kept"), "votes")
    names = [f"vote_{n}" for n in rules()]
    model = fit_label_model(voted, names)
    judged = voted.withColumn("quality_probability", 1 / (1 + F.exp(-model.log_odds({n: F.col(n) for n in names}))))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("quality_probability") >= threshold))


def judge_quality(docs: DataFrame, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """`docs` with statistics, votes, quality_probability and kept; see quality_votes and judge_votes."""
    return judge_votes(quality_votes(docs, text), threshold)
