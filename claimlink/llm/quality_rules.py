"""Quality rules: a decision list learned from labelled statistics.

Sequential covering: a rule is grown on two thirds of the remaining labelled documents by adding
the threshold condition with the highest information gain until it covers no good document, and
pruned on the other third by cutting conditions from its end while its worth does not fall. The
list ends when a rule is no better than chance on the pruning third. The rules become one ordered
``CASE WHEN`` over the statistics, which Spark evaluates for all documents.

A base rule stands before the list: fewer than 10 words, or more than a fifth of the words in
repeated five-word windows.

Defined results: a null text has no words and fails the base rule. Without labels, or with one
class only, the list is empty and the base rule alone decides. Repeated rows are judged alike; ids
may be null; extra columns are not read. The fit takes at most ``MAX_LABELLED`` labelled rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlink.llm.common import staging
from claimlink.llm.text_stats import (
    COUNTS,
    MAX_LABELLED,
    document_stats,
    labelled_ids,
    learn_lexicon,
    ratios,
)

MAX_RULES = 24
MAX_CONDITIONS = 4
THRESHOLDS = 64
LEAST_WORTH = 0.75  # precision a rule must reach on the pruning third


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self, features: dict[str, Column]) -> Column:
        x = features[self.feature]
        return x > self.threshold if self.above else x <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:g}"


Rule = tuple[Condition, ...]


class _Learner:
    def __init__(self, names: list[str], x: np.ndarray):
        self.conditions, covers = [], []
        for j, name in enumerate(names):
            values = np.unique(x[:, j])
            if len(values) > THRESHOLDS:
                values = np.unique(np.quantile(x[:, j], np.linspace(0, 1, THRESHOLDS + 1)))
            cuts = (values[:-1] + values[1:]) / 2
            for cut in cuts.tolist():
                for above in (True, False):
                    self.conditions.append(Condition(name, above, cut))
                    covers.append((x[:, j] > cut) == above)
        self.covers = np.array(covers) if covers else np.empty((0, len(x)), bool)

    def grow(self, bad: np.ndarray, rows: np.ndarray) -> list[int]:
        rule: list[int] = []
        covered = rows.copy()
        while len(rule) < MAX_CONDITIONS and (covered & ~bad).any():
            p, n = (covered & bad).sum(), (covered & ~bad).sum()
            new_p = self.covers @ (covered & bad).astype(np.float32)
            new_n = self.covers @ (covered & ~bad).astype(np.float32)
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = new_p * (np.log2(new_p / (new_p + new_n)) - np.log2(p / (p + n)))
            gain = np.where(new_p > 0, np.nan_to_num(gain, nan=0.0, neginf=0.0), 0.0)
            if not len(gain) or gain.max() <= 1e-9:
                break
            best = int(gain.argmax())
            rule.append(best)
            covered &= self.covers[best]
        return rule

    def covered(self, rule: list[int], rows: np.ndarray) -> np.ndarray:
        out = rows.copy()
        for c in rule:
            out &= self.covers[c]
        return out

    def worth(self, rule: list[int], bad: np.ndarray, rows: np.ndarray) -> float:
        """(p - n) / (p + n), Laplace-corrected."""
        inside = self.covered(rule, rows)
        p, n = (inside & bad).sum(), (inside & ~bad).sum()
        return (p - n) / (p + n + 1)

    def prune(self, rule: list[int], bad: np.ndarray, rows: np.ndarray) -> list[int]:
        cuts = [rule[:k] for k in range(1, len(rule) + 1)]
        return max(cuts, key=lambda r: (self.worth(r, bad, rows), -len(r)))


def learn_rules(names: list[str], x: np.ndarray, bad: np.ndarray, seed: int = 7) -> list[Rule]:
    """Ordered rules that name bad rows; whatever none of them covers is good."""
    if not len(x) or bad.all() or not bad.any():
        return []
    learner = _Learner(names, x)
    rng = np.random.default_rng(seed)
    left, rules = np.ones(len(x), bool), []
    while len(rules) < MAX_RULES and (left & bad).any():
        third = rng.integers(0, 3, len(x))
        grown = learner.grow(bad, left & (third > 0))
        if not grown:
            break
        check = left & (third == 0)
        rule = learner.prune(grown, bad, check)
        inside = learner.covered(rule, check)
        p, n = (inside & bad).sum(), (inside & ~bad).sum()
        if p == 0 or p / (p + n) < LEAST_WORTH:
            break
        rules.append(tuple(learner.conditions[c] for c in rule))
        left &= ~learner.covered(rule, left)
    return rules


def rejecting_rule(rules: list[Rule], features: dict[str, Column] | None = None) -> Column:
    """Text of the first rule that fits, as one ordered conditional; null if none does."""
    features = features or ratios()
    out = None
    for rule in rules:
        fits = rule[0].column(features)
        for condition in rule[1:]:
            fits &= condition.column(features)
        name = F.lit(" and ".join(map(str, rule)))
        out = F.when(fits, name) if out is None else out.when(fits, name)
    return F.lit(None).cast("string") if out is None else out


def base_failed() -> Column:
    n = F.col("n_words")
    return (n < 10) | (100 * F.col("n_repeat_words") > 20 * n)


def fit_rules(stats: DataFrame, sample: dict[int, int]) -> list[Rule]:
    """Rules from the statistics of the labelled sample."""
    features = ratios()
    ids = sorted(sample)
    if not ids:
        return []
    spark = stats.sparkSession
    known = spark.createDataFrame(list(sample.items()), "doc_id long, bad int")
    rows = (
        stats.join(F.broadcast(known), "doc_id")  # at most MAX_LABELLED rows
        .dropDuplicates(["doc_id"])
        .select("doc_id", "bad", *[c.alias(n) for n, c in features.items()])
        .toPandas()
        .sort_values("doc_id")
    )
    return learn_rules(
        list(features), rows[list(features)].to_numpy(float), rows["bad"].to_numpy() == 1
    )


def judge_documents(
    docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED
) -> tuple[DataFrame, list[Rule]]:
    """Statistics and verdict of every document, and the rules."""
    sample = {r.doc_id: r.bad for r in labelled_ids(docs, labels, most).collect()}
    lexicon = learn_lexicon(docs, sample)
    stats = staging(docs.sparkSession)(document_stats(docs, lexicon), "stats")
    rules = fit_rules(stats, sample)
    judged = stats.select(
        "doc_id",
        *COUNTS,
        base_failed().alias("base_failed"),
        rejecting_rule(rules).alias("rule"),
    )
    return judged.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull()), rules
