"""Quality rules: a decision list learned from labelled statistics.

Sequential covering: a rule (a conjunction of thresholds) for bad documents is
grown on two thirds of the uncovered sample by FOIL gain, pruned on the other
third, accepted if precise enough there, and the rows it covers are removed.
The ordered list becomes one Spark conditional expression.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwave.llm.doc_statistics import COUNTS, SHARES, document_statistics, labelled_sample
from tickwave.session import materialize

#: At most about this many labelled documents are learned from.
SAMPLE = 40_000
#: A rule must be right on this share of the rows it covers in the pruning part.
PRECISION = 0.9
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20


@dataclass(frozen=True)
class Condition:
    feature: int
    above: bool
    value: float

    def holds(self, x: np.ndarray) -> np.ndarray:
        v = x[:, self.feature]
        return v > self.value if self.above else v <= self.value

    def column(self) -> Column:
        c = F.col(SHARES[self.feature])
        return c > self.value if self.above else c <= self.value

    def __str__(self) -> str:
        return f"{SHARES[self.feature]} {'>' if self.above else '<='} {self.value:.6g}"


def _covered(rule: list[Condition], x: np.ndarray) -> np.ndarray:
    m = np.ones(len(x), bool)
    for c in rule:
        m &= c.holds(x)
    return m


def _best(x: np.ndarray, bad: np.ndarray, cuts: list[np.ndarray]) -> tuple[float, Condition | None]:
    """The condition of the largest FOIL gain over the rows given."""
    p0, n0 = bad.sum(), (~bad).sum()
    base = np.log2(p0 / (p0 + n0))
    best, found = 1e-9, None
    for f, cut in enumerate(cuts):
        at = np.searchsorted(cut, x[:, f], "left")
        p = np.bincount(at, bad, len(cut) + 1).cumsum()[:-1]
        n = np.bincount(at, ~bad, len(cut) + 1).cumsum()[:-1]
        for above, pp, nn in ((False, p, n), (True, p0 - p, n0 - n)):
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(pp > 0, pp * (np.log2(pp / (pp + nn)) - base), 0)
            if len(gain) and gain.max() > best:
                k = int(gain.argmax())
                best, found = float(gain[k]), Condition(f, above, float(cut[k]))
    return best, found


def learn(x: np.ndarray, y: np.ndarray, max_rules: int = 12, max_conditions: int = 4,
          least: int = 5, precision: float = PRECISION) -> list[list[Condition]]:
    """Ordered rules, each of which marks a document bad (label 0)."""
    if not len(y) or y.min() == y.max():
        return []
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, 65)[1:-1])) for f in range(x.shape[1])]
    # quantiles of the bad rows too: they are few, and their tails matter
    cuts = [np.unique(np.concatenate((c, np.quantile(x[y == 0, f], np.linspace(0, 1, 33))))) for f, c in enumerate(cuts)]
    grow = np.arange(len(y)) % 3 != 0
    left = np.ones(len(y), bool)
    bad = y == 0
    rules = []
    while len(rules) < max_rules:
        rows = left & grow
        if bad[rows].sum() < least:
            break
        rule: list[Condition] = []
        while len(rule) < max_conditions and not bad[rows].all():
            _, c = _best(x[rows], bad[rows], cuts)
            if c is None:
                break
            rule.append(c)
            rows &= c.holds(x)
        if not rule:
            break

        def worth(r: list[Condition]) -> float:
            m = _covered(r, x) & left & ~grow
            return (bad[m].sum() - (~bad[m]).sum()) / max(m.sum(), 1)

        while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
            rule.pop()
        m = _covered(rule, x) & left
        prune = m & ~grow
        if m.sum() < least or bad[m].mean() < precision or (prune.any() and bad[prune].mean() < precision):
            break
        rules.append(rule)
        left &= ~m
    return rules


def verdict(rules: list[list[Condition]]) -> Column:
    """Ordered conditionals: the number of the first rule that holds, else 0."""
    out = F.lit(0)
    for i, rule in reversed(list(enumerate(rules, 1))):
        holds = rule[0].column()
        for c in rule[1:]:
            holds = holds & c.column()
        out = F.when(holds, i).otherwise(out)
    return out


def apply_rules(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, COUNTS, base_failed, kept and rule (0: none) for every row.

    base_failed: fewer than 10 words, or over 20 % of them in repeated
    five-word windows.  kept is false if base_failed or if a learned rule
    holds.  Null and empty texts have zero counts and fail the base rule.
    Repeated rows give a row each.  Without labels of both kinds there are no
    learned rules.  Other columns are ignored; an empty table gives an empty
    result.
    """
    stats = materialize(document_statistics(docs), "statistics")
    rules = learn(*labelled_sample(stats, labels, "quality", sample))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return stats.withColumn("rule", verdict(rules)).select(
        "doc_id", *COUNTS, failed.alias("base_failed"), (~failed & (F.col("rule") == 0)).alias("kept"), "rule")
