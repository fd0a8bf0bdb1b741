"""Quality rules learned as a decision list.

Sequential covering: grow a conjunction of thresholds that parts low-quality texts from the others by adding the test of
most information gain, prune it on rows kept aside, keep it if it is precise there, take away what it covers, go on.
The list becomes one Spark expression of ordered conditions over statistics of whole texts; it runs inside Catalyst.

A base rule comes first: too few words, or too much of the text in repeated windows. The list is learned from labelled
rows that pass it; the number of those is bounded by ``max_rows`` (the rows of least hash), all else reads every text.
Null texts have no words and fail the base. Null or other labels than 0 and 1 teach nothing; of a repeated label the least counts. Without any labels, or with those of one kind, the list is empty.
Repeated rows and null ids are judged each. An empty table gives an empty result. ``judge`` replaces columns that have the names of what it adds.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .text_stats import COUNTS, with_statistics

#: The ratios that rules test, by name: numerator and denominator among the counts.
RATIOS = {
    "symbols_per_char": ("n_symbols", "word_chars"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "upper_share": ("n_upper", "word_chars"),
    "marks_per_word": ("n_marks", "n_words"),
    "same_word_share": ("n_same_words", "n_words"),
    "distinct_share": ("n_distinct_words", "n_words"),
    "word_length": ("word_chars", "n_words"),
    "words": ("n_words", None),
}


@dataclass(frozen=True)
class Test:
    feature: str
    above: bool
    threshold: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.feature] >= self.threshold if self.above else x[self.feature] < self.threshold

    def column(self) -> Column:
        top, bottom = RATIOS[self.feature]
        value = F.col(top).cast("double") / F.greatest(F.col(bottom), F.lit(1)).cast("double") if bottom else F.col(top).cast("double")
        return value >= F.lit(self.threshold) if self.above else value < F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<'} {self.threshold:.4g}"


@dataclass
class DecisionList:
    rules: list[list[Test]] = field(default_factory=list)

    def rejects(self, x: dict[str, np.ndarray]) -> np.ndarray:
        n = len(next(iter(x.values())))
        out = np.zeros(n, bool)
        for rule in self.rules:
            out |= np.logical_and.reduce([t.holds(x) for t in rule])
        return out

    def verdict(self) -> Column:
        """The number of the first rule that fires, else null."""
        out = None
        for i, rule in enumerate(self.rules):
            test = rule[0].column()
            for t in rule[1:]:
                test = test & t.column()
            out = F.when(test, F.lit(i + 1)) if out is None else out.when(test, F.lit(i + 1))
        return F.lit(None).cast("int") if out is None else out

    def __str__(self) -> str:
        return "\n".join("reject if " + " and ".join(map(str, r)) for r in self.rules) or "keep all"


def features(counts: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    return {name: counts[top].astype(float) / (np.maximum(counts[bottom], 1) if bottom else 1.0) for name, (top, bottom) in RATIOS.items()}


def _best_test(x: dict[str, np.ndarray], bad: np.ndarray, cuts: int) -> tuple[float, Test | None]:
    """The test of most first-order gain: covered bad rows times the growth of the log of their share."""
    p, n = bad.sum(), len(bad)
    best: tuple[float, Test | None] = (0.0, None)
    base = np.log2(p / n) if p else 0.0
    for name, v in x.items():
        values = np.unique(np.quantile(v, np.linspace(0, 1, cuts)))
        values = np.unique(np.concatenate([values, np.quantile(v[bad], np.linspace(0, 1, 33))])) if p else values
        for a, b in zip(values[:-1], values[1:]):
            t = (a + b) / 2
            for above in (True, False):
                hit = v >= t if above else v < t
                good = bad[hit].sum()
                if good:
                    gain = good * (np.log2(good / hit.sum()) - base)
                    if gain > best[0] + 1e-9:
                        best = (gain, Test(name, above, float(t)))
    return best


def learn(x: dict[str, np.ndarray], bad: np.ndarray, order: np.ndarray, *, max_rules: int = 12, max_tests: int = 4, precision: float = 0.95, cuts: int = 65) -> DecisionList:
    """``order``: a number for each row that doesn't depend on it; every third row prunes, the others grow."""
    found = DecisionList()
    left = np.ones(len(bad), bool)
    prune_side = order % 3 == 0
    for _ in range(max_rules):
        grow, prune = left & ~prune_side, left & prune_side
        if bad[grow].sum() < 5:
            break
        rule: list[Test] = []
        inside = grow.copy()
        while len(rule) < max_tests and not bad[inside].all():
            gain, test = _best_test({k: v[inside] for k, v in x.items()}, bad[inside], cuts)
            if test is None:
                break
            rule.append(test)
            inside &= test.holds(x)
        if not rule:
            break

        def value(tests: list[Test]) -> float:
            hit = prune & np.logical_and.reduce([t.holds(x) for t in tests])
            good = bad[hit].sum()
            return (2 * good - hit.sum()) / max(1, hit.sum()) if hit.any() else -1.0

        while len(rule) > 1 and value(rule[:-1]) >= value(rule):
            rule = rule[:-1]
        hit = left & np.logical_and.reduce([t.holds(x) for t in rule])
        if not hit.any() or bad[hit].mean() < precision or value(rule) < 2 * precision - 1:
            break
        found.rules.append(rule)
        left &= ~hit
    return found


def base_failed(min_words: int = 10, repeat_percent: int = 20) -> Column:
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))


def labelled_sample(docs: DataFrame, labels: DataFrame, *, key: str, text: str, label: str, max_rows: int, fold: Column | None = None) -> DataFrame:
    """key, text, __label, __order of texts with a 0/1 label: those ``max_rows`` labels of least hash. Of repeated ids in ``labels`` the least label counts, in ``docs`` the least text."""
    clean = labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1))
    clean = clean.where(fold) if fold is not None else clean
    clean = clean.join(docs.select(key), key, "left_semi")  # labels of texts that aren't here don't use up the bound
    chosen = clean.groupBy(key).agg(F.min(label).alias("__label")).withColumn("__order", F.xxhash64(key)).orderBy("__order", key).limit(max_rows)
    # at most max_rows ids: this side's size has a fixed bound, and with one text for each so has the result
    return docs.join(F.broadcast(chosen), key).groupBy(key, "__label", "__order").agg(F.min(text).alias(text))


def learn_from(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "quality", max_rows: int = 20_000, min_words: int = 10, repeat_percent: int = 20) -> DecisionList:
    """Learn the list from the labelled texts; statistics are worked out for these alone."""
    chosen = labelled_sample(docs.select(key, text), labels, key=key, text=text, label=label, max_rows=max_rows)
    rows = with_statistics(chosen, text=text).select(*COUNTS, "__label", "__order").toPandas().sort_values(["__order", *COUNTS])
    # a filter on these statistics within the plan would move before the join, and work them out for every text
    rows = rows[(rows["n_words"] >= min_words) & (100 * rows["n_repeat_words"] <= repeat_percent * rows["n_words"])]
    if not len(rows):
        return DecisionList()
    return learn(features({c: rows[c].to_numpy() for c in COUNTS}), rows["__label"].to_numpy() == 0, rows["__order"].to_numpy() & 0xFFFF)


def judge(docs: DataFrame, found: DecisionList, *, text: str = "text", min_words: int = 10, repeat_percent: int = 20) -> DataFrame:
    """``docs`` with ``COUNTS``, base_failed, rule (the first that fires) and kept; columns of these names are replaced. One pass, no shuffle."""
    judged = with_statistics(docs, text=text).withColumns({"base_failed": base_failed(min_words, repeat_percent), "rule": found.verdict()})
    return judged.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def apply_rules(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "quality", max_rows: int = 20_000, min_words: int = 10, repeat_percent: int = 20) -> tuple[DataFrame, DecisionList]:
    """The list learned from the labels, and every row judged by it: key and what ``judge`` adds."""
    common.ship(docs.sparkSession)
    found = learn_from(docs, labels, key=key, text=text, label=label, max_rows=max_rows, min_words=min_words, repeat_percent=repeat_percent)
    return judge(docs.select(key, text), found, text=text, min_words=min_words, repeat_percent=repeat_percent).drop(text), found
