"""Quality rules: a decision list learned by sequential covering, applied as a Spark expression.

The learner sees a bounded sample of labelled statistics. It grows a conjunction of thresholds by
information gain on two thirds of the sample, prunes it on the rest, removes what the rule covers,
and goes on until no rule is precise enough. The list becomes one ``CASE WHEN``: the first rule that
holds decides, and a document that no rule rejects is kept.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgeloom.llm.textstats import SHARES, text_counts, with_shares

# Labelled rows that the learner may see; everything else covers all rows.
SAMPLE_ROWS = 20_000
MIN_HELD_BACK = 10
GOOD_WEIGHT = 5
MIN_WORDS = 50
REPETITIVE = "100 * n_repeat_words > 50 * n_words"
BASE_FAILED = f"n_words < {MIN_WORDS} OR {REPETITIVE}"


@dataclass(frozen=True)
class Rule:
    """A conjunction of ``(statistic, above?, threshold)``; ``precision`` is that on the pruning rows."""

    tests: tuple[tuple[str, bool, float], ...]
    precision: float

    def sql(self) -> str:
        return " AND ".join(f"{name} {'>' if above else '<='} {value!r}D" for name, above, value in self.tests)


def _covered(tests, columns: dict[str, np.ndarray], n: int) -> np.ndarray:
    mask = np.ones(n, bool)
    for name, above, value in tests:
        mask &= (columns[name] > value) == above
    return mask


def _grow(columns, bad, max_tests):
    """Add the threshold with the largest information gain until no good row is covered."""
    tests: list[tuple[str, bool, float]] = []
    mask = np.ones(len(bad), bool)
    while len(tests) < max_tests and (mask & ~bad).any():
        p0, n0 = (mask & bad).sum(), (mask & ~bad).sum()
        best = (1e-9, None)
        for name, values in columns.items():
            inside = values[mask]
            order = np.argsort(inside, kind="stable")
            v, b = inside[order], bad[mask][order]
            cuts = np.flatnonzero(v[1:] > v[:-1])
            if not len(cuts):
                continue
            below_p = np.cumsum(b)[cuts]
            below_n = cuts + 1 - below_p
            for above in (False, True):
                p, n = (p0 - below_p, n0 - below_n) if above else (below_p, below_n)
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(p > 0, p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0))), -1.0)
                at = int(np.argmax(gain))
                if gain[at] > best[0]:
                    middle = float((v[cuts[at]] + v[cuts[at] + 1]) / 2)
                    # rounding of the middle must not move a row to the other side
                    cut = middle if v[cuts[at]] <= middle < v[cuts[at] + 1] else float(v[cuts[at]])
                    best = (gain[at], (name, above, cut))
        if best[1] is None:
            break
        tests.append(best[1])
        mask &= _covered([best[1]], columns, len(bad))
    return tests


def _prune(tests, columns, bad):
    """The prefix of ``tests`` that is best on held-back rows, and its precision there.

    A good row that is rejected weighs as much as ``GOOD_WEIGHT`` bad ones that are not.
    """
    best = (-1.0 - GOOD_WEIGHT, [], 0.0)
    for k in range(1, len(tests) + 1):
        mask = _covered(tests[:k], columns, len(bad))
        p, n = int((mask & bad).sum()), int((mask & ~bad).sum())
        value = (p - GOOD_WEIGHT * n) / (p + n) if p + n else -1.0
        if value > best[0]:
            best = (value, tests[:k], p / (p + n) if p + n else 0.0)
    return best[1], best[2]


def learn_rules(columns: dict[str, np.ndarray], quality: np.ndarray, max_rules: int = 16, max_tests: int = 4,
                min_precision: float = 0.98, seed: int = 0) -> list[Rule]:
    """Rules that find rows of quality 0. The list is empty if either class is missing."""
    bad = np.asarray(quality) == 0
    columns = {k: np.asarray(v, float) for k, v in columns.items()}
    held_back = np.random.default_rng(seed).random(len(bad)) < 1 / 3
    left = np.ones(len(bad), bool)
    rules: list[Rule] = []
    while len(rules) < max_rules:
        growing, pruning = left & ~held_back, left & held_back
        if (bad & pruning).sum() < MIN_HELD_BACK:  # too few to judge by: grow and prune on all rows
            growing = pruning = left
        if not (bad & growing).any() or not (~bad & growing).any():
            break
        for growing, pruning in ((growing, pruning), (left, left)):
            tests = _grow({k: v[growing] for k, v in columns.items()}, bad[growing], max_tests)
            tests, precision = _prune(tests, {k: v[pruning] for k, v in columns.items()}, bad[pruning])
            if tests and precision >= min_precision:
                break  # else a rule from all rows may still be precise enough
        covered = left & _covered(tests, columns, len(bad))
        if not tests or precision < min_precision or (covered & bad).sum() < 2:
            break
        rules.append(Rule(tuple(tests), precision))
        left &= ~covered
    return rules


def rule_number(rules: list[Rule]) -> Column:
    """The number of the first rule that holds, from 1; null where none does."""
    if not rules:
        return F.lit(None).cast("int")
    whens = " ".join(f"WHEN {rule.sql()} THEN {i}" for i, rule in enumerate(rules, 1))
    return F.expr(f"CASE {whens} END")


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """Statistics and quality of at most ``rows`` labelled documents, chosen by a hash of the id.

    Rows without a label of 0 or 1 take no part. Of several rows with one id the text with the smallest hash counts, so that
    rows are bounded as well as labels. The sample is bounded, so its side is broadcast.
    """
    chosen = (labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").select("doc_id", "quality")
              .orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(rows))
    own = docs.select("doc_id", "text").join(F.broadcast(chosen.select("doc_id").distinct()), "doc_id").groupBy("doc_id").agg(
        F.expr("min_by(text, coalesce(xxhash64(text), 0L)) AS text"))
    return with_shares(text_counts(own)).join(F.broadcast(chosen), "doc_id")


def fit_rules(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, names: Sequence[str] = tuple(SHARES)) -> list[Rule]:
    """Rules on the statistics ``names`` from ``docs(doc_id, text)`` and ``labels(doc_id, quality)``."""
    order = ["doc_id", "quality", *names]
    sample = labelled_sample(docs, labels, rows).select(*order).toPandas().sort_values(order)
    return learn_rules({name: sample[name].to_numpy() for name in names}, sample["quality"].to_numpy())


def apply_rules(docs: DataFrame, rules: list[Rule], with_row: bool = False) -> DataFrame:
    """``(doc_id, counts, shares, base_failed, rule, kept[, row])``, a row for each row of ``docs(doc_id, text)``.

    Null and empty texts fail the base rule. An empty list of rules leaves the base rule alone to
    reject. Repeated rows are judged alike; an empty table gives an empty result. ``row`` holds all columns of ``docs``.
    """
    judged = with_shares(text_counts(docs, with_row)).withColumn("base_failed", F.expr(BASE_FAILED)).withColumn(
        "rule", rule_number(rules))
    return judged.withColumn("kept", F.expr("NOT base_failed AND rule IS NULL"))
