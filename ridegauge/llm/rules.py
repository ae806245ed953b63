"""Quality rules: text statistics, and a decision list learned on them by sequential covering.

Every rule is a conjunction of thresholds on statistics, for instance
``symbol_share >= 0.31 AND upper_share < 0.2``.  Rules are grown one condition at a time by
information gain on two thirds of the rows that no earlier rule covers, pruned from their end on
the other third, and kept while they are precise there.  The list is emitted as one ordered Spark
``CASE WHEN``, so that applying it costs no Python and shows in the plan.

Null texts count as texts without words.  Rows whose statistics are null are not covered by any
condition and get the default.  With no labels, or none of one class, the list is empty and only
the default is left.  An id that comes several times teaches its smallest text, and each of its rows is
judged.  Texts of any length are counted whole.  Other columns pass through whatever their names.  A list
has at most ``most_rules`` rules (32) of at most four conditions.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridegauge.llm.common import SPACE_BYTES, one_text, sampled_labels, unused, whole

# The symbols that are counted, the window in which repeated words are looked for,
# and the limits of the base rule.
SYMBOLS = b"#*$%&|<>"
WINDOW = 5
LEAST_WORDS, MOST_REPEATED = 10, 20

_UPPER = bytes(range(65, 91))
_LETTERS = _UPPER + bytes(range(97, 123))

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_upper", "n_letters", "n_bangs", "n_distinct", "n_doubled",
)
FEATURES = (
    "word_length", "symbol_share", "dup_line_share", "repeat_share", "upper_share", "bang_share",
    "distinct_share", "doubled_share", "log_words",
)


def counts(text: str) -> tuple[int, ...]:
    """The ``COUNTS`` of one text."""
    raw = text.encode()
    words = raw.split()
    lines = [line for line in raw.split(b"\n") if line and not line.isspace()]
    letters = len(raw) - len(raw.translate(None, _LETTERS))
    spaces = len(raw) - len(raw.translate(None, SPACE_BYTES))
    repeated, distinct, doubled = _repeats(words)
    return (
        len(words), len(text) - spaces, len(raw) - len(raw.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)), repeated,
        len(lines), len(raw) - len(raw.translate(None, _UPPER)), letters, raw.count(b"!"),
        distinct, doubled,
    )


def _repeats(words: list[bytes]) -> tuple[int, int, int]:
    """Words in windows found more than once, distinct words, words equal to the one before."""
    if len(words) < 2:
        return 0, len(words), 0
    # 64-bit hashes, so an accidental repeat in a text of a million words has odds of one in 10^7
    hashes = np.fromiter(map(hash, words), np.int64, len(words))
    doubled, distinct = int((hashes[1:] == hashes[:-1]).sum()), len(set(words))
    n = len(words) - WINDOW + 1
    if n < 2 or distinct == len(words):
        return 0, distinct, doubled
    total = np.zeros(n, np.int64)
    for i in range(WINDOW):
        total = (total ^ (total >> 29)) * np.int64(0x5851F42D4C957F2D) + hashes[i : i + n]
    order = np.argsort(total, kind="stable")
    equal = total[order[1:]] == total[order[:-1]]
    if not equal.any():
        return 0, distinct, doubled
    again = np.zeros(n, bool)
    again[order[1:][equal]] = True
    again[order[:-1][equal]] = True
    edges = np.zeros(len(words) + 1, np.int64)
    edges[:n] += again
    edges[WINDOW : WINDOW + n] -= again
    return int((np.cumsum(edges)[:-1] > 0).sum()), distinct, doubled


def statistics(text: str = "text") -> Column:
    """A struct of ``COUNTS`` of a text column."""

    @F.pandas_udf(", ".join(f"{name} long" for name in COUNTS))
    def counted(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in parts:
            yield pd.DataFrame([counts(t) for t in texts], columns=list(COUNTS), dtype="int64")

    return counted(whole(text))


def features(counted: str) -> dict[str, Column]:
    """The ``FEATURES`` as columns on a struct of counts."""
    def share(part: str, of: str) -> Column:
        return F.col(f"{counted}.{part}") / F.greatest(F.col(f"{counted}.{of}"), F.lit(1))

    return {
        "word_length": share("word_chars", "n_words"),
        "symbol_share": share("n_symbols", "n_words"),
        "dup_line_share": share("n_dup_lines", "n_lines"),
        "repeat_share": share("n_repeat_words", "n_words"),
        "upper_share": share("n_upper", "n_letters"),
        "bang_share": share("n_bangs", "n_words"),
        "distinct_share": share("n_distinct", "n_words"),
        "doubled_share": share("n_doubled", "n_words"),
        "log_words": F.log(F.lit(1) + F.col(f"{counted}.n_words")),
    }


def base_failed(counted: str) -> Column:
    words = F.col(f"{counted}.n_words")
    return (words < LEAST_WORDS) | (100 * F.col(f"{counted}.n_repeat_words") > MOST_REPEATED * words)


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    threshold: float

    def holds(self, values: dict[str, np.ndarray]) -> np.ndarray:
        x = values[self.feature]
        return x >= self.threshold if self.at_least else x < self.threshold

    def column(self, columns: dict[str, Column]) -> Column:
        x = columns[self.feature]
        return x >= self.threshold if self.at_least else x < self.threshold


@dataclass(frozen=True)
class DecisionList:
    """Ordered rules; a row gets False from the first rule that covers it, else True."""

    rules: tuple[tuple[Condition, ...], ...]

    def column(self, columns: dict[str, Column]) -> Column:
        listed = None
        for rule in self.rules:
            covers = reduce(lambda a, b: a & b, (c.column(columns) for c in rule))
            listed = F.when(covers, False) if listed is None else listed.when(covers, False)
        return F.lit(True) if listed is None else listed.otherwise(True)

    def __str__(self) -> str:
        return "; ".join(
            " AND ".join(f"{c.feature} {'>=' if c.at_least else '<'} {c.threshold:.4g}" for c in rule)
            for rule in self.rules
        )


def _covered(rule, values: dict[str, np.ndarray]) -> np.ndarray:
    held = np.ones(len(next(iter(values.values()))), bool)
    for condition in rule:
        held &= condition.holds(values)
    return held


def _best_condition(values, positive, inside) -> tuple[float, Condition] | None:
    """The condition with the highest information gain on the rows ``inside`` the rule so far."""
    p0, n0 = int(positive[inside].sum()), int((~positive[inside]).sum())
    if not p0 or not n0:
        return None
    best = None
    before = np.log2(p0 / (p0 + n0))
    for name in FEATURES:
        x = values[name][inside]
        order = np.argsort(x, kind="stable")
        x, y = x[order], positive[inside][order]
        borders = np.flatnonzero(x[1:] > x[:-1]) + 1
        if not len(borders):
            continue
        below_p = np.concatenate([[0], np.cumsum(y)])[borders]
        below_n = borders - below_p
        for at_least, p, n in ((False, below_p, below_n), (True, p0 - below_p, n0 - below_n)):
            gain = np.where(p > 0, p * (np.log2(np.maximum(p, 1) / np.maximum(p + n, 1)) - before), 0)
            i = int(np.argmax(gain))
            if gain[i] > 1e-9 and (best is None or gain[i] > best[0]):
                middle = (x[borders[i] - 1] + x[borders[i]]) / 2
                best = (float(gain[i]), Condition(name, at_least, float(middle)))
    return best


def learn(
    values: dict[str, np.ndarray], rejected: np.ndarray, precision: float = 0.8, most_rules: int = 32,
    seed: int = 7,
) -> DecisionList:
    """Sequential covering of the ``rejected`` rows."""
    left = np.ones(len(rejected), bool)
    pruning = np.random.default_rng(seed).random(len(rejected)) < 1 / 3
    rules = []
    while len(rules) < most_rules and rejected[left & ~pruning].any():
        rule, inside = [], left & ~pruning
        while len(rule) < 4:
            found = _best_condition(values, rejected, inside)
            if found is None:
                break
            rule.append(found[1])
            inside = inside & found[1].holds(values)
        held_out = left & pruning
        scores = []
        for size in range(1, len(rule) + 1):
            covered = _covered(rule[:size], values) & held_out
            p, n = int((rejected & covered).sum()), int((~rejected & covered).sum())
            scores.append(((p - n) / (p + n) if p + n else -1.0, p, -size))
        if not scores:
            break
        size = -max(scores)[2]
        rule = rule[:size]
        covered = _covered(rule, values) & left
        p, n = int((rejected & covered).sum()), int((~rejected & covered).sum())
        p_out, n_out = int((rejected & covered & pruning).sum()), int((~rejected & covered & pruning).sum())
        if p < 5 or p / (p + n) < precision or p_out < precision * (p_out + n_out):
            break
        rules.append(tuple(rule))
        left &= ~covered
    return DecisionList(tuple(rules))


def learned(docs: DataFrame, labels: DataFrame, at_most: int = 20_000) -> DecisionList:
    """A list that rejects what ``labels.quality = 0`` marks, from at most ``at_most`` labels."""
    chosen = sampled_labels(labels, at_most, "quality").withColumnRenamed("doc_id", "of")
    rows = (
        one_text(docs, chosen)
        .filter("text IS NOT NULL")
        .select("quality", statistics().alias("counted"))
        .select("quality", *(c.alias(name) for name, c in features("counted").items()))
        .toPandas()
    )
    if rows.empty:
        return DecisionList(())
    rows = rows.sort_values(list(rows.columns))  # the same list whatever order the rows come in
    values = {name: rows[name].to_numpy(float) for name in FEATURES}
    return learn(values, (rows["quality"] == 0).to_numpy())


def judged(docs: DataFrame, rules: DecisionList, column: str = "judged") -> DataFrame:
    """``docs`` with a struct of counts, ``base_failed`` and ``kept``.

    It is the last column and named ``column``, with underscores after it if ``docs`` has that already.
    """
    column = unused(column, docs)
    counted = docs.withColumn(column, statistics())
    names = [F.col(f"{column}.{name}").alias(name) for name in COUNTS]
    failed = base_failed(column)
    return counted.withColumn(
        column,
        F.struct(*names, failed.alias("base_failed"),
                 (~failed & rules.column(features(column))).alias("kept")),
    )


def without_junk(docs: DataFrame, rules: DecisionList) -> DataFrame:
    """``docs`` that neither the base rule nor a learned one rejects."""
    rows = judged(docs, rules)
    return rows.filter(F.col(rows.columns[-1])["kept"]).drop(rows.columns[-1])
