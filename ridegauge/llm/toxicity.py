"""Toxicity by classifier chains.

The categories are predicted one after the other.  The model of a category is linear (logistic) on
the words and word beginnings of a text and on the probabilities of the categories before it.  While
fitting, those earlier probabilities are out-of-fold predictions, so that a later model learns how
far an unseen text's earlier probabilities can be trusted.

The words and beginnings a model knows are those whose document counts over the labelled sample
tell the classes apart best, counted by Spark; the sample is bounded by ``at_most`` labels and the
features by ``most_features`` per category, so the model is a small constant that goes out with the tasks.  Every
text is scored whole.

Null texts count as empty; they get the probabilities of a text without any known word.  Conflicting
labels are both used.  Without labels of both classes a category's probability is its share of the
labels (0 without any).  An id that comes several times is fitted with its smallest text, and each of its
rows is scored.  Texts of any length are scored whole.  Other columns pass through whatever their names.
"""

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridegauge.llm.common import one_text, sampled_labels, unused, whole
from ridegauge.session import written

# The chain: general categories first, the one that decides last.  Each is a condition on labels.
CATEGORIES = {
    "junk": "quality = 0",
    "toxic_prose": "toxic = 1 AND quality = 1",
    "toxic": "toxic = 1",
}
FOLDS = 5
_BEGINNINGS = range(4, 9)
_WORD = re.compile(r"[^\W\d_]+")
_MEMORY = 300_000


def _features(word: str) -> list[str]:
    return [word, *("^" + word[:n] for n in _BEGINNINGS if n < len(word))]


def _distinct(text: Column) -> Column:
    """The features a text has at least once, and those it has at least twice with a 2 before."""

    @F.pandas_udf("array<string>")
    def distinct(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            found = []
            for one in texts:
                n = Counter(f for w in _WORD.findall(one.lower()) for f in _features(w))
                found.append([*n, *("2" + f for f, times in n.items() if times > 1)])
            yield pd.Series(found, dtype=object)

    return distinct(text)


@dataclass(frozen=True)
class Chain:
    """Feature places, and weights per category: features, earlier probabilities, intercept."""

    places: dict[str, int]
    weights: dict[str, np.ndarray]

    def row(self, text: str, memory: dict[str, tuple[int, ...]]) -> np.ndarray:
        """Log counts of the known features; ``memory`` keeps which features a word has."""
        x = np.zeros(len(self.places))
        for word in _WORD.findall(text.lower()):
            found = memory.get(word)
            if found is None:
                if len(memory) > _MEMORY:
                    memory.clear()
                found = memory[word] = tuple(
                    self.places[f] for f in _features(word) if f in self.places
                )
            for place in found:
                x[place] += 1
        return np.log1p(x)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        for weights in self.weights.values():
            x = np.column_stack([x, _probability(x, weights)])
        return x[:, len(self.places):]


def _probability(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ weights[:-1] + weights[-1], -40, 40)))


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, steps: int = 150) -> np.ndarray:
    """L2-regularised logistic regression by accelerated gradient steps."""
    n, d = x.shape
    share = y.mean() if n else 0.0
    if not 0 < share < 1:
        return np.append(np.zeros(d), 40.0 if share == 1 else -40.0)
    full = np.column_stack([x, np.ones(n)]).astype(np.float32)
    y, ridge = y.astype(np.float32), np.append(np.full(d, penalty), 0.0).astype(np.float32)
    probe = np.ones(d + 1, np.float32)
    for _ in range(20):  # the largest curvature, by power iteration
        probe = full.T @ (full @ probe) / 4 + ridge * probe
        probe /= np.linalg.norm(probe)
    step = np.float32(1 / (1.05 * (np.linalg.norm(full.T @ (full @ probe) / 4) + penalty)))
    weights = ahead = np.append(np.zeros(d), math.log(share / (1 - share))).astype(np.float32)
    for i in range(steps):
        p = 1 / (1 + np.exp(-np.clip(full @ ahead, -40, 40)))
        new = ahead - step * (full.T @ (p - y) + ridge * ahead)
        ahead = new + np.float32(i / (i + 3)) * (new - weights)
        weights = new
    return weights.astype(float)


def fitted(
    docs: DataFrame, labels: DataFrame, categories: dict[str, str] | None = None,
    at_most: int = 8_000, most_features: int = 300,
) -> Chain:
    """A chain fitted on up to ``at_most`` labels (``doc_id``, ``quality``, ``toxic``)."""
    categories = categories or CATEGORIES
    chosen = sampled_labels(labels, at_most, "quality", "toxic").select(
        F.col("doc_id").alias("of"),
        *(F.expr(condition).cast("int").alias(name) for name, condition in categories.items()),
    )
    sample = written(one_text(docs, chosen), "toxicity-sample")
    sizes = sample.agg(F.count("*").alias("n"), *(F.sum(c).alias(c) for c in categories)).first()
    if not sizes["n"]:
        return Chain({}, {c: np.append(np.zeros(i), -40.0) for i, c in enumerate(categories)})
    counted = written(
        sample.select(F.explode(_distinct(whole("text"))).alias("feature"), *categories)
        .groupBy(F.col("feature"))
        .agg(F.count("*").alias("n"), *(F.sum(c).alias(c) for c in categories))
        .filter("n >= 5"),
        "toxicity-features",
    )
    names: dict[tuple, str] = {}
    for category in categories:
        has, all_of = sizes[category] or 0, sizes["n"]
        if not 0 < has < all_of:
            continue
        # difference of shares, in standard deviations of a difference without cause
        share = F.col("n") / all_of
        z = F.abs(F.col(category) / has - (F.col("n") - F.col(category)) / (all_of - has)) / F.sqrt(
            F.greatest(share * (1 - share), F.lit(1e-6))
        )
        best = counted.orderBy(z.desc(), "feature").limit(most_features)
        for feature, *alike in best.collect():
            # of features that the same documents seem to have, the longest is the most specific
            feature, alike = feature.removeprefix("2"), tuple(alike)
            names[alike] = max(names.get(alike, ""), feature, key=lambda f: (len(f), f))
    places = {name: i for i, name in enumerate(sorted(set(names.values())))}
    chain = Chain(places, {})
    names = list(categories)

    def rows(batches):
        memory: dict[str, tuple[int, ...]] = {}
        for batch in batches:
            x = [chain.row(t, memory).astype(np.float32).tobytes() for t in batch["text"]]
            yield batch.drop(columns="text").assign(x=pd.Series(x, index=batch.index, dtype=object))

    data = sample.select("doc_id", whole("text").alias("text"), *names).mapInPandas(
        rows, "doc_id long, " + ", ".join(f"{c} int" for c in names) + ", x binary"
    ).toPandas().sort_values(["doc_id", *names, "x"])
    x = np.frombuffer(b"".join(data["x"]), np.float32).reshape(len(data), len(places)).astype(float)
    fold = data["doc_id"].rank(method="dense").to_numpy(np.int64) % FOLDS
    weights = {}
    for category in categories:
        y = data[category].to_numpy(float)
        unseen = np.zeros(len(y))
        for f in range(FOLDS):
            unseen[fold == f] = _probability(x[fold == f], _logistic(x[fold != f], y[fold != f]))
        weights[category] = _logistic(x, y)
        x = np.column_stack([x, unseen])
    return Chain(places, weights)


def scored(docs: DataFrame, chain: Chain, column: str = "toxicity") -> DataFrame:
    """``docs`` with a struct of the chain's probabilities, ``p_<category>``.

    It is the last column and named ``column``, with underscores after it if ``docs`` has that already.
    """
    names = [f"p_{category}" for category in chain.weights]

    @F.pandas_udf(", ".join(f"{name} double" for name in names))
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        memory: dict[str, tuple[int, ...]] = {}
        for texts in parts:
            blocks = []
            for at in range(0, len(texts), 512):
                part = texts[at : at + 512]
                x = np.array([chain.row(t, memory) for t in part]).reshape(len(part), len(chain.places))
                blocks.append(chain.probabilities(x))
            yield pd.DataFrame(np.concatenate(blocks) if blocks else [], columns=names, dtype=float)

    return docs.withColumn(unused(column, docs), score(whole("text")))


def without_toxic(docs: DataFrame, chain: Chain, least: float = 0.5) -> DataFrame:
    """``docs`` whose last category in the chain is less probable than ``least``."""
    rows = scored(docs, chain)
    return rows.filter(F.col(rows.columns[-1])[f"p_{list(chain.weights)[-1]}"] < least).drop(rows.columns[-1])
