"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature is cut into bins.  Boosting goes round the features in turn and fits a
shallow tree on one feature's bins to the current gradient; all trees of a feature
add up to one lookup table over its bins.  Then the strongest pairs of features get
tables over pairs of coarser bins in the same way.  A score is the sum of table
entries, so scoring is a vector of additions.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import held_out, labelled_sample, stored, vector_udf

FEATURES = (
    "log_words", "mean_word", "long_words", "distinct_words", "top_word", "upper", "digits", "marks", "symbols",
    "bangs", "pipes", "sentence_ends", "words_per_line", "dup_lines", "dup_trigrams", "mid_marks", "title_words",
    "non_ascii", "braces", "log_lines",
)
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]+").findall
_DIGITS = re.compile(r"[0-9]+").findall
_MARKS = re.compile(r"[.,;:'\"()?!-]+").findall
_SYMBOLS = re.compile(r"[#*$%&<>@^~=+\\/]+").findall
_BRACES = re.compile(r"[{}\[\]<>]+").findall


def features(text: str) -> list[float]:
    """The values of `FEATURES` of one whole text; all shares are of characters or words."""
    words = text.split()
    n, chars = len(words), max(1, len(text))
    if not n:
        return [0.0] * len(FEATURES)
    counts = Counter(words)
    size = lambda found: sum(map(len, found))
    lines = [x for x in text.split("\n") if x.strip()]
    letters = sum(map(len, words))
    number = {w: i for i, w in enumerate(counts)}
    ids = np.fromiter(map(number.__getitem__, words), np.int64, n)
    if n > 3:
        tri = (ids[:-2] * len(counts) + ids[1:-1]) * len(counts) + ids[2:]
        repeated = 1 - len(np.unique(tri)) / len(tri)
    else:
        repeated = 0.0
    return [
        np.log1p(n), letters / n, sum(c for w, c in counts.items() if len(w) > 15) / n, len(counts) / n,
        max(counts.values()) / n, size(_UPPER(text)) / letters, size(_DIGITS(text)) / letters, size(_MARKS(text)) / chars,
        size(_SYMBOLS(text)) / chars, text.count("!") / n, text.count("|") / n,
        sum(c for w, c in counts.items() if w[-1] in ".?!") / n, n / max(1, len(lines)),
        1 - len(set(lines)) / max(1, len(lines)), repeated,
        sum(c for w, c in counts.items() if len(w) > 2 and not w[-1].isalnum() and not w[-2].isalnum()) / n,
        sum(c for w, c in counts.items() if w[0].isupper()) / n,
        1 - len(text.encode("ascii", "ignore")) / chars, size(_BRACES(text)) / chars, np.log1p(len(lines)),
    ]


def feature_column(text: Column) -> Column:
    """An array of the features of each text; null counts as empty, which has zeros."""
    @vector_udf("array<double>")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t or "") for t in texts])

    return run(text)


def _tree(sums: np.ndarray, weight: np.ndarray, leaves: int, ridge: float) -> np.ndarray:
    """A tree on ordered bins: splits the bins greedily into at most ``leaves`` runs by the
    gain in squared error; returns the step of each bin."""
    edges = [0, len(sums)]
    g, h = np.concatenate([[0], np.cumsum(sums)]), np.concatenate([[0], np.cumsum(weight)])
    part = lambda a, b: (g[b] - g[a]) ** 2 / (h[b] - h[a] + ridge)
    while len(edges) <= leaves:
        best = max(((part(a, m) + part(m, b) - part(a, b), m) for a, b in zip(edges, edges[1:]) for m in range(a + 1, b)),
                   default=(0, None))
        if best[0] <= 1e-12:
            break
        edges = sorted([*edges, best[1]])
    step = np.empty(len(sums))
    for a, b in zip(edges, edges[1:]):
        step[a:b] = (g[b] - g[a]) / (h[b] - h[a] + ridge)
    return step


@dataclass
class AdditiveModel:
    cuts: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)
    base: float = 0.0

    def bins(self, x: np.ndarray) -> list[np.ndarray]:
        return [np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(self.cuts)]

    def margin(self, x: np.ndarray) -> np.ndarray:
        b = self.bins(x)
        out = np.full(len(x), self.base)
        for j, table in enumerate(self.tables):
            out += table[b[j]]
        for i, j, table in self.pairs:
            out += table[self.coarse[i][b[i]], self.coarse[j][b[j]]]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, n_bins: int = 32, rounds: int = 150, rate: float = 0.15, leaves: int = 3,
        ridge: float = 3.0, n_pairs: int = 8, pair_bins: int = 6, pair_rounds: int = 40) -> AdditiveModel:
    """Fits to rows ``x`` and labels ``y`` (0 or 1).  Without rows the model scores 0.5; with
    one class only it scores that class's smoothed share."""
    m = AdditiveModel()
    d = x.shape[1]
    m.base = float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
    for j in range(d):
        cut = np.unique(np.quantile(x[:, j], np.linspace(0, 1, n_bins + 1)[1:-1])) if len(x) else np.zeros(0)
        m.cuts.append(cut)
        m.tables.append(np.zeros(len(cut) + 1))
        m.coarse.append(np.arange(len(cut) + 1) * pair_bins // (len(cut) + 1))
    if not len(x) or y.min() == y.max():
        return m
    b = m.bins(x)
    f = np.full(len(x), m.base)
    for _ in range(rounds):
        for j in range(d):
            p = 1 / (1 + np.exp(-f))
            size = len(m.tables[j])
            step = rate * _tree(np.bincount(b[j], y - p, size), np.bincount(b[j], p * (1 - p), size), leaves, ridge)
            m.tables[j] += step
            f += step[b[j]]
    # the pairs whose cells still explain most of the residual, best first
    p = 1 / (1 + np.exp(-f))
    gains = []
    for i, j in combinations(range(d), 2):
        cell = m.coarse[i][b[i]] * pair_bins + m.coarse[j][b[j]]
        g, h = np.bincount(cell, y - p, pair_bins ** 2), np.bincount(cell, p * (1 - p), pair_bins ** 2)
        gains.append((float((g ** 2 / (h + ridge)).sum()), i, j, cell))
    chosen = sorted(gains, key=lambda t: (-t[0], t[1], t[2]))[:n_pairs]
    tables = [np.zeros(pair_bins ** 2) for _ in chosen]
    for _ in range(pair_rounds):
        for k, (_, _, _, cell) in enumerate(chosen):
            p = 1 / (1 + np.exp(-f))
            g, h = np.bincount(cell, y - p, pair_bins ** 2), np.bincount(cell, p * (1 - p), pair_bins ** 2)
            step = rate * g / (h + ridge)
            tables[k] += step
            f += step[cell]
    m.pairs = [(i, j, t.reshape(pair_bins, pair_bins)) for (_, i, j, _), t in zip(chosen, tables)]
    return m


def train(featured: DataFrame, labels: DataFrame, label: str, max_rows: int = 20_000) -> AdditiveModel:
    """Fits on the features (not the texts) of at most ``max_rows`` labelled rows."""
    sample = labelled_sample(labels, label, max_rows)
    rows = (featured.where(F.col("doc_id").isNotNull()).join(F.broadcast(sample), "doc_id")
            .groupBy("doc_id").agg(F.min("x").alias("x"), F.max("label").alias("label"))
            .orderBy("doc_id").limit(max_rows).collect())  # at most max_rows short arrays
    x = np.array([r.x for r in rows]).reshape(len(rows), len(FEATURES))
    return fit(x, np.array([float(r.label) for r in rows]))


def quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, max_rows: int = 20_000) -> DataFrame:
    """doc_id, score and predicted of each document.

    Labels with null or repeated ids are handled by `labelled_sample`; empty texts have
    features of zero and get a score like any other; an empty table gives no rows, and
    without labels all scores are 0.5."""
    featured = stored(docs.select("doc_id", feature_column(F.col("text")).alias("x")), "gam")
    shared = docs.sparkSession.sparkContext.broadcast(train(featured, labels, "quality", max_rows))

    @vector_udf("double")
    def score(x: pd.Series) -> pd.Series:
        return pd.Series(shared.value.score(np.stack(x.to_numpy())) if len(x) else np.zeros(0))

    scored = featured.select("doc_id", score("x").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op9(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return quality(docs, labels).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
