"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature is cut into quantile bins. Boosting goes round the features, and in
each turn fits a shallow tree of one feature to the logistic gradient; the trees
of a feature add up to its lookup table. Pairs that explain most of what is left
get tables of two features the same way. A score is the sigmoid of an intercept
plus one table entry per feature and pair: vectorised lookups and additions.

The model is fitted on the driver, on a bounded sample of labelled rows; every
text is scored, whole, in one pass without a shuffle.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Sent, by_value, map_rows
from .labelled import base_rate, labelled_rows

#: Bound on the labelled rows that the model is fitted on.
MAX_ROWS = 20_000
FEATURES = ("words", "word_length", "longest_word", "symbols", "exclamations", "separators", "upper_words", "upper_letters",
            "digits", "other_punctuation", "distinct_words", "stutter", "commonest_word", "lines", "words_per_line",
            "repeated_lines", "ended_lines", "not_ascii")
_BLANK = re.compile(r"[^\x20\x09-\x0D]+")
_SYMBOL = np.array([chr(b) in "#*$%&<>" for b in range(256)])
_UPPER = np.array([65 <= b <= 90 for b in range(256)])
_LETTER = np.array([65 <= b <= 90 or 97 <= b <= 122 for b in range(256)])
_DIGIT = np.array([48 <= b <= 57 for b in range(256)])
_PUNCT = np.array([chr(b) in "\"'()[]{}=+_/\\^~`@;:?" for b in range(256)])


def features(text: str | None) -> list[float]:
    """The text's features; all zero without a word."""
    words = _BLANK.findall(text or "")
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    raw = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), np.uint8), minlength=256)
    counts, size = Counter(words), int(raw.sum())
    lines = [x for x in text.split("\n") if x.strip()] or [text]
    letters = max(1, int(raw[_LETTER].sum()))
    return [np.log1p(n), sum(map(len, words)) / n, np.log1p(max(map(len, words))), raw[_SYMBOL].sum() / n, raw[33] / n, raw[124] / n,
            sum(map(str.isupper, words)) / n, raw[_UPPER].sum() / letters, raw[_DIGIT].sum() / size, raw[_PUNCT].sum() / n,
            len(counts) / n, sum(a == b for a, b in zip(words, words[1:], strict=False)) / n, counts.most_common(1)[0][1] / n,
            np.log1p(len(lines)), np.log1p(n / len(lines)), 1 - len(set(lines)) / len(lines),
            sum(x.rstrip()[-1:] in ".!?:;\"'" for x in lines) / len(lines), raw[128:].sum() / size]


def _leaves(g: np.ndarray, h: np.ndarray, depth: int, smooth: float) -> np.ndarray:
    """Leaf value of each bin: the best cut of a run of bins by gain, then its halves, to ``depth``."""
    value = np.full(len(g), g.sum() / (h.sum() + smooth))
    if depth and len(g) > 1:
        gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
        gain = gl**2 / (hl + smooth) + (g.sum() - gl) ** 2 / (h.sum() - hl + smooth)
        k = int(gain.argmax()) + 1
        if gain[k - 1] > g.sum() ** 2 / (h.sum() + smooth) + 1e-9:
            value = np.concatenate([_leaves(g[:k], h[:k], depth - 1, smooth), _leaves(g[k:], h[k:], depth - 1, smooth)])
    return value


@dataclass
class AdditiveModel:
    """Intercept, bin edges and tables; pairs are (feature, feature, table)."""
    intercept: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], 1) if self.edges else np.zeros((len(x), 0), int)

    def logit(self, x: np.ndarray) -> np.ndarray:
        b = self.bins(x)
        out = np.full(len(x), self.intercept)
        for j, t in enumerate(self.tables):
            out += t[b[:, j]]
        for i, j, t in self.pairs:
            out += t[b[:, i], b[:, j]]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x), -30, 30)))


def _pair_leaves(g: np.ndarray, h: np.ndarray, smooth: float) -> tuple[np.ndarray, float]:
    """A tree of one cut in each of two features: the table of leaf values, and its gain over no cut."""
    best, cuts = -np.inf, (0, 0)
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    for a in range(g.shape[0] - 1):
        low_g, low_h, top_g, top_h = cg[a, :-1], ch[a, :-1], cg[-1, :-1], ch[-1, :-1]
        parts = ((low_g, low_h), (cg[a, -1] - low_g, ch[a, -1] - low_h), (top_g - low_g, top_h - low_h),
                 (cg[-1, -1] - cg[a, -1] - top_g + low_g, ch[-1, -1] - ch[a, -1] - top_h + low_h))
        gain = sum(x**2 / (np.maximum(y, 0) + smooth) for x, y in parts)
        if len(gain) and gain.max() > best:
            best, cuts = gain.max(), (a + 1, int(gain.argmax()) + 1)
    out = np.zeros_like(g)
    if cuts[0]:
        for rows in (slice(None, cuts[0]), slice(cuts[0], None)):
            for cols in (slice(None, cuts[1]), slice(cuts[1], None)):
                out[rows, cols] = g[rows, cols].sum() / (h[rows, cols].sum() + smooth)
    return out, best - cg[-1, -1] ** 2 / (ch[-1, -1] + smooth)


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 150, pair_rounds: int = 40, n_pairs: int = 6, rate: float = 0.15,
        max_bins: int = 32, depth: int = 2, smooth: float = 4.0) -> AdditiveModel:
    """Fit on features and 0/1 labels; with fewer than two classes the model is its intercept."""
    ones = y.mean() if len(y) else 0.5
    model = AdditiveModel(float(np.log((ones + 1e-3) / (1 - ones + 1e-3))))
    if not 0 < ones < 1:
        return model
    at = np.linspace(0, 1, max_bins + 1)[1:-1]
    for j in range(x.shape[1]):
        values = np.unique(x[:, j])
        cuts = np.unique(np.quantile(x[:, j], at)) if len(values) > max_bins else (values[1:] + values[:-1]) / 2
        if len(values) > max_bins:   # quantiles of mostly equal values leave the rest uncut
            cuts = np.union1d(cuts, np.quantile(values, np.linspace(0, 1, 9)[1:-1]))
        model.edges.append(cuts)
        model.tables.append(np.zeros(len(cuts) + 1))
    b, out = model.bins(x), np.full(len(y), model.intercept)

    def gradient() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-out))
        return y - p, p * (1 - p)
    for _ in range(rounds):
        for j, table in enumerate(model.tables):
            g, h = gradient()
            step = rate * _leaves(np.bincount(b[:, j], g, len(table)), np.bincount(b[:, j], h, len(table)), depth, smooth)
            table += step
            out += step[b[:, j]]

    def grid(i: int, j: int) -> tuple[np.ndarray, np.ndarray, tuple[int, int], np.ndarray]:
        shape = (len(model.tables[i]), len(model.tables[j]))
        cell = b[:, i] * shape[1] + b[:, j]
        return *(np.bincount(cell, v, shape[0] * shape[1]).reshape(shape) for v in gradient()), shape, cell
    gains = []
    for i, j in combinations(range(x.shape[1]), 2):
        g, h, _, _ = grid(i, j)
        gains.append((_pair_leaves(g, h, smooth)[1], i, j))
    chosen = [(i, j) for gain, i, j in sorted(gains, reverse=True)[:n_pairs] if gain > 0]
    tables = [np.zeros((len(model.tables[i]), len(model.tables[j]))) for i, j in chosen]
    for _ in range(pair_rounds):
        for (i, j), table in zip(chosen, tables, strict=True):
            g, h, _, cell = grid(i, j)
            step = rate * _pair_leaves(g, h, smooth)[0]
            table += step
            out += step.ravel()[cell]
    model.pairs = [(i, j, t) for (i, j), t in zip(chosen, tables, strict=True)]
    return model


def train(docs: DataFrame, labels: DataFrame, label: str, learn: Column, max_rows: int = MAX_ROWS) -> AdditiveModel:
    """Fit on up to ``max_rows`` labelled rows where ``learn`` holds; the intercept is set back to the labels' own rate."""
    rows = labelled_rows(docs, labels, label, learn, max_rows)

    def run(parts: Iterator[dict]) -> Iterator[dict]:
        for p in parts:
            yield {"x": [features(t) for t in p["text"]], "y": p["y"]}
    got = map_rows(rows.select("text", "y"), "x array<double>, y int", run).limit(4 * max_rows).collect()
    x = np.array([r["x"] for r in got], float).reshape(len(got), len(FEATURES))
    y = np.array([r["y"] for r in got], float)
    order = np.lexsort(x.T)   # rows arrive in any order: sums and so tables agree between runs
    model = fit(x[order], y[order])
    if len(y) and 0 < y.mean() < 1:
        rate = base_rate(labels, label, learn)
        model.intercept += np.log(rate / (1 - rate)) - np.log(y.mean() / (1 - y.mean()))
    return model


def score(docs: DataFrame, model: AdditiveModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``(doc_id, score)``. Null and empty texts score by the zero features; repeated rows score alike."""
    sent = Sent(docs.sparkSession, model)   # a few thousand numbers, whatever the input
    kind = docs.select(id_col).schema[0].dataType.simpleString()

    def run(parts: Iterator[dict]) -> Iterator[dict]:
        own = sent.get()
        for p in parts:
            x = np.array([features(t) for t in p["text"]], float).reshape(len(p["text"]), len(FEATURES))
            yield {"doc_id": p["id"], "score": own.score(x).tolist()}
    return map_rows(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), f"doc_id {kind}, score double", run)


by_value(__name__)
