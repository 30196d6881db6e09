"""Toxicity by weak supervision: voters, a generative label model, a linear classifier.

Terms (words, and word beginnings of 3 to 6 letters) that stand out in toxic
labelled texts form lexicons; lexicons, a public seed list and patterns are
voters. The label model is a latent class with a tree of voter dependencies: it
estimates by expectation-maximisation how often each voter fires in toxic and
other texts given its parent voter, the tree joining the voters that depend on
each other most within a class. Its posterior labels, not the given ones, train a
logistic classifier over the terms and votes, which scores every whole text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Sent, by_value, map_rows, write_scratch
from .labelled import base_rate, labelled_rows

#: Bound on the labelled rows that voters, label model and classifier are fitted on.
MAX_ROWS = 20_000
#: Lexicon terms kept at most, and the lexicons that they are dealt to.
MAX_TERMS, LEXICONS = 512, 8
#: Toxic texts that a term must be in, and its least log ratio of rates.
SUPPORT, LEAST_RATIO = 8, 2.5
#: Seed lexicon (fixed values): common insults.
SEED = frozenset("idiot moron stupid scum trash loser pathetic worthless disgusting dumb fool imbecile "
                 "filthy vermin bastard hate kill ugly clown".split())
_LETTERS = re.compile(r"[^\W\d_]{3,40}")
_SHOUT = re.compile(r"\b[^\W\d_]{3,}!{2,}")
_SECOND_PERSON = re.compile(r"\b(?:you|your|they|these|those)\b[^.\n]{0,40}")
PREFIXES = (3, 4, 5, 6)


def words_of(text: str | None) -> set[str]:
    return set(_LETTERS.findall((text or "").lower()))


def word_terms(word: str) -> list[str]:
    """A word itself, and its beginnings marked by a star."""
    return [word, *(word[:k] + "*" for k in PREFIXES if k < len(word))]


def signature(text: str | None) -> int:
    """Least hash of the text's three-word runs: near copies mostly share it, so that one stands for all in the sample."""
    words = (text or "").lower().split()
    runs = zip(words, words[1:], words[2:], strict=False) if len(words) >= 3 else [words]
    return min((xxhash.xxh64_intdigest(" ".join(r)) for r in runs), default=0) >> 1


@dataclass
class ToxicityModel:
    terms: dict[str, int]
    weights: np.ndarray
    intercept: float

    def __post_init__(self):
        self._of_word: dict[str, tuple[int, ...]] = {}

    def matches(self, words: set[str]) -> set[int]:
        """Indices of the terms in a text's words; these are looked up once per task (the table is emptied when full)."""
        known, found = self._of_word, set()
        for w in words:
            hit = known.get(w)
            if hit is None:
                if len(known) >= 300_000:
                    known.clear()
                hit = known[w] = tuple(self.terms[t] for t in word_terms(w) if t in self.terms)
            if hit:
                found.update(hit)
        return found

    def read(self, text: str | None) -> tuple[list[int], np.ndarray]:
        """The terms found in a text, and the voters' 0/1 votes; each voter reads the text for itself."""
        low, out = (text or "").lower(), np.zeros(LEXICONS + 5)
        words = words_of(low)
        found = sorted(self.matches(words))
        for i in found:
            out[i % LEXICONS] = 1
        out[LEXICONS] = bool(words & SEED)
        out[LEXICONS + 1] = len(found) >= 2
        out[LEXICONS + 2] = len(found) >= 4
        out[LEXICONS + 3] = any(words_of(m) & SEED for m in _SECOND_PERSON.findall(low))
        out[LEXICONS + 4] = "!!" in low and bool(_SHOUT.search(low))
        return found, out

    def score(self, text: str | None) -> float:
        found, votes = self.read(text)
        z = self.intercept + self.weights[found].sum() + self.weights[len(self.terms):] @ votes
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def mine_terms(sample: DataFrame) -> list[str]:
    """Up to ``MAX_TERMS`` terms of a bounded sample ``(text, y)`` that stand out in toxic texts, strongest first."""
    def run(parts: Iterator[dict]) -> Iterator[dict]:
        for p in parts:
            counts = (Counter(), Counter())
            for text, y in zip(p["text"], p["y"], strict=True):
                counts[y].update({t for w in words_of(text) for t in word_terms(w)})
            terms = list(counts[0].keys() | counts[1].keys())
            yield {"term": terms, "n0": [counts[0][t] for t in terms], "n1": [counts[1][t] for t in terms]}
    sizes = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes.get(1) or not sizes.get(0):
        return []
    ratio = F.log((F.col("n1") + 0.5) / (sizes[1] + 1.0)) - F.log((F.col("n0") + 0.5) / (sizes[0] + 1.0))
    return [r["term"] for r in map_rows(sample.select("text", "y"), "term string, n0 long, n1 long", run)
            .groupBy("term").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
            .where((F.col("n1") >= SUPPORT) & (ratio >= LEAST_RATIO))
            .orderBy((F.col("n1") * ratio).desc(), F.length("term"), "term").limit(MAX_TERMS).collect()]


def label_model(votes: np.ndarray, start: np.ndarray, rounds: int = 40) -> np.ndarray:
    """Posterior P(toxic) of each row of 0/1 ``votes`` under a latent class with a tree of dependent voters."""
    n, m = votes.shape
    q = np.clip(start, 0.05, 0.95)
    v = votes.astype(int)
    parent = np.full(m, -1)
    for r in range(rounds):
        weights = np.stack([1 - q, q])
        if r % 10 == 5:
            parent = _tree(v, weights)
        log = np.log(weights.sum(1) / n + 1e-9)[:, None].repeat(n, 1)
        for j in range(m):
            above = v[:, parent[j]] if parent[j] >= 0 else np.zeros(n, int)
            for y in (0, 1):
                fired = np.bincount(above, weights[y] * v[:, j], 2)
                every = np.bincount(above, weights[y], 2)
                p = ((fired + 0.1) / (every + 0.2))[above]
                log[y] += np.where(v[:, j] == 1, np.log(p), np.log(1 - p))
        after = 1 / (1 + np.exp(np.clip(log[0] - log[1], -30, 30)))
        if np.abs(after - q).max() < 1e-6 and r > 20:
            break
        q = after
    return q


def _tree(v: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Parents of the spanning tree of voters with the greatest mutual information within the classes."""
    m, n = v.shape[1], len(v)
    info = np.zeros((m, m))
    for y in (0, 1):
        w = weights[y] / n
        total = w.sum() + 1e-12
        for a in range(m):
            for b in range(a):
                joint = np.bincount(v[:, a] * 2 + v[:, b], w, 4).reshape(2, 2) / total + 1e-12
                info[a, b] += total * (joint * np.log(joint / (joint.sum(1, keepdims=True) * joint.sum(0)))).sum()
    info += info.T
    parent, linked = np.full(m, -1), {0}
    while len(linked) < m:
        a, b = max(((a, b) for a in linked for b in range(m) if b not in linked), key=lambda x: info[x])
        parent[b] = a
        linked.add(b)
    return parent


def linear_classifier(x: np.ndarray, q: np.ndarray, rounds: int = 400, rate: float = 0.1, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Logistic weights for soft labels ``q``, by full-batch adaptive gradient steps."""
    w, m, s = (np.zeros(x.shape[1] + 1) for _ in range(3))
    x = np.concatenate([x, np.ones((len(x), 1))], 1).astype(np.float32)
    for t in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w.astype(np.float32), -30, 30)))
        g = (x.T @ (p - q.astype(np.float32))) / len(x) + decay * np.append(w[:-1], 0)
        m, s = 0.9 * m + 0.1 * g, 0.999 * s + 0.001 * g**2
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.999**t)) + 1e-8)
    return w[:-1], float(w[-1])


def train(docs: DataFrame, labels: DataFrame, label: str, learn: Column, max_rows: int = MAX_ROWS) -> ToxicityModel:
    """Fit on up to ``max_rows`` labelled rows where ``learn`` holds; without both classes the score is the base rate."""
    rate = base_rate(labels, label, learn)
    nothing = ToxicityModel({}, np.zeros(LEXICONS + 5), float(np.log(rate / (1 - rate))))
    rows = labelled_rows(docs, labels, label, learn, max_rows)

    def signed(parts: Iterator[dict]) -> Iterator[dict]:
        for p in parts:
            yield p | {"sign": [signature(t) for t in p["text"]]}
    sample = write_scratch(map_rows(rows, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + ", sign long", signed)
                           .groupBy("sign", "y").agg(F.min(F.struct("doc_id", "text")).alias("one")).select("one.doc_id", "one.text", "y", "sign"), "labelled")
    terms = mine_terms(sample)
    model = ToxicityModel({t: i for i, t in enumerate(terms)}, np.zeros(len(terms) + LEXICONS + 5), 0.0)
    sent = Sent(docs.sparkSession, model)

    def run(parts: Iterator[dict]) -> Iterator[dict]:
        own = sent.get()
        for p in parts:
            found, votes = zip(*(own.read(t) for t in p["text"]), strict=True)
            yield {"doc_id": p["doc_id"], "y": p["y"], "found": list(found), "votes": [v.astype(int).tolist() for v in votes]}
    kind = docs.select("doc_id").schema[0].dataType.simpleString()
    got = sorted(map_rows(sample.select("doc_id", "text", "y"), f"doc_id {kind}, y int, found array<int>, votes array<int>", run)
                 .limit(4 * max_rows).collect())
    if len({r["y"] for r in got}) < 2:
        return nothing
    votes, y = np.array([r["votes"] for r in got], float), np.array([r["y"] for r in got], float)
    x = np.zeros((len(got), len(terms)), np.float32)
    for i, r in enumerate(got):
        x[i, r["found"]] = 1
    q = label_model(votes, y)
    model.weights, intercept = linear_classifier(np.concatenate([x, votes], 1), q)
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    model.intercept = intercept + float(np.log(rate / (1 - rate)) - np.log(share / (1 - share)))
    return model


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``(doc_id, score)``. Null and empty texts score by the intercept; repeated rows score alike."""
    sent = Sent(docs.sparkSession, model)   # MAX_TERMS terms and weights at most
    kind = docs.select(id_col).schema[0].dataType.simpleString()

    def run(parts: Iterator[dict]) -> Iterator[dict]:
        own = sent.get()
        for p in parts:
            yield {"doc_id": p["id"], "score": [own.score(t) for t in p["text"]]}
    return map_rows(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), f"doc_id {kind}, score double", run)


by_value(__name__)
