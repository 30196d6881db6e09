"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text's paragraphs (sentences of its lines) are hashed, the k-th copy of one with
seed k, and each digest is added to one cell in each of three subtables: a count,
the xor of digests, the xor of their checks. Two sketches of a size subtract cell
by cell; cells left with one digest are peeled until nothing is left, which
recovers the digests that differ. If cells remain, larger sketches are made of
the digests and the peeling starts again, so the likeness is that of the whole
texts: shared over all paragraphs.

Sketches of many pairs are subtracted and peeled together in numpy arrays.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_value, map_rows

#: Cells of a stored fingerprint, and how much larger each retry is.
CELLS, GROWTH = 24, 4
TABLES = 3
#: Words of a stretch without a sentence end beyond which it is cut at words chosen by their hash, one in
#: ``CUT_EVERY``, or after ``MOST_WORDS``.
LONG_WORDS, CUT_EVERY, MOST_WORDS = 32, 16, 64
_SENTENCE = re.compile(r"[^.!?\n]+[.!?]*|[.!?]+")
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def paragraphs(text: str) -> list[str]:
    """Sentences of each line, trimmed; long stretches without an end are cut where the content says so."""
    out = []
    for s in _SENTENCE.findall(text):
        s = s.strip()
        if len(s) > 4 * LONG_WORDS and len(words := s.split()) > LONG_WORDS:
            begin = 0
            for i, w in enumerate(words, 1):
                if i in (len(words), begin + MOST_WORDS) or xxhash.xxh32_intdigest(w) % CUT_EVERY == 0:
                    out.append(" ".join(words[begin:i]))
                    begin = i
        elif s:
            out.append(s)
    return out


def digests(text: str) -> np.ndarray:
    """A 64-bit digest of each paragraph; equal ones are told apart by their turn."""
    turn: dict[str, int] = {}
    out = []
    for p in paragraphs(text):
        k = turn.get(p, 0)
        turn[p] = k + 1
        out.append(xxhash.xxh64_intdigest(p, k))
    return np.array(out, np.uint64)


def _places(d: np.ndarray, which: np.ndarray, size: int) -> list[np.ndarray]:
    """The cell of each digest in each subtable, sketches laid end to end."""
    part = size // TABLES
    return [which * size + t * part + ((d * _MIX[t]) >> np.uint64(33)).astype(np.int64) % part for t in range(TABLES)]


def _checks(d: np.ndarray) -> np.ndarray:
    return ((d ^ (d >> np.uint64(29))) * _MIX[3]) >> np.uint64(32)


def sketch(groups: list[np.ndarray], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(counts, digests, checks) of each group's sketch, a row per group."""
    n = len(groups)
    d = np.concatenate(groups) if n else np.zeros(0, np.uint64)
    which = np.repeat(np.arange(n), [len(g) for g in groups])
    counts, keys, checks = np.zeros(n * size, np.int64), np.zeros(n * size, np.uint64), np.zeros(n * size, np.uint64)
    own = _checks(d)
    for at in _places(d, which, size):
        np.add.at(counts, at, 1)
        np.bitwise_xor.at(keys, at, d)
        np.bitwise_xor.at(checks, at, own)
    return counts.reshape(n, size), keys.reshape(n, size), checks.reshape(n, size)


def peel(counts: np.ndarray, keys: np.ndarray, checks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Peel subtracted sketches: (sketch, digest, side) of what differs, and which sketches are empty in the end.

    Side is 1 for the first version's digests, -1 for the second's.
    """
    n, size = counts.shape
    counts, keys, checks = counts.ravel().copy(), keys.ravel().copy(), checks.ravel().copy()
    found = []
    left = n * size + 1
    while True:
        single = np.flatnonzero(np.abs(counts) == 1)
        single = single[checks[single] == _checks(keys[single])]
        if not len(single) or left <= 0:
            break
        left -= 1
        pairs = np.empty(len(single), [("w", np.int64), ("d", np.uint64), ("s", np.int64)])
        pairs["w"], pairs["d"], pairs["s"] = single // size, keys[single], counts[single]
        pairs = np.unique(pairs)
        found.append(pairs)
        own = _checks(pairs["d"])
        for at in _places(pairs["d"], pairs["w"], size):
            np.subtract.at(counts, at, pairs["s"])
            np.bitwise_xor.at(keys, at, pairs["d"])
            np.bitwise_xor.at(checks, at, own)
    got = np.concatenate(found) if found else np.empty(0, [("w", np.int64), ("d", np.uint64), ("s", np.int64)])
    empty = ~(counts.astype(bool) | keys.astype(bool) | checks.astype(bool)).reshape(n, size).any(1)
    return got["w"], got["d"], got["s"], empty


def differing(first: list[np.ndarray], second: list[np.ndarray], start=None) -> tuple[np.ndarray, np.ndarray]:
    """How many digests each pair's first and second version have alone, recovered by peeling.

    ``start`` holds both versions' stored sketches, if they are at hand. Pairs that don't peel go on with
    sketches ``GROWTH`` times as large, until all do.
    """
    only = np.zeros((2, len(first)), np.int64)
    todo, size = np.arange(len(first)), CELLS
    while len(todo):
        a, b = start if start is not None else (sketch([x[i] for i in todo], size) for x in (first, second))
        start = None
        which, _, side, empty = peel(a[0] - b[0], a[1] ^ b[1], a[2] ^ b[2])
        for row, s in ((0, 1), (1, -1)):
            n = np.bincount(which[side == s], minlength=len(todo))
            only[row, todo[empty]] = n[empty]
        todo, size = todo[~empty], size * GROWTH
    return only[0], only[1]


def encoded(n: int, counts: np.ndarray, keys: np.ndarray, checks: np.ndarray) -> str:
    """A stored fingerprint: the number of paragraphs and the cells, little-endian, in base 64."""
    return base64.b64encode(np.array([n], "<u4").tobytes() + counts.astype("<i4").tobytes() + keys.astype("<u8").tobytes()
                            + checks.astype("<u4").tobytes()).decode()


def likeness(n_first: np.ndarray, n_second: np.ndarray, only_first: np.ndarray, only_second: np.ndarray) -> np.ndarray:
    """Shared paragraphs over all paragraphs; 1 if neither has any."""
    shared = n_first - only_first
    every = n_second + only_first
    return np.where(every > 0, shared / np.maximum(every, 1), 1.0)


def edited_text(text: str, after: str) -> str:
    cut = len(text) // 3
    return text[:len(text) - cut] + after[:cut]


def _compare(rows: list[tuple]) -> dict[str, list]:
    """Results of ``(doc_id, text, digests, next text, next digests)``."""
    edited = [edited_text(r[1], r[3]) for r in rows]
    own, new, after = [r[2] for r in rows], [digests(e) for e in edited], [r[4] for r in rows]
    at_own, at_new, at_after = (sketch(x, CELLS) for x in (own, new, after))
    n_own, n_new, n_after = (np.array([len(d) for d in x]) for x in (own, new, after))
    out = {"doc_id": [r[0] for r in rows], "n_chars": [len(r[1]) for r in rows],
           "edited_sha256": [hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest() for e in edited]}
    for name, n, s in (("fingerprint", n_own, at_own), ("edited_fingerprint", n_new, at_new)):
        out[name] = [encoded(n[i], s[0][i], s[1][i], s[2][i]) for i in range(len(rows))]
    for name, other, n, s in (("near_edited", new, n_new, at_new), ("near_next", after, n_after, at_after)):
        out[name] = likeness(n_own, n, *differing(own, other, (at_own, s))).tolist()
    return out


def version_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.

    The next document is the one of the next lower id (after the lowest, the highest; a single row is its own
    next); null ids come last, and rows of one id are ordered by a hash of their text. Null texts count as empty;
    two texts without paragraphs are alike (1). Extra columns are not read; an empty table gives an empty result.

    Ids are cut into ranges of equal count, a task each, and an id that fills several is cut by its texts' hashes;
    every range also gets the first row of the one below it, so each text is moved once and each task reads its
    rows in order. The driver sees a bound, a first id and a hash for each range.
    """
    spark = docs.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("h"))
    share = [i / parts for i in range(1, parts)]
    found = (rows.agg(F.percentile_approx("id", share, 10_000)).first()[0] if share else None) or []
    hot = [i for i, n in Counter(found).items() if n > 1]   # fewer than there are ranges
    cuts = {r["id"]: np.array(sorted(set(r["cuts"])), np.int64) for r in rows.where(F.col("id").isin(hot)).groupBy("id").agg(
        F.percentile_approx("h", share, 10_000).alias("cuts")).collect()} if hot else {}
    bounds = np.array(sorted(i for i in set(found) for _ in range(1 + len(cuts.get(i, ())))), np.int64)

    def ranges(ids: pd.Series, unknown: pd.Series, hashes: pd.Series) -> np.ndarray:
        """Number of the row's range, highest ids (then hashes) first; rows without an id are behind all."""
        i, h = ids.to_numpy(np.int64), hashes.to_numpy(np.int64)
        at = np.searchsorted(bounds, i, side="left")
        for one, own in cuts.items():
            here = i == one
            at[here] += np.searchsorted(own, h[here], side="left")
        return np.where(unknown, len(bounds) + 1, len(bounds) - at)
    key = (F.coalesce("id", F.lit(0)), F.col("id").isNull(), F.col("h"))   # a null would turn a batch's ids into doubles

    @F.pandas_udf("int")
    def range_of(ids: pd.Series, unknown: pd.Series, hashes: pd.Series) -> pd.Series:
        return pd.Series(ranges(ids, unknown, hashes))
    firsts = {r["range"]: (r["first"]["id"], r["first"]["h"]) for r in rows.groupBy(range_of(*key).alias("range")).agg(
        F.max(F.struct("id", "h")).alias("first")).collect()}
    filled = sorted(firsts)
    before = {r: filled[i - 1] for i, r in enumerate(filled)}

    @F.pandas_udf("array<int>")
    def goes_to(ids: pd.Series, unknown: pd.Series, hashes: pd.Series) -> pd.Series:
        """The row's range, and as (-1 - range) the range above if the row is the first of its own."""
        out = []
        for r, i, h in zip(ranges(ids, unknown, hashes), ids, hashes, strict=True):
            first_id, first_h = firsts[r]
            is_first = h == first_h and (first_id is None or i == first_id)
            out.append([r, -1 - before[r]] if is_first else [r])
        return pd.Series(out)
    dealt = rows.select("id", "text", "h", F.explode(goes_to(*key)).alias("to")).select(
        "id", "text", "h", F.when(F.col("to") < 0, -1 - F.col("to")).otherwise(F.col("to")).alias("range"), (F.col("to") < 0).alias("carried"))
    ordered = dealt.repartitionById(max(filled, default=0) + 1, F.col("range")).sortWithinPartitions(
        "range", "carried", F.col("id").desc_nulls_last(), F.col("h").desc())

    def run(slices: Iterator[dict]) -> Iterator[dict]:
        waiting = None
        for p in slices:
            ready = []
            for i, text, r, carried in zip(p["id"], p["text"], p["range"], p["carried"], strict=True):
                if carried and waiting is None:
                    continue
                text = text or ""
                d = digests(text)
                if waiting is not None:
                    ready.append((*waiting, text, d))
                waiting = None if carried else (i, text, d)
            if ready:
                yield _compare(ready)
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    out = map_rows(ordered.select("id", "text", "range", "carried"), "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                   "edited_fingerprint string, near_edited double, near_next double", run)
    return out.withColumn("doc_id", F.col("doc_id").cast(kind))


by_value(__name__)
