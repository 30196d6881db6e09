"""Centroid clustering by PCA-rotated filtering, exact in integers.

Vectors become integers. One pass adds up their sums and products; the covariance's
leading eigenvectors span a rotated frame. Each vector is stored with its ``lead``
leading rotated coordinates and the norm of what is left of it. As a rotation keeps
distances, the squared distance of two vectors is at least the squared distance of
their leading coordinates plus the squared difference of their residual norms.

To assign a vector, the centroid of least bound is measured first; only centroids
whose bound does not exceed the least measured distance are measured as well, in
integers. The bound is lowered by more than the rounding of its own arithmetic, so
results are those of measuring all of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_value, map_batches, write_scratch

#: Components of the integer vectors lie within this bound, so that a squared distance of 2**9 components fits a long.
MOST = 1 << 26


def kept_vectors(vectors: DataFrame, dim: int, scale: int, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(vec_id, v)``: floor(scale * x) of vectors of ``dim`` components, none of them null, NaN or infinite."""
    x = F.transform(F.col(vec_col), lambda c: c.cast("double"))
    odd = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    at = F.transform(x, lambda c: F.greatest(F.least(F.floor(c * F.lit(float(scale))), F.lit(MOST)), F.lit(-MOST)).cast("int"))
    return vectors.where((F.size(vec_col) == dim) & ~odd).select(F.col(id_col).alias("vec_id"), at.alias("v"))


def first_centroids(kept: DataFrame, k: int, salt: str = "1:") -> np.ndarray:
    """The ``k`` vectors of least SHA-256 of salt and id, in that order; ties by components, null ids last."""
    digest: Column = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")).cast("binary"), 256)
    rows = kept.orderBy(digest.asc_nulls_last(), "v").select("v").limit(k).collect()
    return np.array([r["v"] for r in rows], np.int64)


def _moments(kept: DataFrame, dim: int) -> tuple[int, np.ndarray, np.ndarray]:
    """Count, mean and covariance: each task adds up its rows and gives one row of sums."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        n, sums, products = 0, np.zeros(dim), np.zeros((dim, dim))
        for batch in batches:
            x = _matrix(batch, "v", dim, float)
            n, sums, products = n + len(x), sums + x.sum(0), products + x.T @ x
        yield {"i": [*range(dim + 1)], "n": [n] * (dim + 1), "s": [sums.tolist(), *products.tolist()]}
    parts = map_batches(kept.select("v"), "i int, n long, s array<double>", run)
    got = sorted(parts.groupBy("i").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("s")[j]) for j in range(dim)]).alias("s")).collect())
    n = got[0]["n"] if got else 0
    if not n:
        return 0, np.zeros(dim), np.eye(dim)
    mean = np.array(got[0]["s"]) / n
    return n, mean, np.array([r["s"] for r in got[1:]]) / n - np.outer(mean, mean)


class Frame:
    """The rotated frame: a mean and ``lead`` orthonormal directions of greatest variance."""

    def __init__(self, mean: np.ndarray, axes: np.ndarray):
        self.mean, self.axes = mean, axes

    def place(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leading coordinates and norm of the rest, of rows ``x``."""
        y = x - self.mean
        head = y @ self.axes
        return head, np.sqrt(np.maximum((y * y).sum(1) - (head * head).sum(1), 0))


def fit_frame(kept: DataFrame, dim: int, lead: int) -> Frame:
    _, mean, covariance = _moments(kept, dim)
    _, axes = np.linalg.eigh(covariance)
    return Frame(mean, np.ascontiguousarray(axes[:, ::-1][:, :lead]))


def nearest(v: np.ndarray, head: np.ndarray, rest: np.ndarray, centroids: np.ndarray, frame: Frame) -> tuple[np.ndarray, np.ndarray, int]:
    """``(cluster, squared distance, distances measured)`` of integer rows ``v`` stored as ``head`` and ``rest``."""
    chead, crest = frame.place(centroids.astype(float))
    bound = ((head[:, None, :] - chead) ** 2).sum(2) + (rest[:, None] - crest) ** 2
    size = (head * head).sum(1) + rest * rest
    slack = 1e-9 * (size[:, None] + (chead * chead).sum(1) + crest * crest) + 1e-6   # far above rounding in doubles
    bound -= slack
    order = np.argsort(bound, axis=1, kind="stable")
    rows = np.arange(len(v))
    best = np.full(len(v), np.iinfo(np.int64).max)
    cluster, measured = np.zeros(len(v), np.int64), 0
    for j in order.T:
        live = bound[rows, j[rows]] <= best[rows]
        rows = rows[live]   # bounds only grow from here on: a row that is done stays done
        if not len(rows):
            break
        c = j[rows]
        gap = v[rows] - centroids[c]
        d = (gap * gap).sum(1)
        measured += len(rows)
        better = (d < best[rows]) | ((d == best[rows]) & (c < cluster[rows]))
        best[rows[better]], cluster[rows[better]] = d[better], c[better]
    return cluster, best, measured


def _matrix(batch: pa.RecordBatch, name: str, width: int, kind: type) -> np.ndarray:
    """A column of lists of equal length as rows of an array."""
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(batch.num_rows, width)


def _arrays(batch: pa.RecordBatch, dim: int, lead: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return _matrix(batch, "v", dim, np.int64), _matrix(batch, "head", lead, float), batch.column("rest").to_numpy(zero_copy_only=False)


def _round(stored: DataFrame, centroids: np.ndarray, frame: Frame) -> np.ndarray:
    """Centroids after one round: floors of the exact means of what is assigned to them; empty ones stay."""
    k, dim = centroids.shape
    lead = frame.axes.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        counts, sums = np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
        for batch in batches:
            v, head, rest = _arrays(batch, dim, lead)
            cluster, _, _ = nearest(v, head, rest, centroids, frame)
            np.add.at(counts, cluster, 1)
            np.add.at(sums, cluster, v)
        used = np.flatnonzero(counts)
        yield {"c": used.tolist(), "n": counts[used].tolist(), "s": sums[used].tolist()}
    parts = map_batches(stored.select("v", "head", "rest"), "c int, n long, s array<long>", run)
    out = centroids.copy()
    exact = [F.sum(F.col("s")[j].cast("decimal(38,0)")) for j in range(dim)]
    for r in parts.groupBy("c").agg(F.sum("n").alias("n"), F.array(*exact).alias("s")).collect():   # k rows at most
        out[r["c"]] = [int(x) // r["n"] for x in r["s"]]
    return out


def cluster(vectors: DataFrame, k: int = 16, rounds: int = 3, dim: int = 64, scale: int = 64, lead: int = 16,
            id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Per kept vector: ``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256``.

    Lloyd's rounds from the first centroids, then a last assignment to the final ones. Vectors that are null, of another
    size, or with a null or non-finite component are left out, as the contract says; fewer than ``k`` kept vectors
    give fewer centroids, none an empty result. Null and repeated ids are assigned row by row; equal distances go to
    the smaller number. Components beyond ``MOST`` count as that. Extra columns are not read.

    The driver holds ``k`` centroids and the frame; a task holds ``k`` sums. No row is shuffled by its cluster.
    """
    kept = write_scratch(kept_vectors(vectors, dim, scale, id_col, vec_col), "vectors")
    centroids = first_centroids(kept, k)
    kind = vectors.select(id_col).schema[0].dataType.simpleString()
    if not len(centroids):
        return kept.select("vec_id", *[F.lit(None).cast(t).alias(n) for n, t in (
            ("cluster", "int"), ("distance", "long"), ("cluster_inertia", "long"), ("inertia", "long"), ("centroid_sha256", "string"))])
    frame = fit_frame(kept, dim, lead)

    def rotate(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            head, rest = frame.place(_matrix(batch, "v", dim, float))
            yield {"vec_id": batch.column("vec_id"), "v": batch.column("v"), "head": list(head), "rest": rest}
    stored = write_scratch(map_batches(kept, f"vec_id {kind}, v array<int>, head array<double>, rest double", rotate), "rotated")
    for _ in range(rounds):
        centroids = _round(stored, centroids, frame)

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            c, d, _ = nearest(*_arrays(batch, dim, lead), centroids, frame)
            yield {"vec_id": batch.column("vec_id"), "cluster": c.astype(np.int32), "distance": d}
    assigned = write_scratch(map_batches(stored, f"vec_id {kind}, cluster int, distance long", last), "assigned")
    total = {r["cluster"]: r["d"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}   # k rows at most
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    of = F.col("cluster")
    inertia = F.create_map(*[F.lit(x) for c in total for x in (c, total[c])])
    sha = F.create_map(*[F.lit(x) for c in total for x in (c, digests[c])])
    return assigned.select("vec_id", "cluster", "distance", inertia[of].cast("long").alias("cluster_inertia"),
                           F.lit(sum(total.values())).cast("long").alias("inertia"), sha[of].alias("centroid_sha256"))


by_value(__name__)
