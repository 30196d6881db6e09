"""Agglomerative tiers by Ward's criterion over a bounded table of cluster features.

Rows are summed by Spark into leaves: a leaf is a cell of a grid, kept as its count
and sums. The grid is as fine as keeps the leaves within ``MAX_LEAVES``; while the
distinct rows fit, every distinct row is a leaf, and the merges are exactly Ward's.
The leaves, not the rows, are merged on the driver, by chains of nearest
neighbours; rows get their tier through their cell.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Leaves that the driver merges at most (its matrix of distances has this many rows).
MAX_LEAVES = 2000


def _cell(cols: list[str], width: float) -> Column:
    """The cell of a row: its values, or, for a grid of some width, their floors."""
    return F.array(*[F.col(c).cast("double") + F.lit(0.0) if not width else F.floor(F.col(c) / F.lit(width)).cast("double") for c in cols])


def leaves(df: DataFrame, cols: list[str], max_leaves: int = MAX_LEAVES) -> tuple[float, DataFrame]:
    """(grid width, 0 for none; ``(cell, n, sums)``), with at most ``max_leaves`` cells: the width doubles until they fit."""
    spread = max((x for x in df.agg(*[F.max(c) - F.min(c) for c in cols]).first() if x is not None), default=0.0)
    width = 0.0
    while True:
        cells = df.groupBy(_cell(cols, width).alias("cell")).agg(
            F.count(F.lit(1)).alias("n"), F.array(*[F.sum(F.col(c).cast("double")) for c in cols]).alias("sums"))
        if cells.limit(max_leaves + 1).count() <= max_leaves:
            return width, cells
        width = 2 * width if width else spread / max_leaves


def merges(n: np.ndarray, sums: np.ndarray) -> list[tuple[int, int, float, float]]:
    """Ward's merges of leaves with counts ``n``: (one, other, height, rows), in order of height.

    Leaves are numbered from 0, the cluster of the i-th merge is ``len(n) + i``. A chain goes from a cluster to its
    nearest neighbour until two are each other's; these merge, and the chain goes on from what is left of it. As a
    merge never brings a cluster nearer to others than its parts were, sorting by height gives the greedy order.
    """
    m = len(n)
    size, centre = n.astype(float).copy(), sums / np.maximum(n, 1)[:, None]
    live, chain, made = np.ones(m, bool), [], []
    name = np.arange(m)
    for step in range(m - 1):
        if not chain:
            chain = [int(np.flatnonzero(live)[0])]
        while True:
            a = chain[-1]
            gap = ((centre - centre[a]) ** 2).sum(1) * size * size[a] / (size + size[a])
            gap[~live] = np.inf
            gap[a] = np.inf
            b = int(gap.argmin())
            if len(chain) > 1 and gap[chain[-2]] <= gap[b]:
                b = chain[-2]
                break
            chain.append(b)
        chain = chain[:-2]
        made.append((int(name[a]), int(name[b]), float(np.sqrt(2 * gap[b])), size[a] + size[b]))
        centre[a] = (centre[a] * size[a] + centre[b] * size[b]) / (size[a] + size[b])
        size[a] += size[b]
        live[b], name[a] = False, m + step
    order = sorted(range(m - 1), key=lambda i: (made[i][2], i))
    place = {m + i: m + k for k, i in enumerate(order)}
    return [(*sorted(place.get(x, x) for x in made[i][:2]), *made[i][2:]) for i in order]


def cut(m: int, made: list[tuple], k: int) -> list[int]:
    """The cluster, 0 to k-1, of every leaf when the last k-1 merges are undone; numbered by their first leaf."""
    parent = list(range(m + len(made)))
    for i, (a, b, *_) in enumerate(made[:max(0, m - k)]):
        parent[a] = parent[b] = m + i

    def top(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x
    found: dict[int, int] = {}
    return [found.setdefault(top(x), len(found)) for x in range(m)]


def linkage(df: DataFrame, cols: list[str], max_leaves: int = MAX_LEAVES) -> tuple[float, list, list[tuple]]:
    """(grid width, leaves in order, merges) of the rows of ``df``; rows with a null among ``cols`` are left out."""
    width, cells = leaves(df.na.drop(subset=cols), cols, max_leaves)
    rows = sorted(cells.collect())   # max_leaves rows at most
    if not rows:
        return width, [], []
    return width, [r["cell"] for r in rows], merges(np.array([r["n"] for r in rows]), np.array([r["sums"] for r in rows], float))


def with_clusters(df: DataFrame, cols: list[str], k: int, out: str, found: tuple[float, list, list[tuple]]) -> DataFrame:
    """``df`` with the cluster of each row for ``k`` clusters, through its leaf; null for rows left out."""
    width, cells, made = found
    spark = df.sparkSession
    labels = spark.createDataFrame(list(zip(cells, cut(len(cells), made, k), strict=True)), f"_cell array<double>, {out} int")
    return df.join(F.broadcast(labels), _cell(cols, width) == F.col("_cell"), "left").drop("_cell")   # max_leaves rows at most
