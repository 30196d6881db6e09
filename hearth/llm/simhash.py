"""SimHash near-duplicates by covering locality-sensitive hashing.

A text's fingerprint holds, for each of 64 bits, whether more than half of its
shingle hashes set it. Texts link when their fingerprints differ in at most
``radius`` bits. Candidates come from a covering family of bit masks: each bit
position gets a nonzero vector of ``radius + 1`` bits, and table ``v`` keeps the
positions whose vector has an odd product with ``v``. At most ``radius``
differing positions span a space of at most ``radius`` dimensions, so some
nonzero ``v`` is orthogonal to all of them: in that table the two masked
fingerprints are equal. No pair within the radius is missed, whatever the data.

Work is on distinct fingerprints: equal texts, however many, are one node. A
bucket of up to ``PAIR_BUCKET`` nodes is joined with itself; the nodes of larger
ones go through ``_hub_edges``, which is exact too and linear in their number.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_value, fresh, map_rows, write_scratch
from .components import connected_components

BITS = 64
#: Buckets of more distinct fingerprints than this are linked over hubs instead of pair by pair.
PAIR_BUCKET = 64


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def text_fingerprint(text: str | None, shingle: int) -> int:
    """Unsigned SimHash of one text; zero for a text without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()   # bytes: only A-Z and ASCII blanks count
    if not words:
        return 0
    if len(words) < shingle:
        parts = [b" ".join(words)]
    else:
        parts = [b" ".join(x) for x in zip(*(words[i:] for i in range(shingle)), strict=False)]
    ones, digest = np.zeros(BITS, np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(parts), 1 << 16):
        h = np.array([digest(p, 42) for p in parts[at:at + (1 << 16)]], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(parts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                 row_key: bool = False) -> DataFrame:
    """``(doc_id, fp)`` for every row, fp as a signed long; null and empty texts get zero. ``row_key`` adds ``(digest, row)``."""
    def run(parts: Iterator[dict]) -> Iterator[dict]:
        for p in parts:
            text, p["doc_id"] = p.pop("text"), p.pop("id")
            yield p | {"fp": [_signed(text_fingerprint(t, shingle)) for t in text]}
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    extra = [c.alias(n) for c, n in zip(_row_key(docs, text_col), ("digest", "row"), strict=True)] if row_key else []
    return map_rows(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *extra),
                    f"doc_id {kind}, fp long" + ", digest string, row long" * row_key, run)


def _row_key(docs: DataFrame, text_col: str) -> tuple[Column, Column]:
    """Digest of the text (empty for null) and hash of the row (maps can't be hashed): with the id, what a row is known by."""
    return F.coalesce(F.md5(F.col(text_col)), F.lit("")), F.xxhash64(*[F.col(f"`{c}`") for c, t in docs.dtypes if "map<" not in t])


def covering_masks(radius: int) -> list[int]:
    """The 2^(radius+1) - 1 masks; bit positions take the nonzero vectors in turn."""
    vectors = (1 << (radius + 1)) - 1
    return [sum(1 << i for i in range(BITS) if ((i % vectors + 1) & v).bit_count() & 1) for v in range(1, vectors + 1)]


def _flips(most: int) -> list[int]:
    return [_signed(sum(1 << i for i in c)) for n in range(most + 1) for c in combinations(range(BITS), n)]


def _hub_edges(nodes: DataFrame, radius: int) -> DataFrame:
    """All links among ``nodes(fp)``, each set of mutually linked nodes as a star.

    Two fingerprints within ``radius`` bits meet at a hub value that is within ``near`` bits of one and
    ``far`` of the other (near + far = radius). Whoever is near a hub links truly with whoever is far from
    it, so once one near node is there, all of the hub's nodes are connected: an edge from each to the least.
    """
    near, far = radius // 2, radius - radius // 2

    def spread(most: int) -> DataFrame:
        flips = F.array(*[F.lit(x).cast("long") for x in _flips(most)])
        return nodes.select("fp", F.explode(F.transform(flips, lambda m: F.col("fp").bitwiseXOR(m))).alias("hub"))
    close = spread(near)
    centre = close.groupBy("hub").agg(F.min("fp").alias("c"))
    wide = spread(far).join(centre, "hub")
    return wide.select(F.col("fp").alias("a"), F.col("c").alias("b")).unionByName(
        close.join(centre, "hub").select(F.col("fp").alias("a"), F.col("c").alias("b"))).where("a <> b").distinct()


def fingerprint_links(nodes: DataFrame, radius: int = 3) -> DataFrame:
    """``(a, b)`` edges that connect the distinct ``nodes(fp)`` exactly as all pairs within ``radius`` would."""
    masks = F.array(*[F.struct(F.lit(i).cast("short").alias("t"), F.lit(_signed(m)).cast("long").alias("m"))
                      for i, m in enumerate(covering_masks(radius))])
    keyed = (nodes.select("fp", F.explode(masks).alias("x"))
             .select(F.col("x.t").alias("t"), F.col("fp").bitwiseAND(F.col("x.m")).alias("k"), "fp"))
    sizes = keyed.groupBy("t", "k").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = write_scratch(keyed.join(sizes, ["t", "k"]), "buckets")
    few = shared.where(F.col("n") <= PAIR_BUCKET)
    left, right = few.select("t", "k", F.col("fp").alias("a")), few.select("t", "k", F.col("fp").alias("b"))
    pairs = (left.join(right, ["t", "k"])
             .where((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius))
             .select("a", "b").distinct())
    many = shared.where(F.col("n") > PAIR_BUCKET).select("fp").distinct()
    return pairs.unionByName(_hub_edges(many, radius))


def _placed(nodes: DataFrame, radius: int) -> DataFrame:
    """``nodes`` with the ``root`` fingerprint of their component."""
    roots = connected_components(fingerprint_links(nodes.select("fp"), radius)).withColumnRenamed("node", "fp")
    return nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    radius: int = 3) -> DataFrame:
    """One row per row of ``docs``: ``(doc_id, fp, component_id)``; component_id is the least id reachable.

    Links join fingerprints within ``radius`` bits; components are their transitive closure. Null texts
    count as empty, and all texts without words share fingerprint zero. Rows with a null id keep their
    fingerprint and component (the least non-null id, or null if there is none); repeated rows are each
    returned. Extra columns are not read. An empty table gives an empty result.
    """
    prints = write_scratch(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    nodes = write_scratch(prints.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "nodes")
    placed = _placed(nodes, radius)
    least = placed.groupBy("root").agg(F.min("least_id").alias("component_id"))
    return prints.join(placed.select("fp", "root").join(least, "root").drop("root"), "fp").select(
        "doc_id", "fp", "component_id")


def fingerprint_text(fp) -> F.Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                radius: int = 3) -> DataFrame:
    """``docs`` with one row of each fingerprint component: that of the least id, then text digest, then row hash.

    A row without an id stays only where its whole component has none. An id with texts in several components
    stays once in each of which it is the least; rows equal in all columns count once. Rows are chosen by
    fingerprint and component with sums added up by task; only the chosen keys meet the texts again.
    """
    prints = write_scratch(fingerprints(docs, id_col, text_col, shingle, row_key=True), "fingerprints")
    key = ("doc_id", "digest", "row")
    nodes = write_scratch(prints.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), *key)).alias("least")), "nodes")
    chosen = _placed(nodes, radius).groupBy("root").agg(F.min("least").alias("k")).select(*[F.col(f"k.{c}").alias(c) for c in key])
    repeated = prints.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*[F.col(c).alias(f"r_{c}") for c in key])
    keep = write_scratch(chosen.join(repeated, (F.col("doc_id").eqNullSafe(F.col("r_doc_id"))) & (F.col("digest") == F.col("r_digest"))
                                     & (F.col("row") == F.col("r_row")), "left")
                         .select(*key, F.col("r_row").isNotNull().alias("again")), "kept-keys")
    digest, row = fresh(docs, "_keep_digest"), fresh(docs, "_keep_row")
    text_digest, row_hash = _row_key(docs, text_col)
    keyed = docs.withColumns({digest: text_digest, row: row_hash})
    names = [fresh(docs, f"_kept_{c}") for c in key]

    def rows(again: bool) -> DataFrame:
        known = keep.where(F.col("again") == again).select(*[F.col(c).alias(n) for c, n in zip(key, names, strict=True)])
        return keyed.join(known, F.col(id_col).eqNullSafe(F.col(names[0])) & (F.col(digest) == F.col(names[1]))
                          & (F.col(row) == F.col(names[2])), "left_semi")
    return rows(False).unionByName(rows(True).dropDuplicates([id_col, digest, row])).drop(digest, row)


by_value(__name__)
