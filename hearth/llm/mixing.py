"""Mixing sources to target weights: whole copies, then a Pareto order sample.

A source's target is its weight's share of all words, stopped at ``cap`` times
its own size, the excess going to the others by weight. A document is expected
``e`` times in the mix (the same for all documents of a source, or in proportion
to a weight column). ``floor(e)`` copies are certain; the rest, ``e - floor(e)``,
is its inclusion probability in a sample of fixed size: documents are ranked by
random odds over inclusion odds (Pareto order sampling) and taken in that order
while the source's target holds them; a last document, the one whose size fits
best, closes the gap.

The random number of a document is a digest of its id, text and source, and of its turn
among rows that are equal in these, so reruns agree and equal rows, however many, are
drawn one by one. Ranks are
never laid out in one task: cell sums of the ranking variable give the cell in
which the cut falls, that cell's finer cells the finer one, and only its few
documents are put in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, fresh, write_scratch

CELLS = 4096
_SEED = "mix-1"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def random_number(doc_id: Column, seed: str = _SEED) -> Column:
    """Uniform on (0, 1), from the first 13 hex digits of a digest of the id (null counts as empty)."""
    digits = F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("")))), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def same_rows(doc_id: Column, text: Column, source: Column) -> Column:
    """Digest of what rows must share to count as equal (null as empty)."""
    part = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    return F.md5(F.concat(part(doc_id), F.lit("|"), F.md5(part(text)), F.lit("|"), part(source)))


def with_turns(sized: DataFrame) -> DataFrame:
    """``sized`` (a written table with ``same``) with ``u`` of each row's turn, 1, 2, ... among rows of one ``same``.

    A turn is the row's number among the equal rows of its partition, after those of the partitions before it: so a
    value that a third of all rows share is numbered by as many tasks as hold it.
    """
    rows = sized.withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()})
    rows = rows.withColumn("rn", F.row_number().over(Window.partitionBy("same", "part").orderBy("at")))
    many = rows.groupBy("same", "part").agg(F.max("rn").alias("n")).withColumn(
        "before", F.coalesce(F.sum("n").over(Window.partitionBy("same").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    later = write_scratch(many.where("before > 0").select(F.col("same").alias("same_r"), F.col("part").alias("part_r"), "before"), "turns")
    turn = F.col("rn") + F.coalesce("before", F.lit(0))
    numbered = rows.join(later, (F.col("same") == F.col("same_r")) & (F.col("part") == F.col("part_r")), "left")
    return numbered.withColumn("u", random_number(F.concat("same", F.lit(":"), turn.cast("string")))).drop(
        "part", "at", "rn", "same", "same_r", "part_r", "before")


def targets(sizes: DataFrame, weights: tuple[float, ...], cap: float) -> DataFrame:
    """``(source, source_size)``, a row for each source -> the same with ``target``.

    With sources in the order in which they reach their cap, ``level`` is the share per unit of weight if
    all before a source are capped and it is not; the highest consistent level is the answer.
    """
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          ((F.row_number().over(in_order) - 1) % len(weights) + 1).cast("int"))
    first_full = Window.orderBy(F.col("full_at"), F.col("source").asc_nulls_last())
    before = first_full.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(0))
    level = ((F.sum("source_size").over(every) - F.coalesce(F.sum(F.col("source_size") * F.lit(float(cap))).over(before), F.lit(0.0)))
             / (F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0))))
    return (sizes.withColumn("w", weight)
            .withColumn("full_at", F.col("source_size") * F.lit(float(cap)) / F.col("w"))
            .withColumn("level", level)
            .withColumn("level", F.max(F.when(F.col("level") <= F.col("full_at"), F.col("level"))).over(every))
            .select("source", "source_size",
                    F.least(F.col("source_size") * F.lit(float(cap)), F.col("level") * F.col("w")).alias("target")))


def _on_source(left: DataFrame, right: DataFrame) -> DataFrame:
    right = right.withColumnRenamed("source", "source_r")
    return left.join(right, F.col("source").eqNullSafe(F.col("source_r")), "left").drop("source_r")


def _scale(docs: DataFrame, sources: DataFrame, cap: float) -> DataFrame:
    """Add ``rate``: a document's expected copies are ``least(cap, rate * weight)``, and the words add up to the target.

    With all weights 1 the first rate is right at once; else capped documents leave their excess to the rest
    until no rate moves (a round for each new set of capped documents, aggregated by source).
    """
    own = docs.groupBy("source").agg(F.sum(F.col("size") * F.col("weight")).alias("free"))
    sources = _on_source(sources, own).withColumn(
        "rate", F.when(F.col("free") > 0, F.col("target") / F.col("free")).otherwise(0.0)).drop("free")
    while True:
        sources = write_scratch(sources, "rates")
        if not sources.where(F.col("rate") * F.lit(1.0) > 0).limit(1).count():
            return sources
        full = F.col("rate") * F.col("weight") >= cap
        sums = _on_source(docs, sources.select("source", "rate")).groupBy("source").agg(
            F.sum(F.when(full, F.col("size")).otherwise(0)).alias("full"),
            F.sum(F.when(~full, F.col("size") * F.col("weight")).otherwise(0.0)).alias("free"))
        after = _on_source(sources, sums).withColumn(
            "next", F.when(F.col("free") > 0, F.greatest("rate", (F.col("target") - F.lit(float(cap)) * F.col("full")) / F.col("free")))
            .otherwise(F.col("rate"))).drop("full", "free")
        after = write_scratch(after, "rates")
        if not after.where(F.col("next") > F.col("rate") * (1 + 1e-12)).limit(1).count():
            return sources
        sources = after.drop("rate").withColumnRenamed("next", "rate")


def _ranked(docs: DataFrame, cap: float) -> DataFrame:
    """Add certain copies and the ranking variable: odds ratio q as p = q / (1 + q), with its two cells."""
    expected = F.least(F.lit(float(cap)), F.col("rate") * F.col("weight"))
    lam, u = F.col("lam"), F.col("u")
    odds = u / (1 - u) / (lam / (1 - lam))
    return (docs.withColumn("certain", F.floor(expected).cast("long"))
            .withColumn("lam", expected - F.floor(expected))
            .withColumn("p", F.when(lam > 0, F.least(odds / (1 + odds), F.lit(1 - 1e-15))))
            .withColumn("c1", F.floor(F.col("p") * CELLS))
            .withColumn("c2", F.floor((F.col("p") * CELLS - F.col("c1")) * CELLS)))


def _cut(cells: DataFrame, cell: str) -> DataFrame:
    """Of each source's ``(source, rest, cell, size)``: the last cell that begins within ``rest`` words, and what is left there."""
    before = Window.partitionBy("source").orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    return (cells.withColumn("before", F.coalesce(F.sum("size").over(before), F.lit(0)))
            .where(F.col("before") <= F.col("rest"))
            .groupBy("source").agg(F.max(F.struct(cell, (F.col("rest") - F.col("before")).alias("rest"))).alias("x"))
            .select("source", F.col(f"x.{cell}").alias(cell + "_cut"), F.col("x.rest").alias("rest")))


def cuts(sized: DataFrame, weights: tuple[float, ...] = (1, 2, 3), cap: float = 3) -> DataFrame:
    """Of ``sized(source, size, weight, u)``: a row for each source with its target, rate and where its sample ends."""
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = _scale(sized, targets(sums, weights, cap), cap)
    ranked = _ranked(_on_source(sized, sources.select("source", "target", "rate")), cap)
    rest = ranked.groupBy("source").agg(
        (F.first("target") - F.sum(F.col("certain") * F.col("size"))).alias("rest"))
    drawn = ranked.where("p is not null")
    one = write_scratch(_cut(_on_source(
        drawn.groupBy("source", "c1").agg(F.sum("size").alias("size")), rest), "c1"), "cuts")
    two = write_scratch(_cut(_on_source(drawn, one).where("c1 = c1_cut")
                             .groupBy("source", "rest", "c2").agg(F.sum("size").alias("size")), "c2"), "cuts")
    inner = (_on_source(_on_source(drawn, one.drop("rest")), two).where("c1 = c1_cut and c2 = c2_cut")
             .groupBy("source", "rest", "p").agg(F.sum("size").alias("size")))
    before = Window.partitionBy("source").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    last = (inner.withColumn("upto", F.sum("size").over(Window.partitionBy("source").orderBy("p")))
            .where(F.col("upto") <= F.col("rest"))
            .groupBy("source").agg(F.max(F.struct("p", "upto")).alias("x")).select("source", "x.p", "x.upto")
            .withColumnRenamed("p", "p_cut"))
    cut = write_scratch(_on_source(_on_source(_on_source(sources, one.drop("rest")), two), last).withColumn(
        "gap", F.col("rest") - F.coalesce("upto", F.lit(0))).drop("rest", "upto"), "cuts")
    miss = F.abs(F.col("size") - F.col("gap"))
    close = (_ranked(_on_source(sized, cut), cap).where(F.col("p").isNotNull() & ~_within_cut() & (miss < F.col("gap")))
             .groupBy("source").agg(F.min(F.struct(miss.alias("miss"), F.col("p"))).alias("x")).select("source", F.col("x.p").alias("p_last")))
    return write_scratch(_on_source(cut.drop("gap"), close), "cuts")


def _within_cut() -> Column:
    """Whether a ranked row comes before its source's cut; false where the source has none."""
    at, end = F.struct("c1", "c2", "p"), F.struct(F.col("c1_cut"), F.col("c2_cut"), F.coalesce("p_cut", F.lit(-1.0)))
    return F.coalesce(F.col("p").isNotNull() & F.col("c1_cut").isNotNull() & F.col("c2_cut").isNotNull() & (at <= end), F.lit(False))


def allocate(sized: DataFrame, cut: DataFrame, cap: float = 3) -> DataFrame:
    """``sized`` with ``source_size, target, copies, taken``: the certain copies, and one more within the source's sample."""
    extra = F.when(_within_cut() | F.coalesce(F.col("p") == F.col("p_last"), F.lit(False)), 1).otherwise(0)
    ranked = _ranked(_on_source(sized, cut), cap).withColumn("copies", F.col("certain") + extra)
    return ranked.withColumn("taken", F.col("copies") * F.col("size")).drop(
        "rate", "certain", "lam", "p", "c1", "c2", "c1_cut", "c2_cut", "p_cut", "p_last")


def sized_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    weight: Column | None = None) -> DataFrame:
    """``(doc_id, source, size, weight, same)`` of every row; weights must be positive, null or less counts as 0."""
    w = F.lit(1.0) if weight is None else F.greatest(F.coalesce(weight.cast("double"), F.lit(0.0)), F.lit(0.0))
    return docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                       word_count(F.col(text_col)).alias("size"), w.alias("weight"),
                       same_rows(F.col(id_col), F.col(text_col), F.col(source_col)).alias("same"))


def mix_plan(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), cap: float = 3, **columns) -> DataFrame:
    """Per row of ``docs``: ``doc_id, source, size, source_size, target, copies, taken``.

    A null text has size 0; a null source is a source of its own, last in order; a source without words has
    target 0. Rows of a repeated or null id are drawn one by one, also where they are equal. Extra columns are not
    read. An empty table gives an empty result.
    """
    sized = write_scratch(with_turns(write_scratch(sized_documents(docs, **columns), "rows")), "sized")
    return allocate(sized, cuts(sized, weights, cap), cap).drop("weight", "u")


def mix(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), cap: float = 3, id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``docs`` as the mix holds them: each row as often as it is taken, with its own columns.

    Only the table of sources is joined to the texts; no text is shuffled unless a source must be split. Rows equal in
    id, text and source share their random number here, so that they are taken or left together: where there may be
    many of them, near duplicates should go first.
    """
    first = lambda same: random_number(F.concat(same, F.lit(":1")))
    cut = cuts(write_scratch(sized_documents(docs, id_col, text_col, source_col).withColumn("u", first(F.col("same"))).drop("same"), "sized"),
               weights, cap)
    whole = fresh(docs, "_row")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(whole))
    sized = rows.select(whole, F.col(f"{whole}.`{source_col}`").alias("source"),
                        word_count(F.col(f"{whole}.`{text_col}`")).alias("size"), F.lit(1.0).alias("weight"),
                        first(same_rows(*[F.col(f"{whole}.`{c}`") for c in (id_col, text_col, source_col)])).alias("u"))
    copies = allocate(sized, cut, cap).select(whole, F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))))
    return copies.select(f"{whole}.*")
