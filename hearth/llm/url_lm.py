"""URL filter: rules first, then a ratio of character language models.

Two smoothed variable-order Markov models, of accepted and of rejected URLs, give
each character a probability from the longest context seen, interpolated down to
order 0 and a uniform floor (Witten-Bell). A URL's score is the mean over its
characters of log P(accepted) - log P(rejected); the threshold is the one with
the least balanced error on rule-judged URLs kept out of the counts.

All of it is DataFrame work. Counts are shuffled as sums by five-character gram;
each distinct gram of the URLs to be judged is resolved once, and only then are
the grams' ratios added up by URL.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import write_scratch

#: (verdict, host, path) of the contract.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))
#: Characters of context at most.
ORDER = 4
#: The models' symbols: these, one for any other character, and the end.
KNOWN = "abcdefghijklmnopqrstuvwxyz0123456789./_-"
SYMBOLS = len(KNOWN) + 2
#: URLs whose digest begins with a lower hex digit than this are kept out of the counts (a quarter).
HELD_BELOW = "4"
BINS, SPAN = 400, 4.0

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(name, verdict) of the longest rule that fits, or nulls."""
    name = verdict = F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, v).otherwise(verdict)
    return name, verdict


def _symbols(url: Column) -> Column:
    """What the models read: all of a URL after its scheme, query and fragment too; without ``://`` all of it."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.coalesce(url, F.lit("")))
    return F.regexp_replace(F.translate(rest, _UPPER, _LOWER), r"[^a-z0-9./_\-]", "*")


def _grams(urls: DataFrame, *keep: str) -> DataFrame:
    """A row for each symbol of ``s`` and its end, with the ``ORDER`` symbols before it: ``g``.

    All places are met in one walk over the URL (a substring by place would count from its beginning each time).
    """
    padded = F.concat(F.lit("^" * ORDER), F.col("s"), F.lit("$"))
    return urls.select(*keep, F.explode(F.regexp_extract_all(padded, F.lit(f"(?=(.{{{ORDER + 1}}}))"), F.lit(1))).alias("g"))


def _contexts(counted: DataFrame) -> DataFrame:
    """``(ctx, next)``: for every context of 0 to ``ORDER`` symbols, its next symbols with both models' counts (at most ``SYMBOLS``)."""
    longest = F.substring("g", 1, ORDER)
    each = counted.select(
        F.substring("g", -1, 1).alias("c"), "a", "r",
        F.explode(F.transform(F.sequence(F.lit(0), F.lit(ORDER)), lambda k: F.substring(longest, F.lit(ORDER + 1) - k, k))).alias("ctx"))
    sums = each.groupBy("ctx", "c").agg(F.sum("a").alias("a"), F.sum("r").alias("r"))
    return sums.groupBy("ctx").agg(F.collect_list(F.struct("c", "a", "r")).alias("next"))


def _probability(steps: Column, field: str) -> Column:
    """Interpolate ``steps`` from order 0 up: (n + t * lower) / (all + t); an unseen context changes nothing."""
    def step(lower: Column, x: Column) -> Column:
        every = F.aggregate(x["next"], F.lit(0).cast("long"), lambda s, y: s + y[field])
        kinds = F.size(F.filter(x["next"], lambda y: y[field] > 0))
        own = F.aggregate(F.filter(x["next"], lambda y: y["c"] == x["c"]), F.lit(0).cast("long"), lambda s, y: s + y[field])
        return F.when(every > 0, (own + kinds * lower) / (every + kinds)).otherwise(lower)
    return F.aggregate(steps, F.lit(1.0 / SYMBOLS), step)


def _ratios(grams: DataFrame, contexts: DataFrame) -> DataFrame:
    """``(g, ratio)`` of distinct grams: log of the accepted model's probability over the rejected one's."""
    longest = F.substring("g", 1, ORDER)
    steps = grams.select("g", F.explode(F.sequence(F.lit(0), F.lit(ORDER))).alias("k")).select(
        "g", "k", F.substring(longest, F.lit(ORDER + 1) - F.col("k"), F.col("k")).alias("ctx"))
    met = steps.join(contexts, "ctx").groupBy("g").agg(F.sort_array(F.collect_list(
        F.struct("k", "next", F.substring("g", -1, 1).alias("c")))).alias("steps"))
    return met.select("g", (F.log(_probability(F.col("steps"), "a")) - F.log(_probability(F.col("steps"), "r"))).alias("ratio"))


def _threshold(scored: DataFrame) -> float:
    """Middle of the score cells with the least balanced error; 0 without URLs of both verdicts."""
    cell = F.least(F.lit(BINS - 1), F.greatest(F.lit(0), F.floor((F.col("score") + SPAN) * (BINS / (2 * SPAN)))))
    cells = scored.groupBy(cell.alias("x")).agg(
        F.sum(F.when(F.col("judged") == "allow", 1).otherwise(0)).alias("a"),
        F.sum(F.when(F.col("judged") == "block", 1).otherwise(0)).alias("r"))   # BINS rows at most
    upto, every = Window.orderBy("x").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(F.lit(0))
    wrong = (F.try_divide(F.coalesce(F.sum("a").over(upto), F.lit(0)), F.sum("a").over(every))
             + 1 - F.try_divide(F.coalesce(F.sum("r").over(upto), F.lit(0)), F.sum("r").over(every)))
    low = F.lag("x").over(Window.orderBy("x"))
    best = cells.select("x", low.alias("low"), wrong.alias("wrong")).where("wrong is not null").orderBy("wrong", "x").first()
    if best is None:
        return 0.0
    edge = best["x"] if best["low"] is None else (best["x"] + best["low"] + 1) / 2
    return edge * (2 * SPAN / BINS) - SPAN


def judge(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Per row: ``page_id, host, path, rule, verdict, score``; score is null where a rule decides.

    The models read all of a URL after its scheme. A null URL or one without ``://`` has empty host and path, and is
    scored by its own characters (null: none). The work grows in proportion to the URLs' length. Without
    rule-judged URLs every score is 0 and allowed. Repeated rows are each returned; extra columns are not
    read; an empty table gives an empty result.
    """
    host, path = host_and_path(F.col(url_col))
    parsed = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"), _symbols(F.col(url_col)).alias("s"))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    parsed = write_scratch(parsed.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("judged"),
                                         F.col("s")), "urls")
    digest = F.md5(F.encode("s", "UTF-8"))   # stands for the URL in the rows of its symbols
    urls = write_scratch(parsed.groupBy("s").agg(
        F.sum(F.when(F.col("judged") == "allow", 1).otherwise(0)).alias("a"),
        F.sum(F.when(F.col("judged") == "block", 1).otherwise(0)).alias("r"),
        F.max(F.col("rule").isNull()).alias("open")).withColumn("d", digest).withColumn("held", F.substring("d", 1, 1) < HELD_BELOW), "distinct-urls")
    counted = _grams(urls.where(~F.col("held") & (F.col("a") + F.col("r") > 0)), "a", "r").groupBy("g").agg(
        F.sum("a").alias("a"), F.sum("r").alias("r"))
    contexts = write_scratch(_contexts(counted), "contexts")
    rated = urls.where(F.col("open") | (F.col("held") & (F.col("a") + F.col("r") > 0)))
    wanted = _grams(rated, "d")
    ratios = write_scratch(_ratios(wanted.select("g").distinct(), contexts), "ratios")
    scores = write_scratch(
        wanted.join(ratios, "g").groupBy("d").agg(F.avg("ratio").alias("score")).join(rated.select("d", "s"), "d").drop("d"), "scores")
    held = scores.join(urls.where("held"), "s")
    cut = _threshold(reduce(DataFrame.unionByName, [
        held.where(f"{c} > 0").select("score", F.lit(v).alias("judged")) for c, v in (("a", "allow"), ("r", "block"))]))
    ruled = parsed.where("rule is not null").select("page_id", "host", "path", "rule", F.col("judged").alias("verdict"),
                                                    F.lit(None).cast("double").alias("score"))
    free = parsed.where("rule is null").join(scores, "s", "left").withColumn("score", F.coalesce("score", F.lit(0.0)))
    return ruled.unionByName(free.select("page_id", "host", "path", "rule", F.when(F.col("score") >= cut, "allow").otherwise("block")
                                         .alias("verdict"), "score"))
