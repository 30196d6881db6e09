"""Table data-quality checks (Q1-Q7).

``check_table(df, name, rules)`` evaluates every rule of one table in a
single aggregate pass (distinct counts for uniqueness ride in the same
aggregate) and returns one row per rule:
``(table_name, rule, column_name, n_rows, n_violations, passed)``.
NULLs pass range rules, as in the usual not_null/unique/accepted_range tests.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    kind: str
    column: str
    violation: Column | None = None   # row-level violation predicate (None for unique/row_count)
    expected: int | None = None


def not_null(c: str) -> Rule:
    return Rule("not_null", c, F.col(c).isNull())


def unique(c: str) -> Rule:
    return Rule("unique", c)


def accepted_range(c: str, lo=None, hi=None) -> Rule:
    v = F.lit(False)
    if lo is not None:
        v = v | (F.col(c) < lo)
    if hi is not None:
        v = v | (F.col(c) > hi)
    return Rule("accepted_range", c, F.coalesce(v, F.lit(False)))


def row_count(expected: int) -> Rule:
    return Rule("row_count", "*", expected=expected)


def ordered(*cols: str) -> Rule:
    """low <= mid <= high (rows with NULLs pass)."""
    v = F.lit(False)
    for a, b in zip(cols, cols[1:]):
        v = v | (F.col(a) > F.col(b))
    return Rule("ordered", "<=".join(cols), F.coalesce(v, F.lit(False)))


def sums_to(cols: list[str], total: float, tol: float = 0.15) -> Rule:
    s = sum((F.coalesce(F.col(c), F.lit(0.0)) for c in cols[1:]), F.coalesce(F.col(cols[0]), F.lit(0.0)))
    return Rule("sums_to", "+".join(cols), F.abs(s - total) > tol)


def check_table(df: DataFrame, name: str, rules: list[Rule]) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for i, r in enumerate(rules):
        if r.kind == "unique":
            aggs.append((F.count(F.col(r.column)) - F.count_distinct(F.col(r.column))).alias(f"v{i}"))
        elif r.kind == "row_count":
            aggs.append(F.lit(0).alias(f"v{i}"))
        else:
            aggs.append(F.count_if(r.violation).alias(f"v{i}"))
    wide = df.agg(*aggs)
    rows = []
    for i, r in enumerate(rules):
        n_viol = F.col(f"v{i}").cast("long")
        if r.kind == "row_count":
            n_viol = F.abs(F.col("n_rows") - F.lit(r.expected)).cast("long")
        rows.append(F.struct(F.lit(r.kind).alias("rule"), F.lit(r.column).alias("column_name"),
                             n_viol.alias("n_violations")))
    return (wide.select("n_rows", F.explode(F.array(*rows)).alias("r"))
            .select(F.lit(name).alias("table_name"), "r.rule", "r.column_name", "n_rows", "r.n_violations",
                    (F.col("r.n_violations") == 0).alias("passed")))
