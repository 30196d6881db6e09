"""Column jobs: pure ``Column -> Column`` builders.

Everything here is a native Catalyst expression, so it stays inside
whole-stage codegen and runs on the JVM (no Python workers). The rules
follow the reference's parsers and flags, with ANSI-safe casts
(``try_cast``/``try_to_date``) so malformed input yields NULL instead of
failing the job.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- strings

def strip_ws(c: ColumnOrName) -> Column:
    """Strip all leading/trailing whitespace (Python ``str.strip``), not only spaces."""
    return F.regexp_replace(_c(c), r"^\s+|\s+$", "")


def norm_key(c: ColumnOrName) -> Column:
    """Normalised join key: ``upper(trim(c))``."""
    return F.upper(F.trim(_c(c)))


def safe_int(c: ColumnOrName) -> Column:
    """Blank -> NULL, else trimmed int; '3.0' -> 3 (P2, traps 21/22)."""
    t = F.nullif(F.trim(_c(c)), F.lit(""))
    return t.try_cast("double").try_cast("int")


def to_double(c: ColumnOrName) -> Column:
    return _c(c).try_cast("double")


def parse_date(c: ColumnOrName, fmt: str = "yyyy-MM-dd") -> Column:
    return F.try_to_date(_c(c), fmt)


def contains_any(c: ColumnOrName, needles) -> Column:
    c = _c(c)
    return reduce(lambda a, b: a | b, [c.contains(n) for n in needles])


def _num(text: Column) -> Column:
    return F.regexp_replace(text, ",", "").try_cast("double")


# ---------------------------------------------------------------- flags

def tenure_in_scope(c: ColumnOrName) -> Column:
    """Multi-spelling, case-insensitive tenure filter (P5)."""
    return F.upper(_c(c)).isin(*fixed.SOCIAL_TENURES)


def below_c_flag(rating: ColumnOrName) -> Column:
    """Rating letter in D..G -> True, any other value (incl. NULL) -> False."""
    return F.when(_c(rating).isin(*fixed.BELOW_C_RATINGS), True).otherwise(False)


def fuel_category(fuel: ColumnOrName) -> Column:
    """Fuel label -> category; NULL stays NULL."""
    f = _c(fuel)
    return (
        F.when(f.isin(*fixed.GAS_INDIVIDUAL), "gas_individual")
        .when(f == fixed.GAS_COMMUNITY, "gas_community")
        .when(f.isin(*fixed.ELECTRIC_INDIVIDUAL), "electric_individual")
        .when(f == fixed.ELECTRIC_COMMUNITY, "electric_community")
        .when(f.isNotNull(), "other")
    )


def pre_1950_flag(band: ColumnOrName) -> Column:
    return _c(band).isin(*fixed.PRE_1950_BANDS)


def overcrowded_flag(bedrooms_vs_need: ColumnOrName) -> Column:
    """Negative bedroom surplus -> True, NULL -> False (C7, trap 8)."""
    return F.when(_c(bedrooms_vs_need) < 0, True).otherwise(False)


def age_group(band: ColumnOrName) -> Column:
    """12 age bands -> 6 groups, anything else -> Unknown (C11)."""
    m = F.create_map(*[F.lit(x) for kv in fixed.AGE_GROUPS.items() for x in kv])
    return F.coalesce(m[_c(band)], F.lit(fixed.UNKNOWN))


def age_group_order(group: ColumnOrName) -> Column:
    """Fixed display order of age groups; Unknown last."""
    m = F.create_map(*[F.lit(x) for i, g in enumerate(fixed.AGE_ORDER) for x in (g, i)])
    return F.coalesce(m[_c(group)], F.lit(len(fixed.AGE_ORDER)))


# ---------------------------------------------------------------- parsers

def band_midpoint(band: ColumnOrName) -> Column:
    """Band text -> numeric midpoint (C4).

    sentinel -> NULL; 'More than N' -> N; 'Less than N' -> N/2;
    'A to B' -> (A+B)/2; plain number (commas allowed) -> number; else NULL.
    """
    s = strip_ws(band)
    first_num = F.get(F.regexp_extract_all(s, F.lit(fixed.NUMBER_PATTERN), 0), 0)
    parts = F.split(s, " to ")
    return (
        F.when(_c(band).isNull() | s.isin(*fixed.BAND_SENTINELS), F.lit(None).cast("double"))
        .when(s.contains("More than") | s.contains("more than"), _num(first_num))
        .when(s.contains("Less than") | s.contains("less than"), _num(first_num) / 2)
        .when(s.contains(" to "),
              (_num(strip_ws(F.get(parts, 0))) + _num(strip_ws(F.get(parts, 1)))) / 2)
        .otherwise(_num(s))
    )


def cost_bounds(cost: ColumnOrName) -> Column:
    """Cost text -> struct(low, mid, high) parsed once (C5, traps 1-3).

    One number: low = mid = high. Two numbers: low, (low+high)/2, high.
    None: all NULL. Three or more: low = first, mid/high NULL.
    """
    nums = F.regexp_extract_all(F.coalesce(_c(cost), F.lit("")), F.lit(fixed.NUMBER_PATTERN), 0)
    n = F.size(nums)
    v0 = _num(F.get(nums, 0))
    v1 = _num(F.get(nums, 1))
    return F.struct(
        v0.alias("low"),
        F.when(n == 2, (v0 + v1) / 2).when(n == 1, v0).alias("mid"),
        F.when(n == 2, v1).when(n == 1, v0).alias("high"),
    )


def category(improvement: ColumnOrName) -> Column:
    """Ordered keyword cascade -> category; first match wins; NULL -> Other."""
    t = F.lower(_c(improvement))
    expr = None
    for label, words in fixed.CATEGORY_KEYWORDS:
        cond = contains_any(t, words)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return F.when(_c(improvement).isNull(), fixed.OTHER_CATEGORY).otherwise(
        expr.otherwise(fixed.OTHER_CATEGORY))


def work_tier(mid: ColumnOrName) -> Column:
    """Midpoint <= 1000 -> Quick win, else (incl. NULL) Major works (C14, trap 7)."""
    return F.when(_c(mid) <= fixed.QUICK_WIN_MAX, fixed.QUICK_WIN).otherwise(fixed.MAJOR_WORKS)


def guarded_pct(num: ColumnOrName, den: ColumnOrName) -> Column:
    """num/den*100 only when den > 0 and num is not NULL."""
    n, d = _c(num), _c(den)
    return F.when((d > 0) & n.isNotNull(), n / d * 100)


def pct(cond: Column, scale: int = 1) -> Column:
    """Rounded share of rows meeting ``cond`` in the current group, in percent."""
    return F.round(F.sum(F.when(cond, 1).otherwise(0)) / F.count(F.lit(1)) * 100, scale)


def money(c: ColumnOrName) -> Column:
    """Thousands-separated whole pounds, e.g. '£1,235'."""
    return F.concat(F.lit("£"), F.format_number(F.round(_c(c), 0), 0))


def money_range(mid: ColumnOrName, low: ColumnOrName, high: ColumnOrName) -> Column:
    """'£mid (£low–£high)', or '' when any part is NULL."""
    m, lo, hi = _c(mid), _c(low), _c(high)
    return F.when(m.isNull() | lo.isNull() | hi.isNull() | F.isnan(m) | F.isnan(lo) | F.isnan(hi),
                  F.lit("")).otherwise(
        F.concat(money(m), F.lit(" ("), money(lo), F.lit("–"), money(hi), F.lit(")")))


def region_name(code: ColumnOrName) -> Column:
    """Region code -> name, unknown codes -> 'Unknown' (C12). A literal map: no join needed."""
    m = F.create_map(*[F.lit(x) for kv in fixed.REGION_NAMES.items() for x in kv])
    return F.coalesce(m[_c(code)], F.lit(fixed.UNKNOWN))
