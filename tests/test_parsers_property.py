"""Property test: native band / cost parsing against a plain-Python statement of the rules."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st

from hearth.functions import columns as C
from hearth.functions import fixed

NUM = re.compile(r"[\d,]+")


def to_num(t):
    try:
        return float(t.replace(",", ""))
    except ValueError:
        return None


def band_rule(s):
    if s is None:
        return None
    s = s.strip()
    if s in fixed.BAND_SENTINELS:
        return None
    if "More than" in s or "more than" in s:
        m = NUM.findall(s)
        return to_num(m[0]) if m else None
    if "Less than" in s or "less than" in s:
        m = NUM.findall(s)
        v = to_num(m[0]) if m else None
        return None if v is None else v / 2
    if " to " in s:
        parts = s.split(" to ")
        a, b = to_num(parts[0].strip()), to_num(parts[1].strip())
        return None if a is None or b is None else (a + b) / 2
    return to_num(s)


def cost_rule(s):
    nums = [to_num(n) for n in NUM.findall(s or "")]
    low = nums[0] if nums else None
    if len(nums) == 2:
        mid = None if None in nums else (nums[0] + nums[1]) / 2
        return low, mid, nums[1]
    if len(nums) == 1:
        return low, low, low
    return low, None, None


number = st.integers(0, 20000).map(lambda n: f"{n:,}" if n % 3 == 0 else str(n))
band = st.one_of(
    st.none(), st.sampled_from(list(fixed.BAND_SENTINELS) + [" Missing ", "\tR", "x", ",", "1,,0"]),
    st.builds(lambda a, b: f"{a} to {b}", number, number),
    st.builds(lambda a: f"More than {a}", number), st.builds(lambda a: f"Less than {a}", number),
    st.builds(lambda a: f" {a} ", number), st.builds(lambda a, b: f"£{a} to £{b}", number, number),
)
cost = st.one_of(
    st.none(), st.builds(lambda a: f"£{a}", number), st.builds(lambda a, b: f"£{a} - £{b}", number, number),
    st.builds(lambda a, b, c: f"£{a} - £{b} (£{c})", number, number, number), st.just("£1,2.5"), st.just("none"),
)


@settings(max_examples=3, deadline=None)
@given(st.lists(st.tuples(band, cost), min_size=100, max_size=200))
def test_parsers_match_rules(spark, rows):
    df = spark.createDataFrame(rows, "b string, c string")
    out = df.select("b", "c", C.band_midpoint("b").alias("m"), C.cost_bounds("c").alias("k")).collect()
    for r in out:
        assert r["m"] == band_rule(r["b"]), r["b"]
        assert (r["k"]["low"], r["k"]["mid"], r["k"]["high"]) == cost_rule(r["c"]), r["c"]
