"""Randomised checks against plain-Python statements of the rules."""

from __future__ import annotations

import datetime as dt
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dqspark.functions.exprs import age_years
from dqspark.operators.core import duplicates

DATES = st.dates(min_value=dt.date(1850, 1, 1), max_value=dt.date(2100, 12, 31))


def pg_age_years(later: dt.date, earlier: dt.date) -> int:
    """Years field of PostgreSQL's age(later, earlier): field-wise
    difference on the ordered pair with day and month borrows, sign
    restored."""
    flip = later < earlier
    hi, lo = (earlier, later) if flip else (later, earlier)
    years, months, days = hi.year - lo.year, hi.month - lo.month, hi.day - lo.day
    if days < 0:
        months -= 1
    if months < 0:
        years -= 1
    return -years if flip else years


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(DATES, DATES), min_size=1, max_size=300))
def test_age_years_matches_postgres_rule(spark, pairs):
    df = spark.createDataFrame(pairs, "dob date, as_of date")
    got = [r["a"] for r in df.select(age_years(F.col("dob"), F.col("as_of")).alias("a")).collect()]
    assert got == [pg_age_years(a, d) for d, a in pairs]


KEYS = st.one_of(st.none(), st.sampled_from(["a", "b", "c"]))


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(KEYS, st.one_of(st.none(), st.integers(0, 2))), min_size=1, max_size=60), st.integers(1, 5))
def test_duplicates_match_brute_force(spark, rows, parts):
    data = [(k1, k2, f"id{i:03d}") for i, (k1, k2) in enumerate(rows)]
    df = spark.createDataFrame(data, "k1 string, k2 int, id string").repartition(parts)
    out = duplicates(df, ["k1", "k2"], "id").members().collect()
    got = defaultdict(dict)
    for r in out:
        got[(r["k1"], r["k2"])][r["member_no"]] = r["id"]
        assert r["first_id"] == min(i for k1, k2, i in data if (k1, k2) == (r["k1"], r["k2"]))
    want = defaultdict(list)
    for k1, k2, i in data:
        want[(k1, k2)].append(i)
    want = {k: dict(enumerate(sorted(v), 1)) for k, v in want.items() if len(v) > 1}
    assert got == want
    assert {(r["k1"], r["k2"]): r["duplicate_count"] for r in out} == {k: len(v) for k, v in want.items()}
