"""Randomised checks of the exact operators against plain Python (hypothesis, few examples each)."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tabsift.operators import clean as C
from tabsift.operators import profile as P

NAN, INF = float("nan"), float("inf")
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

doubles = st.one_of(
    st.none(), st.just(NAN), st.just(INF), st.just(-INF), st.sampled_from([0.0, -0.0, 1.5, 7.0]),
    st.floats(min_value=-1e6, max_value=1e6, allow_nan=False),
)
ints = st.one_of(st.none(), st.integers(min_value=-50, max_value=50))


def _lower_median(vals):
    vals = sorted(vals)
    return vals[math.ceil(len(vals) / 2) - 1] if vals else None


@SETTINGS
@given(st.lists(st.tuples(doubles, ints), min_size=0, max_size=60), st.sampled_from([3, 1_000_000]))
def test_exact_median_matches_sort(spark, rows, limit):
    df = spark.createDataFrame(rows, "x double, k int")
    got = C.medians(df, ["x", "k"], exact=True, pick_limit=limit)
    xs = [x for x, _ in rows if x is not None and not math.isnan(x)]
    ks = [k for _, k in rows if k is not None]
    want_x, want_k = _lower_median(xs), _lower_median(ks)
    assert got["k"] == want_k
    assert (got["x"] is None and want_x is None) or got["x"] == want_x


@SETTINGS
@given(st.lists(st.tuples(doubles, st.one_of(st.none(), st.sampled_from(["-", "nan", "null", "NULL", "a", ""]))),
                min_size=0, max_size=40))
def test_profile_counts_match_python(spark, rows):
    df = spark.createDataFrame(rows, "x double, s string")
    got = {r["column"]: r for r in P.profile_columns(df).collect()}
    xs = [x for x, _ in rows]
    ss = [s for _, s in rows]
    assert got["x"]["n_null"] == sum(x is None for x in xs)
    assert got["x"]["n_nan"] == sum(x is not None and math.isnan(x) for x in xs)
    assert got["x"]["n_inf"] == sum(x is not None and math.isinf(x) for x in xs)
    assert got["s"]["n_null"] == sum(s is None for s in ss)
    assert got["s"]["n_sentinel"] == sum(s in ("-", "nan", "null") for s in ss)


@SETTINGS
@given(st.lists(doubles, min_size=0, max_size=30))
def test_constant_matches_definition(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = P.constant_columns(df).first()["is_constant"]
    present = [x for x in xs if x is not None]
    if len(present) <= 1:
        want = True
    else:
        want = all(math.isfinite(x) for x in present) and len(set(present)) == 1
    assert got == want
