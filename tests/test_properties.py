"""Random small frames with NULLs against plain Python."""

from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quartermill.functions import semantics as s
from quartermill.operators import aggregates, joins, reshape, windows

FEW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
letter = st.sampled_from([None, "a", "b", "c"])
small = st.integers(0, 3)
value = st.sampled_from([None, 0.0, 1.0, 2.5])


def as_multiset(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((v is None, str(v)) for v in r))


@FEW
@given(st.lists(letter, min_size=1, max_size=20), st.lists(letter, max_size=4))
def test_membership(spark, data, listed):
    df = spark.createDataFrame([(x,) for x in data], "x string")
    assert as_multiset(df.filter(s.in_set("x", listed)).collect()) == as_multiset([(x,) for x in data if x in listed])
    assert as_multiset(df.filter(s.not_in("x", listed)).collect()) == as_multiset([(x,) for x in data if x not in listed])


@FEW
@given(st.lists(st.tuples(letter, small, value), min_size=1, max_size=25))
def test_grid_and_lag(spark, data):
    df = spark.createDataFrame(data, "t string, p int, v double")
    summed = aggregates.sum_by(df, ["t", "p"], ["v"])
    got = windows.lag_periods(reshape.complete_grid(summed, "p", ["t"], {"v": 0.0}), "v", ["t"], "p", [1])
    totals = defaultdict(float)
    for t, p, v in data:
        totals[t, p] += v or 0.0
    periods = sorted({p for _, p, _ in data})
    want = []
    for t in {t for t, _, _ in data}:
        before = None
        for p in periods:
            want.append((t, p, totals.get((t, p), 0.0), before))
            before = totals.get((t, p), 0.0)
    assert as_multiset(got.select("t", "p", "v", "v_lag1").collect()) == as_multiset(want)


@FEW
@given(st.lists(st.tuples(letter, letter, value), min_size=1, max_size=25), st.lists(letter, max_size=3))
def test_resum_selected(spark, data, chosen):
    df = spark.createDataFrame(data, "k string, c string, v double")
    selected = spark.createDataFrame([(x,) for x in chosen], "k string")
    got = aggregates.resum_repeats(df, selected, ["k"], ["k", "c"], "v")
    sums = defaultdict(float)
    for k, c, v in set(data):
        if k in chosen:
            sums[k, c] += v or 0.0
    want = [r for r in data if r[0] not in chosen] + [(k, c, v) for (k, c), v in sums.items()]
    assert as_multiset(got.collect()) == as_multiset(want)


@FEW
@given(st.lists(st.tuples(letter, letter), min_size=1, max_size=20), st.lists(st.tuples(letter, letter), max_size=8))
def test_null_safe_map(spark, data, mapping):
    keys = list(dict.fromkeys(mapping))
    df = spark.createDataFrame(data, "a string, b string")
    table = spark.createDataFrame([(a, b, f"{a}/{b}") for a, b in keys], "a string, b string, e string")
    got = joins.map_join(df, table, ["a", "b"])
    assert as_multiset(got.collect()) == as_multiset([(a, b, f"{a}/{b}" if (a, b) in keys else None) for a, b in data])


@FEW
@given(st.lists(st.tuples(letter, st.sampled_from([None, "1", "22", "1234567", "7654321"])), min_size=1, max_size=20))
def test_code_repair(spark, data):
    listed = {"a": "9999999", "b": None}
    df = spark.createDataFrame([(f, c, i) for i, (f, c) in enumerate(data)], "f string, c string, i int")
    table = spark.createDataFrame(list(listed.items()), "n string, code string")
    got = {r.i: r.c for r in windows.repair_codes(df, "c", ["f"], table, ("f", "n"), "code").collect()}
    for i, (f, c) in enumerate(data):
        order = sorted({y for x, y in data if x == f}, key=lambda y: (y is None, -len(y or ""), y or ""))
        carried = None
        for y in order:
            fixed = None if y is None else (listed.get(f) if len(y) < 6 else y)
            carried = fixed if fixed is not None else carried
            if y == c:
                break
        assert got[i] == carried


@FEW
@given(st.lists(st.tuples(letter, st.lists(value, min_size=6, max_size=6)), min_size=1, max_size=10))
def test_long_form_is_lossless(spark, data):
    df = spark.createDataFrame(
        [(k, 2022, *v) for k, v in data], "k string, fiscal_year int, targets double, qtr1 double, qtr2 double, qtr3 double, qtr4 double, cumulative double"
    )
    long = reshape.reshape_long(df)
    assert long.count() == sum(x is not None for _, v in data for x in v)
    assert (long.agg(F.sum("value")).first()[0] or 0.0) == sum(x or 0.0 for _, v in data for x in v)
    semi = reshape.reshape_semi_wide(df)
    parts = semi.agg(*[F.coalesce(F.sum(c), F.lit(0.0)) for c in ("results", "cumulative", "targets")]).first()
    assert sum(parts) == sum(x or 0.0 for _, v in data for x in v)
