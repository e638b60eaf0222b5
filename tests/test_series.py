"""Packed series: work in proportion to their length, and the same rows as a plain loop."""

import itertools

import pytest

from quartermill.operators import series
from quartermill.operators.joins import match
from quartermill.plans import products


def plan_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_entries_are_made_once(frame):
    df = frame("s string, p string, v double", [("a", "1", 1.0), ("a", "3", 2.0), ("b", "2", 3.0)])
    late = series.lagged(series.completed(series.pack(df, ["s"], "p", ["v"]), {"v": 0.0}, ["1", "2", "3"]), "v")
    plan = plan_of(series.unpack(late))
    # No test of the size ahead of the rows: it would hold the whole array once more.
    assert "size(" not in plan and plan.count("sort_array(concat") == 1


def test_series_without_entries_give_no_rows(frame):
    packed = series.pack(frame("s string, p int", [("a", 1), ("b", 2)]), ["s"], "p", [])
    assert [r.s for r in series.unpack(series.kept(packed, lambda e: e["p"] > 1)).collect()] == ["b"]


def test_carried_values_are_made_once(frame):
    df = frame("g string, p int, a string", [("x", 1, None), ("x", 2, "m")])
    filled = plan_of(series.filled(series.pack(df, ["g"], "p", ["a"]), ["a"]))
    # Neither built up entry by entry, nor inside the function that is called for each entry.
    assert "aggregate(" not in filled and "zip_with(zip_with(" in filled


def nearest(values, direction):
    def carried(vs):
        return list(itertools.accumulate(vs, lambda last, v: last if v is None else v))

    down, up = carried(values), carried(values[::-1])[::-1]
    return {"down": down, "up": up, "downup": [u if d is None else d for d, u in zip(down, up)]}[direction]


@pytest.mark.parametrize("direction", ["down", "up", "downup"])
def test_fill_within_equals_a_loop(frame, direction):
    groups = [
        [None, "m", None, None, "k", None], [None, None], ["a"], [None, "z"], ["a", None], [None, None, "b", "c", None, "d"],
        *([*p] for p in itertools.product([None, "u", "v"], repeat=3)),
    ]
    df = frame("g int, p int, a string", [(g, p, v) for g, vs in enumerate(groups) for p, v in enumerate(vs)])
    got = {(r.g, r.p): r.a for r in series.fill_within(df, ["a"], ["g"], "p", direction).collect()}
    assert got == {(g, p): v for g, vs in enumerate(groups) for p, v in enumerate(nearest(vs, direction))}


def test_smallest_value_of_a_period_fills_its_rows(frame, rows):
    df = frame("g int, p int, a string, b int", [(1, None, None, 0), (1, 1, "y", 1), (1, 1, "x", 2), (1, 1, None, 3), (1, 2, None, 4), (None, 2, "n", 5), (None, 3, None, 6)])
    got = series.fill_within(df, ["a"], ["g"], "p")
    assert got.columns == ["g", "p", "a", "b"]
    assert rows(got, "b", "a") == [(0, "x"), (1, "y"), (2, "x"), (3, "x"), (4, "x"), (5, "n"), (6, "n")]


def test_series_keep_their_tasks_after_a_join_on_the_site(spark, frame):
    long = frame("site string, indicator string, period string, period_type string, value double", [("s", "TX", "1", "results", 5.0), ("t", "TX", "2", "results", 1.0)])
    sites = frame("site string, name string", [("s", "S"), ("t", "T")])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = products.site_series(match(long, sites, ["site"], "inner"), "TX", ["site"], ["name"], ["site"], steps=(1,))
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # The join deals by site as well; tasks joined by their bytes would be one or two.
    assert "REPARTITION_BY_NUM" in plan and out.count() == 2 * 2 * 2
