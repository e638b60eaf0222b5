"""Joins, aggregates, windows, reshapes and set operations on small frames and against brute force."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from quartermill.operators import aggregates, filters, joins, reshape, setops, windows


# --- joins -----------------------------------------------------------------

def test_map_join_matches_null_keys(frame, rows):
    left = frame("a string, b string, v int", [("x", None, 1), ("x", "y", 2), (None, None, 3), ("z", "z", 4)])
    mapping = frame("a string, b string, e string", [("x", None, "E1"), ("x", "y", "E2"), (None, None, "E3"), (None, None, "E3")])
    got = rows(joins.map_join(left, mapping, ["a", "b"]), "v", "e")
    assert got == [(1, "E1"), (2, "E2"), (3, "E3"), (4, None)]
    assert "e" in joins.map_join(left, mapping, {"a": "a", "b": "b"}).columns


def test_plain_match_does_not_match_null(frame, rows):
    left, right = frame("k string", [("a",), (None,)]), frame("k string, w int", [("a", 1), (None, 2)])
    assert rows(joins.match(left, right, ["k"])) == [("a", 1), (None, None)]


def test_partial_keys_do_not_fan_out(frame, rows):
    feed = frame("site string, sex string, age string, v double", [("s", "F", "1", 1.0), ("s", "F", "2", 2.0), ("s", None, "1", 4.0)])
    mapping = frame("sex string, age string, e string", [("F", "1", "EF"), ("F", "2", "EF"), (None, "1", "EN"), ("F", "1", "other")])
    got = joins.partial_key_map(feed, mapping, ["sex"], ["site"], "v", ["e"], F.col("e").startswith("E"))
    assert rows(got, "site", "sex", "v", "e") == [("s", "F", 3.0, "EF"), ("s", None, 4.0, "EN")]


def test_reconcile_keeps_both_keys(frame, rows):
    a = frame("uid string, n int", [("1", 1), ("2", 2), ("2", 3), (None, 4)])
    b = frame("listed string, m int", [("2", 2), ("3", 3), (None, 5)])
    got = rows(joins.reconcile(a, b, ("uid", "listed")))
    assert got == [("1", 1, None, None), ("2", 2, "2", 2), ("2", 3, "2", 2), (None, 4, None, 5), (None, None, "3", 3)]
    with pytest.raises(ValueError, match="both sides"):
        joins.reconcile(a, a, ("uid", "uid"))


def test_full_lookup_has_one_key_column(frame, rows):
    a, b = frame("k string, n int", [("1", 1), ("2", 2)]), frame("k string, m int", [("2", 2), ("3", 3)])
    assert rows(joins.full_lookup(a, b, ["k"])) == [("1", 1, None), ("2", 2, 2), ("3", None, 3)]


def test_overwrite_only_where_present(frame, rows):
    df = frame("code string, name string, y int", [("1", "a", 2022), ("1", "a", 2023), ("2", "b", 2023)])
    walk = frame("old string, new string", [("1", "A")])
    assert rows(joins.overwrite(df, walk, {"code": "old"}, {"name": "new"})) == [("1", "A", 2022), ("1", "A", 2023), ("2", "b", 2023)]
    scoped = joins.overwrite(df, walk, {"code": "old"}, {"name": "new"}, when=F.col("y") == 2023)
    assert rows(scoped) == [("1", "A", 2023), ("1", "a", 2022), ("2", "b", 2023)]


def test_shared_columns_collapse(frame, rows):
    a, b = frame("k int, p string", [(1, None), (2, "x")]), frame("k int, p string", [(1, "y"), (2, "z")])
    assert rows(joins.overlap_join(a, b, ["k"])) == [(1, "y"), (2, "x")]
    assert rows(joins.overlap_join(a, b, ["k"], prefer="right")) == [(1, "y"), (2, "z")]


def test_semi_and_anti_treat_null_as_a_value(frame, rows):
    a, b = frame("k string", [("a",), ("a",), ("b",), (None,)]), frame("k string", [("a",), ("a",), (None,)])
    assert rows(joins.matched(a, b, ["k"])) == [("a",), ("a",), (None,)]
    assert rows(joins.not_matched(a, b, ["k"])) == [("b",)]


def test_literal_table_quotes(spark, rows):
    t = joins.literal_table(spark, ["a", "b"], [("it's \\ ok", 1), (None, 2)])
    assert rows(t) == [("it's \\ ok", 1), (None, 2)]


def test_compare_totals(frame, rows):
    a, b = frame("k string, v double", [("x", 1.0), ("x", 2.0), ("y", 5.0)]), frame("k string, v double", [("x", 1.0)])
    assert rows(joins.compare_totals(a, b, ["k"], "v", ("s", "t"))) == [("x", 3.0, 1.0, 2.0), ("y", 5.0, None, None)]


# --- aggregates ------------------------------------------------------------

def test_collapse_keeps_rows_without_band_and_totals(frame, rows):
    df = frame("i string, b string, v double", [("TX", "50-54", 1.0), ("TX", "65+", 2.0), ("TX", "10-14", 3.0), ("TX", None, 4.0), ("C", "65+", 5.0)])
    got = aggregates.collapse_bands(df, "b", {"50-54": "50+", "65+": "50+"}, ["v"], when=F.col("i") != "C")
    assert rows(got) == [("C", "65+", 5.0), ("TX", "10-14", 3.0), ("TX", "50+", 3.0), ("TX", None, 4.0)]


def test_sum_by_strings_ignores_other_numbers(frame, rows):
    df = frame("a string, n int, v double", [("x", 1, 1.0), ("x", 2, None), ("y", 3, None)])
    assert rows(aggregates.sum_by_strings(df, ["v"])) == [("x", 1.0), ("y", 0.0)]


def test_row_total_null_choice(frame, rows):
    df = frame("a double, b double", [(1.0, None), (1.0, 2.0)])
    got = df.select(aggregates.row_total(["a", "b"]).alias("s"), aggregates.row_total(["a", "b"], False).alias("p"))
    assert rows(got) == [(1.0, None), (3.0, 3.0)]


def test_resum_repeats_touches_selected_only(frame, rows):
    df = frame("k string, c string, v double", [("a", "x", 1.0), ("a", "x", 1.0), ("a", "x", 2.0), ("b", "x", 1.0), ("b", "x", 1.0)])
    got = aggregates.resum_repeats(df, frame("k string", [("a",)]), ["k"], ["k", "c"], "v")
    assert rows(got) == [("a", "x", 3.0), ("b", "x", 1.0), ("b", "x", 1.0)]


def test_distinct_count_counts_null_as_value(frame, rows):
    df = frame("g string, v string", [("a", "x"), ("a", "x"), ("a", None), ("b", "y")])
    assert rows(aggregates.distinct_count(df, ["g"], "v", "n")) == [("a", 2), ("b", 1)]


# --- windows: one group holds most of the rows -----------------------------

@pytest.fixture
def skewed(spark):
    rng = random.Random(7)
    data = []
    for i in range(3000):
        group = "hot" if rng.random() < 0.6 else (None if rng.random() < 0.05 else f"g{rng.randrange(20)}")
        data.append((i, group, rng.randrange(12), rng.choice([None, None, "p", "q", "r"]), float(rng.randrange(5))))
    return data, spark.createDataFrame(data, "id int, g string, p int, a string, v double")


def brute_fill(data):
    at = defaultdict(lambda: defaultdict(list))
    for _, g, p, a, _ in data:
        if a is not None:
            at[g][p].append(a)
    out = {}
    for i, g, p, a, _ in data:
        known = {q: min(x) for q, x in at[g].items()}
        before = [q for q in known if q <= p]
        after = [q for q in known if q > p]
        fill = known[max(before)] if before else (known[min(after)] if after else None)
        out[i] = a if a is not None else fill
    return out


def test_fill_within_equals_brute_force(skewed):
    data, df = skewed
    got = {r.id: r.a for r in windows.fill_within(df, ["a"], ["g"], ["p"]).collect()}
    assert got == brute_fill(data)


def test_fill_directions(frame, rows):
    df = frame("g string, p int, a string", [("x", 1, None), ("x", 2, "m"), ("x", 3, None)])
    assert rows(windows.fill_within(df, ["a"], ["g"], ["p"], "down"), "p", "a") == [(1, None), (2, "m"), (3, "m")]
    assert rows(windows.fill_within(df, ["a"], ["g"], ["p"], "up"), "p", "a") == [(1, "m"), (2, "m"), (3, None)]
    with pytest.raises(ValueError):
        windows.fill_within(df, ["a"], ["g"], ["p"], "sideways")


def test_shares_repeats_and_counts_equal_brute_force(skewed):
    data, df = skewed
    totals = defaultdict(float)
    for _, g, _, _, v in data:
        totals[g] += v
    got = {r.id: r.share for r in windows.share_of_total(df, "v", ["g"]).collect()}
    assert len(got) == len(data)
    for i, g, _, _, v in data:
        assert got[i] == (pytest.approx(v / totals[g]) if totals[g] else None)
    keys = Counter((g, p) for _, g, p, _, _ in data)
    repeats = {r.id: r.dupe_count for r in windows.find_repeats(df, ["g", "p"]).collect()}
    assert repeats == {i: keys[g, p] for i, g, p, _, _ in data if keys[g, p] > 1}
    counts = {r.id: r.n for r in windows.add_count(df, ["g"]).collect()}
    sizes = Counter(g for _, g, _, _, _ in data)
    assert counts == {i: sizes[g] for i, g, _, _, _ in data}


def test_full_copies_come_back_once_each(frame, rows):
    df = frame("a string, b int", [("x", 1), ("x", 1), ("x", 1), ("y", 2), (None, 3), (None, 3)])
    assert rows(windows.find_repeats(df)) == [("x", 1, 3), ("x", 1, 3), ("x", 1, 3), (None, 3, 2), (None, 3, 2)]


def test_first_per_key_equals_brute_force(skewed):
    data, df = skewed
    best = {}
    for i, g, p, _, v in data:
        if g not in best or (p, i) < best[g][:2]:
            best[g] = (p, i, v)
    got = {r.g: (r.p, r.id, r.v) for r in windows.first_per_key(df, ["g"], ["p", "id"]).collect()}
    assert got == best


def test_lag_on_complete_grid(frame, rows):
    df = frame("s string, p string, v double", [("a", "1", 1.0), ("a", "3", 3.0), ("b", "2", 5.0)])
    grid = reshape.complete_grid(df, "p", ["s"], {"v": 0.0})
    got = rows(windows.lag_periods(grid, "v", ["s"], "p"), "s", "p", "v", "v_lag1", "v_lag2")
    assert got == [
        ("a", "1", 1.0, None, None), ("a", "2", 0.0, 1.0, None), ("a", "3", 3.0, 0.0, 1.0),
        ("b", "1", 0.0, None, None), ("b", "2", 5.0, 0.0, None), ("b", "3", 0.0, 5.0, 0.0),
    ]


def test_code_repair(frame, rows):
    df = frame(
        "f string, c string, v int",
        [("A", "1234567", 1), ("A", "12", 2), ("A", None, 3), ("B", "12", 4), ("C", None, 5), ("D", "12", 6), ("D", None, 7)],
    )
    listed = frame("n string, code string", [("B", "7654321"), ("D", "1111111")])
    got = rows(windows.repair_codes(df, "c", ["f"], listed, ("f", "n"), "code"), "v", "c")
    assert got == [(1, "1234567"), (2, "1234567"), (3, "1234567"), (4, "7654321"), (5, None), (6, "1111111"), (7, "1111111")]


def test_period_differences(frame, rows):
    df = frame("k string, p string, v double", [("a", "Q1", 5.0), ("a", "Q2", 2.0), ("a", "Q2", 1.0), ("b", "Q2", 1.0)])
    assert rows(windows.period_differences(df, ["k"], "p", "v", "Q1", ["Q2"])) == [("a", 5.0, 3.0, 2.0), ("b", None, 1.0, None)]


# --- reshape ---------------------------------------------------------------

@pytest.fixture
def wide(frame):
    return frame(
        "psnu string, indicator string, fiscal_year int, qtr1 double, qtr2 double, qtr3 double, qtr4 double, cumulative double, targets double",
        [("a", "TX", 2022, 1.0, None, 3.0, 0.0, 4.0, 9.0), ("a", "HTS", 2023, None, None, None, None, None, 7.0), ("b", "TX", 2022, 2.0, 2.0, 2.0, 2.0, 8.0, None)],
    )


def test_long_form_keeps_sums_and_drops_null(wide, rows):
    long = reshape.reshape_long(wide)
    assert rows(long.filter("psnu = 'a'"), "period", "period_type", "value") == [
        ("FY22", "cumulative", 4.0), ("FY22", "targets", 9.0), ("FY22Q1", "results", 1.0), ("FY22Q3", "results", 3.0),
        ("FY22Q4", "results", 0.0), ("FY23", "targets", 7.0),
    ]
    assert long.agg(F.sum("value")).first()[0] == 4 + 9 + 4 + 7 + 8 + 8
    assert reshape.reshape_long(wide, drop_null=False).count() == 18
    assert "period_type" not in reshape.reshape_long(wide, keep_type=False).columns


def test_mirror_columns_have_exactly_one_value(wide):
    long = reshape.reshape_long(wide)
    mirrored = reshape.mirror_columns(long, "indicator", ["TX", "HTS"])
    assert mirrored.count() == long.count()
    filled = F.col("TX").isNotNull().cast("int") + F.col("HTS").isNotNull().cast("int")
    assert mirrored.filter(filled != 1).isEmpty()


def test_semi_wide_and_wide(wide, rows):
    semi = reshape.reshape_semi_wide(wide)
    assert rows(semi.filter("psnu = 'b'"), "period", "results", "cumulative", "targets") == [
        ("FY22", None, 8.0, None), ("FY22Q1", 2.0, None, None), ("FY22Q2", 2.0, None, None), ("FY22Q3", 2.0, None, None), ("FY22Q4", 2.0, None, None),
    ]
    long = reshape.reshape_long(wide).filter("period_type = 'results'")
    flat = reshape.reshape_wide(long, ["FY22Q1", "FY22Q2"], ["psnu"])
    assert flat.columns == ["psnu", "fy2022q1", "fy2022q2"]
    assert rows(flat) == [("a", 1.0, None), ("b", 2.0, 2.0)]


def test_grid_size_and_reported_nulls(frame, rows):
    df = frame("t string, p int, v double, n int", [("a", 1, None, 1), ("a", 2, 1.0, 1), ("b", 3, 2.0, 1), (None, 1, 5.0, 1)])
    grid = reshape.complete_grid(df, "p", ["t"], {"v": 0.0})
    assert grid.count() == 3 * 3
    assert rows(grid.filter("t = 'a'"), "p", "v", "n") == [(1, None, 1), (2, 1.0, 1), (3, 0.0, None)]
    assert reshape.complete_grid(df, "p", ["t"], {"v": 0.0}, periods=[1, 2, 3, 4]).count() == 3 * 4


def test_pivot_with_absent_and_null_category(frame, rows):
    df = frame("k string, c string, v double", [("x", "D", 1.0), ("x", None, 2.0), ("y", "N", 4.0)])
    got = reshape.pivot_values(df, ["k"], "c", ["N", "D", None, "Z"], "v")
    assert got.columns == ["k", "N", "D", "NA", "Z"]
    assert rows(got) == [("x", None, 1.0, 2.0, None), ("y", 4.0, None, None, None)]


def test_unpivot_keeps_nulls(frame, rows):
    df = frame("k string, a double, b double", [("x", 1.0, None)])
    assert rows(reshape.unpivot(df, ["k"], ["a", "b"], "n", "v")) == [("x", "a", 1.0), ("x", "b", None)]


# --- set operations and filters --------------------------------------------

def test_strict_append_checks_columns(frame):
    a, b = frame("x int, y int", [(1, 2)]), frame("y int, x int", [(3, 4)])
    assert setops.strict_append(a, b).count() == 2
    with pytest.raises(ValueError, match="columns differ"):
        setops.strict_append(a, frame("x int", [(1,)]))


def test_vintages_must_be_disjoint(frame):
    df = frame("fiscal_year int, v int", [(2021, 1), (2022, 2), (2023, 3)])
    assert setops.join_vintages(df, df, [2021], [2022, 2023]).count() == 3
    with pytest.raises(ValueError, match="2022"):
        setops.join_vintages(df, df, [2021, 2022], [2022])


def test_differences(frame, rows):
    a, b = frame("x int, y string", [(1, "a"), (1, "a"), (2, None)]), frame("y string, x int", [("a", 1)])
    assert rows(setops.rows_only_in(a, b)) == [(2, None)]
    assert rows(setops.keys_only_in(a, b, ["x"])) == [(2,)]
    assert setops.loose_append(a, frame("z int", [(1,)])).columns == ["x", "y", "z"]


def test_latest_and_exclusions(frame, rows):
    df = frame("s string, p int, v int", [("a", 1, 1), ("a", 2, 2), ("a", 2, 3), (None, 1, 4)])
    assert rows(filters.latest_period(df, "p"), "v") == [(2,), (3,)]
    assert rows(filters.latest_rows(df, ["s"], "p"), "v") == [(2,), (3,), (4,)]
    assert rows(filters.exclude_where(df, F.col("s") == "a", F.col("p") == 1), "v") == [(2,), (3,)]
    assert rows(filters.current_rows(df, F.col("p") == 2, ["v"], "is_current")) == [(2, "Yes"), (3, "Yes")]
    assert rows(filters.inside_box(df, "p", "v", 1, 1, 0, 2), "v") == [(1,)]


def test_doubled_dimension_keys_are_an_error(frame, rows):
    fact = frame("k string, v int", [("a", 1), ("b", 2), (None, 3)])
    dim = frame("k string, x int, y int", [("a", 1, 1), ("a", 2, 1), ("c", 3, 3), (None, 4, 4), (None, 5, 5)])
    with pytest.raises(Exception, match="not unique on k: a"):
        joins.lookup(fact, dim, ["k"]).collect()
    assert rows(joins.lookup(fact, dim, ["k"], unique=False), "k", "x") == [("a", 1), ("a", 2), ("b", None), (None, None)]
    # Equal in the wanted columns, or NULL where NULL matches nothing: no error.
    assert rows(joins.lookup(fact, dim, ["k"], ["y"]), "k", "y") == [("a", 1), ("b", None), (None, None)]
    with pytest.raises(Exception, match="not unique on k: NULL"):
        joins.lookup(fact, dim, ["k"], ["y"], null_safe=True).collect()
    moves = frame("old string, new string", [("a", "z"), ("a", "y")])
    with pytest.raises(Exception, match="not unique on old: a"):
        joins.overwrite(fact, moves, {"k": "old"}, {"k": "new"}).collect()
    assert joins.overwrite(fact, moves, {"k": "old"}, {"k": "new"}, unique=False).count() == 4
