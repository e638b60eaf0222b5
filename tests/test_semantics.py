"""One literal frame per missing-value rule."""

from pyspark.sql import functions as F

from quartermill.functions import semantics as s


def test_not_in_keeps_null(frame, rows):
    df = frame("x string", [("a",), ("b",), (None,)])
    assert rows(df.filter(s.not_in("x", ["a"]))) == [("b",), (None,)]
    assert rows(df.filter(s.not_in("x", ["a", None]))) == [("b",)]
    assert rows(df.filter(s.not_in("x", []))) == [("a",), ("b",), (None,)]


def test_in_set_with_null_listed_matches_null(frame, rows):
    df = frame("x string", [("a",), ("b",), (None,)])
    assert rows(df.filter(s.in_set("x", [None, "a"]))) == [("a",), (None,)]
    assert rows(df.select(s.in_set("x", ["a"]).alias("t"))) == [(False,), (False,), (True,)]


def test_if_else_with_null_condition_is_null(frame, rows):
    df = frame("x int", [(1,), (2,), (None,)])
    assert rows(df.select(s.if_else(F.col("x") == 1, F.lit("y"), F.lit("n")).alias("r"))) == [("n",), ("y",), (None,)]


def test_sum_of_all_null_group_is_zero(frame, rows):
    df = frame("k string, v double", [("a", None), ("a", None), ("b", 1.0)])
    assert rows(df.groupBy("k").agg(s.na_sum("v").alias("v"))) == [("a", 0.0), ("b", 1.0)]


def test_unite_prints_null_as_na(frame, rows):
    df = frame("a string, b string", [("x", None), (None, None), ("x", "y")])
    assert rows(df.select(s.unite("a", "b").alias("k"))) == [("NA_NA",), ("x_NA",), ("x_y",)]


def test_extract_without_match_is_null(frame, rows):
    df = frame("x string", [("ab12",), ("zz",), (None,)])
    assert rows(df.select(s.extract("x", r"\d+").alias("r"))) == [("12",), (None,), (None,)]
    assert rows(df.select(s.extract("x", r"[a-z]+(\d)", 1).alias("r"))) == [("1",), (None,), (None,)]


def test_filter_drops_null_comparison(frame, rows):
    assert rows(frame("x int", [(1,), (None,)]).filter(F.col("x") != 2)) == [(1,)]


def test_number_from_bad_text_is_null(frame, rows):
    df = frame("x string", [("1.5",), ("n/a",), (None,)])
    assert rows(df.select(s.to_number("x").alias("r"))) == [(1.5,), (None,), (None,)]


def test_zero_denominator(frame, rows):
    df = frame("n double, d double", [(1.0, 0.0), (0.0, 0.0), (1.0, 2.0), (1.0, 100.0), (None, 1.0)])
    got = df.select("n", "d", s.ratio("n", "d").alias("r"), s.ratio_exceeds("n", "d", 0.1).alias("x"))
    assert rows(got) == [
        (0.0, 0.0, None, None), (1.0, 0.0, None, True), (1.0, 100.0, 0.01, False), (1.0, 2.0, 0.5, True), (None, 1.0, None, None),
    ]


def test_codes_compare_as_text(frame, rows):
    df = frame("c string", [("70310",), ("070310",), (None,)])
    assert rows(df.filter(s.code_in("c", [70310]))) == [("70310",)]


def test_nulls_last_when_sorting(frame):
    df = frame("x int", [(None,), (2,), (1,)])
    assert [r.x for r in df.orderBy(F.col("x").asc_nulls_last()).collect()] == [1, 2, None]


def test_round_half_to_even(frame, rows):
    df = frame("x double", [(0.125,), (0.375,), (2.5,)])
    assert rows(df.select(s.round_even("x", 2).alias("r"))) == [(0.12,), (0.38,), (2.5,)]
    assert rows(df.select(s.round_even("x").alias("r"))) == [(0.0,), (0.0,), (2.0,)]


def test_posix_classes_mean_characters(frame, rows):
    df = frame("x string", [("a b1",), ("space",)])
    assert rows(df.select(s.extract("x", "[:space:].*").alias("r"))) == [(" b1",), (None,)]
    assert s.java_pattern("[:digit:]+") == r"\d+"


def test_null_group_is_kept(frame, rows):
    df = frame("k string, v double", [(None, 1.0), (None, 2.0), ("a", 3.0)])
    assert rows(df.groupBy("k").agg(s.na_sum("v").alias("v"))) == [("a", 3.0), (None, 3.0)]


def test_code_suffix_only_at_the_end(frame, rows):
    df = frame("c string", [("12340",), ("12340.0",), ("1.05",)])
    assert rows(df.select(s.strip_decimal_code("c").alias("r"))) == [("1.05",), ("12340",), ("12340",)]
