"""Text, period and selector functions on literal rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quartermill.functions import periods, selectors, text
from quartermill.plans import context


def one(frame, value, column, kind="string"):
    return frame(f"x {kind}", [(value,)]).select(column.alias("r")).collect()[0].r


def test_replace_first_leaves_later_matches(frame):
    assert one(frame, "a1b1", text.replace_first("x", "1", "$")) == "a$b1"
    assert one(frame, "a1b1", text.remove_first("x", "(1)b")) == "a1"
    assert one(frame, "none", text.replace_first("x", "1", "z")) == "none"
    assert one(frame, "FY2020Q1", periods.drop_century("x")) == "FY20Q1"
    assert one(frame, "two\n1 lines 1", text.replace_first("x", "1", "z")) == "two\nz lines 1"


def test_substrings(frame):
    assert one(frame, "fy22q1_support", text.substring_from("x", 1, 6)) == "fy22q1"
    assert one(frame, "abcdef", text.substring_from("x", -2)) == "ef"
    assert one(frame, "a", text.substring_from("x", -3)) == "a"
    assert one(frame, "abcdef", text.substring_from("x", 3)) == "cdef"


def test_split_is_per_row(frame, rows):
    df = frame("x string", [("TX_NEW (N, DSD, Age)",), ("TX_NEW (N, TA, Age)",), ("none",)])
    assert rows(df.select(text.split_take("x", ", ", 2).alias("r"))) == [("DSD",), ("TA",), (None,)]


def test_split_into_pads_and_drops(frame, rows):
    df = frame("id int, x string", [(1, "a-b-c"), (2, "a")])
    assert rows(text.split_into(df, "x", ["p", "q"], "-")) == [(1, "a", "b"), (2, "a", None)]


def test_recode_keeps_other_values_and_null(frame, rows):
    df = frame("x string", [("a",), ("b",), (None,)])
    assert rows(df.select(text.recode("x", {"a": "A"}).alias("r"))) == [("A",), ("b",), (None,)]


def test_first_pattern_wins(frame):
    rules = (("Thabo", "T"), ("h", "H"))
    assert one(frame, "Thabo", text.first_matching("x", rules)) == "T"
    assert one(frame, "oh", text.first_matching("x", rules)) == "H"
    assert one(frame, "z", text.first_matching("x", rules)) == "z"


@pytest.mark.parametrize(
    ("value", "label"), [(999.0, "999"), (1500.0, "2K"), (2500.0, "2K"), (3.4e6, "3M"), (2e9, "2B"), (0.5, "0.5")]
)
def test_number_label(frame, value, label):
    assert one(frame, value, text.number_label("x"), "double") == label


def test_element_parts(frame):
    name = "PMTCT_EID (N, DSD, Age): Infant Testing"
    df = text.parse_element(frame("x string", [(name,), ("TX_TB (D, TA, Age/Sex/TBScreen): TX/TB",)]), "x")
    got = {r.indicator: (r.numeratordenom, r.support_type, r.disaggregate) for r in df.collect()}
    assert got == {"PMTCT_EID": ("N", "DSD", "Age"), "TX_TB": ("D", "TA", "Age/Sex/TBScreen")}
    assert one(frame, "TX_NEW (N, DSD) TARGET: x", text.element_kind("x")) == "Targets"


def test_modality_labels(frame, rows):
    df = frame("item string", [("Community - Home Based FY21",), ("Facility - Other PITC FY22",), ("Facility - Index FY22",)])
    got = rows(text.parse_modality(df, "item"), "fiscal_year", "sitetype", "short_name")
    assert got == [("FY21", "Community", "HomeCom"), ("FY22", "Facility", "Index"), ("FY22", "Facility", "OtherPITC")]


def test_mechanism_names(frame, rows):
    df = frame(
        "full string, code string, partner string",
        [("70310 - GH001 - Some Name", "70310", "P"), ("81902 - Plain - Name\n", "81902", "TBD one"), ("NoCode", "1", "P")],
    )
    got = rows(df.select(text.mechanism_award("full", "partner").alias("a"), text.mechanism_name("full", "code", "partner").alias("n")))
    assert got == [("GH001", "Some Name"), (None, "NoCode"), (None, "Plain - Name")]


def test_fiscal_calendar(frame, rows):
    df = frame("d date", [(dt.date(2022, 10, 1),), (dt.date(2022, 9, 30),), (dt.date(2022, 12, 31),), (dt.date(2023, 6, 1),)])
    assert rows(df.select(periods.quarter_label("d").alias("p"))) == [("FY22Q4",), ("FY23Q1",), ("FY23Q1",), ("FY23Q3",)]


def test_fiscal_year_ranges_equal_the_derived_year(spark):
    days = spark.sql("SELECT explode(sequence(date'1995-01-01', date'2003-12-31')) AS d")
    by_range = days.filter(periods.in_fiscal_years("d", [1996, 1997, 2001])).count()
    assert by_range == days.filter(periods.fiscal_year("d").isin(1996, 1997, 2001)).count()
    assert days.filter(periods.in_fiscal_years("d", [])).count() == 0


def test_period_labels(frame):
    assert one(frame, "FY22Q4", periods.fiscal_to_calendar_quarter("x")) == "2022Q3"
    assert one(frame, "FY23Q1", periods.fiscal_to_calendar_quarter("x")) == "2022Q4"
    assert one(frame, "CY2023Q3", periods.calendar_quarter_to_year("x")) == "FY23"
    assert one(frame, "CY2023Q4", periods.calendar_quarter_to_year("x")) == "FY24"
    assert one(frame, "20230115", periods.iso_period_label(F.lit("Daily"), "x")) == "FY23M01D15"
    assert one(frame, "2023W05", periods.iso_period_label(F.lit("WeeklyMonday"), "x")) == "FY23W05"
    assert one(frame, "202303", periods.iso_period_label(F.lit("Monthly"), "x")) == "FY23M03"
    assert one(frame, "2023Q3", periods.iso_period_label(F.lit("Quarterly"), "x")) == "FY23Q3"
    assert one(frame, "junk", periods.fiscal_to_calendar_quarter("x")) is None


def test_serial_dates(frame):
    assert one(frame, "44593", periods.serial_date("x")) == dt.date(2022, 2, 1)
    assert one(frame, "n/a", periods.serial_date("x")) is None
    assert one(frame, "12-2022", periods.month_year("x")) == dt.date(2022, 12, 1)
    assert one(frame, "bad", periods.month_year("x")) is None
    assert periods.heading_months(["code", "44593", "44621.0"]) == {"44593": "02-2022", "44621.0": "03-2022"}


def test_selectors(frame):
    df = frame("qtr1 double, name string, qtr2 double, Code string, n int", [])
    assert selectors.starting(df, "qtr") == ["qtr1", "qtr2"]
    assert selectors.strings(df) == ["name", "Code"]
    assert selectors.numbers(df) == ["qtr1", "qtr2", "n"]
    assert selectors.span(df, "name", "Code") == ["name", "qtr2", "Code"]
    assert selectors.containing(df, "NAM") == ["name"]
    assert selectors.leading(df, ["n"]).columns == ["n", "qtr1", "name", "qtr2", "Code"]
    assert selectors.relocate(df, "n", before="name").columns == ["qtr1", "n", "name", "qtr2", "Code"]
    assert selectors.relocate(df, "qtr1", after="Code").columns == ["name", "qtr2", "Code", "qtr1", "n"]
    assert selectors.rename_with(df, str.upper).columns[1] == "NAME"


def test_clean_names(frame):
    df = frame("`Agency lookback` int, `mech_ID` int, `OU5name` int, `1st` int, `a b` int, `a.b` int", [])
    assert selectors.clean_names(df).columns == ["agency_lookback", "mech_id", "ou5name", "x1st", "a_b", "a_b_2"]


def test_area_context(frame, rows):
    areas = [
        ("1", "gp Ekurhuleni Metropolitan Municipality", "1 - Scale-Up: Saturation"),
        ("2", "ec Alfred Nzo District Municipality", None),
    ]
    df = context.area_flags(context.area_key(frame("mech_code string, psnu string, snuprioritization string", areas)))
    got = rows(df, "short_name", "DSPID", "HIGHBURDEN", "focus_district")
    assert got == [
        ("ec Alfred Nzo DM", "2ec Alfred Nzo DM", "NO", "NO"), ("gp Ekurhuleni MM", "1gp Ekurhuleni MM", "YES", "YES"),
    ]


def test_community_worker_pairs(frame, rows):
    df = frame(
        "cadre string, model string",
        [("Lay Counselors", "Community-based"), ("Lay Counselors", "Facility site - Surge"), ("WBOT CHW", None), (None, "Community-based")],
    )
    got = rows(context.pair_flag(df, "cadre", "model"), "cadre", "model", "CHW_like")
    assert got == [
        ("Lay Counselors", "Community-based", "Yes"), ("Lay Counselors", "Facility site - Surge", "No"),
        ("WBOT CHW", None, "Yes"), (None, "Community-based", "No"),
    ]


def test_labels_and_lookback(frame, rows):
    df = frame("c string, h string, i string, nd string", [("1", "2", "TX", "D"), ("1", None, "TX", "N"), ("3", "3", "TX", None)])
    assert rows(df.select(context.lookback_code("c", "h").alias("r"))) == [("2",), ("3",), (None,)]
    assert rows(df.select(context.with_denominator_suffix("i", "nd").alias("r"))) == [("TX",), ("TX_D",), (None,)]
    assert rows(df.select(context.labels_by_code("c", {1: "one"}, "i").alias("r"))) == [("TX",), ("one",), ("one",)]
    assert rows(df.select(context.labels_by_code("c", {"9": "x"}).alias("r"))) == [("",), ("",), ("",)]


def test_age_classes(frame, rows):
    df = frame("a string", [("<01",), ("15-19",), ("odd",), (None,)])
    assert rows(df.select(context.coarse_age("a").alias("r"))) == [("15+",), ("<15",), (None,), (None,)]
    years = frame("a string", [("14",), ("15",), ("x",)])
    assert rows(years.select(context.coarse_age_from_number("a").alias("r"))) == [("15+",), ("<15",), (None,)]


def test_membership_flag(frame, rows):
    df = frame("k string", [("a",), ("b",), (None,)])
    members = frame("k string", [("a",), ("a",), (None,)])
    assert rows(context.flagged_members(df, members, ["k"])) == [("a", True), ("b", False), (None, True)]


def test_listed_mechanism_names_and_combos(frame):
    assert one(frame, "70310 - 72067419CA00023 - Some Name", text.listed_mechanism_name("x")) == "Some Name"
    assert one(frame, "00000 De-duplication", text.listed_mechanism_name("x")) == "De-duplication"
    assert one(frame, "81902 - Plain Name", text.listed_mechanism_name("x")) == "Plain Name"
    assert one(frame, "15-19, Female", text.combo_age("x")) == "15-19"
    assert one(frame, "15-19, Female", text.combo_sex("x")) == "Female"
    assert one(frame, "cadre...12", text.extract("x", r"^(.*?)\.+(\d+)$", 1)) == "cadre"


def test_cash_age_bands_and_their_coarse_age(frame):
    from quartermill.plans.conform import cash_age_bands

    want = {"5 to 9": ("05-09", "<15"), "30 to 34": ("30-34", "15+"), "40 to 44": ("40-44", "15+"), "15 - 24": ("15-24", "15+"), "0 to 14": ("0-14", "<15"),
            "< 5": ("<5", "<15"), "> 80": ("80+", "15+"), "25 and older": ("25+", "15+"), "Other": ("Unknown Age", None), "75 to 79": ("75-79", "15+"), "x": ("x", None)}
    for text_, (band, coarse) in want.items():
        assert one(frame, text_, cash_age_bands("x")) == band
        assert one(frame, band, context.coarse_age("x")) == coarse
    assert one(frame, "10-24", context.coarse_age("x")) is None
