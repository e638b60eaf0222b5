"""Submission building, data-quality rules and products on literal rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quartermill.plans import conform, products, quality, rules

TODAY = dt.date(2023, 4, 24)
FACT = "mech_code string, psnu string, sitename string, indicator string, numeratordenom string, qtr1 double, qtr2 double"
KEYS = ["mech_code", "psnu", "sitename"]
PERIODS = {"'FY23Q1'": "qtr1", "'FY23Q2'": "qtr2"}


# --- rules -----------------------------------------------------------------

def failed(found):
    return sorted((r.sitename, r.period, r.check) for r in found.collect())


def test_comparison_needs_both_sides(frame):
    fact = frame(FACT, [
        ("1", "p", "both", "A", "N", 1.0, 5.0), ("1", "p", "both", "B", "N", 2.0, 5.0),
        ("1", "p", "only", "B", "N", 2.0, 2.0),
        ("1", "p", "nullside", "A", "N", None, None), ("1", "p", "nullside", "B", "N", 2.0, 0.0),
    ])
    rule = quality.less_than("ab", "A < B", "indicator = 'A'", "indicator = 'B'")
    assert failed(quality.findings(fact, KEYS, [rule], PERIODS, TODAY)) == [
        ("both", "FY23Q1", "A < B"), ("nullside", "FY23Q1", "A < B"),
    ]
    loose = quality.findings(fact, KEYS, [rule], PERIODS, TODAY, missing_as_zero=True, only_periods=["FY23Q2"])
    assert failed(loose) == [("only", "FY23Q2", "A < B")]


def test_partners_are_not_mixed(frame):
    fact = frame(FACT, [("1", "p", "s", "A", "N", 1.0, 1.0), ("2", "p", "s", "B", "N", 5.0, 5.0)])
    rule = quality.less_than("ab", "A < B", "indicator = 'A'", "indicator = 'B'")
    assert quality.findings(fact, KEYS, [rule], PERIODS, TODAY).isEmpty()


def test_share_rule_with_zero_total(frame):
    fact = frame(FACT, [
        ("1", "p", "zero", "E", "N", 1.0, 0.0), ("1", "p", "zero", "T", "N", 0.0, 0.0),
        ("1", "p", "ten", "E", "N", 1.0, 2.0), ("1", "p", "ten", "T", "N", 10.0, 10.0),
    ])
    rule = quality.share_above("share", "E > 10%", "indicator = 'E'", "indicator = 'T'", 0.10)
    assert failed(quality.findings(fact, KEYS, [rule], PERIODS, TODAY)) == [
        ("ten", "FY23Q2", "E > 10%"), ("zero", "FY23Q1", "E > 10%"),
    ]


def test_sum_rules_need_every_part(frame):
    fact = frame(FACT, [
        ("1", "p", "full", "A", "N", 3.0, 9.0), ("1", "p", "full", "B", "N", 2.0, 2.0), ("1", "p", "full", "C", "N", 2.0, 2.0),
        ("1", "p", "part", "A", "N", 1.0, 1.0), ("1", "p", "part", "B", "N", 9.0, 9.0),
    ])
    less = quality.less_than_sum("less", "A < B+C", "indicator = 'A'", ["indicator = 'B'", "indicator = 'C'"])
    more = quality.greater_than_sum("more", "A > B+C", "indicator = 'A'", ["indicator = 'B'", "indicator = 'C'"])
    assert failed(quality.findings(fact, KEYS, [less, more], PERIODS, TODAY)) == [
        ("full", "FY23Q1", "A < B+C"), ("full", "FY23Q2", "A > B+C"),
    ]


def test_numerator_and_equality_rules(frame):
    fact = frame(FACT, [("1", "p", "s", "TB", "N", 5.0, 1.0), ("1", "p", "s", "TB", "D", 4.0, 1.0), ("1", "p", "s", "Z", "D", 4.0, 2.0)])
    nd = quality.numerator_over_denominator("tb", "N > D", "indicator = 'TB'")
    ne = quality.differs("ne", "differs", "indicator = 'TB' AND numeratordenom = 'D'", "indicator = 'Z'")
    assert failed(quality.findings(fact, KEYS, [nd, ne], PERIODS, TODAY)) == [("s", "FY23Q1", "N > D"), ("s", "FY23Q2", "differs")]


def test_prior_quarter_rule_and_parity(frame):
    fact = frame(FACT, [
        ("1", "p", "gone", "A", "N", 4.0, None), ("1", "p", "zero", "A", "N", 4.0, 0.0),
        ("1", "p", "never", "A", "N", None, None), ("1", "p", "fine", "A", "N", 4.0, 1.0),
    ])
    keys = [*KEYS, "indicator"]
    found = quality.findings(fact, keys, [quality.prior_missing()], PERIODS, TODAY)
    assert [(s, p) for s, p, _ in failed(found)] == [("gone", "FY23Q2"), ("zero", "FY23Q2")]
    row = found.filter("sitename = 'gone'").first()
    assert (row.level, row.type_check, row.indicator, row.today_date) == ("Level 1", "Result in previous quarter", "A", TODAY)


def test_strict_parity_flags_later_gaps_too(frame):
    fact = frame(FACT + ", qtr3 double", [("1", "p", "s", "A", "N", 4.0, 0.0, None), ("1", "p", "empty", "A", "N", 0.0, None, 0.0)])
    periods = {**PERIODS, "'FY23Q3'": "qtr3"}
    plain = quality.findings(fact, KEYS, [quality.prior_missing()], periods, TODAY)
    assert [(s, p) for s, p, _ in failed(plain)] == [("s", "FY23Q2")]
    strict = quality.findings(fact, KEYS, [quality.prior_missing(strict_parity=True)], periods, TODAY)
    assert [(s, p) for s, p, _ in failed(strict)] == [("s", "FY23Q2"), ("s", "FY23Q3")]


def test_targets_without_results(frame):
    fact = frame(
        "site string, indicator string, targets double, cumulative double",
        [("a", "X", 5.0, None), ("a", "X", 1.0, 0.0), ("b", "X", 5.0, 1.0), ("c", "X", None, None)],
    )
    got = quality.target_findings(fact, ["site", "indicator"], "'FY23Q2'", TODAY).collect()
    assert [(r.site, r.period, r.check) for r in got] == [("a", "FY23Q2", "Targets reported but results blank")]


def test_completeness_counts(frame, rows):
    df = frame("a string, b string", [("x", "x"), ("x", None), ("y", "z")])
    got = quality.completeness(df, {"has_b": "b IS NOT NULL", "same": "a = b"})
    assert rows(got) == [("has_b", 3, 2, 1, 0), ("same", 3, 1, 1, 1)]


def test_key_prefixes_stop_at_first_unique(frame):
    def prefixes(rows, columns=("a", "b", "c")):
        return [(r["prefix"], r["is_key"]) for r in quality.key_prefixes(frame("a int, b int, c int", rows), list(columns)).orderBy("prefix").collect()]

    assert prefixes([(1, 1, 1), (1, 2, 1), (2, 1, 1)]) == [(1, False), (2, True), (3, True)]
    assert prefixes([(1, 1, 1), (2, 2, 1)]) == [(1, True), (2, True), (3, True)]
    assert prefixes([(1, 1, 1)] * 2) == [(1, False), (2, False), (3, False)]
    # NULL is a value; a prefix that only nearly is a key passes the sketch and fails the count.
    nearly = [(k, None, 0) for k in range(300)] + [(7, None, 1), (8, 8, 2)]
    assert prefixes(nearly) == [(1, False), (2, False), (3, True)]


def test_key_prefixes_start_no_job(spark, frame):
    spark.sparkContext.setJobGroup("key-prefixes", "")
    quality.key_prefixes(frame("a int, b int", [(1, 1), (1, 2)]), ["a", "b"])
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("key-prefixes")
    spark.sparkContext._jsc.clearJobGroup()


PROGRAMME = """mech_code string, psnu string, sitename string, funding_agency string, indicator string, numeratordenom string,
    standardizeddisaggregate string, otherdisaggregate string, statushiv string, trendscoarse string,
    categoryoptioncomboname string, qtr1 double"""


def programme_row(site, indicator, value, dis="Total Numerator", nd="N", other=None, status=None, coarse=None, combo=None, agency="AG"):
    return ("1", "p", site, agency, indicator, nd, dis, other, status, coarse, combo, value)


@pytest.mark.parametrize(
    ("message", "rows_"),
    [
        ("OVC Serv exited without GRAD / OVC_SERV> 10%", [
            programme_row("s", "OVC_SERV", 2.0, "ProgramStatus", other="Exited without Graduation"), programme_row("s", "OVC_SERV", 10.0)]),
        ("OVC_HIVSTAT not equal to OVC_SERV <18", [
            programme_row("s", "OVC_HIVSTAT", 2.0), programme_row("s", "OVC_SERV", 3.0, "Age/Sex/ProgramStatus", coarse="<18")]),
        ("Index_offered<Index_accepted", [
            programme_row("s", "HTS_INDEX", 1.0, "1:Age/Sex/IndexCasesOffered"), programme_row("s", "HTS_INDEX", 2.0, "2:Age/Sex/IndexCasesAccepted")]),
        ("Index_contacts <contacts_ new_pos + contacts_ new_neg + contacts_ known_pos", [
            programme_row("s", "HTS_INDEX", 2.0, "3:Age Aggregated/Sex/Contacts"),
            programme_row("s", "HTS_INDEX", 1.0, "4:Age/Sex/Result", other="Known at Entry", status="Positive"),
            programme_row("s", "HTS_INDEX", 1.0, "4:Age/Sex/Result", other="Newly Identified", status="Positive"),
            programme_row("s", "HTS_INDEX", 1.0, "4:Age/Sex/Result", other="Newly Identified", status="Negative")]),
        ("HTS_TST_POS (>=15) < HTS_RECENT", [
            programme_row("s", "HTS_TST", 1.0, "x", combo="50+, Male, Positive"), programme_row("s", "HTS_TST", 9.0, "x", combo="10-14, Male, Positive"),
            programme_row("s", "HTS_RECENT", 2.0)]),
        ("TX_NEW > TX_CURR", [programme_row("s", "TX_NEW", 2.0), programme_row("s", "TX_CURR", 1.0)]),
        ("TX_PVLS_N >  TX_PVLS_D", [programme_row("s", "TX_PVLS", 2.0), programme_row("s", "TX_PVLS", 1.0, nd="D")]),
        ("PMTCT_EID 0-2months > PMTCT_STAT_POS+HTS_TST_POS_PMTCT", [
            programme_row("s", "PMTCT_EID", 3.0, combo="<= 2 months"), programme_row("s", "PMTCT_STAT", 1.0, combo="10-14, Newly Identified Positive"),
            programme_row("s", "HTS_TST", 1.0, "PMTCT PostANC/Age/Sex/Result", combo="15-19, Female, Positive")]),
        ("TX ML IIT <3 > IIT 3+", [
            programme_row("s", "TX_ML", 3.0, "x", combo="Interruption (<3 Months)"), programme_row("s", "TX_ML", 1.0, "x", combo="Interruption (3-5 Months)"),
            programme_row("s", "TX_ML", 1.0, "x", combo="Interruption (6+ Months)")]),
    ],
)
def test_programme_rule_table(frame, message, rows_):
    found = quality.findings(frame(PROGRAMME, rows_), KEYS, rules.programme_rules("AG"), {"'FY23Q1'": "qtr1"}, TODAY)
    assert message in [r.check for r in found.collect()]


def test_rule_tables_are_checked_before_any_job(spark, frame):
    fact = frame(PROGRAMME, [])
    good = {"name": "r", "message": "m", "left": "indicator = 'A'", "right": ["indicator = 'B'"], "comparison": "<"}
    bad = [
        good, {**good, "message": ""}, {**good, "name": "c", "comparison": "~"}, {**good, "name": "l", "comparison": "share >"},
        {**good, "name": "e", "right": []}, {**good, "name": "s", "left": "indicator = = 'A'"}, {**good, "name": "u", "right": ["nothing = 1"]},
        {**good, "name": "n", "left": "qtr1 + 1"},
    ]
    spark.sparkContext.setJobGroup("rule-checks", "")
    with pytest.raises(ValueError) as fault:
        rules.compile_rules(bad, fact)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("rule-checks")
    spark.sparkContext._jsc.clearJobGroup()
    text = str(fault.value)
    for part in ("rule 2 (r): no message", "rule 2 (r): the name", "unknown comparison '~'", "a share needs a limit", "rule 5 (e): a condition is missing",
                 "rule 6 (s): indicator = =", "rule 7 (u): nothing = 1", "rule 8 (n): not a condition"):
        assert part in text, part
    assert "rule 1 " not in text


def test_rules_from_a_table_give_the_same_findings(spark, frame, tmp_path):
    rows_ = [programme_row("s", "TX_NEW", 2.0), programme_row("s", "TX_CURR", 1.0), programme_row("s", "TX_ML", 5.0)]
    fact = frame(PROGRAMME, rows_)
    table = [
        {"name": "b", "message": "whole", "left": "indicator = 'TX_NEW'", "right": ["indicator = 'TX_CURR'"], "comparison": "whole <"},
        {"name": "a", "message": "more", "left": "indicator = 'TX_ML'", "right": ["indicator = 'TX_NEW'", "indicator = 'TX_CURR'"], "comparison": ">",
         "indicator": "TX_ML", "type_check": "Own", "level": "Level 3"},
    ]
    rules.rule_table(spark, table).write.json(str(tmp_path / "rules"))
    own = rules.rules_from(spark.read.schema(rules.RULE_SCHEMA).json(str(tmp_path / "rules")), fact)
    assert [r.name for r in own] == ["a", "b"]
    found = quality.findings(fact, KEYS, own, {"'FY23Q1'": "qtr1"}, TODAY).collect()
    assert [(r.level, r.type_check, r.indicator, r.check) for r in found] == [("Level 3", "Own", "TX_ML", "more")]


# --- conform ---------------------------------------------------------------

def test_conform_folds_bands_and_names(frame, rows):
    feed = frame("site string, indicator string, CoarseAgeGroup string, Total double", [
        ("s", "TX_PVLS_Denom", "50-54", 1.0), ("s", "TX_PVLS_Denom", "65+", 2.0), ("s", "TX_CURR", "65+", 3.0), ("s", "TX_CURR", None, 4.0),
    ])
    got = conform.conform(feed, "Total")
    assert rows(got, "indicator", "numeratordenom", "CoarseAgeGroup", "Total") == [
        ("TX_CURR", "N", "65+", 3.0), ("TX_CURR", "N", None, 4.0), ("TX_PVLS", "D", "50+", 3.0),
    ]
    assert conform.conform(feed, "Total", strict_parity=True).filter("CoarseAgeGroup IS NULL").isEmpty()


def test_facility_list_periods(frame, rows):
    mfl = frame("ou5name string, fy22q1_dsd string, fy22q2_dsd string", [("A", "DSD+Roving TA", None), ("B", "TA", "DSD")])
    got = rows(conform.facility_periods(mfl, ["ou5name"], "fy22"))
    assert got == [("A", "FY22Q1", "DSD"), ("A", "FY22Q2", None), ("B", "FY22Q1", "TA"), ("B", "FY22Q2", "DSD")]


def test_consolidation_and_repeats(frame, rows):
    schema = "mech string, site string, element string, value double"
    a = frame(schema, [("1", "s", "e", 1.0), ("1", "s", "e", 1.0), ("1", "s", None, 2.0), ("1", "t", "e", 0.0)])
    b = frame(schema + ", extra string", [("1", "s", "e", 5.0, "z"), ("2", "s", "x", 5.0, "z")])
    out = conform.consolidate([a, b.drop("extra")], "2022Q3", F.col("element") == "x", drop_zero=True)
    assert rows(out) == [("1", "s", "e", 1.0, "2022Q3"), ("1", "s", "e", 5.0, "2022Q3")]
    assert [r.dupe_count for r in conform.repeated_records(out).collect()] == [2, 2]


def test_dispensing_keeps_unmapped_packs(frame, rows):
    feed = frame("site string, r string, b string, Packs double", [("s", "13", "A", 1.0), ("s", "14", "A", 2.0), ("s", "99", "A", 4.0)])
    mapping = frame("code string, band string, element string", [("13", "A", "TLD"), ("14", "A", "TLD")])
    got = conform.map_dispensing(feed, mapping, ["site"], {"r": "code", "b": "band"})
    assert rows(got) == [("s", "TLD", 3.0), ("s", None, 4.0)]


def test_rename_merges_sites(frame, rows):
    feed = frame("Facility string, Code string, Total double", [("old", "1", 1.0), ("new", "2", 2.0), ("other", "3", 4.0)])
    renames = frame("old_name string, new_name string, new_code string", [("old", "new", "2")])
    assert rows(conform.rename_sites(feed, renames, "Facility", "Code", "Total")) == [("new", "2", 3.0), ("other", "3", 4.0)]


def test_staffing_records(frame, rows):
    counts = frame("OrgUnit string, n double, c double, l double", [("a", 1.0, 2.0, None), ("b", None, None, 0.0)])
    got = conform.staffing_submission(counts, ["OrgUnit"], {"Clinical": ["n", "c"], "Lay": ["l"]}, "el", "2023Q3")
    assert rows(got, "OrgUnit", "CategoryOptionCombo", "Value") == [("a", "mkOfrTuz7tS", 3.0)]
    strict = conform.staffing_submission(counts, ["OrgUnit"], {"All": ["n", "l"]}, "el", "2023Q3", skip_null=False)
    assert strict.isEmpty()


def test_district_and_age_spellings(frame, rows):
    df = frame("x string", [("Nelson Mandela Bay Metropolitan Municipality",), ("OR Tambo",), ("uThukela",), ("Other",)])
    assert rows(df.select(conform.area_names("x").alias("r"))) == [
        ("Nelson Mandela Bay Municipality",), ("Oliver Tambo District Municipality",), ("Other",), ("Uthukela District Municipality",),
    ]
    ages = frame("x string", [("Less than one year",), ("1-4 years",), ("70-74 years",), ("85 + years",), ("20-24 years",)])
    got = [r[0] for r in rows(ages.select(conform.age_bands("x").alias("r")))]
    assert got == ["01-04", "20-24", "65+", "65+", "<01"]


def test_expected_sites(frame, rows):
    fact = frame("uid string, v double", [("a", 0.0), ("b", 5.0), ("c", 0.0)])
    listed = frame("uid string, expected string", [("a", "YES"), ("b", "YES"), ("d", "YES")])
    assert rows(conform.expected_but_zero(fact, listed, "uid", "expected", "v"), "uid", "flag") == [
        ("a", "FLAG"), ("b", "OK"), ("c", "OK"), ("d", "OK"),
    ]


def test_wrong_ids(frame, rows):
    names = frame("n string, uid string", [("A", "1"), ("A", "2"), ("B", "3")])
    wrong = conform.wrong_ids(names, "n", "uid", 1, frame("u string", [("1",)]), "u")
    assert rows(wrong) == [("A", "2")]
    assert rows(conform.without_wrong_ids(names, wrong, "uid")) == [("A", "1"), ("B", "3")]


# --- products --------------------------------------------------------------

def test_achievement_masks_and_rounds(frame, rows):
    fact = frame(
        "mech_code string, indicator string, qtr1 double, cumulative double, targets double",
        [("1", "TX_CURR", 1.0, 85.0, 100.0), ("1", "TX_NET_NEW", 1.0, 5.0, 10.0), ("1", "TX_NEW", 1.0, 1.0, 0.0), ("1", "OTHER", 1.0, 1.0, 1.0)],
    )
    got = products.achievement_table(
        fact, ["mech_code"], ["TX_NEW", "TX_NET_NEW", "TX_CURR"], ["TX_NET_NEW"], [(0.9, "behind"), (9.9, "met")],
        measures=("qtr1", "cumulative", "targets"),
    )
    assert rows(got, "order_index", "indicator", "achievement", "cumulative", "status") == [
        (1, "TX_NEW", None, 1.0, None), (2, "TX_NET_NEW", None, None, "NA"), (3, "TX_CURR", 0.85, 85.0, "behind"),
    ]


def test_site_series_carries_attributes(frame, rows):
    long = frame(
        "site string, name string, indicator string, period string, period_type string, value double",
        [("s", "S", "TX", "1", "results", 5.0), ("s", "S", "TX", "3", "results", 7.0), ("t", "T", "TX", "2", "results", 1.0), ("t", "T", "TX", "2", "targets", 9.0)],
    )
    got = products.site_series(long, "TX", ["site"], ["name"], ["site"], steps=(1,))
    assert rows(got.filter("site = 's'"), "period", "indicator", "value", "name", "source_name") == [
        ("1", "TX", 5.0, "S", "Reported"), ("1", "TX_LAG1", None, "S", "Derived"), ("2", "TX", 0.0, "S", "Reported"),
        ("2", "TX_LAG1", 5.0, "S", "Derived"), ("3", "TX", 7.0, "S", "Reported"), ("3", "TX_LAG1", 0.0, "S", "Derived"),
    ]
    assert got.count() == 2 * 3 * 2


def test_partner_geography(frame, rows):
    fact = frame("site string, mech_code string, v int", [("a", "70310", 1), ("a", "70310", 2), ("b", "9", 1)])
    got = products.partner_geography(fact, ["site", "mech_code"], {"70310": "Care & Treatment"})
    assert rows(got) == [("a", "70310", "Care & Treatment"), ("b", "9", "")]


def test_sorting_by_category_total(frame):
    df = frame("c string, v double", [("a", 1.0), ("b", 5.0), ("a", 1.0), (None, 3.0)])
    assert [r.c for r in products.sort_by_total(df, "c", "v").collect()] == ["a", "a", None, "b"]


def test_quality_report_layout(frame):
    fact = frame(
        "mech_code string, psnu string, sitename string, indicator string, numeratordenom string, fiscal_year int, qtr1 double, qtr2 double, targets double, cumulative double",
        [("1", "p", "s", "A", "N", 2023, 3.0, 0.0, 5.0, 0.0), ("1", "p", "s", "A", "D", 2023, 1.0, 0.0, 0.0, 0.0)],
    )
    level_1 = quality.level_one(fact, [*KEYS, "indicator"], "fiscal_year", ["qtr1", "qtr2"], (2023, 2), TODAY)
    level_2 = quality.findings(fact, KEYS, [quality.numerator_over_denominator("nd", "N > D", "indicator = 'A'")], PERIODS, TODAY)
    out = quality.report(level_1, level_2)
    assert out.columns == list(quality.FINDING)
    got = sorted((r.level, r.period, r.indicator, r.check) for r in out.select("level", "period", F.coalesce("indicator", F.lit("")).alias("indicator"), "check").collect())
    assert got == [
        ("Level 1", "FY23", "A", "Targets reported but results blank"),
        ("Level 1", "FY23Q2", "A", "Value reported in previous quarter but missing in this quarter"),
        ("Level 2", "FY23Q1", "", "N > D"),
    ]
    assert {r.type_check for r in level_1.collect()} == {"Target without result", "Result in previous quarter"}


def test_gaps_over_the_year_end(frame):
    rows = [
        ("stays", 2022, None, None, 0.0, 5.0), ("stays", 2023, 1.0, 1.0, 1.0, 1.0), ("empty", 2022, 0.0, 0.0, 0.0, 5.0), ("empty", 2023, None, 2.0, 2.0, 2.0),
        ("gone", 2022, 0.0, 0.0, 0.0, 5.0), ("skips", 2021, 0.0, 0.0, 0.0, 1.0), ("skips", 2023, 1.0, 1.0, 1.0, 1.0), ("last", 2023, 1.0, 1.0, 1.0, 3.0),
        ("inside", 2023, 1.0, 0.0, 1.0, 1.0),
    ]
    fact = frame("site string, fiscal_year int, q1 double, q2 double, q3 double, q4 double", rows).selectExpr("*", "0D AS targets", "0D AS cumulative")
    args = (fact, ["site"], "fiscal_year", ["q1", "q2", "q3", "q4"])
    got = sorted((r.site, r.period) for r in quality.level_one(*args, (2023, 4), TODAY).collect())
    assert got == [("empty", "FY23Q1"), ("gone", "FY23Q1"), ("inside", "FY23Q2"), ("skips", "FY22Q1")]
    assert sorted(r.site for r in quality.level_one(*args, (2022, 4), TODAY).collect()) == ["skips"]
    assert ("last", "FY24Q1") in {(r.site, r.period) for r in quality.level_one(*args, (2024, 1), TODAY).collect()}


def test_site_fact_appends_lags(frame, rows):
    fact = frame(
        "psnu string, site string, mech_code string, indicator string, fiscal_year int, qtr1 double, qtr2 double, cumulative double",
        [("p", "s", "1", "TX", 2022, 5.0, 7.0, 7.0), ("p", "s", "1", "HTS", 2022, 1.0, 1.0, 2.0), ("p", "t", "1", "TX", 2022, None, 3.0, 3.0)],
    )
    out = products.site_fact(fact, ["TX", "HTS"], "TX", ["site", "mech_code"], ["psnu"], ["site", "mech_code"], steps=(1,))
    assert {"TX", "HTS", "TX_LAG1", "DSPID", "HIGHBURDEN"} <= set(out.columns)
    got = rows(out.filter("indicator = 'TX_LAG1'"), "site", "period", "value", "TX_LAG1", "psnu", "DSPID", "source_name")
    assert got == [
        ("s", "FY22Q1", None, None, "p", "1p", "Derived"), ("s", "FY22Q2", 5.0, 5.0, "p", "1p", "Derived"),
        ("t", "FY22Q1", None, None, "p", "1p", "Derived"), ("t", "FY22Q2", 0.0, 0.0, "p", "1p", "Derived"),
    ]
    assert out.filter("indicator = 'HTS'").count() == 3


def test_semi_wide_product_with_attributes(frame, rows):
    fact = frame(
        "DSPID string, indicator string, fiscal_year int, qtr1 double, qtr2 double, cumulative double, targets double",
        [("a", "TX", 2022, 1.0, None, 1.0, 4.0), ("a", "TX", 2022, 2.0, None, 2.0, 4.0)],
    )
    out = products.semi_wide_fact(fact, ["DSPID", "indicator"], frame("DSPID string, DSP string", [("a", "Yes")]))
    assert rows(out, "period", "results", "cumulative", "targets", "DSP") == [
        ("FY22", None, 3.0, 8.0, "Yes"), ("FY22Q1", 3.0, None, None, "Yes"), ("FY22Q2", 0.0, None, None, "Yes"),
    ]


def test_submission_import(frame, rows):
    feed = frame("site_uid string, indicator string, CoarseAgeGroup string, period string, Total double", [
        ("u", "TX_PVLS_Numer", "50-54", "FY22Q3", 1.0), ("u", "TX_PVLS_Numer", "65+", "FY22Q3", 2.0), ("u", "TX_NEW", None, "FY22Q3", 9.0),
    ])
    mapping = frame("indicator string, numeratordenom string, age string, de string, coc string", [("TX_PVLS", "N", "50+", "DE", "COC")])
    sites, mechs = frame("uid string, mech_code string", [("u", "70310")]), frame("mech_code string, mech_uid string", [("70310", "M")])
    out = conform.submission_import(
        feed, "Total", mapping, {"indicator": "indicator", "numeratordenom": "numeratordenom", "CoarseAgeGroup": "age"}, sites, mechs,
        {"site_uid": "uid"},
        {"mech_uid": "mech_uid", "orgUnit_uid": "site_uid", "dataElement_uid": "de", "categoryOptionCombo_uid": "coc", "value": "Total"},
    )
    assert out.columns == list(conform.SUBMISSION)
    assert rows(out) == [("M", "u", "DE", "COC", 3.0, "FY22Q3")]


def test_missing_from_submission(frame, rows):
    fact = frame("uid string, indicator string, qtr2 double", [("a", "TX", 5.0), ("b", "TX", 1.0), ("c", "TX", 2.0)])
    submitted = frame("site string, indicator string, value double", [("a", "TX", 4.0), ("a", "TX", 1.0), ("b", "TX", None)])
    got = quality.missing_from_submission(
        fact, submitted, {"uid": "site", "indicator": "indicator"}, "value", ["uid", "indicator"], "FY22Q3", TODAY
    )
    assert rows(got, "uid", "period", "level") == [("b", "FY22Q3", "Level 1"), ("c", "FY22Q3", "Level 1")]
