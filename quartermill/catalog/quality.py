"""Queries for the data-quality rules."""

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quartermill.catalog.joining import full_reconcile
from quartermill.catalog.registry import query
from quartermill.catalog.series import _GRID_SQL, packed_grid
from quartermill.catalog.tables import Tables, iso, wide_sql, with_sql
from quartermill.functions.periods import fiscal_quarter, fiscal_year
from quartermill.operators.aggregates import side_by_side
from quartermill.plans import quality
from quartermill.plans.conform import without_wrong_ids

SITE = ["orgunituid", "mech_code", "fiscal_year"]
TODAY = dt.date(2023, 4, 24)
_FY = "concat('FY', substring(fiscal_year, 3, 2){})"
YEARLY = {_FY.format(""): "cumulative"}
QUARTERLY = {_FY.format(f", 'Q{i}'"): f"qtr{i}" for i in range(1, 5)}

_FY_SQL = "'FY' || right(CAST(fiscal_year AS VARCHAR), 2)"


def report(t: Tables, found: DataFrame) -> DataFrame:
    """Findings with their site's name and area, in the reported columns."""
    return iso(t.with_site(found, ["sitename", "psnu"]), "today_date").select(
        "psnu", "sitename", "mech_code", "level", "type_check", "period", "indicator", "check", "today_date"
    )


def _yearly_sql(terms: dict[str, str], where: str, check: str, level: str = "Level 2", type_check: str = "IntraIndicator") -> str:
    """One rule as plain SQL over the line rows, yearly grain."""
    sums = ", ".join(f"sum(CASE WHEN {cond} THEN value END) AS {name}" for name, cond in terms.items())
    return (
        f"SELECT psnu, sitename, mech_code, '{level}' AS level, '{type_check}' AS type_check, {_FY_SQL} AS period, "
        f"CAST(NULL AS VARCHAR) AS indicator, '{check}' AS \"check\", '2023-04-24' AS today_date FROM "
        f"(SELECT snu1, psnu, orgunituid, sitename, mech_code, fiscal_year, {sums} FROM lines GROUP BY ALL) WHERE {where}"
    )


def yearly_facts(t: Tables, rules: list[quality.Rule]) -> DataFrame:
    """The fact at line level with the columns the rules look at."""
    conditions = " ".join(c for r in rules for c in r.terms.values())
    dims = ["indicator", "numeratordenom", "standardizeddisaggregate", "ageasentered"]
    return t.lines([*SITE, *[d for d in dims if d in conditions], "value"]).withColumnRenamed("value", "cumulative")


def yearly_findings(t: Tables, rules: list[quality.Rule]) -> DataFrame:
    """Findings of the given rules at site, mechanism and year."""
    return quality.findings(yearly_facts(t, rules), SITE, rules, YEARLY, TODAY)


N_OVER_D = quality.numerator_over_denominator("n_over_d", "A_N > A_D", "indicator = 'A'")
A_LESS_R = quality.less_than("a_less_r", "A < R", "indicator = 'A'", "indicator = 'R'")
A_NOT_N = quality.differs("a_not_n", "A not equal to N", "indicator = 'A'", "indicator = 'N'")
LARGE_OVER_TOTAL = quality.greater_than(
    "large_over_small", "LARGE > SMALL", "ageasentered = 'LARGE'", "ageasentered = 'SMALL'"
)
PARTS = quality.less_than_sum(
    "a_less_parts", "A < N SMALL + N LARGE + R without age",
    "indicator = 'A'",
    ["indicator = 'N' AND ageasentered = 'SMALL'", "indicator = 'N' AND ageasentered = 'LARGE'", "indicator = 'R' AND ageasentered IS NULL"],
)
CROSS = quality.greater_than_sum(
    "r_over_parts", "R > A N + N D", "indicator = 'R'",
    ["indicator = 'A' AND numeratordenom = 'N'", "indicator = 'N' AND numeratordenom = 'D'"],
)
RATIO = quality.share_above(
    "r_share", "R with BUILDING / R > 10%",
    "indicator = 'R' AND standardizeddisaggregate = 'BUILDING'", "indicator = 'R'", 0.10,
)

_N_OVER_D_SQL = _yearly_sql(
    {"n": "indicator = 'A' AND numeratordenom = 'N'", "d": "indicator = 'A' AND numeratordenom = 'D'"}, "n > d", "A_N > A_D"
)
_COMPARE_SQL = " UNION ALL ".join(
    [
        _yearly_sql({"a": "indicator = 'A'", "b": "indicator = 'R'"}, "a < b", "A < R"),
        _yearly_sql({"a": "indicator = 'A'", "b": "indicator = 'N'"}, "a <> b", "A not equal to N"),
        _yearly_sql({"a": "ageasentered = 'LARGE'", "b": "ageasentered = 'SMALL'"}, "a > b", "LARGE > SMALL"),
    ]
)
_SUM_COMPARE_SQL = " UNION ALL ".join(
    [
        _yearly_sql(
            {
                "a": "indicator = 'A'", "p": "indicator = 'N' AND ageasentered = 'SMALL'",
                "q": "indicator = 'N' AND ageasentered = 'LARGE'", "r": "indicator = 'R' AND ageasentered IS NULL",
            },
            "a < p + q + r", "A < N SMALL + N LARGE + R without age",
        ),
        _yearly_sql(
            {
                "a": "indicator = 'R'", "p": "indicator = 'A' AND numeratordenom = 'N'",
                "q": "indicator = 'N' AND numeratordenom = 'D'",
            },
            "a > p + q", "R > A N + N D",
        ),
    ]
)
_RATIO_SQL = _yearly_sql(
    {"part": "indicator = 'R' AND standardizeddisaggregate = 'BUILDING'", "whole": "indicator = 'R'"},
    "CASE WHEN whole = 0 THEN part > 0 ELSE part / whole > 0.10::DOUBLE END", "R with BUILDING / R > 10%",
)
LEVEL_1_KEYS = ["orgunituid", "mech_code", "indicator", "fiscal_year"]
_TARGET_SQL = f"""SELECT psnu, sitename, mech_code, 'Level 1' AS level, 'Target without result' AS type_check, {_FY_SQL} AS period,
       indicator, 'Targets reported but results blank' AS "check", '2023-04-24' AS today_date
FROM (SELECT psnu, orgunituid, sitename, mech_code, indicator, fiscal_year, sum(target) AS targets,
             sum(CASE WHEN numeratordenom = 'D' AND quarter = 1 THEN value ELSE 0 END) AS cumulative
      FROM lines GROUP BY ALL) WHERE targets > 0 AND cumulative = 0"""
_PRIOR_SQL = """SELECT psnu, sitename, mech_code, 'Level 1' AS level, 'Result in previous quarter' AS type_check,
       'FY' || right(CAST((p + 1) // 4 AS VARCHAR), 2) || 'Q' || CAST((p + 1) % 4 + 1 AS VARCHAR) AS period,
       indicator, 'Value reported in previous quarter but missing in this quarter' AS "check", '2023-04-24' AS today_date
FROM reported a WHERE p + 1 <= (SELECT max(fiscal_year * 4 + quarter - 1) FROM lines) AND NOT EXISTS (
  SELECT 1 FROM reported b WHERE b.p = a.p + 1 AND b.orgunituid = a.orgunituid AND b.mech_code = a.mech_code AND b.indicator = a.indicator)"""
_REPORTED_SQL = """SELECT psnu, orgunituid, sitename, mech_code, indicator, fiscal_year * 4 + quarter - 1 AS p
FROM lines GROUP BY ALL HAVING sum(value) > 0"""


def last_due(t: Tables) -> Column:
    """The last period that is due, here the last one reported: no gap is reported after it."""
    newest = t.read("lineitem").agg(F.max("l_shipdate").alias("day"))
    return newest.select(fiscal_year("day") * 4 + fiscal_quarter("day") - 1).scalar()


def level_one_fact(t: Tables) -> DataFrame:
    """Targets, quarters and a cumulative result (here: the first quarter's denominator) per key."""
    rows = t.lines([*LEVEL_1_KEYS, "numeratordenom", "quarter", "value", "target"])
    reached = F.when((F.col("numeratordenom") == "D") & (F.col("quarter") == 1), F.col("value")).otherwise(0.0)
    quarters = [F.sum(F.when(F.col("quarter") == i, F.col("value"))).alias(f"qtr{i}") for i in range(1, 5)]
    return rows.groupBy(*LEVEL_1_KEYS).agg(
        F.sum("target").alias("targets"), F.sum(reached).alias("cumulative"), *quarters
    )


def level_one(t: Tables, *checks: tuple[str, str]) -> DataFrame:
    """Level 1 findings of the given checks."""
    keys = [k for k in LEVEL_1_KEYS if k != "fiscal_year"]
    return quality.level_one(level_one_fact(t), keys, "fiscal_year", [f"qtr{i}" for i in range(1, 5)], last_due(t), TODAY, checks)


def every_finding(t: Tables, rules: list[quality.Rule]) -> DataFrame:
    """Both levels in one pass over the rows."""
    rows = t.lines([*LEVEL_1_KEYS, "numeratordenom", "standardizeddisaggregate", "ageasentered", "quarter", "value", "target"])
    reached = {"targets": "target", "cumulative": "if(numeratordenom = 'D' AND quarter = 1, value, 0.0D)"}
    quarters = {q: f"if(quarter = {q}, value, NULL)" for q in range(1, 5)}
    return quality.both_levels(
        rows, ["orgunituid", "mech_code"], "fiscal_year", ["A", "N", "R"], reached, quarters, last_due(t), rules, "value", _FY.format(""), TODAY)


@query("rule_target_no_result", with_sql(_TARGET_SQL, "lines"))
def rule_target_no_result(t: Tables) -> DataFrame:
    return report(t, level_one(t, quality.TARGET_CHECK))


@query("rule_prior_missing", with_sql(_PRIOR_SQL, "lines", reported=_REPORTED_SQL))
def rule_prior_missing(t: Tables) -> DataFrame:
    return report(t, level_one(t, quality.PRIOR_CHECK))


@query(
    "rule_missing_in_submission",
    with_sql(
        """SELECT orgunituid, mech_code, indicator, 'FY96Q2' AS period, 'Level 1' AS level, 'Result in previous quarter' AS type_check,
                  'Value reported in previous quarter but missing in this quarter' AS "check"
           FROM (SELECT orgunituid, mech_code, indicator FROM lines WHERE fiscal_year = 1996 AND quarter = 1 GROUP BY ALL) q1
           WHERE NOT EXISTS (SELECT 1 FROM lines s WHERE s.fiscal_year = 1996 AND s.quarter = 2 AND s.orgunituid = q1.orgunituid
                             AND s.mech_code = q1.mech_code AND s.indicator = q1.indicator)""",
        "lines",
    ),
)
def rule_missing_in_submission(t: Tables) -> DataFrame:
    keys = ["orgunituid", "mech_code", "indicator"]
    rows = t.lines([*keys, "quarter", "value"], [1996]).filter("quarter IN (1, 2)")
    # One pass gives both quarters per key.
    both = rows.groupBy(*keys).agg(
        F.sum(F.when(F.col("quarter") == 1, F.col("value"))).alias("previous"),
        F.sum(F.when(F.col("quarter") == 2, F.col("value"))).alias("submitted"),
    )
    submitted = both.select(F.col("orgunituid").alias("site"), F.col("mech_code").alias("mech"), "indicator", "submitted")
    on = {"orgunituid": "site", "mech_code": "mech", "indicator": "indicator"}
    reported = both.filter("previous IS NOT NULL")
    return quality.missing_from_submission(reported, submitted, on, "submitted", keys, "FY96Q2", TODAY).drop("today_date")


@query("rule_ratio", with_sql(_RATIO_SQL, "lines"))
def rule_ratio(t: Tables) -> DataFrame:
    return report(t, yearly_findings(t, [RATIO]))


@query("rule_compare", with_sql(_COMPARE_SQL, "lines"))
def rule_compare(t: Tables) -> DataFrame:
    return report(t, yearly_findings(t, [A_LESS_R, A_NOT_N, LARGE_OVER_TOTAL]))


@query("rule_sum_compare", with_sql(_SUM_COMPARE_SQL, "lines"))
def rule_sum_compare(t: Tables) -> DataFrame:
    return report(t, yearly_findings(t, [PARTS, CROSS]))


@query("rule_nd", with_sql(_N_OVER_D_SQL, "lines"))
def rule_nd(t: Tables) -> DataFrame:
    return report(t, yearly_findings(t, [N_OVER_D]))


@query(
    "rule_missing_as_zero",
    with_sql(
        _yearly_sql({"a": "indicator = 'A'", "b": "indicator = 'R'"}, "coalesce(a, 0) < coalesce(b, 0)", "A < R"), "lines"
    ),
)
def rule_missing_as_zero(t: Tables) -> DataFrame:
    rules = [A_LESS_R]
    return report(t, quality.findings(yearly_facts(t, rules), SITE, rules, YEARLY, TODAY, missing_as_zero=True))


@query(
    "rule_lagged",
    with_sql(
        """SELECT facility, event_type, CAST(day AS VARCHAR) AS day, value_lag2, value, 'two periods ago > now' AS "check" FROM
             (SELECT *, lag(value, 2) OVER (PARTITION BY facility, event_type ORDER BY day) AS value_lag2 FROM grid)
           WHERE value_lag2 > value""",
        "series",
        grid=_GRID_SQL,
    ),
)
def rule_lagged(t: Tables) -> DataFrame:
    return iso(quality.lagged_comparison(packed_grid(t), "value", "value", 2, "two periods ago > now"), "day")


@query(
    "findings_by_level",
    with_sql(
        f"""SELECT level, mech_code, "check", count(*) AS findings FROM
              ({_TARGET_SQL} UNION ALL {_PRIOR_SQL} UNION ALL {_N_OVER_D_SQL} UNION ALL {_COMPARE_SQL}
               UNION ALL {_SUM_COMPARE_SQL} UNION ALL {_RATIO_SQL}) GROUP BY ALL""",
        "lines",
        reported=_REPORTED_SQL,
    ),
)
def findings_by_level(t: Tables) -> DataFrame:
    every = every_finding(t, [N_OVER_D, A_LESS_R, A_NOT_N, LARGE_OVER_TOTAL, PARTS, CROSS, RATIO])
    return every.groupBy("level", "mech_code", "check").agg(F.count(F.lit(1)).alias("findings"))


@query(
    "rule_summary",
    with_sql(
        """SELECT rule, items, passes, fails, missing FROM (
             SELECT 'listed' AS rule, count(*) AS items, count(CASE WHEN orgunit_name IS NOT NULL THEN 1 END) AS passes,
                    count(CASE WHEN orgunit_name IS NULL THEN 1 END) AS fails, 0::BIGINT AS missing FROM joined
             UNION ALL
             SELECT 'reported', count(*), count(CASE WHEN sitename IS NOT NULL THEN 1 END),
                    count(CASE WHEN sitename IS NULL THEN 1 END), 0 FROM joined
             UNION ALL
             SELECT 'same_name', count(*), count(CASE WHEN sitename = orgunit_name THEN 1 END),
                    count(CASE WHEN sitename <> orgunit_name THEN 1 END),
                    count(CASE WHEN sitename IS NULL OR orgunit_name IS NULL THEN 1 END) FROM joined)""",
        "lines",
        "roster",
        joined="""SELECT a.sitename, b.orgunit_name FROM
                    (SELECT DISTINCT orgunituid, sitename FROM lines) a
                    FULL JOIN (SELECT orgunituid, sitename AS orgunit_name FROM roster) b ON a.orgunituid = b.orgunituid""",
    ),
)
def rule_summary(t: Tables) -> DataFrame:
    rules = {
        "listed": "orgunit_name IS NOT NULL", "reported": "sitename IS NOT NULL", "same_name": "sitename = orgunit_name",
    }
    return quality.completeness(full_reconcile(t), rules)


@query(
    "value_mismatch",
    with_sql(
        """SELECT a.orgunituid, a.indicator, a.submitted, b.source FROM
             (SELECT orgunituid, indicator, sum(value) AS submitted FROM lines WHERE NOT (snu1 = 'ASIA' AND quarter = 2) GROUP BY ALL) a
             LEFT JOIN (SELECT orgunituid, indicator, sum(value) AS source FROM lines GROUP BY ALL) b USING (orgunituid, indicator)
           WHERE submitted <> source""",
        "lines",
    ),
)
def value_mismatch(t: Tables) -> DataFrame:
    keys = ["orgunituid", "indicator"]
    rows = t.lines([*keys, "snu1", "quarter", "value"])
    both = side_by_side(rows, keys, "value", {"submitted": "NOT (snu1 = 'ASIA' AND quarter = 2)", "source": None})
    return both.filter("submitted <> source")


@query(
    "candidate_keys",
    """SELECT * FROM (
         SELECT 1 AS prefix, 'l_orderkey' AS columns, (SELECT max(n) FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey)) = 1 AS is_key
         UNION ALL SELECT 2, 'l_orderkey, l_linenumber',
           (SELECT max(n) FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)) = 1
         UNION ALL SELECT 3, 'l_orderkey, l_linenumber, l_partkey',
           (SELECT max(n) FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber, l_partkey)) = 1
         UNION ALL SELECT 4, 'l_orderkey, l_linenumber, l_partkey, l_extendedprice',
           (SELECT max(n) FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber, l_partkey, l_extendedprice)) = 1)""",
)
def candidate_keys(t: Tables) -> DataFrame:
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]
    return quality.key_prefixes(t.read("lineitem"), columns)


@query(
    "site_without_wrong_ids",
    with_sql(
        """SELECT orgunituid, sum(value) AS value FROM lines WHERE orgunituid NOT IN (SELECT orgunituid FROM sites WHERE balance < 0)
           GROUP BY 1""",
        "lines",
        "sites",
    ),
)
def site_without_wrong_ids(t: Tables) -> DataFrame:
    totals = t.lines(["orgunituid", "value"]).groupBy("orgunituid").agg(F.sum("value").alias("value"))
    return without_wrong_ids(totals, t.sites().filter("balance < 0"), "orgunituid")
