"""Queries that run the programme's own rules and products on a programme-like view of the tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermill.catalog.quality import TODAY
from quartermill.catalog.registry import query
from quartermill.catalog.tables import Tables, iso, with_sql
from quartermill.operators.joins import literal_table, match
from quartermill.plans import quality, rules
from quartermill.session import run_folder

TOTAL = "Total Numerator"
#: What a line item stands for, by its part's number: indicator, disaggregate, side, other disaggregate, status, coarse age, combination.
KINDS = [
    *[(i, TOTAL, "N", None, None, None, None) for i in (
        "OVC_SERV", "OVC_HIVSTAT", "PrEP_CT", "PrEP_NEW", "HTS_TST", "HTS_TST_POS", "HTS_RECENT", "TX_NEW", "TX_CURR", "TX_RTT", "SC_ARVDISP")],
    ("OVC_SERV", "ProgramStatus", "N", "Exited without Graduation", None, None, None),
    ("OVC_SERV", "ProgramStatus", "N", "Graduated", None, None, None),
    ("OVC_SERV", "Age/Sex/ProgramStatus", "N", None, None, "<18", None),
    ("PrEP_CT", "KeyPop", "N", None, None, None, None),
    ("PrEP_CT", "TestResult", "N", None, None, None, None),
    ("HTS_INDEX", "1:Age/Sex/IndexCasesOffered", "N", None, None, None, None),
    ("HTS_INDEX", "2:Age/Sex/IndexCasesAccepted", "N", None, None, None, None),
    ("HTS_INDEX", "3:Age Aggregated/Sex/Contacts", "N", None, None, None, None),
    ("HTS_INDEX", "4:Age/Sex/Result", "N", "Known at Entry", "Positive", None, None),
    ("HTS_INDEX", "4:Age/Sex/Result", "N", "Newly Identified", "Negative", None, None),
    ("HTS_INDEX", "4:Age/Sex/Result", "N", "Newly Identified", "Positive", None, None),
    ("HTS_TST", "Modality/Age/Sex/Result", "N", None, "Positive", None, "15-19, Female, Positive"),
    ("HTS_TST", "Modality/Age/Sex/Result", "N", None, "Positive", None, "05-09, Female, Positive"),
    ("HTS_TST", "PMTCT PostANC/Age/Sex/Result", "N", None, "Positive", None, "25-29, Female, Positive"),
    *[(i, "Age/Sex", side, None, None, None, None) for i in ("TB_PREV", "TB_STAT", "TX_PVLS") for side in ("N", "D")],
    ("PMTCT_STAT", "Age/Sex/KnownNewResult", "N", None, None, None, "15-19, Newly Identified Positive"),
    ("PMTCT_STAT", "Age/Sex", "D", None, None, None, "15-19"),
    ("PMTCT_HEI_POS", "Age/HIVStatus", "N", None, None, None, None),
    ("PMTCT_EID", "Age", "N", None, None, None, "<= 2 months"),
    ("PMTCT_ART", "Age/Sex", "N", None, None, None, None),
    *[("TX_ML", "Age/Sex/ARTCauseofDeath", "N", None, None, None, f"Interruption ({span} Months)") for span in ("<3", "3-5", "6+")],
]
KIND_COLUMNS = ["indicator", "standardizeddisaggregate", "numeratordenom", "otherdisaggregate", "statushiv", "trendscoarse", "categoryoptioncomboname"]
#: A user's own rules, in the form of their file.
OWN_RULES = [
    {"name": "pvls_low", "message": "TX_PVLS_D < half of TX_CURR", "comparison": "share >", "limit": 2.0, "type_check": "Own",
     "left": "indicator = 'TX_CURR'", "right": ["indicator = 'TX_PVLS' AND numeratordenom = 'D'"]},
    {"name": "ml_sum", "message": "TX_ML > TX_NEW + TX_RTT", "comparison": ">", "level": "Level 3", "indicator": "TX_ML",
     "left": "indicator = 'TX_ML'", "right": ["indicator = 'TX_NEW'", "indicator = 'TX_RTT'"]},
]
AGENCY = "AGENCY"
KEYS = ["orgunituid", "fiscal_year"]
PERIODS = {f"concat('FY', substring(fiscal_year, 3, 2), 'Q{q}')": f"qtr{q}" for q in range(1, 5)}


def programme(t: Tables) -> DataFrame:
    """The fact as the programme's rules see it, one column per quarter."""
    rows = t.lines(["orgunituid", "fiscal_year", "quarter", "value", "l_partkey", "numeratordenom"])
    kinds = literal_table(t.spark, ["kind", *KIND_COLUMNS], [(k, *kind) for k, kind in enumerate(KINDS)])
    agency = F.expr(f"if(l_partkey % 7 = 0, 'OTHER', '{AGENCY}')").alias("funding_agency")
    quarters = [F.when(F.col("quarter") == q, F.col("value")).alias(f"qtr{q}") for q in range(1, 5)]
    coded = rows.select("orgunituid", "fiscal_year", agency, F.expr(f"cast(l_partkey % {len(KINDS)} AS int)").alias("kind"), *quarters)
    return match(coded, kinds, ["kind"], "inner").drop("kind")


def _text(v) -> str:
    return "NULL" if v is None else "'" + v.replace("'", "''") + "'"


_KINDS_SQL = ", ".join(f"({k}, {', '.join(map(_text, kind))})" for k, kind in enumerate(KINDS))
_PROGRAMME_SQL = f"""SELECT orgunituid, psnu, sitename, fiscal_year, quarter, value, CASE WHEN l_partkey % 7 = 0 THEN 'OTHER' ELSE '{AGENCY}' END AS funding_agency,
       {', '.join('k.' + c for c in KIND_COLUMNS)}
FROM lines JOIN (VALUES {_KINDS_SQL}) k(kind, {', '.join(KIND_COLUMNS)}) ON l_partkey % {len(KINDS)} = k.kind"""
_TESTS_SQL = {
    "<": "a < p", ">": "a > p", "<>": "a <> p", "share >": "CASE WHEN p = 0 THEN a > 0 ELSE a / p > {limit} END", "whole <": "a + p < a",
}


def _rule_sql(row: dict) -> str:
    """One rule as a query of its own."""
    plain = lambda c: c.replace("regexp_like(", "regexp_matches(")
    # A term with rows in a year is 0, not missing, in a quarter without any.
    term = lambda c: f"sum(CASE WHEN {plain(c)} THEN CASE WHEN quarter = q THEN value ELSE 0 END END)"
    total = " + ".join(map(term, row["right"]))
    return f"""SELECT psnu, sitename, {_text(row.get('level') or 'Level 2')} AS level, {_text(row.get('type_check') or 'IntraIndicator')} AS type_check,
        'FY' || right(CAST(fiscal_year AS VARCHAR), 2) || 'Q' || q AS period, {_text(row.get('indicator'))} AS indicator, {_text(row['message'])} AS "check"
      FROM (SELECT psnu, sitename, orgunituid, fiscal_year, q, {term(row['left'])} AS a, {total} AS p
            FROM programme, (SELECT unnest(range(1, 5)) AS q) GROUP BY ALL) WHERE {_TESTS_SQL[row['comparison']].format(limit=f"{row.get('limit')}::DOUBLE")}"""


@query(
    "programme_report",
    with_sql(" UNION ALL ".join(_rule_sql(r) for r in [*rules.programme_rule_rows(AGENCY), *OWN_RULES]), "lines", programme=_PROGRAMME_SQL),
)
def programme_report(t: Tables) -> DataFrame:
    """The 20 rules of the quarterly report and a user's rules from a file, in one pass."""
    fact, folder = programme(t), run_folder(t.spark)
    rules.rule_table(t.spark, OWN_RULES).write.json(folder)
    own = rules.rules_from(t.spark.read.schema(rules.RULE_SCHEMA).json(folder), fact)
    listed = rules.compile_rules(rules.programme_rule_rows(AGENCY), fact)
    found = quality.findings(fact, KEYS, [*listed, *own], PERIODS, TODAY)
    return t.with_site(found, ["sitename", "psnu"]).select("psnu", "sitename", "level", "type_check", "period", "indicator", "check")


@query(
    "feed_rule",
    with_sql(
        """SELECT orgunituid, 'Level 2' AS level, 'IntraIndicator' AS type_check, 'FY' || right(CAST(fiscal_year AS VARCHAR), 2) AS period, 'HTS_TST < HTS_TST_POS' AS "check"
           FROM (SELECT orgunituid, fiscal_year, sum(CASE WHEN indicator = 'A' THEN value END) AS a, sum(CASE WHEN indicator = 'R' THEN value - 26 END) AS p
                 FROM lines GROUP BY ALL) WHERE a + p < a""",
        "lines",
    ),
)
def feed_rule(t: Tables) -> DataFrame:
    """Positive tests against the total of positive and negative ones, on a feed that may correct itself downwards."""
    rows = t.lines(["orgunituid", "fiscal_year", "indicator", "value"])
    result = {"A": "Positive (Reactive)", "R": "Negative (Non-reactive)"}
    feed = rows.select(
        "orgunituid", "fiscal_year", F.lit("HTS_TST").alias("indicator"),
        F.when(F.col("indicator") == "A", result["A"]).when(F.col("indicator") == "R", result["R"]).otherwise("Unknown").alias("result"),
        F.when(F.col("indicator") == "R", F.col("value") - 26).otherwise(F.col("value")).alias("value"))
    found = quality.findings(feed, KEYS, rules.compile_rules([rules.FEED_TESTS], feed), {"concat('FY', substring(fiscal_year, 3, 2))": "value"}, TODAY)
    return found.select("orgunituid", "level", "type_check", "period", "check")


@query(
    "submission_mismatch",
    with_sql(
        """SELECT psnu, indicator, submitted, source, 'FY' || right(CAST(fiscal_year AS VARCHAR), 2) AS period, 'Level 1' AS level,
                  'TriangulationWithSource' AS type_check, 'Value in import does not match source' AS "check", '2023-04-24' AS today_date
           FROM (SELECT psnu, indicator, fiscal_year, sum(value) AS submitted FROM lines WHERE quarter <> 2 OR snu1 <> 'ASIA' GROUP BY ALL)
           JOIN (SELECT psnu, indicator, fiscal_year, sum(value) AS source FROM lines GROUP BY ALL) USING (psnu, indicator, fiscal_year)
           WHERE submitted <> source""",
        "lines",
    ),
)
def submission_mismatch(t: Tables) -> DataFrame:
    """A submission that lacks a quarter of one region, against the source it was made from."""
    keys = ["psnu", "indicator", "fiscal_year"]
    source = t.lines([*keys, "snu1", "quarter", "value"])
    submitted = source.filter("quarter <> 2 OR snu1 <> 'ASIA'")
    return iso(quality.value_mismatch(submitted, source, keys, "value", keys[:2], "concat('FY', substring(fiscal_year, 3, 2))", TODAY), "today_date")
