"""Quality rules as a table: rows of conditions, compiled to the one-pass report.

A rule row has a ``name``, a ``message``, an SQL condition ``left``, a list of SQL conditions
``right``, a ``comparison`` and, for shares, a ``limit``; ``level``, ``type_check`` and
``indicator`` are optional. Rows can come from code or from any table (a JSON or parquet
file of a user). All of them are checked, and all faults named together, before a job
runs on the fact.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from quartermill.plans import lists
from quartermill.plans.quality import LEVEL_2, Rule

#: What a rule table looks like.
RULE_SCHEMA = (
    "name string, message string, left string, right array<string>, comparison string, limit double, "
    "level string, type_check string, indicator string"
)
#: More rules than this are an error: they come to the driver and become one expression.
MOST_RULES = 10_000
#: Condition on the sums: ``a`` is the left one, ``{sum}`` the right ones added up.
COMPARISONS = {
    "<": "a < {sum}",
    ">": "a > {sum}",
    "<>": "a <> {sum}",
    # A positive part over zero is too large a share as well.
    "share >": "CASE WHEN {sum} = 0 THEN a > 0 ELSE try_divide(a, {sum}) > {limit} END",
    # The whole, which is the left and the right sums, is smaller than the left part.
    "whole <": "a + {sum} < a",
}


def faults_of(row: Mapping, probe: DataFrame | None) -> list[str]:
    """What is wrong with a rule row; ``probe`` is an empty table with the fact's columns."""
    found = []
    comparison, right = row.get("comparison"), row.get("right") or []
    if not row.get("message"):
        found.append("no message")
    if comparison not in COMPARISONS:
        found.append(f"unknown comparison {comparison!r}")
    if comparison == "share >" and row.get("limit") is None:
        found.append("a share needs a limit")
    if not row.get("left") or not right or not all(right):
        found.append("a condition is missing")
    for condition in [row.get("left"), *right]:
        if not condition or probe is None:
            continue
        try:
            kind = probe.selectExpr(f"({condition}) AS c").schema["c"].dataType
            if not isinstance(kind, T.BooleanType):
                found.append(f"not a condition: {condition}")
        except (AnalysisException, ParseException) as e:
            found.append(f"{condition}: {str(e).splitlines()[0]}")
    return found


def compile_rules(rows: Iterable[Mapping], fact: DataFrame | None = None) -> list[Rule]:
    """Rules from rule rows; conditions are checked against the columns of ``fact``, without a job."""
    rows = list(rows)
    probe = None if fact is None else fact.sparkSession.createDataFrame([], fact.schema)
    faults, seen, rules = [], set(), []
    for at, row in enumerate(rows, 1):
        name = row.get("name")
        own = faults_of(row, probe)
        if not name or name in seen:
            own.append("the name is missing or not unique")
        seen.add(name)
        faults += [f"rule {at} ({name}): {fault}" for fault in own]
        if own:
            continue
        total = "(" + " + ".join(f"p{k}" for k in range(len(row["right"]))) + ")"
        test = COMPARISONS[row["comparison"]].format(sum=total, limit=repr(float(row.get("limit") or 0)))
        terms = {"a": row["left"], **{f"p{k}": c for k, c in enumerate(row["right"])}}
        rules.append(Rule(name, row["message"], terms, test, row.get("level") or LEVEL_2, row.get("type_check") or "IntraIndicator", row.get("indicator")))
    if faults:
        raise ValueError("; ".join(faults))
    return rules


def rules_from(table: DataFrame, fact: DataFrame) -> list[Rule]:
    """Rules of a rule table (see :data:`RULE_SCHEMA`), in the order of their names."""
    rows = table.limit(MOST_RULES + 1).collect()
    if len(rows) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    return compile_rules(sorted((r.asDict() for r in rows), key=lambda r: r.get("name") or ""), fact)


def rule_table(spark: SparkSession, rows: Iterable[Mapping]) -> DataFrame:
    """Rule rows as a table that can be stored, edited and given to :func:`rules_from`."""
    names = T.StructType.fromDDL(RULE_SCHEMA).names
    return spark.createDataFrame([tuple(row.get(n) for n in names) for row in rows], RULE_SCHEMA)


def programme_rule_rows(agency: str) -> list[dict]:
    """The level 2 checks of the quarterly report for one funding agency.

    Conditions name the fact's own columns; the agency is a parameter.
    """
    own = "funding_agency = '" + agency.replace("\\", "\\\\").replace("'", "\\'") + "'"
    total = "standardizeddisaggregate = 'Total Numerator'"

    def ind(name: str, *more: str) -> str:
        return " AND ".join([f"indicator = '{name}'", *more])

    def dis(value: str) -> str:
        return f"standardizeddisaggregate = '{value}'"

    def combo(text: str) -> str:
        return f"contains(categoryoptioncomboname, '{text}')"

    def sides(name: str) -> tuple[str, list[str]]:
        return ind(name, "numeratordenom = 'N'"), [ind(name, "numeratordenom = 'D'")]

    exits = "(otherdisaggregate IS NULL OR otherdisaggregate = 'Exited without Graduation')"
    adult = "'^(15-19|20-24|25-29|30-34|35-39|40-44|45-49|50[+]), (Male|Female), Positive$'"
    contacts = [
        ind("HTS_INDEX", dis("4:Age/Sex/Result"), f"otherdisaggregate = '{o}'", f"statushiv = '{s}'")
        for o, s in (("Known at Entry", "Positive"), ("Newly Identified", "Negative"), ("Newly Identified", "Positive"))
    ]
    stat_positive = ind("PMTCT_STAT", "numeratordenom = 'N'", combo("Positive"))
    table = [
        ("ovc_exit_share", ind("OVC_SERV", own, dis("ProgramStatus"), exits), "share >", [ind("OVC_SERV", own, total, exits)]),
        ("ovc_hivstat", ind("OVC_HIVSTAT", own, total), "<>", [ind("OVC_SERV", own, "trendscoarse = '<18'", dis("Age/Sex/ProgramStatus"))]),
        ("prep_ct_keypop", ind("PrEP_CT", own, total), "<", [ind("PrEP_CT", own, dis("KeyPop"))]),
        ("prep_ct_result", ind("PrEP_CT", own, total), "<", [ind("PrEP_CT", own, dis("TestResult"))]),
        ("index_offered", ind("HTS_INDEX", own, dis("1:Age/Sex/IndexCasesOffered")), "<", [ind("HTS_INDEX", own, dis("2:Age/Sex/IndexCasesAccepted"))]),
        ("index_contacts", ind("HTS_INDEX", dis("3:Age Aggregated/Sex/Contacts")), "<", contacts),
        ("positives_recent", ind("HTS_TST", f"regexp_like(categoryoptioncomboname, {adult})"), "<", [ind("HTS_RECENT")]),
        ("hts_positives", ind("HTS_TST", own, total), "<", [ind("HTS_TST_POS", own, total)]),
        ("prep_new", ind("PrEP_NEW", total), ">", [ind("PrEP_CT", total)]),
        ("tx_new", ind("TX_NEW", total), ">", [ind("TX_CURR", total)]),
        ("tx_rtt", ind("TX_RTT", total), ">", [ind("TX_CURR", total)]),
        ("tx_dispensed", ind("TX_CURR", total), ">", [ind("SC_ARVDISP", total)]),
        *[(name, sides(i)[0], ">", sides(i)[1]) for name, i in
          (("tb_prev", "TB_PREV"), ("tb_stat", "TB_STAT"), ("tx_pvls", "TX_PVLS"), ("pmtct_stat", "PMTCT_STAT"))],
        ("hei_pos", ind("PMTCT_HEI_POS"), ">", [ind("PMTCT_EID")]),
        ("eid_positives", ind("PMTCT_EID", "categoryoptioncomboname = '<= 2 months'"), ">",
         [stat_positive, ind("HTS_TST", dis("PMTCT PostANC/Age/Sex/Result"), combo("Positive"))]),
        ("stat_art", stat_positive, "<", [ind("PMTCT_ART")]),
        ("iit_short", ind("TX_ML", combo("<3 Months")), ">", [ind("TX_ML", "regexp_like(categoryoptioncomboname, '3-5 Months|6[+] Months')")]),
    ]
    limits = {"ovc_exit_share": 0.10}
    return [
        {"name": n, "message": lists.RULE_TEXTS[n], "left": a, "comparison": c, "right": b, "limit": limits.get(n)} for n, a, c, b in table
    ]


def programme_rules(agency: str) -> list[Rule]:
    """:func:`programme_rule_rows`, compiled."""
    return compile_rules(programme_rule_rows(agency))


#: The feed has test results instead of a total: positive and negative tests make it.
FEED_TESTS = {
    "name": "feed_positives", "message": lists.RULE_TEXTS["hts_positives"], "comparison": "whole <",
    "left": "indicator = 'HTS_TST' AND result = 'Positive (Reactive)'", "right": ["indicator = 'HTS_TST' AND result = 'Negative (Non-reactive)'"],
}
