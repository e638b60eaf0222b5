"""Queries for joins, overwrites and comparisons of two sources."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermill.catalog.registry import query
from quartermill.catalog.tables import Tables, with_sql
from quartermill.functions.semantics import na_sum
from quartermill.operators.aggregates import side_by_side, sum_by
from quartermill.operators.joins import lookup, map_join, match, matched, not_matched, overwrite, partial_key_map, reconcile
from quartermill.operators.setops import keys_only_in, loose_append, rows_only_in
from quartermill.operators.snapshots import snapshot_difference
from quartermill.operators.windows import first_per_key
from quartermill.plans.conform import attach_mechanism

MAP_KEYS = ["indicator", "numeratordenom", "standardizeddisaggregate", "ageasentered"]


@query(
    "left_lookup",
    with_sql(
        """SELECT l.psnu, l.indicator, l.value, a.snu1, a.DSP
           FROM (SELECT psnu, indicator, sum(value) AS value FROM lines GROUP BY ALL) l
           LEFT JOIN (SELECT * FROM areas WHERE snu1 <> 'EUROPE') a ON l.psnu = a.psnu""",
        "lines",
        "areas",
    ),
)
def left_lookup(t: Tables) -> DataFrame:
    totals = sum_by(t.lines(["psnu", "indicator", "value"]), ["psnu", "indicator"], ["value"])
    return lookup(totals, t.areas().filter("snu1 <> 'EUROPE'"), ["psnu"], ["snu1", "DSP"])


@query(
    "left_composite",
    with_sql(
        """SELECT a.orgunituid, a.indicator, a.value, b.denominator FROM
             (SELECT orgunituid, indicator, sum(value) AS value FROM lines GROUP BY ALL) a
             LEFT JOIN (SELECT orgunituid AS site, indicator AS ind, sum(value) AS denominator FROM lines
                        WHERE numeratordenom = 'D' AND indicator <> 'N' GROUP BY ALL) b
               ON a.orgunituid = b.site AND a.indicator = b.ind""",
        "lines",
    ),
)
def left_composite(t: Tables) -> DataFrame:
    rows = t.lines(["orgunituid", "indicator", "numeratordenom", "value"])
    denominators = "numeratordenom = 'D' AND indicator <> 'N'"
    return side_by_side(rows, ["orgunituid", "indicator"], "value", {"value": None, "denominator": denominators})


@query(
    "null_safe_map",
    with_sql(
        """SELECT f.*, e.element FROM
             (SELECT orgunituid, indicator, numeratordenom, standardizeddisaggregate, ageasentered, sum(value) AS value
              FROM lines GROUP BY ALL) f
           LEFT JOIN elements e ON f.indicator = e.indicator AND f.numeratordenom = e.numeratordenom
             AND f.standardizeddisaggregate = e.standardizeddisaggregate
             AND f.ageasentered IS NOT DISTINCT FROM e.ageasentered""",
        "lines",
        "elements",
    ),
)
def null_safe_map(t: Tables) -> DataFrame:
    feed = sum_by(t.lines(["orgunituid", *MAP_KEYS, "value"]), ["orgunituid", *MAP_KEYS], ["value"])
    return map_join(feed, t.elements().drop("element_group"), MAP_KEYS)


@query(
    "partial_key_map",
    with_sql(
        """SELECT f.*, e.element_group FROM
             (SELECT orgunituid, indicator, numeratordenom, standardizeddisaggregate, sum(value) AS value
              FROM lines GROUP BY ALL) f
           LEFT JOIN (SELECT DISTINCT indicator, numeratordenom, standardizeddisaggregate, element_group FROM elements
                      WHERE regexp_matches(element_group, 'BUILDING|HOUSEHOLD')) e
             ON f.indicator = e.indicator AND f.numeratordenom = e.numeratordenom
             AND f.standardizeddisaggregate = e.standardizeddisaggregate""",
        "lines",
        "elements",
    ),
)
def partial_key_map_query(t: Tables) -> DataFrame:
    return partial_key_map(
        t.lines(["orgunituid", *MAP_KEYS, "value"]),
        t.elements(),
        MAP_KEYS[:3],
        ["orgunituid"],
        "value",
        ["element_group"],
        F.col("element_group").rlike("BUILDING|HOUSEHOLD"),
    )


@query(
    "full_reconcile",
    with_sql(
        """SELECT a.orgunituid, a.sitename, b.listed_uid, b.orgunit_name FROM
             (SELECT DISTINCT orgunituid, sitename FROM lines) a
             FULL JOIN (SELECT orgunituid AS listed_uid, sitename AS orgunit_name FROM roster) b
               ON a.orgunituid = b.listed_uid""",
        "lines",
        "roster",
    ),
)
def full_reconcile(t: Tables) -> DataFrame:
    reported = t.with_site(t.lines(["orgunituid"]).distinct(), ["sitename"])
    listed = t.roster().select(F.col("orgunituid").alias("listed_uid"), F.col("sitename").alias("orgunit_name"))
    return reconcile(reported.distinct(), listed, ("orgunituid", "listed_uid"))


@query(
    "anti_unmatched",
    with_sql(
        """SELECT DISTINCT orgunituid, sitename FROM lines
           WHERE sitename NOT IN (SELECT sitename FROM roster)""",
        "lines",
        "roster",
    ),
)
def anti_unmatched(t: Tables) -> DataFrame:
    reporting = t.with_site(t.lines(["orgunituid"]).distinct(), ["sitename"])
    return not_matched(reporting, t.roster(), ["sitename"], null_safe=False)


@query(
    "semi_unmapped",
    with_sql(
        """SELECT orgunituid, f.indicator, f.numeratordenom, f.standardizeddisaggregate, f.ageasentered, sum(value) AS value
           FROM lines f SEMI JOIN missing m ON f.indicator = m.indicator AND f.numeratordenom = m.numeratordenom
             AND f.standardizeddisaggregate = m.standardizeddisaggregate
             AND f.ageasentered IS NOT DISTINCT FROM m.ageasentered GROUP BY ALL""",
        "lines",
        "elements",
        missing="""SELECT indicator, numeratordenom, standardizeddisaggregate, ageasentered FROM lines l
             WHERE NOT EXISTS (SELECT 1 FROM elements e WHERE l.indicator = e.indicator
               AND l.numeratordenom = e.numeratordenom AND l.standardizeddisaggregate = e.standardizeddisaggregate
               AND l.ageasentered IS NOT DISTINCT FROM e.ageasentered)""",
    ),
)
def semi_unmapped(t: Tables) -> DataFrame:
    feed = sum_by(t.lines(["orgunituid", *MAP_KEYS, "value"]), ["orgunituid", *MAP_KEYS], ["value"])
    missing = map_join(t.element_keys(), t.elements().select(*MAP_KEYS, "element"), MAP_KEYS).filter("element IS NULL")
    return matched(feed, missing, MAP_KEYS)


@query(
    "inner_first",
    with_sql(
        """SELECT orgunituid, r.sitename, r.psnu, mech_code FROM
             (SELECT DISTINCT orgunituid, mech_code FROM lines) m JOIN roster r USING (orgunituid)
           QUALIFY row_number() OVER (PARTITION BY orgunituid ORDER BY mech_code) = 1""",
        "lines",
        "roster",
    ),
)
def inner_first(t: Tables) -> DataFrame:
    pairs = t.lines(["orgunituid", "mech_code"]).distinct()
    joined = match(pairs, t.roster().drop("snu1"), ["orgunituid"], "inner")
    return first_per_key(joined, ["orgunituid"], ["mech_code"])


@query(
    "chained_lookup",
    with_sql(
        """SELECT orgunituid, indicator, value, m.mech_code, a.mech_uid FROM
             (SELECT orgunituid, indicator, sum(value) AS value FROM lines GROUP BY ALL) f
             LEFT JOIN (SELECT orgunituid, psnu AS mech_code FROM roster) m USING (orgunituid)
             LEFT JOIN (SELECT psnu AS mech_code, snu1 || '-' || n_nationkey AS mech_uid FROM areas) a
               ON m.mech_code = a.mech_code""",
        "lines",
        "roster",
        "areas",
    ),
)
def chained_lookup(t: Tables) -> DataFrame:
    totals = sum_by(t.lines(["orgunituid", "indicator", "value"]), ["orgunituid", "indicator"], ["value"])
    sites = t.roster().select("orgunituid", F.col("psnu").alias("mech_code"))
    mechanisms = t.areas().select(F.col("psnu").alias("mech_code"), F.expr("concat(snu1, '-', n_nationkey)").alias("mech_uid"))
    return attach_mechanism(totals, sites, mechanisms, {"orgunituid": "orgunituid"})


@query(
    "crosswalk_overwrite",
    with_sql(
        """SELECT CASE WHEN mech_code LIKE 'Brand#1_' THEN 'Brand#9' ELSE mech_code END AS mech_code,
                  CASE WHEN mech_code LIKE 'Brand#1_' THEN 'moved' ELSE funding_agency END AS funding_agency,
                  sum(value) AS value FROM lines GROUP BY 1, 2""",
        "lines",
    ),
)
def crosswalk_overwrite(t: Tables) -> DataFrame:
    rows = sum_by(t.lines(["mech_code", "funding_agency", "value"]), ["mech_code", "funding_agency"], ["value"])
    crosswalk = (
        t.read("part").select(F.col("p_brand").alias("old_code")).filter("old_code LIKE 'Brand#1_'").distinct()
        .withColumns({"new_code": F.lit("Brand#9"), "new_agency": F.lit("moved")})
    )
    moved = overwrite(rows, crosswalk, {"mech_code": "old_code"}, {"mech_code": "new_code", "funding_agency": "new_agency"})
    return sum_by(moved, ["mech_code", "funding_agency"], ["value"])


@query(
    "aggregate_compare",
    with_sql(
        """SELECT a.psnu, a.indicator, a.fiscal_year, a.submitted, b.source, a.submitted - b.source AS gap FROM
             (SELECT psnu, indicator, fiscal_year, sum(value) AS submitted FROM lines WHERE funding_agency = 'F' GROUP BY ALL) a
             LEFT JOIN (SELECT psnu, indicator, fiscal_year, sum(value) AS source FROM lines
                        WHERE funding_agency = 'O' AND indicator <> 'R' GROUP BY ALL) b
               USING (psnu, indicator, fiscal_year)""",
        "lines",
    ),
)
def aggregate_compare(t: Tables) -> DataFrame:
    keys = ["psnu", "indicator", "fiscal_year"]
    rows = t.lines([*keys, "funding_agency", "value"])
    sides = {"submitted": "funding_agency = 'F'", "source": "funding_agency = 'O' AND indicator <> 'R'"}
    both = side_by_side(rows, keys, "value", sides).filter("submitted IS NOT NULL")
    return both.withColumn("gap", F.col("submitted") - F.col("source"))


@query(
    "loose_union",
    with_sql(
        """SELECT orgunituid, psnu, indicator, CAST(NULL AS VARCHAR) AS facility, CAST(NULL AS VARCHAR) AS "table",
                  'FY' || right(CAST(fiscal_year AS VARCHAR), 2) || 'Q' || quarter AS period, sum(value) AS value
           FROM lines GROUP BY ALL
           UNION ALL
           SELECT NULL, NULL, CASE WHEN event_type = 'signup' THEN 'A' ELSE event_type END, facility, 'HFR',
                  strftime(day, '%Y-%m'), round(sum(value), 2)
           FROM series GROUP BY ALL""",
        "lines",
        "series",
    ),
)
def loose_union(t: Tables) -> DataFrame:
    quarterly = (
        t.lines(["orgunituid", "psnu", "indicator", "fiscal_year", "quarter", "value"])
        .groupBy("orgunituid", "psnu", "indicator", "fiscal_year", "quarter")
        .agg(na_sum("value").alias("value"))
        .withColumn("period", F.expr("concat('FY', substring(fiscal_year, 3, 2), 'Q', quarter)"))
        .drop("fiscal_year", "quarter")
    )
    monthly = (
        t.series()
        .groupBy("facility", F.col("event_type").alias("indicator"), F.date_format("day", "yyyy-MM").alias("period"))
        .agg(F.round(F.sum("value"), 2).alias("value"))
        .withColumns({"table": F.lit("HFR"), "indicator": F.expr("if(indicator = 'signup', 'A', indicator)")})
    )
    return loose_append(quarterly, monthly)


@query(
    "except_rows",
    with_sql(
        """SELECT psnu, mech_code, indicator, fiscal_year FROM lines WHERE funding_agency = 'F'
           EXCEPT SELECT psnu, mech_code, indicator, fiscal_year FROM lines WHERE funding_agency = 'O'""",
        "lines",
    ),
)
def except_rows(t: Tables) -> DataFrame:
    columns = ["psnu", "mech_code", "indicator", "fiscal_year"]
    rows = t.lines([*columns, "funding_agency"])
    a, b = rows.filter("funding_agency = 'F'").select(*columns), rows.filter("funding_agency = 'O'").select(*columns[::-1])
    return rows_only_in(a, b)


@query(
    "key_set_diff",
    with_sql(
        """SELECT DISTINCT orgunituid FROM lines WHERE orgunituid NOT IN (SELECT orgunituid FROM roster)""",
        "lines",
        "roster",
    ),
)
def key_set_diff(t: Tables) -> DataFrame:
    return keys_only_in(t.lines(["orgunituid"]), t.roster(), ["orgunituid"])


@query(
    "snapshot_diff",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, 'removed' AS change FROM orders WHERE o_orderkey % 1000 = 7
       UNION ALL SELECT o_orderkey, o_custkey, 'X', o_totalprice, 'changed' FROM orders WHERE o_orderkey % 1000 = 8
       UNION ALL SELECT -o_orderkey, o_custkey, NULL, o_totalprice, 'added' FROM orders WHERE o_orderkey % 1000 = 9""",
)
def snapshot_diff(t: Tables) -> DataFrame:
    """Two snapshots of the orders that differ in a few rows of each kind."""
    old = t.read("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    status = F.when(F.col("o_orderkey") % 1000 == 8, F.lit("X")).otherwise(F.col("o_orderstatus"))
    kept = old.filter("o_orderkey % 1000 <> 7").withColumn("o_orderstatus", status)
    fresh = old.filter("o_orderkey % 1000 = 9").withColumns({"o_orderkey": -F.col("o_orderkey"), "o_orderstatus": F.lit(None).cast("string")})
    return snapshot_difference(old, kept.unionByName(fresh), ["o_orderkey"])
