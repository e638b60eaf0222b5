"""Queries for area flags, labels, names and age bands."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermill.catalog.aggregation import FINE_BAND, FINE_BAND_SQL
from quartermill.catalog.registry import query
from quartermill.catalog.tables import Tables, with_sql
from quartermill.functions.semantics import na_sum
from quartermill.operators.aggregates import sum_by
from quartermill.operators.joins import lookup
from quartermill.plans import context
from quartermill.plans.conform import age_bands, area_names


@query(
    "area_flags",
    with_sql(
        """SELECT psnu, snu1, CASE WHEN psnu IN ('NATION_3', 'NATION_11') THEN 'YES' ELSE 'NO' END AS HIGHBURDEN,
                  CASE WHEN snu1 IN ('ASIA', 'AFRICA') THEN 'YES' ELSE 'NO' END AS focus_district, value
           FROM (SELECT psnu, nullif(snu1, 'EUROPE') AS snu1, sum(value) AS value FROM lines GROUP BY ALL)""",
        "lines",
    ),
)
def area_flags(t: Tables) -> DataFrame:
    rows = t.lines(["psnu", "snu1", "value"]).withColumn("snu1", F.nullif("snu1", F.lit("EUROPE")))
    totals = sum_by(rows, ["psnu", "snu1"], ["value"])
    return context.area_flags(totals, "psnu", "snu1", ["NATION_3", "NATION_11"], ["ASIA", "AFRICA"])


@query(
    "case_rules",
    with_sql(
        """SELECT mech_code, indicator, value,
                  CASE WHEN mech_code = 'Brand#1' AND indicator IN ('A', 'N') THEN 'First partner'
                       WHEN mech_code = 'Brand#2' AND indicator IN ('A', 'N') THEN 'Second partner'
                       WHEN mech_code = 'Brand#3' AND indicator = 'R' THEN 'Third partner' ELSE 'NOT LISTED' END AS partner,
                  CASE WHEN indicator <> 'R' AND mech_code IN ('Brand#1', 'Brand#9') THEN 'original pilot district'
                       WHEN indicator <> 'R' THEN 'pilot expansion district' ELSE 'not a pilot district' END AS programme,
                  CASE WHEN mech_code = 'Brand#4' AND indicator = 'A' THEN 'tested' WHEN mech_code = 'Brand#5' AND indicator = 'R'
                       THEN 'treated' ELSE 'none' END AS rule_label,
                  CASE WHEN mech_code = 'Brand#1' THEN 'WR' ELSE mech_code END AS partner_other
           FROM (SELECT mech_code, indicator, sum(value) AS value FROM lines GROUP BY ALL)""",
        "lines",
    ),
)
def case_rules(t: Tables) -> DataFrame:
    totals = sum_by(t.lines(["mech_code", "indicator", "value"]), ["mech_code", "indicator"], ["value"])
    labels = {("Brand#1", "AN"): "First partner", ("Brand#2", "AN"): "Second partner", ("Brand#3", "R"): "Third partner"}
    named = totals.withColumns(
        {
            "partner": context.prevention_partner(
                "mech_code", "indicator", {"A": "AN", "N": "AN", "R": "R"}, labels, "NOT LISTED"
            ),
            "programme": context.programme_class(F.col("indicator") != "R", "mech_code", ["Brand#1", "Brand#9"], "pilot"),
            "partner_other": context.labels_by_code("mech_code", {"Brand#1": "WR"}, "mech_code"),
        }
    )
    rules = [("Brand#4", "A", "tested"), ("Brand#5", "R", "treated")]
    return context.rule_labels(named, ["mech_code", "indicator"], rules, "rule_label", "none")


@query(
    "pair_flag",
    with_sql(
        """SELECT event_type, weekday, CASE WHEN (event_type = 'click' AND weekday IN (1, 7))
                       OR (event_type = 'view' AND weekday = 1) OR event_type = 'error' THEN 'Yes' ELSE 'No' END AS CHW_like,
                  round(sum(value), 2) AS value
           FROM (SELECT event_type, dayofweek(day) + 1 AS weekday, value FROM series) GROUP BY ALL""",
        "series",
    ),
)
def pair_flag(t: Tables) -> DataFrame:
    rows = t.series().select("event_type", F.dayofweek("day").alias("weekday"), "value")
    totals = rows.groupBy("event_type", "weekday").agg(F.round(na_sum("value"), 2).alias("value"))
    flagged = context.pair_flag(totals, "event_type", "weekday", {"click": (1, 7), "view": (1,), "error": None})
    return flagged.withColumn("weekday", F.col("weekday").cast("bigint"))


@query(
    "lookback_override",
    with_sql(
        """SELECT l.psnu, CASE WHEN a.historic IS NULL THEN NULL ELSE a.historic END AS mech_code, sum(l.value) AS value
           FROM (SELECT psnu, snu1, mech_code, value FROM lines) l
           LEFT JOIN (SELECT psnu, 'H-' || snu1 AS historic FROM areas WHERE DSP = 'Yes') a ON l.psnu = a.psnu GROUP BY ALL""",
        "lines",
        "areas",
    ),
)
def lookback_override(t: Tables) -> DataFrame:
    totals = sum_by(t.lines(["psnu", "mech_code", "value"]), ["psnu", "mech_code"], ["value"])
    historic = t.areas().filter("DSP = 'Yes'").select("psnu", F.expr("concat('H-', snu1)").alias("historic"))
    moved = lookup(totals, historic, ["psnu"]).withColumn("mech_code", context.lookback_code("mech_code", "historic"))
    return sum_by(moved, ["psnu", "mech_code"], ["value"])


@query(
    "age_bands",
    with_sql(
        f"""SELECT CASE WHEN band = '00-04' THEN '<01' WHEN band = '50-54' THEN '65+' ELSE band END AS ageasentered,
                   CASE WHEN band IN ('00-04', '05-09', '10-14') THEN '<15' WHEN band IS NOT NULL THEN '15+' END AS trendscoarse,
                   CASE WHEN item_size < 15 THEN '<15' ELSE '15+' END AS from_number, sum(value) AS value
            FROM (SELECT {FINE_BAND_SQL} AS band, item_size, value FROM lines) GROUP BY ALL""",
        "lines",
    ),
)
def age_bands_query(t: Tables) -> DataFrame:
    rows = t.lines(["regimen", "item_size", "value"]).select(F.expr(FINE_BAND).alias("band"), "item_size", "value")
    spelled = F.concat("band", F.lit(" years"))
    settled = rows.withColumn("ageasentered", age_bands(spelled, {"00-04": "<01", "50-54": "65+"}))
    tagged = settled.withColumns(
        {
            "trendscoarse": context.coarse_age("ageasentered"),
            "from_number": context.coarse_age_from_number(F.col("item_size").cast("string")),
        }
    )
    return sum_by(tagged, ["ageasentered", "trendscoarse", "from_number"], ["value"])


@query(
    "area_names",
    with_sql(
        """SELECT area, count(*) AS n FROM (
             SELECT CASE WHEN psnu = 'NATION_8' THEN 'NATION_8 Municipality' WHEN contains(psnu, 'N_1') THEN 'First District'
                         WHEN contains(psnu, '2') THEN 'Second District' ELSE psnu || ' Metropolitan Municipality' END AS area
             FROM sites) GROUP BY 1""",
        "sites",
    ),
)
def area_names_query(t: Tables) -> DataFrame:
    named = t.sites().select(F.concat("psnu", F.lit(" Metropolitan Municipality")).alias("raw"))
    patterns = (("N_1", "First District"), ("2", "Second District"))
    settled = named.select(area_names("raw", patterns, "NATION_8 Metropolitan Municipality").alias("area"))
    return settled.groupBy("area").agg(F.count(F.lit(1)).alias("n"))


@query(
    "disagg_type",
    with_sql(
        """SELECT CASE WHEN age = 'No age disagg' AND sex = 'No sex disagg' THEN 'Total' WHEN age = 'No age disagg' THEN 'Sex'
                       WHEN sex = 'No sex disagg' THEN 'Age' ELSE 'Age/Sex' END AS standardizeddisaggregate, count(*) AS n
           FROM (SELECT coalesce(ageasentered, 'No age disagg') AS age,
                        CASE WHEN indicator = 'A' THEN 'No sex disagg' ELSE indicator END AS sex FROM lines) GROUP BY 1""",
        "lines",
    ),
)
def disagg_type(t: Tables) -> DataFrame:
    rows = t.lines(["ageasentered", "indicator"]).select(
        F.coalesce("ageasentered", F.lit("No age disagg")).alias("age"),
        F.expr("if(indicator = 'A', 'No sex disagg', indicator)").alias("sex"),
    )
    kind = context.disaggregate_type("age", "sex").alias("standardizeddisaggregate")
    return rows.groupBy(kind).agg(F.count(F.lit(1)).alias("n"))


@query(
    "pattern_table",
    with_sql(
        """SELECT psnu, coalesce((SELECT min_by(label, priority) FROM (SELECT n_nationkey AS priority, 'N_' || n_nationkey AS pattern, 'District ' || n_nationkey AS label
                                   FROM nation WHERE n_nationkey BETWEEN 1 AND 3) r WHERE contains(l.psnu, r.pattern)), 'elsewhere') AS district,
                  indicator, value
           FROM (SELECT psnu, indicator, sum(value) AS value FROM lines GROUP BY ALL) l""",
        "lines",
    ),
)
def pattern_table(t: Tables) -> DataFrame:
    """Area names settled by ordered patterns that come from a table."""
    nations = t.read("nation").filter("n_nationkey BETWEEN 1 AND 3")
    rules = nations.selectExpr("n_nationkey AS priority", "concat('N_', n_nationkey) AS pattern", "concat('District ', n_nationkey) AS label")
    totals = sum_by(t.lines(["psnu", "indicator", "value"]), ["psnu", "indicator"], ["value"])
    return context.pattern_labels(totals, "psnu", rules, "district", F.lit("elsewhere"))
