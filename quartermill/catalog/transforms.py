"""Queries for submission building, patches, staffing and roster checks."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermill.catalog.joining import MAP_KEYS
from quartermill.catalog.registry import query
from quartermill.catalog.tables import Tables, with_sql
from quartermill.functions.periods import fiscal_to_calendar_quarter
from quartermill.functions.semantics import in_set, na_sum
from quartermill.operators.aggregates import sum_by
from quartermill.operators.joins import map_join
from quartermill.plans import conform

_FEED = """CASE WHEN numeratordenom = 'D' THEN concat(indicator, '_Denom') ELSE concat(indicator, '_Numer') END"""
_SOURCES = {f"{i}_{long}": f"{i}_{short}" for i in "ANR" for long, short in (("Denom", "D"), ("Numer", "N"))}
_PLAIN = {f"{i}_{nd}": i for i in "ANR" for nd in "DN"}


@query(
    "unmapped_report",
    with_sql(
        """SELECT DISTINCT l.indicator, l.numeratordenom, l.standardizeddisaggregate, l.ageasentered FROM lines l
           LEFT JOIN elements e ON l.indicator = e.indicator AND l.numeratordenom = e.numeratordenom
             AND l.standardizeddisaggregate = e.standardizeddisaggregate AND l.ageasentered IS NOT DISTINCT FROM e.ageasentered
           WHERE e.element IS NULL AND l.ageasentered IS NOT NULL""",
        "lines",
        "elements",
    ),
)
def unmapped_report(t: Tables) -> DataFrame:
    combos = t.lines(MAP_KEYS).distinct()
    mapped = map_join(combos, t.elements().drop("element_group"), MAP_KEYS)
    return conform.unmapped(mapped, "element", "ageasentered", MAP_KEYS)


@query(
    "conform_map",
    with_sql(
        """SELECT a.mech_uid, f.orgunituid AS "orgUnit_uid", e.element AS "dataElement_uid",
                  'combo-' || coalesce(f.age, 'none') AS "categoryOptionCombo_uid", f.value,
                  f.cal || 'Q' || f.calq AS period
           FROM (SELECT orgunituid, indicator, numeratordenom, standardizeddisaggregate, age, cal, calq, sum(value) AS value FROM
                   (SELECT *, CASE WHEN indicator <> 'A' AND ageasentered IN ('SMALL', 'MEDIUM') THEN 'MEDIUM' ELSE ageasentered END AS age,
                           CASE WHEN quarter = 1 THEN fiscal_year - 1 ELSE fiscal_year END AS cal,
                           CASE WHEN quarter = 1 THEN 4 ELSE quarter - 1 END AS calq
                    FROM lines) GROUP BY ALL) f
           JOIN elements e ON f.indicator = e.indicator AND f.numeratordenom = e.numeratordenom
             AND f.standardizeddisaggregate = e.standardizeddisaggregate AND f.age IS NOT DISTINCT FROM e.ageasentered
           LEFT JOIN (SELECT orgunituid, psnu AS mech_code FROM roster) m ON f.orgunituid = m.orgunituid
           LEFT JOIN (SELECT psnu AS mech_code, snu1 || '-' || n_nationkey AS mech_uid FROM areas) a ON m.mech_code = a.mech_code""",
        "lines",
        "elements",
        "roster",
        "areas",
    ),
)
def conform_map(t: Tables) -> DataFrame:
    rows = t.lines(["orgunituid", *MAP_KEYS, "fiscal_year", "quarter", "value"])
    feed = rows.select(
        "orgunituid", F.expr(_FEED).alias("indicator"), "standardizeddisaggregate",
        F.col("ageasentered").alias("CoarseAgeGroup"),
        F.expr("concat('FY', substring(fiscal_year, 3, 2), 'Q', quarter)").alias("period"), "value",
    )
    keys = {**{k: k for k in MAP_KEYS[:3]}, "CoarseAgeGroup": "ageasentered"}
    combo = F.concat(F.lit("combo-"), F.coalesce("ageasentered", F.lit("none"))).alias("combo")
    mapping = t.elements().select(*MAP_KEYS, "element", combo)
    sites = t.roster().select("orgunituid", F.col("psnu").alias("mech_code"))
    mechanisms = t.areas().select(F.col("psnu").alias("mech_code"), F.expr("concat(snu1, '-', n_nationkey)").alias("mech_uid"))
    names = {
        "mech_uid": "mech_uid", "orgUnit_uid": "orgunituid", "dataElement_uid": "element",
        "categoryOptionCombo_uid": "combo", "value": "value",
    }
    return conform.submission_import(
        feed, "value", mapping, keys, sites, mechanisms, {"orgunituid": "orgunituid"}, names,
        fiscal_to_calendar_quarter("period"), sources=_SOURCES, plain=_PLAIN, bands={"SMALL": "MEDIUM"}, keep_fine=["A_D", "A_N"],
    )


@query(
    "dispense_map",
    with_sql(
        """SELECT f.orgunituid, e.element, sum(f.packs) AS "Packs" FROM
             (SELECT orgunituid, regimen, CASE WHEN item_size < 15 THEN 'Pediatric' ELSE 'Adult' END AS band, sum(value) AS packs
              FROM lines GROUP BY ALL) f
           LEFT JOIN (SELECT DISTINCT p_type AS regimen, CASE WHEN p_size < 15 THEN 'Pediatric' ELSE 'Adult' END AS band,
                             'SC_ARVDISP/' || CASE WHEN p_type IN ('LARGE', 'MEDIUM') THEN 'TLD' ELSE p_type END || '/'
                             || CASE WHEN p_size < 15 THEN 'Pediatric' ELSE 'Adult' END AS element
                      FROM part WHERE p_type <> 'PROMO') e ON f.regimen = e.regimen AND f.band = e.band
           GROUP BY 1, 2""",
        "lines",
    ),
)
def dispense_map(t: Tables) -> DataFrame:
    band = "if({0} < 15, 'Pediatric', 'Adult')"
    feed = t.lines(["orgunituid", "regimen", "item_size", "value"]).select(
        "orgunituid", "regimen", F.expr(band.format("item_size")).alias("band"), F.col("value").alias("Packs")
    )
    group = "if(p_type IN ('LARGE', 'MEDIUM'), 'TLD', p_type)"
    mapping = t.read("part").filter("p_type <> 'PROMO'").selectExpr(
        "p_type AS regimen_code", f"{band.format('p_size')} AS age_band",
        f"concat('SC_ARVDISP/', {group}, '/', {band.format('p_size')}) AS element",
    )
    return conform.map_dispensing(feed, mapping.distinct(), ["orgunituid"], {"regimen": "regimen_code", "band": "age_band"})


@query(
    "denominator_variants",
    with_sql(
        """SELECT f.orgunituid, e.element_group, f.value FROM
             (SELECT orgunituid, indicator, numeratordenom, standardizeddisaggregate AS dis, sum(value) AS value FROM lines
              WHERE numeratordenom = 'D' AND indicator IN ('A', 'N') GROUP BY ALL) f
           LEFT JOIN (SELECT DISTINCT indicator, numeratordenom, standardizeddisaggregate AS dis, element_group FROM elements) e
             USING (indicator, numeratordenom, dis)
           UNION ALL
           SELECT f.orgunituid, e.element_group, f.value FROM
             (SELECT orgunituid, numeratordenom, standardizeddisaggregate AS dis, sum(value) AS value FROM lines
              WHERE numeratordenom = 'D' AND indicator = 'R' GROUP BY ALL) f
           LEFT JOIN (SELECT DISTINCT numeratordenom, standardizeddisaggregate AS dis, element_group FROM elements
                      WHERE starts_with(element_group, 'R ')) e USING (numeratordenom, dis)""",
        "lines",
        "elements",
    ),
)
def denominator_variants(t: Tables) -> DataFrame:
    feed = t.lines(["orgunituid", *MAP_KEYS[:3], "value"]).filter("numeratordenom = 'D'")
    all_keys = {k: k for k in MAP_KEYS[:3]}
    fewer = {k: k for k in MAP_KEYS[1:3]}
    variants = [
        (F.col("indicator").isin("A", "N"), all_keys, None),
        (F.col("indicator") == "R", fewer, F.col("element_group").startswith("R ")),
    ]
    return conform.denominator_variants(feed, t.elements(), variants, ["orgunituid"], "value", ["element_group"])


@query(
    "import_consolidation",
    with_sql(
        """SELECT DISTINCT orgunituid, mech_code, element, '2000Q4' AS period, value FROM
             (SELECT orgunituid, mech_code, nullif(ageasentered, 'LARGE') AS element, sum(value) AS value FROM lines
              WHERE funding_agency = 'F' GROUP BY ALL
              UNION ALL SELECT orgunituid, mech_code, nullif(ageasentered, 'LARGE'), sum(value) - 50 FROM lines
              WHERE funding_agency = 'O' GROUP BY ALL
              UNION ALL SELECT orgunituid, mech_code, nullif(ageasentered, 'LARGE'), sum(value) FROM lines
              WHERE funding_agency = 'P' GROUP BY ALL)
           WHERE element IS NOT NULL AND value <> 0 AND NOT (mech_code = 'Brand#7')""",
        "lines",
    ),
)
def import_consolidation(t: Tables) -> DataFrame:
    rows = t.lines(["orgunituid", "mech_code", "ageasentered", "funding_agency", "value"])
    rows = rows.withColumn("element", F.nullif("ageasentered", F.lit("LARGE"))).drop("ageasentered")
    keys = ["orgunituid", "mech_code", "element"]
    first = sum_by(rows.filter("funding_agency = 'F'"), keys, ["value"])
    second = rows.filter("funding_agency = 'O'").groupBy(*keys).agg((na_sum("value") - 50).alias("value"))
    third = sum_by(rows.filter("funding_agency = 'P'"), keys, ["value"])
    return conform.consolidate([first, second, third], "2000Q4", F.col("mech_code") == "Brand#7", drop_zero=True)


@query(
    "repeated_records",
    with_sql(
        """SELECT orgunituid, mech_code, element, value, dupe_count FROM
             (SELECT *, count(*) OVER (PARTITION BY orgunituid, mech_code, element) AS dupe_count FROM
               (SELECT orgunituid, mech_code, ageasentered AS element, sum(value) AS value FROM lines
                WHERE funding_agency = 'F' GROUP BY ALL
                UNION ALL SELECT orgunituid, mech_code, ageasentered, sum(value) FROM lines
                WHERE funding_agency = 'O' GROUP BY ALL
                UNION ALL SELECT orgunituid, mech_code, ageasentered, sum(value) FROM lines
                WHERE funding_agency = 'P' GROUP BY ALL)) WHERE dupe_count > 1""",
        "lines",
    ),
)
def repeated_records(t: Tables) -> DataFrame:
    rows = t.lines(["orgunituid", "mech_code", "ageasentered", "funding_agency", "value"])
    rows = rows.withColumnRenamed("ageasentered", "element").filter(F.col("funding_agency").isin("F", "O", "P"))
    keys = ["orgunituid", "mech_code", "element"]
    # A file per agency: summed in one pass, its rows told apart by the agency.
    files = sum_by(rows, [*keys, "funding_agency"], ["value"])
    return conform.repeated_records(files.drop("funding_agency"))


@query(
    "delete_file",
    with_sql(
        """SELECT a.mech_uid, f.orgunituid AS "orgUnit_uid", e.element_group AS "dataElement_uid",
                  'combo-' || f.standardizeddisaggregate AS "categoryOptionCombo_uid", f.value, '2022Q4' AS period
           FROM (SELECT orgunituid, psnu, indicator, numeratordenom, standardizeddisaggregate, sum(value) AS value FROM lines
                 WHERE fiscal_year = 1997 AND quarter = 1 AND indicator IN ('A', 'R')
                   AND ageasentered IN ('SMALL', 'LARGE') AND funding_agency = 'F' GROUP BY ALL) f
           LEFT JOIN (SELECT DISTINCT indicator, numeratordenom, standardizeddisaggregate, element_group FROM elements) e
             USING (indicator, numeratordenom, standardizeddisaggregate)
           LEFT JOIN (SELECT psnu, snu1 || '-' || n_nationkey AS mech_uid FROM areas) a ON f.psnu = a.psnu""",
        "lines",
        "elements",
        "areas",
    ),
)
def delete_file(t: Tables) -> DataFrame:
    dims = ["orgunituid", "psnu", *MAP_KEYS, "funding_agency"]
    rows = t.lines([*dims, "fiscal_year", "quarter", "value"], [1997])
    wanted = in_set("indicator", ["A", "R"]) & in_set("ageasentered", ["SMALL", "LARGE"]) & (F.col("funding_agency") == "F")
    summed = sum_by(
        rows.filter(wanted & (F.col("quarter") == 1)), ["orgunituid", "psnu", *MAP_KEYS[:3]], ["value"]
    ).withColumnRenamed("psnu", "mech_code")
    elements = t.elements().select(*MAP_KEYS[:3], "element_group")
    mechanisms = t.areas().select(F.col("psnu").alias("mech_code"), F.expr("concat(snu1, '-', n_nationkey)").alias("mech_uid"))
    tagged = summed.withColumn("combo", F.concat(F.lit("combo-"), "standardizeddisaggregate"))
    names = {"orgUnit_uid": "orgunituid", "dataElement_uid": "element_group", "categoryOptionCombo_uid": "combo"}
    return conform.delete_records(tagged, F.lit(True), elements, mechanisms, MAP_KEYS[:3], names, "2022Q4")


@query(
    "patch_subset",
    with_sql(
        """SELECT orgunituid, indicator, value, CAST(NULL AS VARCHAR) AS note FROM
             (SELECT orgunituid, psnu, indicator, sum(value) AS value FROM lines GROUP BY ALL)
           WHERE NOT (psnu IN ('NATION_2', 'NATION_4') AND indicator = 'A')
           UNION ALL
           SELECT orgunituid, 'A', sum(target), 'corrected' FROM lines
           WHERE psnu IN ('NATION_2', 'NATION_4') AND indicator = 'A' GROUP BY ALL""",
        "lines",
    ),
)
def patch_subset(t: Tables) -> DataFrame:
    totals = sum_by(
        t.lines(["orgunituid", "psnu", "indicator", "value", "target"]), ["orgunituid", "psnu", "indicator"], ["value", "target"]
    )
    wrong = in_set("psnu", ["NATION_2", "NATION_4"]) & (F.col("indicator") == "A")
    corrected = totals.filter(wrong).select(
        "orgunituid", "indicator", F.col("target").alias("value"), F.lit("corrected").alias("note")
    )
    return conform.patch(totals, [wrong], corrected).drop("psnu", "target")


@query(
    "staffing_rollup",
    with_sql(
        """SELECT 'element' AS "Dataelement", '2023Q3' AS "Period", OrgUnit, category AS "CategoryOptionCombo", sum(v) AS "Value" FROM
             (SELECT OrgUnit, 'clin' AS category, coalesce(click, 0) + coalesce("view", 0) AS v FROM cadres
              UNION ALL SELECT OrgUnit, 'lab', coalesce(error, 0) FROM cadres
              UNION ALL SELECT OrgUnit, 'rest', coalesce(signup, 0) FROM cadres
              UNION ALL SELECT OrgUnit, 'rest', coalesce(purchase, 0) FROM cadres)
           WHERE v > 0 GROUP BY ALL""",
        "cadres",
    ),
)
def staffing_rollup(t: Tables) -> DataFrame:
    name = "{} - Position Count".format
    groups = {
        "Clinical": [name("click"), name("view")], "Laboratory": [name("error")],
        "Social": [name("signup")], "Other": [name("purchase")],
    }
    return conform.staffing_submission(
        t.cadres(), ["OrgUnit"], groups, "element", "2023Q3", (("Clin", "clin"), ("Lab", "lab")), "rest"
    )


@query(
    "facility_periods",
    """WITH mfl AS (SELECT s_name, s_suppkey,
                           CASE WHEN s_acctbal > 4000 THEN 'DSD+Roving TA' WHEN s_acctbal < 0 THEN NULL ELSE 'TA' END AS q1,
                           CASE WHEN s_nationkey < 12 THEN 'DSD' ELSE 'TA' END AS q2 FROM supplier)
       SELECT s_name AS facility, s_suppkey AS code, 'FY22Q1' AS period,
              CASE WHEN q1 = 'DSD+Roving TA' THEN 'DSD' ELSE q1 END AS "DSD_TA" FROM mfl
       UNION ALL SELECT s_name, s_suppkey, 'FY22Q2', q2 FROM mfl""",
)
def facility_periods(t: Tables) -> DataFrame:
    mfl = t.read("supplier").selectExpr(
        "s_name AS facility", "s_suppkey AS code",
        "CASE WHEN s_acctbal > 4000 THEN 'DSD+Roving TA' WHEN s_acctbal < 0 THEN NULL ELSE 'TA' END AS fy22q1_support",
        "CASE WHEN s_nationkey < 12 THEN 'DSD' ELSE 'TA' END AS fy22q2_support",
    )
    return conform.facility_periods(mfl, ["facility", "code"], "fy22")


@query(
    "expected_zero",
    with_sql(
        """SELECT coalesce(f.orgunituid, e.orgunituid) AS orgunituid, f.fy1996q1, f.fy1996q2, e.expected,
                  CASE WHEN upper(e.expected) = 'YES' AND f.fy1996q1 = 0 THEN 'FLAG' ELSE 'OK' END AS flag FROM
             (SELECT orgunituid, sum(CASE WHEN quarter = 1 AND fiscal_year = 1996 AND mech_code = 'Brand#5' THEN value ELSE 0 END) AS fy1996q1,
                     sum(CASE WHEN quarter = 2 AND fiscal_year = 1996 AND mech_code = 'Brand#5' THEN value ELSE 0 END) AS fy1996q2
              FROM lines GROUP BY 1) f
             FULL JOIN (SELECT orgunituid, CASE WHEN snu1 = 'ASIA' THEN 'no' ELSE 'Yes' END AS expected FROM roster) e USING (orgunituid)""",
        "lines",
        "roster",
    ),
)
def expected_zero(t: Tables) -> DataFrame:
    """Every site that ever reported, with one mechanism's results of two quarters; none is zero there."""
    rows = t.lines(["orgunituid", "mech_code", "fiscal_year", "quarter", "value"])
    own = (F.col("fiscal_year") == 1996) & (F.col("mech_code") == "Brand#5")
    fact = rows.groupBy("orgunituid").agg(
        *[F.sum(F.when(own & (F.col("quarter") == q), F.col("value")).otherwise(0.0)).alias(f"fy1996q{q}") for q in (1, 2)]
    )
    expected = t.roster().select("orgunituid", F.expr("if(snu1 = 'ASIA', 'no', 'Yes')").alias("expected"))
    return conform.expected_but_zero(fact, expected, "orgunituid", "expected", "fy1996q1")


@query(
    "wrong_ids",
    with_sql(
        """SELECT DISTINCT sitename, mech_code FROM lines
             WHERE sitename IN (SELECT sitename FROM lines GROUP BY 1 HAVING count(*) > 40)
             AND mech_code NOT IN (SELECT p_brand FROM part WHERE p_size > 49 AND p_type = 'PROMO')""",
        "lines",
    ),
)
def wrong_ids(t: Tables) -> DataFrame:
    rows = t.lines(["sitename", "mech_code"])
    submitted = t.read("part").filter("p_size > 49 AND p_type = 'PROMO'").select(F.col("p_brand").alias("submitted_code"))
    return conform.wrong_ids(rows, "sitename", "mech_code", 40, submitted, "submitted_code")


@query(
    "rename_sites",
    with_sql(
        """SELECT CASE WHEN r.orgunituid IS NULL THEN l.sitename ELSE 'Merged ' || l.psnu END AS sitename,
                  CASE WHEN r.orgunituid IS NULL THEN l.orgunituid ELSE 'M' END AS orgunituid, l.indicator, sum(l.value) AS value
           FROM lines l LEFT JOIN (SELECT orgunituid FROM sites WHERE balance < 0) r ON l.orgunituid = r.orgunituid GROUP BY ALL""",
        "lines",
        "sites",
    ),
)
def rename_sites(t: Tables) -> DataFrame:
    feed = sum_by(
        t.lines(["sitename", "orgunituid", "indicator", "value"]), ["sitename", "orgunituid", "indicator"], ["value"]
    )
    renames = t.sites().filter("balance < 0").select(
        F.col("sitename").alias("old_name"), F.expr("concat('Merged ', psnu)").alias("new_name"), F.lit("M").alias("new_code")
    )
    return conform.rename_sites(feed, renames, "sitename", "orgunituid", "value")
