"""Queries for the finished products."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermill.catalog.registry import query
from quartermill.catalog.tables import Tables, long_sql, wide_sql, with_sql
from quartermill.functions.periods import quarter_label
from quartermill.functions.semantics import na_sum
from quartermill.operators.aggregates import sum_by, sum_by_strings
from quartermill.operators.joins import lookup
from quartermill.operators.reshape import reshape_long
from quartermill.plans import lists, products
from quartermill.plans.conform import age_bands, area_names, cash_age_bands
from quartermill.plans.context import agency_short_name, area_key, coarse_age, disaggregate_type, official_names
from quartermill.session import run_folder
from quartermill.sources.writers import read_ranked

DIMS = ["snu1", "psnu", "mech_code", "indicator", "numeratordenom", "standardizeddisaggregate"]
_MIRROR = ", ".join(f"CASE WHEN indicator = '{i}' THEN value END AS {i}" for i in "ANR")
_MIRROR_L = _MIRROR.replace("indicator", "l.indicator")


@query(
    "product_treatment",
    with_sql(
        f"""SELECT l.snu1, l.psnu, l.mech_code, l.indicator, l.numeratordenom, l.standardizeddisaggregate, l.psnu AS short_name,
                   l.mech_code || l.psnu AS DSPID, CASE WHEN l.psnu = 'NATION_3' THEN 'YES' ELSE 'NO' END AS HIGHBURDEN,
                   CASE WHEN l.mech_code = 'Brand#1' THEN 'WR' ELSE l.mech_code || ' partner' END AS partner_other,
                   l.mech_code || ' partner' AS prime_partner_name, period, period_type, value, {_MIRROR_L}, a.DSP, d.disaggregate_label
            FROM long l
            LEFT JOIN (SELECT DISTINCT mech_code, psnu, DSP FROM lines JOIN (SELECT psnu, DSP FROM areas) USING (psnu) WHERE snu1 <> 'EUROPE') a
              ON l.mech_code = a.mech_code AND l.psnu = a.psnu
            LEFT JOIN (SELECT DISTINCT indicator, numeratordenom, standardizeddisaggregate, element_group AS disaggregate_label FROM elements) d
              ON l.indicator = d.indicator AND l.numeratordenom = d.numeratordenom
             AND l.standardizeddisaggregate = d.standardizeddisaggregate""",
        "lines",
        "areas",
        "elements",
        wide=wide_sql(DIMS),
        long=long_sql(DIMS),
    ),
)
def product_treatment(t: Tables) -> DataFrame:
    fact = t.wide(DIMS).withColumn("prime_partner_name", F.concat("mech_code", F.lit(" partner")))
    # Partner attributes and labels come from the code lists, not from the fact.
    areas = t.areas().filter("snu1 <> 'EUROPE'").agg(F.collect_list(F.struct("psnu", "DSP"))).scalar()
    codes = t.read("part").select(F.col("p_brand").alias("mech_code")).distinct().withColumn("areas", areas)
    attributes = area_key(codes.select("mech_code", F.inline("areas"))).select("DSPID", "DSP")
    labels = t.elements().select(
        F.concat_ws("_", "indicator", "numeratordenom", "standardizeddisaggregate").alias("disagg_key"), F.col("element_group").alias("disaggregate_label")
    ).distinct()
    return products.treatment_fact(
        fact, ["A", "N", "R"], attributes, {"Brand#1": "WR"}, labels, priority=None, high_burden=["NATION_3"]
    )


@query(
    "product_site_lag",
    with_sql(
        """SELECT orgunituid, mech_code, sitename, psnu, period, 'A' AS indicator, value, 'Reported' AS source_name FROM filled
           UNION ALL SELECT orgunituid, mech_code, sitename, psnu, period, 'A_LAG1', lag(value, 1) OVER w, 'Derived' FROM filled
             WINDOW w AS (PARTITION BY orgunituid, mech_code ORDER BY period)
           UNION ALL SELECT orgunituid, mech_code, sitename, psnu, period, 'A_LAG2', lag(value, 2) OVER w, 'Derived' FROM filled
             WINDOW w AS (PARTITION BY orgunituid, mech_code ORDER BY period)""",
        "lines",
        "sites",
        observed="""SELECT orgunituid, mech_code, fiscal_year || 'Q' || quarter AS period, sum(value) AS value
                    FROM lines WHERE indicator = 'A' GROUP BY ALL""",
        filled="""SELECT x.orgunituid, x.mech_code, s.sitename, s.psnu, p.period, coalesce(o.value, 0) AS value
                  FROM (SELECT DISTINCT orgunituid, mech_code FROM observed) x CROSS JOIN (SELECT DISTINCT period FROM observed) p
                  LEFT JOIN observed o ON o.orgunituid = x.orgunituid AND o.mech_code = x.mech_code AND o.period = p.period
                  JOIN sites s ON s.orgunituid = x.orgunituid""",
    ),
)
def product_site_lag(t: Tables) -> DataFrame:
    # Summed by site and mechanism before the site's attributes are joined.
    rows = t.lines(["orgunituid", "mech_code", "indicator", "fiscal_year", "quarter", "value"])
    summed = rows.groupBy("orgunituid", "mech_code", "indicator", "fiscal_year", "quarter").agg(na_sum("value").alias("value"))
    long = t.with_site(summed, ["sitename", "psnu"]).withColumns(
        {"period": F.concat("fiscal_year", F.lit("Q"), "quarter"), "period_type": F.lit("results")}
    ).drop("fiscal_year", "quarter")
    return products.site_series(
        long, "A", ["orgunituid", "mech_code"], ["sitename", "psnu"], ["orgunituid"], steps=(1, 2)
    )


_PREV_DIMS = ["psnu", "snu1", "mech_code", "indicator"]


@query(
    "product_prevention",
    with_sql(
        f"""SELECT psnu, snu1, psnu AS short_name, mech_code, DSPID, 'NO' AS HIGHBURDEN, indicator, programme_class,
                   period, period_type, value, {_MIRROR}
            FROM long""",
        "lines",
        moved="""SELECT psnu, snu1, indicator, mech_code || psnu AS DSPID, fiscal_year, quarter, value, target,
                   CASE WHEN fiscal_year = 1999 AND mech_code IN ('Brand#10', 'Brand#11') THEN 'Brand#9' ELSE mech_code END AS mech_code,
                   CASE WHEN snu1 <> 'EUROPE' AND psnu IN ('NATION_0', 'NATION_3') THEN 'original DREAMS district'
                        WHEN snu1 <> 'EUROPE' THEN 'DREAMS expansion district' ELSE 'not a DREAMS district' END AS programme_class
                 FROM lines""",
        wide=wide_sql([*_PREV_DIMS, "DSPID", "programme_class"]).replace("FROM lines", "FROM moved"),
        long=long_sql([*_PREV_DIMS, "DSPID", "programme_class"]),
    ),
)
def product_prevention(t: Tables) -> DataFrame:
    return products.prevention_fact(
        t.wide(_PREV_DIMS), ["A", "N", "R"], {"Brand#10": "Brand#9", "Brand#11": "Brand#9"}, 1999,
        F.col("snu1") != "EUROPE", ["NATION_0", "NATION_3"],
    )


@query(
    "product_epi",
    with_sql(
        f"""SELECT *, {_MIRROR}, CASE WHEN indicator = 'PLHIV' THEN value END AS "PLHIV" FROM
             (SELECT psnu, indicator, standardizeddisaggregate, ageasentered, trendscoarse, period, period_type, source_name,
                     coalesce(sum(value), 0) AS value FROM
               (SELECT psnu, indicator, standardizeddisaggregate, ageasentered, NULL AS trendscoarse, period, period_type,
                       NULL AS source_name, value FROM long
                UNION ALL
                SELECT n_name, 'PLHIV', CASE WHEN c_mktsegment = 'BUILDING' THEN 'Sex' ELSE 'Age/Sex' END,
                       CASE WHEN c_mktsegment = 'BUILDING' THEN 'No age disagg' WHEN c_acctbal < 0 THEN '<01' ELSE '15-19' END,
                       CASE WHEN c_mktsegment = 'BUILDING' THEN NULL WHEN c_acctbal < 0 THEN '<15' ELSE '15+' END,
                       'FY22', 'cumulative', 'estimate', 1.0::DOUBLE
                FROM customer JOIN nation ON c_nationkey = n_nationkey) GROUP BY ALL)""",
        "lines",
        wide=wide_sql(["psnu", "indicator", "standardizeddisaggregate", "ageasentered"]),
        long=long_sql(["psnu", "indicator", "standardizeddisaggregate", "ageasentered"]),
    ),
)
def product_epi(t: Tables) -> DataFrame:
    long = reshape_long(t.wide(["psnu", "indicator", "standardizeddisaggregate", "ageasentered"]))
    people, nations = t.read("customer"), t.read("nation")
    age = F.expr(
        "CASE WHEN c_mktsegment = 'BUILDING' THEN 'No age disagg' WHEN c_acctbal < 0 THEN '<01' ELSE '15-19' END"
    )
    estimates = people.join(nations, people.c_nationkey == nations.n_nationkey).select(
        F.col("n_name").alias("psnu"),
        F.lit("PLHIV").alias("indicator"),
        disaggregate_type(age, F.col("c_mktsegment")).alias("standardizeddisaggregate"),
        age.alias("ageasentered"),
        coarse_age(age).alias("trendscoarse"),
        F.lit("FY22").alias("period"),
        F.lit("cumulative").alias("period_type"),
        F.lit("estimate").alias("source_name"),
        F.lit(1.0).alias("value"),
    )
    return products.with_estimates(long, [estimates], ["A", "N", "R", "PLHIV"])


@query(
    "product_multi_source",
    with_sql(
        """SELECT *, CASE WHEN indicator = 'TX_CURR' THEN value END AS "TX_CURR", CASE WHEN indicator = 'TX_CURR_PS' THEN value END AS "TX_CURR_PS",
                  CASE WHEN indicator = 'TX_CURR_90' THEN value END AS "TX_CURR_90" FROM (
             SELECT psnu, indicator, period, source, ageasentered, trendscoarse, sum(value) AS value FROM (
               SELECT psnu, 'TX_CURR' AS indicator, 'FY' || right(CAST(fiscal_year AS VARCHAR), 2) AS period, 'programme' AS source,
                      CAST(NULL AS VARCHAR) AS ageasentered, CAST(NULL AS VARCHAR) AS trendscoarse, value FROM lines WHERE indicator = 'A'
               UNION ALL
               SELECT CASE WHEN n_name = 'NATION_1' THEN 'First District' ELSE n_name END, 'TX_CURR_PS', 'FY23', 'private',
                      CASE WHEN c_mktsegment = 'BUILDING' THEN '<01' WHEN c_mktsegment = 'HOUSEHOLD' THEN '65+' ELSE '15-19' END,
                      CASE WHEN c_mktsegment = 'BUILDING' THEN '<15' ELSE '15+' END, 1.0::DOUBLE
               FROM customer JOIN nation ON c_nationkey = n_nationkey
               UNION ALL
               SELECT NULL, 'TX_CURR_90', 'FY24Q2', 'public', NULL, NULL, n::DOUBLE FROM series)
             GROUP BY ALL)""",
        "lines",
        "series",
    ),
)
def product_multi_source(t: Tables) -> DataFrame:
    programme = t.lines(["psnu", "indicator", "fiscal_year", "value"]).filter("indicator = 'A'").select(
        "psnu", F.lit("TX_CURR").alias("indicator"), F.expr("concat('FY', substring(fiscal_year, 3, 2))").alias("period"),
        F.lit("programme").alias("source"), "value",
    )
    people, nations = t.read("customer"), t.read("nation")
    spelled = F.expr(
        """CASE c_mktsegment WHEN 'BUILDING' THEN 'Less than one year' WHEN 'HOUSEHOLD' THEN '70-74 years' ELSE '15-19 years' END"""
    )
    band = age_bands(spelled, {**lists.AGE_BAND_SPELLINGS, "Less than one year": "<01"})
    private = people.join(nations, people.c_nationkey == nations.n_nationkey).select(
        area_names("n_name", (("N_1$", "First District"),), None).alias("psnu"),
        F.lit("TX_CURR_PS").alias("indicator"), F.lit("FY23").alias("period"), F.lit("private").alias("source"),
        band.alias("ageasentered"), coarse_age(band).alias("trendscoarse"), F.lit(1.0).alias("value"),
    )
    public = t.series().select(
        F.lit("TX_CURR_90").alias("indicator"), quarter_label("day").alias("period"), F.lit("public").alias("source"),
        F.col("n").cast("double").alias("value"),
    )
    return products.with_estimates(programme, [private, public], ["TX_CURR", "TX_CURR_PS", "TX_CURR_90"])


@query(
    "product_outlay",
    with_sql(
        f"""SELECT *, CASE WHEN indicator = 'budget' THEN value END AS budget,
                   CASE WHEN indicator = 'outlays' THEN value END AS outlays, {_MIRROR} FROM (
             SELECT p_brand AS mech_code, 'budget' AS indicator, CAST(NULL AS VARCHAR) AS period_type, 'FY21Q3' AS period,
                    round(sum(p_retailprice), 2) AS value FROM part GROUP BY 1
             UNION ALL SELECT p_brand, 'outlays', NULL, 'FY21Q3', CAST(sum(p_size) AS DOUBLE) FROM part GROUP BY 1
             UNION ALL SELECT mech_code, indicator, period_type, period, value FROM long)""",
        "lines",
        wide=wide_sql(["mech_code", "indicator"]),
        long=long_sql(["mech_code", "indicator"]),
    ),
)
def product_outlay(t: Tables) -> DataFrame:
    results = reshape_long(t.wide(["mech_code", "indicator"]))
    outlays = t.read("part").groupBy(F.col("p_brand").alias("mech_code")).agg(
        F.round(F.sum("p_retailprice"), 2).alias("budget"), F.sum("p_size").cast("double").alias("outlays")
    )
    return products.outlays_and_results(results, outlays, ["budget", "outlays"], ["A", "N", "R"], "FY21Q3", ["mech_code"])


_QUARTERS = [f"FY{y}Q{q}" for y in (98, 99) for q in range(1, 5)]
_BASE = _QUARTERS[-1]


@query(
    "partner_transition",
    with_sql(
        f"""SELECT psnu, mech_code, {', '.join(_QUARTERS)}, {', '.join(f'{_BASE} - {q} AS difference_{_BASE}_{q}' for q in _QUARTERS[:-1])}
           FROM (SELECT psnu, mech_code, {', '.join(f"sum(CASE WHEN fiscal_year = 19{q[2:4]} THEN qtr{q[-1]} END) AS {q}" for q in _QUARTERS)}
                 FROM wide WHERE NOT contains(psnu, 'N_1') GROUP BY ALL)""",
        "lines",
        wide=wide_sql(["psnu", "mech_code"], "indicator = 'A' AND fiscal_year IN (1998, 1999)"),
    ),
)
def partner_transition(t: Tables) -> DataFrame:
    """Every quarter of the two years around a change of partners, against the last one."""
    rows = t.wide(["psnu", "mech_code", "indicator"], [1998, 1999]).filter("indicator = 'A'")
    return products.partner_transition(rows, ["psnu", "mech_code"], _BASE, _QUARTERS[:-1], "N_1")


_SITE_DIMS = ["orgunituid", "sitename", "psnu", "mech_code", "indicator", "numeratordenom"]
_LAGS = ("A_LAG1", "A_LAG2")


@query(
    "site_dashboard",
    with_sql(
        f"""SELECT orgunituid, sitename, psnu, psnu AS short_name, mech_code, mech_code || psnu AS DSPID, 'NO' AS HIGHBURDEN, indicator, numeratordenom,
                   NULL AS source_name, period, period_type, value, {_MIRROR}, {', '.join(f'CAST(NULL AS DOUBLE) AS {c}' for c in _LAGS)} FROM long
            UNION ALL
            SELECT orgunituid, sitename, psnu, psnu, mech_code, mech_code || psnu, 'NO', indicator, NULL, 'Derived',
                   'FY' || substr(period, 3), 'results', value, NULL, NULL, NULL, {', '.join(f"CASE WHEN indicator = '{c}' THEN value END" for c in _LAGS)}
            FROM (SELECT orgunituid, sitename, psnu, mech_code, period, 'A_LAG1' AS indicator, lag(value, 1) OVER w AS value FROM filled
                    WINDOW w AS (PARTITION BY orgunituid, mech_code ORDER BY period)
                  UNION ALL SELECT orgunituid, sitename, psnu, mech_code, period, 'A_LAG2', lag(value, 2) OVER w FROM filled
                    WINDOW w AS (PARTITION BY orgunituid, mech_code ORDER BY period))""",
        "lines",
        "sites",
        wide=wide_sql(_SITE_DIMS),
        long=long_sql(_SITE_DIMS),
        observed="SELECT orgunituid, mech_code, fiscal_year || 'Q' || quarter AS period, sum(value) AS value FROM lines WHERE indicator = 'A' GROUP BY ALL",
        filled="""SELECT x.orgunituid, x.mech_code, s.sitename, s.psnu, p.period, coalesce(o.value, 0) AS value
                  FROM (SELECT DISTINCT orgunituid, mech_code FROM observed) x CROSS JOIN (SELECT DISTINCT period FROM observed) p
                  LEFT JOIN observed o ON o.orgunituid = x.orgunituid AND o.mech_code = x.mech_code AND o.period = p.period
                  JOIN sites s ON s.orgunituid = x.orgunituid""",
    ),
)
def site_dashboard(t: Tables) -> DataFrame:
    """Long totals by site with mirror columns, and the lagged series of one indicator."""
    fact = t.wide(_SITE_DIMS)
    return products.site_fact(fact, ["A", "N", "R"], "A", ["orgunituid", "mech_code"], ["sitename", "psnu"], ["orgunituid"]).select(
        "orgunituid", "sitename", "psnu", "short_name", "mech_code", "DSPID", "HIGHBURDEN", "indicator", "numeratordenom", "source_name", "period",
        "period_type", "value", "A", "N", "R", *_LAGS)


@query(
    "ranked_mechanisms",
    with_sql(
        """SELECT row_number() OVER (ORDER BY total DESC, mech_code, value DESC, orgunituid) AS position, mech_code, orgunituid, value
           FROM (SELECT *, sum(value) OVER (PARTITION BY mech_code) AS total FROM (SELECT mech_code, orgunituid, sum(value) AS value FROM lines GROUP BY ALL))""",
        "lines",
    ),
)
def ranked_mechanisms(t: Tables) -> DataFrame:
    """Sites of every mechanism, the largest mechanism first, with their position in the whole list."""
    folder = run_folder(t.spark)
    sums = sum_by(t.lines(["mech_code", "orgunituid", "value"]), ["mech_code", "orgunituid"], ["value"])
    products.write_by_total(sums, "mech_code", "value", folder, [F.desc("value"), F.asc("orgunituid")], descending=True, parts=5)
    return read_ranked(t.spark, folder).select("position", "mech_code", "orgunituid", "value")


@query(
    "cash_ages",
    """SELECT band, coarse, count(*) AS n, sum(p_retailprice > 1000)::BIGINT AS dear FROM
         (SELECT *, CASE WHEN p_size < 5 THEN '<5' WHEN p_size < 10 THEN '05-09' WHEN p_size < 15 THEN '0-14' WHEN p_size < 25 THEN '15-24'
                         WHEN p_size < 30 THEN '25-29' WHEN p_size < 40 THEN '25+' WHEN p_size < 45 THEN '80+' ELSE 'Unknown Age' END AS band,
                 CASE WHEN p_size < 15 THEN '<15' WHEN p_size < 45 THEN '15+' END AS coarse FROM part) GROUP BY ALL""",
)
def cash_ages(t: Tables) -> DataFrame:
    """Age bands of the cash source, in all its spellings."""
    spelled = F.expr(
        """CASE WHEN p_size < 5 THEN '< 5' WHEN p_size < 10 THEN ' 5 to 9' WHEN p_size < 15 THEN '0 to 14' WHEN p_size < 25 THEN '15 - 24'
                WHEN p_size < 30 THEN '25 to 29' WHEN p_size < 40 THEN '25 and older' WHEN p_size < 45 THEN '> 80' ELSE 'Other' END"""
    )
    people = t.read("part").select(cash_age_bands(spelled).alias("band"), (F.col("p_retailprice") > 1000).cast("long").alias("dear"))
    return people.groupBy("band", coarse_age("band").alias("coarse")).agg(F.count(F.lit(1)).alias("n"), F.sum("dear").alias("dear"))


@query(
    "executive_extract",
    with_sql(
        """SELECT psnu, CASE WHEN numeratordenom = 'D' THEN indicator || '_D' ELSE indicator END AS indicator, numeratordenom,
                  standardizeddisaggregate, funding_agency, period || ' ' || period_type AS period, period_type, value
           FROM long WHERE indicator IN ('A', 'N') AND standardizeddisaggregate IN ('BUILDING', 'MACHINERY') AND funding_agency = 'F'""",
        "lines",
        wide=wide_sql(["psnu", "indicator", "numeratordenom", "standardizeddisaggregate", "funding_agency"]),
        long=long_sql(["psnu", "indicator", "numeratordenom", "standardizeddisaggregate", "funding_agency"]),
    ),
)
def executive_extract(t: Tables) -> DataFrame:
    long = reshape_long(t.wide(["psnu", "indicator", "numeratordenom", "standardizeddisaggregate", "funding_agency"]))
    return products.executive_extract(long, ["A", "N"], ["BUILDING", "MACHINERY"], "F")


@query(
    "disengagement_extract",
    with_sql(
        """SELECT psnu, orgunituid, indicator, fiscal_year, sum(target) AS targets, sum(value) AS cumulative FROM
             (SELECT l.psnu, orgunituid, indicator, CAST(fiscal_year AS VARCHAR) AS fiscal_year, target, value, standardizeddisaggregate
              FROM lines l JOIN (SELECT psnu FROM areas WHERE DSP = 'Yes') a ON l.psnu = a.psnu
              WHERE funding_agency = 'F' AND fiscal_year IN (1996, 1997) AND NOT contains(standardizeddisaggregate, 'FURN'))
           GROUP BY ALL""",
        "lines",
        "areas",
    ),
)
def disengagement_extract(t: Tables) -> DataFrame:
    rows = t.lines(
        ["psnu", "orgunituid", "indicator", "fiscal_year", "standardizeddisaggregate", "funding_agency", "target", "value"], [1996, 1997]
    )
    kept = lookup(rows, t.areas().select("psnu", "DSP"), ["psnu"]).filter(
        (F.col("DSP") == "Yes") & (F.col("funding_agency") == "F") & ~F.col("standardizeddisaggregate").rlike("FURN")
    )
    texts = kept.drop("DSP", "funding_agency", "standardizeddisaggregate").withColumns(
        {"fiscal_year": F.col("fiscal_year").cast("string"), "targets": F.col("target"), "cumulative": F.col("value")}
    )
    return sum_by_strings(texts.drop("target", "value"), ["targets", "cumulative"])


@query(
    "staffing_fact",
    with_sql(
        """SELECT psnu, psnu AS short_name, mech_code, mech_code || psnu AS DSPID, 'NO' AS HIGHBURDEN, occ_classification,
                  service_delivery_model, indicator,
                  CASE WHEN occ_classification = 'PROMO' THEN 'Yes' WHEN occ_classification = 'SMALL' AND service_delivery_model = 'A'
                       THEN 'Yes' ELSE 'No' END AS CHW_like, 'FY' || right(CAST(fiscal_year AS VARCHAR), 2) AS period, value,
                  CASE WHEN indicator = 'Count' THEN value END AS "Count", CASE WHEN indicator = 'Spend' THEN value END AS "Spend"
           FROM (SELECT g.*, p.fiscal_year, coalesce(v.value, 0) AS value FROM
                   (SELECT DISTINCT psnu, mech_code, occ_classification, service_delivery_model, indicator FROM long) g
                   CROSS JOIN (SELECT unnest(range(a, b + 1)) AS fiscal_year FROM (SELECT min(fiscal_year) AS a, max(fiscal_year) AS b FROM lines)) p
                   LEFT JOIN long v ON g.psnu = v.psnu AND g.mech_code = v.mech_code AND g.indicator = v.indicator
                     AND g.occ_classification IS NOT DISTINCT FROM v.occ_classification
                     AND g.service_delivery_model = v.service_delivery_model AND p.fiscal_year = v.fiscal_year)""",
        "lines",
        long="""SELECT psnu, mech_code, ageasentered AS occ_classification, indicator AS service_delivery_model,
                  CASE WHEN numeratordenom = 'D' THEN 'Count' ELSE 'Spend' END AS indicator, fiscal_year, sum(value) AS value
                FROM lines GROUP BY ALL""",
    ),
)
def staffing_fact(t: Tables) -> DataFrame:
    rows = t.lines(["psnu", "mech_code", "ageasentered", "indicator", "numeratordenom", "fiscal_year", "value"])
    years = t.years()
    sheet = rows.select(
        "psnu", "mech_code", F.col("ageasentered").alias("occ_classification"), F.col("indicator").alias("service_delivery_model"),
        F.expr("if(numeratordenom = 'D', 'Count', 'Spend')").alias("indicator"),
        *[F.when(F.col("fiscal_year") == y, F.col("value")).alias(f"FY{y}") for y in years],
    )
    return products.staffing_fact(
        sheet, [f"FY{y}" for y in years], ["Count", "Spend"], {"PROMO": None, "SMALL": ("A",)}
    )


@query(
    "site_attributes",
    with_sql(
        """SELECT r.listed_name, s.sitename, s.orgunituid, s.psnu, m.staffing_model FROM
             (SELECT sitename AS listed_name FROM roster WHERE snu1 <> 'ASIA') r
             FULL JOIN (SELECT sitename, orgunituid, psnu FROM sites WHERE snu1 <> 'AFRICA') s ON r.listed_name = s.sitename
             LEFT JOIN (SELECT orgunituid, 'Yes' AS staffing_model FROM sites WHERE balance > 5000) m ON s.orgunituid = m.orgunituid""",
        "sites",
        "roster",
    ),
)
def site_attributes(t: Tables) -> DataFrame:
    listed = t.roster().filter("snu1 <> 'ASIA'").select(F.col("sitename").alias("listed_name"))
    hierarchy = t.sites().filter("snu1 <> 'AFRICA'").select("sitename", "orgunituid", "psnu")
    model = t.sites().filter("balance > 5000").select("orgunituid", F.lit("Yes").alias("staffing_model"))
    return products.site_attributes(listed, hierarchy, ("listed_name", "sitename"), {"staffing_model": model})


@query(
    "prevention_coverage",
    with_sql(
        """SELECT l.psnu, a.snu1 AS agency_lookback, sum(target) AS targets,
                  CASE WHEN max(CASE WHEN mech_code = 'Brand#3' THEN 1 ELSE 0 END) = 1 THEN 'Y' ELSE 'N' END AS ovc_coverage
           FROM lines l
           JOIN areas a ON l.psnu = a.psnu WHERE a.snu1 IN ('ASIA', 'EUROPE') GROUP BY ALL""",
        "lines",
        "areas",
    ),
)
def prevention_coverage(t: Tables) -> DataFrame:
    rows = t.lines(["psnu", "mech_code", "target"])
    fact = rows.withColumnRenamed("target", "targets")
    pairs = area_key(fact.select("psnu", "mech_code").distinct())
    agency = lookup(pairs, t.areas(), ["psnu"], ["snu1"]).select("DSPID", F.col("snu1").alias("agency_lookback"))
    return products.prevention_coverage(fact, agency, {"Brand#3": "OVC"}, ["ASIA", "EUROPE"], ["psnu"])


@query(
    "official_names",
    with_sql(
        """SELECT mech_code, CASE WHEN mech_code = 'Brand#7' THEN 'Official seven' ELSE mech_code || ' name' END AS mech_name,
                  CASE funding_agency WHEN 'F' THEN 'Agency one' ELSE funding_agency END AS agency, sum(value) AS value
           FROM lines GROUP BY ALL""",
        "lines",
    ),
)
def official_names_query(t: Tables) -> DataFrame:
    rows = t.lines(["mech_code", "funding_agency", "value"]).groupBy("mech_code", "funding_agency")
    totals = rows.agg(na_sum("value").alias("value")).withColumn("mech_name", F.concat("mech_code", F.lit(" name")))
    official = (
        t.read("part").filter("p_brand = 'Brand#7'").select(F.col("p_brand").alias("mech_code")).distinct()
        .withColumns({"mech_name_official": F.lit("Official seven")})
    )
    named = official_names(totals, official)
    return named.withColumn("agency", agency_short_name("funding_agency", {"F": "Agency one"})).drop("funding_agency")
