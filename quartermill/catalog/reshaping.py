"""Queries for wide, long and semi-wide forms, pivots and mirror columns."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermill.catalog.registry import query
from quartermill.catalog.tables import Tables, long_sql, wide_sql, with_sql
from quartermill.functions.selectors import without
from quartermill.operators.reshape import (
    cross_tab, mirror_columns, pivot_values, reshape_long, reshape_semi_wide, reshape_wide, stack_bands, unpivot,
)

DIMS = ["psnu", "indicator", "numeratordenom", "ageasentered"]


@query("reshape_long", with_sql(long_sql(DIMS), "lines", wide=wide_sql(DIMS)))
def reshape_long_query(t: Tables) -> DataFrame:
    return reshape_long(t.wide(DIMS))


@query(
    "reshape_wide",
    with_sql(
        """SELECT psnu, indicator, numeratordenom, ageasentered,
                  sum(CASE WHEN period = 'FY96Q1' THEN value END) AS fy1996q1, sum(CASE WHEN period = 'FY96Q2' THEN value END) AS fy1996q2,
                  sum(CASE WHEN period = 'FY96Q3' THEN value END) AS fy1996q3, sum(CASE WHEN period = 'FY96Q4' THEN value END) AS fy1996q4
           FROM long WHERE period_type = 'results' GROUP BY ALL""",
        "lines",
        wide=wide_sql(DIMS),
        long=long_sql(DIMS),
    ),
)
def reshape_wide_query(t: Tables) -> DataFrame:
    long = reshape_long(t.wide(DIMS)).filter("period_type = 'results'")
    return reshape_wide(long, [f"FY96Q{q}" for q in range(1, 5)], DIMS)


@query(
    "reshape_semi_wide",
    with_sql(
        """SELECT psnu, indicator, numeratordenom, ageasentered, period,
                  sum(CASE WHEN period_type = 'results' THEN value END) AS results,
                  sum(CASE WHEN period_type = 'cumulative' THEN value END) AS cumulative,
                  sum(CASE WHEN period_type = 'targets' THEN value END) AS targets
           FROM long GROUP BY ALL""",
        "lines",
        wide=wide_sql(DIMS),
        long=long_sql(DIMS),
    ),
)
def reshape_semi_wide_query(t: Tables) -> DataFrame:
    return reshape_semi_wide(t.wide(DIMS))


@query(
    "unpivot_generic",
    with_sql(
        """SELECT OrgUnit, 'click - Position Count' AS cadre, click AS value FROM cadres
           UNION ALL SELECT OrgUnit, 'error - Position Count', error FROM cadres
           UNION ALL SELECT OrgUnit, 'purchase - Position Count', purchase FROM cadres
           UNION ALL SELECT OrgUnit, 'signup - Position Count', signup FROM cadres
           UNION ALL SELECT OrgUnit, 'view - Position Count', "view" FROM cadres""",
        "cadres",
    ),
)
def unpivot_generic(t: Tables) -> DataFrame:
    sheet = t.cadres()
    return unpivot(sheet, ["OrgUnit"], without(sheet, ["OrgUnit"]), "cadre", "value")


@query(
    "pivot_values",
    with_sql(
        """SELECT psnu, indicator, sum(CASE WHEN ageasentered = 'SMALL' THEN value END) AS SMALL,
                  sum(CASE WHEN ageasentered = 'LARGE' THEN value END) AS LARGE, sum(CASE WHEN ageasentered IS NULL THEN value END) AS NA,
                  sum(CASE WHEN ageasentered = 'ABSENT' THEN value END) AS ABSENT
           FROM lines GROUP BY ALL""",
        "lines",
    ),
)
def pivot_values_query(t: Tables) -> DataFrame:
    rows = t.lines(["psnu", "indicator", "ageasentered", "value"])
    return pivot_values(rows, ["psnu", "indicator"], "ageasentered", ["SMALL", "LARGE", None, "ABSENT"])


@query(
    "mirror_columns",
    with_sql(
        """SELECT *, CASE WHEN indicator = 'A' THEN value END AS A, CASE WHEN indicator = 'N' THEN value END AS N,
                  CASE WHEN indicator = 'R' THEN value END AS R FROM long""",
        "lines",
        wide=wide_sql(DIMS),
        long=long_sql(DIMS),
    ),
)
def mirror_columns_query(t: Tables) -> DataFrame:
    return mirror_columns(reshape_long(t.wide(DIMS)), "indicator", ["A", "N", "R"])


@query(
    "multi_band_unpivot",
    """WITH aged AS (SELECT p_brand, CAST(p_size AS VARCHAR) AS age,
             CASE WHEN p_size >= 45 THEN '45+' ELSE CAST(p_size // 5 AS VARCHAR) END AS age_to_45,
             CASE WHEN p_size >= 15 THEN '15+' ELSE '<15' END AS age_coarse FROM part)
       SELECT p_brand, system, ageasentered, count(*) AS n FROM (
         SELECT p_brand, 'Age/SingleYear/Sex' AS system, age AS ageasentered FROM aged
         UNION ALL SELECT p_brand, 'Age/Sex', age_to_45 FROM aged
         UNION ALL SELECT p_brand, 'Age/Sex/HIVStatus', age_coarse FROM aged) GROUP BY ALL""",
)
def multi_band_unpivot(t: Tables) -> DataFrame:
    aged = t.read("part").selectExpr(
        "p_brand",
        "cast(p_size AS string) AS age",
        "if(p_size >= 45, '45+', cast(p_size div 5 AS string)) AS age_to_45",
        "if(p_size >= 15, '15+', '<15') AS age_coarse",
    )
    systems = {"age": "Age/SingleYear/Sex", "age_to_45": "Age/Sex", "age_coarse": "Age/Sex/HIVStatus"}
    long = stack_bands(aged, systems, "system", "ageasentered")
    return long.groupBy("p_brand", "system", "ageasentered").agg(F.count(F.lit(1)).alias("n"))


@query(
    "cross_tab",
    with_sql(
        """SELECT indicator, 'FY' || right(CAST(fiscal_year AS VARCHAR), 2) || 'Q' || quarter AS period,
                  sum(CASE WHEN funding_agency = 'F' THEN value END) AS F, sum(CASE WHEN funding_agency = 'O' THEN value END) AS O,
                  sum(CASE WHEN funding_agency = 'P' THEN value END) AS P
           FROM lines GROUP BY ALL""",
        "lines",
    ),
)
def cross_tab_query(t: Tables) -> DataFrame:
    rows = t.lines(["indicator", "funding_agency", "fiscal_year", "quarter", "value"])
    labelled = rows.withColumn(
        "period", F.expr("concat('FY', substring(fiscal_year, 3, 2), 'Q', quarter)")
    )
    return cross_tab(labelled, ["indicator", "period"], "funding_agency", ["F", "O", "P"])

