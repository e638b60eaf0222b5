"""Queries for filters and column selection."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermill.catalog.registry import query
from quartermill.catalog.tables import Tables, iso, wide_sql, with_sql
from quartermill.functions.selectors import starting
from quartermill.functions.semantics import in_set, na_sum, not_in
from quartermill.operators.aggregates import sum_by
from quartermill.operators.filters import exclude_where, inside_box, latest_period
from quartermill.operators.joins import matched


@query(
    "not_in_keep_null",
    with_sql(
        """SELECT ageasentered, indicator, count(*) AS n, sum(value) AS value FROM lines
           WHERE ageasentered IS NULL OR ageasentered NOT IN ('PROMO', 'SMALL') GROUP BY ALL""",
        "lines",
    ),
)
def not_in_keep_null(t: Tables) -> DataFrame:
    rows = t.lines(["ageasentered", "indicator", "value"]).filter(not_in("ageasentered", ["PROMO", "SMALL"]))
    return rows.groupBy("ageasentered", "indicator").agg(F.count(F.lit(1)).alias("n"), na_sum("value").alias("value"))


@query(
    "compound_exclusion",
    with_sql(
        """SELECT psnu, indicator, ageasentered, count(*) AS n FROM lines
           WHERE NOT (psnu IN ('NATION_1', 'NATION_7') AND indicator IN ('A', 'N'))
             AND NOT (coalesce(ageasentered = 'SMALL', indicator = 'R') AND indicator = 'R') GROUP BY ALL""",
        "lines",
    ),
)
def compound_exclusion(t: Tables) -> DataFrame:
    rows = t.lines(["psnu", "indicator", "ageasentered"])
    kept = exclude_where(rows, in_set("psnu", ["NATION_1", "NATION_7"]), in_set("indicator", ["A", "N"]))
    kept = exclude_where(kept, F.col("ageasentered") == "SMALL", in_set("indicator", ["R"]))
    return kept.groupBy("psnu", "indicator", "ageasentered").agg(F.count(F.lit(1)).alias("n"))


@query(
    "pattern_filter",
    """SELECT p_partkey, p_name, contains(p_name, 'ring') AS is_ring FROM part
       WHERE regexp_matches(p_name, '^(small|large)') AND NOT regexp_matches(p_name, 'anvil$')""",
)
def pattern_filter(t: Tables) -> DataFrame:
    name = F.col("p_name")
    return (
        t.read("part")
        .filter(name.rlike("^(small|large)") & ~name.rlike("anvil$"))
        .select("p_partkey", "p_name", name.contains("ring").alias("is_ring"))
    )


@query(
    "drop_any_null",
    with_sql(
        """SELECT l_orderkey, l_linenumber, ageasentered, nullif(indicator, 'N') AS indicator FROM lines
           WHERE ageasentered IS NOT NULL AND nullif(indicator, 'N') IS NOT NULL""",
        "lines",
    ),
)
def drop_any_null(t: Tables) -> DataFrame:
    rows = t.lines(["l_orderkey", "l_linenumber", "ageasentered", "indicator"])
    return rows.withColumn("indicator", F.nullif("indicator", F.lit("N"))).dropna("any")


@query(
    "latest_period",
    with_sql("SELECT facility, event_type, CAST(day AS VARCHAR) AS day, value FROM series WHERE day = (SELECT max(day) FROM series)", "series"),
)
def latest_period_query(t: Tables) -> DataFrame:
    return iso(latest_period(t.series().drop("n"), "day"), "day")


@query(
    "prefix_sum",
    with_sql(
        """SELECT snu1, indicator, numeratordenom, coalesce(sum(qtr1), 0) AS qtr1, coalesce(sum(qtr2), 0) AS qtr2,
                  coalesce(sum(qtr3), 0) AS qtr3, coalesce(sum(qtr4), 0) AS qtr4 FROM wide GROUP BY ALL""",
        "lines",
        wide=wide_sql(["snu1", "sitename", "indicator", "numeratordenom"]),
    ),
)
def prefix_sum(t: Tables) -> DataFrame:
    wide = t.wide(["snu1", "orgunituid", "indicator", "numeratordenom"])
    return sum_by(wide, ["snu1", "indicator", "numeratordenom"], starting(wide, "qtr"))


@query(
    "key_list_semi",
    with_sql(
        """SELECT orgunituid, indicator, sum(value) AS value FROM lines
           WHERE orgunituid IN (SELECT orgunituid FROM roster) GROUP BY ALL""",
        "lines",
        "roster",
    ),
)
def key_list_semi(t: Tables) -> DataFrame:
    totals = sum_by(t.lines(["orgunituid", "indicator", "value"]), ["orgunituid", "indicator"], ["value"])
    return matched(totals, t.roster(), ["orgunituid"], null_safe=False)


@query(
    "bbox_filter",
    """SELECT p_partkey, p_size AS x, p_retailprice AS y FROM part
       WHERE p_size BETWEEN 10 AND 30 AND p_retailprice BETWEEN 920 AND 1050""",
)
def bbox_filter(t: Tables) -> DataFrame:
    points = t.read("part").select("p_partkey", F.col("p_size").alias("x"), F.col("p_retailprice").alias("y"))
    return inside_box(points, "x", "y", 10, 30, 920, 1050)
