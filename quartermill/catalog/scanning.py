"""Queries for scans, sources and sinks."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermill.catalog.registry import query
from quartermill.catalog.tables import Tables, iso, with_sql
from quartermill.functions.semantics import na_sum
from quartermill.operators.aggregates import sum_by
from quartermill.operators.filters import current_rows, keep_listed, latest_rows
from quartermill.operators.setops import join_vintages
from quartermill.plans import rollup
from quartermill.session import run_folder
from quartermill.sources.readers import flatten_grid, read_many, tagged_union
from quartermill.sources.vintages import read_years, replace_years
from quartermill.sources.writers import write_by_key


@query(
    "scan_filter",
    with_sql(
        """SELECT l_orderkey, l_linenumber, indicator, fiscal_year, value FROM lines
           WHERE indicator IN ('A', 'R') AND numeratordenom = 'N' AND fiscal_year IN (1998, 1999, 2001)""",
        "lines",
    ),
)
def scan_filter(t: Tables) -> DataFrame:
    columns = ["l_orderkey", "l_linenumber", "indicator", "fiscal_year", "value"]
    rows = t.lines(columns, [1998, 1999, 2001], F.col("l_linestatus") != "F")
    return keep_listed(rows, "indicator", ["A", "R"])


@query(
    "multi_file_union",
    """SELECT 'customer.parquet' AS source, count(*) AS n, round(sum(c_acctbal), 2) AS total FROM customer
       UNION ALL SELECT 'supplier.parquet', count(*), round(sum(s_acctbal), 2) FROM supplier""",
)
def multi_file_union(t: Tables) -> DataFrame:
    rows = read_many(t.spark, t.folder, "{customer,supplier}.parquet", source="source", merge=True)
    return rows.groupBy("source").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum(F.coalesce("c_acctbal", "s_acctbal")), 2).alias("total")
    )


@query(
    "tagged_sources",
    """SELECT s_name AS Facility, CAST(s_suppkey AS VARCHAR) AS Code, s_acctbal AS Total, 'SITES' AS indicator,
              CAST(NULL AS VARCHAR) AS Sheet, CAST(NULL AS VARCHAR) AS Result FROM supplier
       UNION ALL SELECT c_name, NULL, CASE WHEN c_acctbal >= 0 THEN c_acctbal END, 'CLIENTS', c_mktsegment, NULL FROM customer
       UNION ALL SELECT p_brand, NULL, p_retailprice, 'ITEMS', NULL, p_type FROM part""",
)
def tagged_sources(t: Tables) -> DataFrame:
    sites = t.read("supplier").selectExpr("s_name", "concat(s_suppkey, '.0')", "cast(s_acctbal AS string)")
    clients = t.read("customer").selectExpr("c_name", "c_mktsegment", "if(c_acctbal < 0, 'n/a', cast(c_acctbal AS string))")
    items = t.read("part").selectExpr("p_brand", "p_type", "cast(p_retailprice AS string)")
    return tagged_union(
        {
            "SITES": (sites, ["Facility", "Code", "Total"]),
            "CLIENTS": (clients, ["Facility", "Sheet", "Total"]),
            "ITEMS": (items, ["Facility", "Result", "Total"]),
        }
    )


@query(
    "latest_snapshot",
    """SELECT event_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_id, value FROM events
       QUALIFY CAST(ts AS DATE) = max(CAST(ts AS DATE)) OVER (PARTITION BY event_type)""",
)
def latest_snapshot(t: Tables) -> DataFrame:
    events = t.read("events").select("event_type", F.col("ts").cast("date").alias("day"), "event_id", "value")
    return iso(latest_rows(events, ["event_type"], "day"), "day")


@query(
    "vintage_union",
    with_sql(
        "SELECT fiscal_year, indicator, sum(value) AS value, count(*) AS n FROM lines GROUP BY ALL",
        "lines",
    ),
)
def vintage_union(t: Tables) -> DataFrame:
    # The newest three years are open.
    years = t.years()
    closed, current = years[:-3], years[-3:]
    columns = ["fiscal_year", "indicator", "value"]
    both = join_vintages(t.lines(columns, closed), t.lines(columns, current), closed, current)
    return both.groupBy("fiscal_year", "indicator").agg(na_sum("value").alias("value"), F.count(F.lit(1)).alias("n"))


@query(
    "replaced_vintage",
    with_sql(
        """SELECT fiscal_year, indicator, sum(CASE WHEN fiscal_year = newest THEN 2 * value ELSE value END) AS value
           FROM lines, (SELECT max(fiscal_year) AS newest FROM lines) GROUP BY ALL""",
        "lines",
    ),
)
def replaced_vintage(t: Tables) -> DataFrame:
    """Years stored, the open one replaced, and a second replacement that breaks off half-way and is never seen."""
    folder, years = run_folder(t.spark), t.years()
    rows = t.lines(["fiscal_year", "indicator", "value"])
    sums = rows.groupBy("fiscal_year", "indicator").agg(na_sum("value").alias("value"))
    replace_years(sums, folder, years)
    replace_years(sums.withColumn("value", 2 * F.col("value")), folder, years[-1:])
    broken = F.when(F.col("indicator") == "N", F.raise_error(F.lit("the source broke off")).cast("double")).otherwise(-F.col("value"))
    try:
        replace_years(sums.withColumn("value", broken), folder, years[-1:])
    except Exception as e:  # noqa: BLE001 - the one that was asked for
        if "the source broke off" not in str(e):
            raise
    return read_years(t.spark, folder)


@query(
    "rollup_answer",
    with_sql(
        "SELECT mech_code, indicator, fiscal_year, sum(value) AS value, sum(target) AS target, count(*) AS n_rows FROM lines GROUP BY ALL",
        "lines",
    ),
)
def rollup_answer(t: Tables) -> DataFrame:
    """A rollup by site, mechanism, disaggregate and quarter; its open year is rebuilt, and a coarser sum comes from it."""
    folder, years = run_folder(t.spark), t.years()
    dims, measures = ["orgunituid", "mech_code", "indicator", "numeratordenom"], ["value", "target"]
    columns = [*dims, *rollup.GRAIN, *measures]
    rollup.build(t.lines(columns), folder, dims, measures, years)
    rollup.refresh(t.lines(columns, years[-1:]), folder, dims, measures, years[-1:])
    return rollup.answer(t.spark, folder, ["mech_code", "indicator", "fiscal_year"], measures)


@query(
    "current_ref_rows",
    "SELECT CAST(s_suppkey AS VARCHAR) AS orgunituid, 'Yes' AS reference_site FROM supplier WHERE s_acctbal > 0",
)
def current_ref_rows(t: Tables) -> DataFrame:
    table = t.read("supplier").withColumn("orgunituid", F.col("s_suppkey").cast("string"))
    return current_rows(table, F.col("s_acctbal") > 0, ["orgunituid"], "reference_site")


@query(
    "json_flatten",
    """SELECT event_id, CAST(user_id AS VARCHAR) AS facility, json_extract_string(props, '$.k') AS k FROM events
       UNION ALL SELECT event_id, event_type, CAST(NULL AS VARCHAR) FROM events""",
)
def json_flatten(t: Tables) -> DataFrame:
    grid = F.expr(
        """concat('{"listGrid":{"headers":[{"column":"k"},{"column":"facility"}],"rows":[["',
                  get_json_object(props, '$.k'), '","', user_id, '"],[null,"', event_type, '"]]}}')"""
    )
    return flatten_grid(t.read("events").select("event_id", grid.alias("grid")), "grid", ["facility", "k"], ["event_id"])


@query(
    "partner_split_counts",
    with_sql("SELECT mech_code, count(*) AS n, sum(value) AS value FROM lines GROUP BY 1", "lines"),
)
def partner_split_counts(t: Tables) -> DataFrame:
    # Written as one folder per partner, read back by partition.
    folder = run_folder(t.spark)
    write_by_key(t.lines(["mech_code", "value"]), folder, ["mech_code"])
    return t.spark.read.parquet(folder).groupBy("mech_code").agg(F.count(F.lit(1)).alias("n"), na_sum("value").alias("value"))


@query(
    "group_sum",
    with_sql(
        """SELECT psnu, indicator, fiscal_year, sum(value) AS value, sum(target) AS target
           FROM lines GROUP BY ALL""",
        "lines",
    ),
)
def group_sum(t: Tables) -> DataFrame:
    rows = t.lines(["psnu", "indicator", "fiscal_year", "value", "target"])
    return sum_by(rows, ["psnu", "indicator", "fiscal_year"], ["value", "target"])
