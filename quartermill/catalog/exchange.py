"""Queries that write files, find them and read them back, and rosters for exchange with partners."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermill.catalog.quality import (
    _COMPARE_SQL, _N_OVER_D_SQL, _PRIOR_SQL, _REPORTED_SQL, _TARGET_SQL, A_LESS_R, A_NOT_N, LARGE_OVER_TOTAL, N_OVER_D, every_finding, report,
)
from quartermill.catalog.registry import query
from quartermill.catalog.tables import Tables, long_sql, wide_sql, with_sql
from quartermill.functions.periods import heading_months
from quartermill.functions.selectors import clean_names
from quartermill.functions.text import recode
from quartermill.operators.joins import overlap_join
from quartermill.operators.windows import add_count
from quartermill.plans import products, quality
from quartermill.session import run_folder
from quartermill.sources.readers import latest_folder, promote_header, read_delimited, read_many
from quartermill.sources.writers import write_delimited, write_findings

SITE_SCHEMA = "orgunituid string, sitename string, psnu string, balance double"


@query(
    "delimited_roundtrip",
    with_sql(
        """SELECT CASE WHEN balance >= 0 THEN 'sites_a' ELSE 'sites_b' END AS source, psnu, count(*) AS n,
                  round(sum(balance), 2) AS balance, min(sitename) AS first_site FROM sites GROUP BY ALL""",
        "sites",
    ),
)
def delimited_roundtrip(t: Tables) -> DataFrame:
    """Two extracts of several files each; the second has its columns in another order."""
    folder, sites = run_folder(t.spark), t.sites()
    write_delimited(sites.filter("balance >= 0").select("orgunituid", "sitename", "psnu", "balance").repartition(3), f"{folder}/sites_a")
    write_delimited(sites.filter("balance < 0").select("balance", "psnu", "sitename", "orgunituid").repartition(2), f"{folder}/sites_b")
    rows = read_many(t.spark, folder, "sites_*", fmt="csv", schema=SITE_SCHEMA, source="source")
    return rows.groupBy("source", "psnu").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("balance"), 2).alias("balance"), F.min("sitename").alias("first_site"))


@query("latest_extract", with_sql("SELECT orgunituid, sitename, psnu, balance FROM sites WHERE psnu <> 'NATION_3'", "sites"))
def latest_extract(t: Tables) -> DataFrame:
    """The newest of two extracts, found by the time of its files and read whole."""
    folder, sites = run_folder(t.spark), t.sites().select("orgunituid", "sitename", "psnu", "balance")
    write_delimited(sites, f"{folder}/1")
    write_delimited(sites.filter("psnu <> 'NATION_3'").repartition(3), f"{folder}/2")
    return read_delimited(t.spark, latest_folder(t.spark, f"{folder}/*"), SITE_SCHEMA)


@query("late_header", with_sql("SELECT orgunituid AS org_unit, sitename AS site_name, CAST(balance AS VARCHAR) AS balance_usd FROM sites", "sites"))
def late_header(t: Tables) -> DataFrame:
    """Sheets whose names stand on their third line, below a title, with a line of units after them."""
    folder, sites = run_folder(t.spark), t.sites()
    cells = F.concat_ws(",", "orgunituid", F.concat(F.lit('"'), "sitename", F.lit('"')), F.col("balance").cast("string"))
    # A sheet per area: its lines are one value, so they stay in order.
    title = F.array(F.lit("Site list"), F.lit(""), F.lit('"Org Unit","Site - Name","Balance (USD)"'), F.lit(",,USD"))
    sheets = sites.groupBy("psnu").agg(F.concat_ws("\n", title, F.sort_array(F.collect_list(cells))).alias("value"))
    sheets.repartition(4).write.partitionBy("psnu").text(folder)
    return promote_header(t.spark, f"{folder}/*", 3, skip_after=1)


@query(
    "monthly_feed",
    "SELECT CAST(user_id AS VARCHAR) AS facility, strftime(ts, '%m-%Y') AS month, count(*) AS n FROM events GROUP BY ALL",
)
def monthly_feed(t: Tables) -> DataFrame:
    """A sheet with a column per month, headed by spreadsheet day numbers, back to rows named by month."""
    first = F.trunc("ts", "month")
    rows = t.read("events").select(
        F.col("user_id").cast("string").alias("facility"), F.datediff(first, F.lit("1899-12-30").cast("date")).alias("serial"))
    sheet = rows.groupBy("facility").pivot("serial").count()
    months = heading_months(sheet.columns)
    long = sheet.unpivot(["facility"], list(months), "heading", "n").filter("n IS NOT NULL")
    return long.select("facility", recode("heading", months).alias("month"), "n")


@query(
    "findings_roundtrip",
    with_sql(
        f"""SELECT level, type_check, period, indicator, "check", psnu, sitename, mech_code FROM
              ({_TARGET_SQL} UNION ALL {_PRIOR_SQL} UNION ALL {_N_OVER_D_SQL} UNION ALL {_COMPARE_SQL})""",
        "lines",
        reported=_REPORTED_SQL,
    ),
)
def findings_roundtrip(t: Tables) -> DataFrame:
    """Both levels in the finding layout, written by level and read back."""
    folder = run_folder(t.spark)
    write_findings(quality.report(report(t, every_finding(t, [N_OVER_D, A_LESS_R, A_NOT_N, LARGE_OVER_TOTAL]))), folder, fmt="parquet")
    return t.spark.read.parquet(folder).select("level", "type_check", "period", "indicator", "check", "psnu", "sitename", "mech_code")


@query("added_count", with_sql("SELECT orgunituid, sitename, psnu, count(*) OVER (PARTITION BY psnu) AS n FROM sites", "sites"))
def added_count(t: Tables) -> DataFrame:
    return add_count(t.sites().select("orgunituid", "sitename", "psnu"), ["psnu"])


_SEMI = ["psnu", "mech_code", "indicator"]


@query(
    "semi_wide_product",
    with_sql(
        """SELECT psnu, mech_code, indicator, period, sum(CASE WHEN period_type = 'results' THEN value END) AS results,
                  sum(CASE WHEN period_type = 'cumulative' THEN value END) AS cumulative,
                  sum(CASE WHEN period_type = 'targets' THEN value END) AS targets
           FROM long GROUP BY ALL""",
        "lines",
        wide=wide_sql(_SEMI),
        long=long_sql(_SEMI),
    ),
)
def semi_wide_product(t: Tables) -> DataFrame:
    # Quarters without a row are missing, not zero: only sums that exist become rows.
    return products.semi_wide_fact(t.wide(_SEMI), _SEMI).filter("period NOT LIKE '%Q%' OR results <> 0")


@query(
    "partner_geography",
    with_sql(
        """SELECT DISTINCT orgunituid, mech_code, CASE WHEN mech_code = 'Brand#1' THEN 'Care & Treatment' ELSE '' END AS technical_area FROM lines""",
        "lines",
    ),
)
def partner_geography(t: Tables) -> DataFrame:
    return products.partner_geography(t.lines(["orgunituid", "mech_code"]), ["orgunituid", "mech_code"], {"Brand#1": "Care & Treatment"})


@query(
    "overlap_join",
    """SELECT c_custkey AS id, coalesce(s_name, c_name) AS name, coalesce(nullif(greatest(s_acctbal, 0), 0), c_acctbal) AS balance, c_mktsegment AS segment
       FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey""",
)
def overlap_join_query(t: Tables) -> DataFrame:
    """Clients with what the site of the same number has, where it has it."""
    clients = t.read("customer").selectExpr("c_custkey AS id", "c_name AS name", "c_acctbal AS balance", "c_mktsegment AS segment")
    sites = t.read("supplier").selectExpr("s_suppkey AS id", "s_name AS name", "nullif(greatest(s_acctbal, 0), 0) AS balance")
    return overlap_join(clients, sites, ["id"], prefer="right")


@query("clean_headings", with_sql("SELECT orgunituid AS org_unit_id, sitename AS site_name, psnu AS site_name_2, balance AS balance_usd FROM sites", "sites"))
def clean_headings(t: Tables) -> DataFrame:
    return clean_names(t.sites().select("orgunituid", "sitename", "psnu", "balance").toDF("Org Unit ID", "Site - Name", "site name", "Balance (USD)"))
