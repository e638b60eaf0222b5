"""Queries for grouped sums, counts and roll-ups."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermill.catalog.registry import query
from quartermill.catalog.tables import Tables, wide_sql, with_sql
from quartermill.operators.aggregates import (
    collapse_bands, count_by, distinct_count, keys_with_more_than, resum_repeats, roster, row_total, sum_by_strings,
)
from quartermill.plans.context import labels_by_code

_STRING_DIMS = ["snu1", "mech_code", "indicator", "numeratordenom"]

#: Five-year bands of the item size, with NULL where the fact has no age.
FINE_BAND = """CASE WHEN regimen <> 'ECONOMY' THEN
    concat(lpad(cast(floor(item_size / 5) * 5 AS int), 2, '0'), '-', lpad(cast(floor(item_size / 5) * 5 + 4 AS int), 2, '0')) END"""
FINE_BAND_SQL = """CASE WHEN regimen <> 'ECONOMY' THEN
    lpad(CAST(CAST(floor(item_size / 5) * 5 AS INTEGER) AS VARCHAR), 2, '0') || '-'
    || lpad(CAST(CAST(floor(item_size / 5) * 5 + 4 AS INTEGER) AS VARCHAR), 2, '0') END"""


@query(
    "group_by_strings",
    with_sql(
        """SELECT snu1, mech_code, indicator, numeratordenom, coalesce(sum(qtr1), 0) AS qtr1, coalesce(sum(targets), 0) AS targets,
                  coalesce(sum(cumulative), 0) AS cumulative FROM wide GROUP BY ALL""",
        "lines",
        wide=wide_sql(_STRING_DIMS),
    ),
)
def group_by_strings(t: Tables) -> DataFrame:
    return sum_by_strings(t.wide(_STRING_DIMS), ["qtr1", "targets", "cumulative"])


@query(
    "count_by",
    with_sql("SELECT snu1, funding_agency, indicator, count(*) AS n FROM lines GROUP BY ALL", "lines"),
)
def count_by_query(t: Tables) -> DataFrame:
    return count_by(t.lines(["snu1", "funding_agency", "indicator"]), ["snu1", "funding_agency", "indicator"])


@query(
    "distinct_count",
    with_sql(
        """SELECT psnu, funding_agency, count(DISTINCT orgunituid) AS sites FROM lines GROUP BY ALL""",
        "lines",
    ),
)
def distinct_count_query(t: Tables) -> DataFrame:
    rows = t.lines(["psnu", "funding_agency", "orgunituid"])
    return distinct_count(rows, ["psnu", "funding_agency"], "orgunituid", "sites")


@query("having_count", "SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) > 7")
def having_count(t: Tables) -> DataFrame:
    return keys_with_more_than(t.lines(["l_orderkey"]), ["l_orderkey"], 7)


@query(
    "band_collapse",
    with_sql(
        f"""SELECT indicator, numeratordenom,
                   CASE WHEN band IN ('40-44', '45-49', '50-54') THEN '40+' WHEN band = '00-04' THEN '01-04' ELSE band END AS band,
                   sum(value) AS value
            FROM (SELECT indicator, numeratordenom, {FINE_BAND_SQL} AS band, value FROM lines) GROUP BY ALL""",
        "lines",
    ),
)
def band_collapse(t: Tables) -> DataFrame:
    rows = t.lines(["indicator", "numeratordenom", "regimen", "item_size", "value"])
    banded = rows.withColumn("band", F.expr(FINE_BAND)).drop("regimen", "item_size")
    return collapse_bands(banded, "band", {"40-44": "40+", "45-49": "40+", "50-54": "40+", "00-04": "01-04"}, ["value"])


@query(
    "sql_group_sum",
    """SELECT CAST(user_id AS VARCHAR) AS OrgUnit, 'sheet' AS mech_name,
              count(CASE WHEN event_type = 'click' THEN 1 END) AS clicks,
              count(CASE WHEN event_type = 'error' THEN 1 END) AS errors,
              round(sum(CASE WHEN event_type = 'purchase' THEN value ELSE 0 END), 2) AS purchases
       FROM events GROUP BY 1""",
)
def sql_group_sum(t: Tables) -> DataFrame:
    return t.spark.sql(
        """SELECT OrgUnit, mech_name,
                  count_if(event_type = 'click') AS clicks, count_if(event_type = 'error') AS errors,
                  round(sum(if(event_type = 'purchase', value, 0.0D)), 2) AS purchases
           FROM {sheet} GROUP BY mech_name, OrgUnit""",
        sheet=t.read("events").selectExpr(
            "CAST(user_id AS STRING) AS OrgUnit", "'sheet' AS mech_name", "event_type", "value"
        ),
    )


@query(
    "row_rollup",
    with_sql(
        """SELECT OrgUnit, coalesce(click, 0) + coalesce("view", 0) AS Clinical,
                  coalesce(error, 0) + coalesce(signup, 0) + coalesce(purchase, 0) AS Other_HCW,
                  click + error + purchase + signup + "view" AS complete_total FROM cadres""",
        "cadres",
    ),
)
def row_rollup(t: Tables) -> DataFrame:
    sheet = t.cadres()
    count = {k: f"{k} - Position Count" for k in ("click", "error", "purchase", "signup", "view")}
    return sheet.select(
        "OrgUnit",
        row_total([F.col(count["click"]), F.col(count["view"])]).alias("Clinical"),
        row_total([F.col(count[k]) for k in ("error", "signup", "purchase")]).alias("Other_HCW"),
        row_total([F.col(c) for c in count.values()], skip_null=False).alias("complete_total"),
    )


@query(
    "distinct_roster",
    with_sql(
        """SELECT DISTINCT psnu, orgunituid, sitename, mech_code,
                  CASE WHEN mech_code IN ('Brand#1', 'Brand#2') THEN 'Care' WHEN mech_code = 'Brand#3' THEN 'Prevention'
                       ELSE '' END AS technical_area FROM lines""",
        "lines",
    ),
)
def distinct_roster(t: Tables) -> DataFrame:
    sites = roster(t.lines(["psnu", "orgunituid", "sitename", "mech_code"]), ["psnu", "orgunituid", "sitename", "mech_code"])
    labels = {"Brand#1": "Care", "Brand#2": "Care", "Brand#3": "Prevention"}
    return sites.withColumn("technical_area", labels_by_code("mech_code", labels))


@query(
    "dedup_subset",
    """WITH urgent AS (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')
       SELECT l_orderkey, l_linenumber, sum(l_quantity) AS value FROM
         (SELECT DISTINCT l_orderkey, l_linenumber, l_quantity FROM lineitem SEMI JOIN urgent ON l_orderkey = o_orderkey)
       GROUP BY ALL
       UNION ALL
       SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem ANTI JOIN urgent ON l_orderkey = o_orderkey""",
)
def dedup_subset(t: Tables) -> DataFrame:
    records = t.lines(["l_orderkey", "l_linenumber", "value"])
    urgent = t.read("orders").filter("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").alias("l_orderkey"))
    return resum_repeats(records, urgent, ["l_orderkey"], ["l_orderkey", "l_linenumber"], "value")

