"""Queries for period series, shares, repeats and ordering."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermill.catalog.registry import query
from quartermill.catalog.tables import Tables, iso, wide_sql, with_sql
from quartermill.functions.semantics import na_sum, round_even
from quartermill.operators.reshape import complete_grid
from quartermill.operators.series import completed, fill_within, lagged, pack, unpack
from quartermill.operators.windows import find_repeats, first_per_key, period_differences, repair_codes
from quartermill.plans.products import achievement_table, custom_order, target_share

_GRID_SQL = """
    SELECT t.facility, t.event_type, p.day, CASE WHEN s.facility IS NULL THEN 0 ELSE s.value END AS value, s.n
    FROM (SELECT DISTINCT facility, event_type FROM series) t CROSS JOIN (SELECT DISTINCT day FROM series) p
         LEFT JOIN series s ON s.facility = t.facility AND s.event_type = t.event_type AND s.day = p.day"""


SERIES = ["facility", "event_type"]


def grid(t: Tables) -> DataFrame:
    """Series completed over every observed day."""
    return complete_grid(t.series(), "day", SERIES, {"value": 0.0})


def packed_grid(t: Tables) -> DataFrame:
    """The same as one row per series."""
    return completed(pack(t.series(), SERIES, "day", ["value"]), {"value": 0.0})


@query("complete_grid", with_sql(f"SELECT * REPLACE (CAST(day AS VARCHAR) AS day) FROM ({_GRID_SQL})", "series"))
def complete_grid_query(t: Tables) -> DataFrame:
    return iso(grid(t), "day")


@query(
    "lag_periods",
    with_sql(
        """SELECT facility, event_type, CAST(day AS VARCHAR) AS day, value, lag(value, 1) OVER w AS value_lag1, lag(value, 2) OVER w AS value_lag2
           FROM grid WINDOW w AS (PARTITION BY facility, event_type ORDER BY day)""",
        "series",
        grid=_GRID_SQL,
    ),
)
def lag_periods_query(t: Tables) -> DataFrame:
    return iso(unpack(lagged(packed_grid(t), "value")), "day")


@query(
    "fill_downup",
    with_sql(
        """SELECT facility, event_type, CAST(day AS VARCHAR) AS day, value, coalesce(n, m) AS n FROM grid JOIN
             (SELECT facility, day, coalesce(
                 last_value(m IGNORE NULLS) OVER (PARTITION BY facility ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                 first_value(m IGNORE NULLS) OVER (PARTITION BY facility ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS m
              FROM (SELECT facility, day, min(n) AS m FROM grid GROUP BY ALL)) USING (facility, day)""",
        "series",
        grid=_GRID_SQL,
    ),
)
def fill_downup(t: Tables) -> DataFrame:
    return iso(fill_within(grid(t), ["n"], ["facility"], "day"), "day")


@query(
    "share_of_total",
    with_sql(
        """SELECT mech_code, indicator, fiscal_year, targets,
                  round_even(targets / nullif(sum(targets) OVER (PARTITION BY indicator, fiscal_year), 0), 6) AS share
           FROM (SELECT mech_code, indicator, fiscal_year, sum(target) AS targets FROM lines GROUP BY ALL)""",
        "lines",
    ),
)
def share_of_total_query(t: Tables) -> DataFrame:
    rows = t.lines(["mech_code", "indicator", "fiscal_year", "target"]).withColumnRenamed("target", "targets")
    shares = target_share(rows, ["mech_code"], ["indicator", "fiscal_year"])
    return shares.withColumn("share", round_even("share", 6))


@query(
    "find_dupes",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity AS value,
              count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS dupe_count
       FROM lineitem QUALIFY dupe_count > 1""",
)
def find_dupes(t: Tables) -> DataFrame:
    rows = t.lines(["l_orderkey", "l_linenumber", "l_partkey", "value"])
    return find_repeats(rows, ["l_orderkey", "l_linenumber"])


@query(
    "find_full_copies",
    """SELECT l_orderkey, l_quantity AS value, count(*) OVER (PARTITION BY l_orderkey, l_quantity) AS dupe_count
       FROM lineitem QUALIFY dupe_count > 1""",
)
def find_full_copies(t: Tables) -> DataFrame:
    return find_repeats(t.lines(["l_orderkey", "value"]))


@query(
    "first_per_key",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
       QUALIFY row_number() OVER (PARTITION BY l_orderkey
         ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) = 1""",
)
def first_per_key_query(t: Tables) -> DataFrame:
    rows = t.read("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return first_per_key(rows, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity"])


@query(
    "period_diff",
    with_sql(
        """SELECT psnu, funding_agency, p1 AS FY99Q1, p2 AS FY99Q2, p3 AS FY99Q3, p4 AS FY99Q4, p1 - p2 AS difference_FY99Q1_FY99Q2,
                  p1 - p3 AS difference_FY99Q1_FY99Q3, p1 - p4 AS difference_FY99Q1_FY99Q4
           FROM (SELECT psnu, funding_agency, sum(CASE WHEN quarter = 1 THEN value END) AS p1, sum(CASE WHEN quarter = 2 THEN value END) AS p2,
                        sum(CASE WHEN quarter = 3 THEN value END) AS p3, sum(CASE WHEN quarter = 4 THEN value END) AS p4
                 FROM lines WHERE fiscal_year = 1999 GROUP BY ALL)""",
        "lines",
    ),
)
def period_diff(t: Tables) -> DataFrame:
    rows = t.lines(["psnu", "funding_agency", "quarter", "value"], [1999])
    labelled = rows.withColumn("period", F.concat(F.lit("FY99Q"), "quarter"))
    return period_differences(labelled, ["psnu", "funding_agency"], "period", "value", "FY99Q1", ["FY99Q2", "FY99Q3", "FY99Q4"])


_CODE = """CASE WHEN indicator = 'R' THEN NULL
    WHEN indicator = 'A' AND snu1 IN ('AFRICA', 'ASIA') THEN concat('S', lpad(orgunituid, 7, '0'))
    WHEN indicator = 'A' THEN orgunituid ELSE concat('X', orgunituid) END"""


@query(
    "code_repair",
    with_sql(
        f"""SELECT f.sitename, c.fixed AS code, sum(value) AS value, count(*) AS n
            FROM (SELECT sitename, {_CODE} AS code, value FROM lines) f
            JOIN (SELECT sitename, code, last_value(fixed IGNORE NULLS) OVER (PARTITION BY sitename
                         ORDER BY length(code) DESC NULLS LAST, code NULLS LAST) AS fixed
                  FROM (SELECT sitename, code, CASE WHEN code IS NULL THEN NULL
                               WHEN length(code) < 6 THEN listed ELSE code END AS fixed
                        FROM (SELECT DISTINCT sitename, {_CODE} AS code FROM lines)
                        LEFT JOIN (SELECT sitename, 'L' || lpad(orgunituid, 7, '0') AS listed FROM roster) USING (sitename))) c
              ON f.sitename = c.sitename AND f.code IS NOT DISTINCT FROM c.code
            GROUP BY 1, 2""",
        "lines",
        "roster",
    ),
)
def code_repair(t: Tables) -> DataFrame:
    rows = t.lines(["sitename", "orgunituid", "indicator", "snu1", "value"])
    # Sums per site and code first: the repair joins those, not the fact rows.
    coded = rows.groupBy("sitename", F.expr(_CODE).alias("code")).agg(na_sum("value").alias("value"), F.count(F.lit(1)).alias("n"))
    listed = t.roster().select(F.col("sitename").alias("listed_name"), F.expr("concat('L', lpad(orgunituid, 7, '0'))").alias("new_code"))
    fixed = repair_codes(coded, "code", ["sitename"], listed, ("sitename", "listed_name"), "new_code", one_row_per_code=True)
    return fixed.groupBy("sitename", "code").agg(na_sum("value").alias("value"), F.sum("n").alias("n"))


_ORDER = ["R", "A", "N"]


@query(
    "achievement",
    with_sql(
        """SELECT mech_code, fiscal_year, indicator, qtr1, qtr2, qtr3, qtr4, targets, order_index, 1.0::DOUBLE - reached AS diff,
                  CASE WHEN indicator <> 'N' THEN cumulative END AS cumulative,
                  CASE WHEN indicator <> 'N' THEN reached END AS achievement,
                  CASE WHEN indicator = 'N' THEN 'NA' WHEN reached < 0.75 THEN 'Below' WHEN reached < 0.9 THEN 'Close'
                       WHEN reached IS NOT NULL THEN 'Met' END AS status
           FROM (SELECT mech_code, fiscal_year, indicator, coalesce(qtr1, 0) AS qtr1, coalesce(qtr2, 0) AS qtr2,
                        coalesce(qtr3, 0) AS qtr3, coalesce(qtr4, 0) AS qtr4, targets, cumulative,
                        round_even(cumulative / nullif(targets, 0), 2) AS reached,
                        CAST(list_position(['R', 'A', 'N'], indicator) AS INTEGER) AS order_index FROM wide)""",
        "lines",
        wide=wide_sql(["mech_code", "indicator"]),
    ),
)
def achievement(t: Tables) -> DataFrame:
    return achievement_table(
        t.wide(["mech_code", "indicator"]), ["mech_code", "fiscal_year"], _ORDER, masked=["N"],
        bands=[(0.75, "Below"), (0.9, "Close"), (float("inf"), "Met")],
    )


@query(
    "custom_order",
    with_sql(
        """SELECT o_orderpriority, n, CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '5-LOW' THEN 2 ELSE 3 END AS order_index
           FROM (SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1)"""
    ),
)
def custom_order_query(t: Tables) -> DataFrame:
    counts = t.read("orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("order_index", custom_order("o_orderpriority", ["1-URGENT", "5-LOW"])).orderBy(
        "order_index", "o_orderpriority"
    )

