"""Queries for string, label and period functions."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermill.catalog.registry import query
from quartermill.catalog.tables import Tables, with_sql
from quartermill.functions import periods, text
from quartermill.functions.semantics import extract, if_else, na_sum, unite
from quartermill.functions.selectors import leading, span, without
from quartermill.operators.aggregates import sum_by
from quartermill.operators.reshape import pivot_values, unpivot
from quartermill.plans.context import short_area_name, with_denominator_suffix


@query(
    "short_name",
    """SELECT s_suppkey, area, short_name, mech_code || short_name AS DSPID,
              replace(short_name, 'Supplier', '') AS removed, regexp_replace(area, '0', 'o') AS first_zero,
              replace(area, '0', '') AS no_zero
       FROM (SELECT s_suppkey, area, 'M' || s_nationkey AS mech_code,
                    replace(replace(area, 'District Municipality', 'DM'), 'Metropolitan Municipality', 'MM') AS short_name
             FROM (SELECT s_suppkey, s_nationkey, s_name || CASE WHEN s_acctbal > 5000 THEN ' Metropolitan' ELSE ' District' END
                          || ' Municipality' AS area FROM supplier))""",
)
def short_name(t: Tables) -> DataFrame:
    kind = F.when(F.col("s_acctbal") > 5000, " Metropolitan").otherwise(" District")
    areas = t.read("supplier").select("s_suppkey", "s_nationkey", F.concat("s_name", kind, F.lit(" Municipality")).alias("area"))
    named = areas.withColumn("short_name", short_area_name("area"))
    return named.select(
        "s_suppkey", "area", "short_name",
        unite(F.concat(F.lit("M"), "s_nationkey"), "short_name", sep="").alias("DSPID"),
        text.remove_all("short_name", "Supplier").alias("removed"),
        text.replace_first("area", "0", "o").alias("first_zero"),
        text.remove_all("area", "0").alias("no_zero"),
    )


@query(
    "parse_element",
    with_sql(
        """SELECT element_name, indicator, numeratordenom, 'DSD' AS support_type, standardizeddisaggregate AS disaggregate,
                  CASE WHEN target_row THEN 'Targets' ELSE 'Results' END AS kind, n,
                  'FY21' AS fiscal_year, CASE WHEN indicator = 'A' THEN 'Community' ELSE 'Facility' END AS sitetype,
                  CASE WHEN indicator = 'A' THEN 'HomeCom' ELSE 'TBClinic' END AS modality
           FROM (SELECT indicator, numeratordenom, standardizeddisaggregate, value > 25 AS target_row, count(*) AS n,
                        indicator || ' (' || numeratordenom || ', DSD, ' || standardizeddisaggregate || ')'
                        || CASE WHEN value > 25 THEN ' TARGET' ELSE '' END || ': text' AS element_name
                 FROM lines GROUP BY ALL)""",
        "lines",
    ),
)
def parse_element(t: Tables) -> DataFrame:
    rows = t.lines(["indicator", "numeratordenom", "standardizeddisaggregate", "value"])
    names = rows.select(
        F.expr(
            """concat(indicator, ' (', numeratordenom, ', DSD, ', standardizeddisaggregate, ')',
                      if(value > 25, ' TARGET', ''), ': text')"""
        ).alias("element_name"),
        F.expr("if(indicator = 'A', 'Community - Home Based FY21', 'Facility - TB Clinic FY21')").alias("item"),
    )
    counted = names.groupBy("element_name", "item").agg(F.count(F.lit(1)).alias("n"))
    parsed = text.parse_element(counted, "element_name").withColumn("kind", text.element_kind("element_name"))
    return text.parse_modality(parsed, "item").withColumnRenamed("short_name", "modality").drop("item", "name")


@query(
    "string_basics",
    """SELECT c_custkey, upper(left(c_name, 4)) AS head, right(c_name, 3) AS tail, CAST(length(c_name) AS INTEGER) AS len,
              trim('  ' || lower(c_mktsegment) || ' ') AS segment,
              nullif(regexp_extract(c_name, '#0*([1-9]\\d*)$', 1), '') AS number,
              lower(c_mktsegment) = lower('Building') AS is_building, substring(c_name, 3, 4) AS middle
       FROM customer""",
)
def string_basics(t: Tables) -> DataFrame:
    return t.read("customer").select(
        "c_custkey",
        F.upper(text.substring_from("c_name", 1, 4)).alias("head"),
        text.substring_from("c_name", -3).alias("tail"),
        F.length("c_name").alias("len"),
        F.trim(F.concat(F.lit("  "), F.lower("c_mktsegment"), F.lit(" "))).alias("segment"),
        extract("c_name", r"#0*([1-9]\d*)$", 1).alias("number"),
        text.contains_ignoring_case("c_mktsegment", F.lit("Building")).alias("is_building"),
        text.substring_from("c_name", 3, 6).alias("middle"),
    )


@query(
    "split_columns",
    with_sql(
        """SELECT psnu, indicator, numeratordenom AS ageasentered, 'FY' || right(CAST(fiscal_year AS VARCHAR), 2) AS period,
                  sum(value) AS value, NULL::VARCHAR AS extra
           FROM lines GROUP BY ALL""",
        "lines",
    ),
)
def split_columns(t: Tables) -> DataFrame:
    rows = t.lines(["psnu", "indicator", "numeratordenom", "fiscal_year", "value"])
    labelled = rows.select(
        "psnu", F.concat_ws("-", "indicator", "numeratordenom", periods.year_label("fiscal_year")).alias("heading"), "value"
    )
    headings = [f"{i}-{nd}-FY{y}" for i in "ANR" for nd in "ND" for y in ("95", "96", "97", "98", "99", "00", "01", "02")]
    sheet = pivot_values(labelled, ["psnu"], "heading", headings)
    long = unpivot(sheet, ["psnu"], headings, "heading", "value").filter(F.col("value").isNotNull())
    return text.split_into(long, "heading", ["indicator", "ageasentered", "period", "extra"], "-")


@query(
    "composite_key",
    with_sql(
        """SELECT indicator || '_' || coalesce(ageasentered, 'NA') || '_' || coalesce(nullif(numeratordenom, 'N'), 'NA') AS disagg_key,
                  count(*) AS n FROM lines GROUP BY 1""",
        "lines",
    ),
)
def composite_key(t: Tables) -> DataFrame:
    rows = t.lines(["indicator", "ageasentered", "numeratordenom"])
    key = unite("indicator", "ageasentered", F.nullif("numeratordenom", F.lit("N")))
    return rows.groupBy(key.alias("disagg_key")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "recode",
    with_sql(
        """SELECT CASE standardizeddisaggregate WHEN 'BUILDING' THEN 'Total' WHEN 'MACHINERY' THEN 'Age/Sex'
                       ELSE standardizeddisaggregate END AS disagg, CASE WHEN ageasentered = 'SMALL' THEN 'S' ELSE ageasentered END AS age,
                  sum(value) AS value FROM lines GROUP BY 1, 2""",
        "lines",
    ),
)
def recode(t: Tables) -> DataFrame:
    rows = sum_by(
        t.lines(["standardizeddisaggregate", "ageasentered", "value"]), ["standardizeddisaggregate", "ageasentered"], ["value"]
    )
    renamed = rows.select(
        text.recode("standardizeddisaggregate", {"BUILDING": "Total", "MACHINERY": "Age/Sex"}).alias("disagg"),
        text.recode("ageasentered", {"SMALL": "S"}).alias("age"),
        "value",
    )
    return sum_by(renamed, ["disagg", "age"], ["value"])


@query(
    "fiscal_period",
    """SELECT event_id, 'FY' || right(CAST(year(d) AS VARCHAR), 2) || 'Q' || quarter(d) AS period,
              CAST(DATE '1899-12-30' + CAST(event_id % 60000 AS INTEGER) AS VARCHAR) AS serial_day,
              CAST(CAST(date_trunc('month', ts) AS DATE) AS VARCHAR) AS month
       FROM (SELECT event_id, ts, ts + to_months(CAST(event_id % 30 AS INTEGER)) + INTERVAL 3 MONTH AS d FROM events)""",
)
def fiscal_period(t: Tables) -> DataFrame:
    events = t.read("events")
    day = F.add_months(F.col("ts").cast("date"), (F.col("event_id") % 30).cast("int"))
    return events.select(
        "event_id",
        periods.quarter_label(day).alias("period"),
        periods.serial_date((F.col("event_id") % 60000).cast("string")).cast("string").alias("serial_day"),
        periods.month_year(F.date_format("ts", "MM-yyyy")).cast("string").alias("month"),
    )


@query(
    "period_labels",
    with_sql(
        """SELECT fiscal_year, quarter, calendar, CASE WHEN quarter = 1 THEN (fiscal_year - 1) || 'Q4'
                       ELSE fiscal_year || 'Q' || (quarter - 1) END AS iso,
                  'FY' || right(CAST(fiscal_year + CASE WHEN quarter = 4 THEN 1 ELSE 0 END AS VARCHAR), 2) AS fy,
                  'FY' || right(CAST(fiscal_year AS VARCHAR), 2) || 'M0' || quarter AS month_label,
                  'FY' || right(CAST(fiscal_year AS VARCHAR), 2) || 'Q' || quarter AS short, n
           FROM (SELECT fiscal_year, quarter, 'CY' || fiscal_year || 'Q' || quarter AS calendar, count(*) AS n
                 FROM lines GROUP BY ALL)""",
        "lines",
    ),
)
def period_labels(t: Tables) -> DataFrame:
    rows = t.lines(["fiscal_year", "quarter"]).groupBy("fiscal_year", "quarter")
    labelled = rows.agg(F.count(F.lit(1)).alias("n")).withColumn(
        "calendar", F.concat(F.lit("CY"), "fiscal_year", F.lit("Q"), "quarter")
    )
    quarter = F.concat(periods.year_label("fiscal_year"), F.lit("Q"), "quarter")
    return labelled.select(
        "fiscal_year", "quarter", "calendar", "n",
        periods.fiscal_to_calendar_quarter(quarter).alias("iso"),
        periods.calendar_quarter_to_year("calendar").alias("fy"),
        periods.iso_period_label(F.lit("Monthly"), F.concat("fiscal_year", F.lit("0"), "quarter")).alias("month_label"),
        periods.drop_century(F.concat(F.lit("FY"), "fiscal_year", F.lit("Q"), "quarter")).alias("short"),
    )


@query(
    "number_label",
    with_sql(
        """SELECT mech_code, indicator, value, CASE WHEN value >= 1e9 THEN CAST(round_even(value / 1e9, 0) AS BIGINT) || 'B'
                       WHEN value >= 1e6 THEN CAST(round_even(value / 1e6, 0) AS BIGINT) || 'M'
                       WHEN value >= 1e3 THEN CAST(round_even(value / 1e3, 0) AS BIGINT) || 'K'
                       ELSE CAST(CAST(value AS BIGINT) AS VARCHAR) END AS label
           FROM (SELECT mech_code, indicator, sum(value) AS value FROM lines GROUP BY ALL
                 UNION ALL SELECT mech_code, 'scaled', sum(value) * 1000 FROM lines GROUP BY ALL
                 UNION ALL SELECT mech_code, 'line', max(value) FROM lines GROUP BY ALL)""",
        "lines",
    ),
)
def number_label(t: Tables) -> DataFrame:
    rows = t.lines(["mech_code", "indicator", "value"])
    # One pass: per mechanism the sum of each indicator, from which its total follows, and the largest line.
    totals = rows.groupBy("mech_code", "indicator").agg(na_sum("value").alias("value"), F.max("value").alias("largest"))
    listed = totals.groupBy("mech_code").agg(
        F.collect_list(F.struct("indicator", "value")).alias("each"), (na_sum("value") * 1000).alias("scaled"), F.max("largest").alias("line"))
    more = F.array(*[F.struct(F.lit(name).alias("indicator"), F.col(name).alias("value")) for name in ("scaled", "line")])
    each = listed.select("mech_code", F.inline(F.concat("each", more)))
    return each.withColumn("label", text.number_label("value"))


@query(
    "name_cleanup",
    """SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN NULL ELSE 'A' || p_size || 'B' END AS award,
              CASE WHEN p_type = 'PROMO' THEN 'A' || p_size || 'B - ' || p_name ELSE p_name END AS mech_name
       FROM part""",
)
def name_cleanup(t: Tables) -> DataFrame:
    parts = t.read("part").select(
        "p_partkey",
        F.col("p_partkey").cast("string").alias("code"),
        F.expr("concat(p_partkey, ' - A', p_size, 'B - ', p_name, '\n')").alias("full"),
        F.expr("if(p_type = 'PROMO', 'TBD partner', p_type)").alias("partner"),
    )
    return parts.select(
        "p_partkey",
        text.mechanism_award("full", "partner").alias("award"),
        text.mechanism_name("full", "code", "partner").alias("mech_name"),
    )


@query(
    "exchange_names",
    "SELECT p_partkey, CASE WHEN p_partkey % 4 = 2 THEN p_name || ' - x' ELSE p_name END AS mech_name FROM part",
)
def exchange_names(t: Tables) -> DataFrame:
    """Mechanism names of the exchange list: with code and award, placeholder, dashes of their own, award only."""
    entry = F.expr(
        """CASE p_partkey % 4 WHEN 0 THEN concat(p_partkey, ' - 720', p_size, 'FA - ', p_name) WHEN 1 THEN concat('0000', p_size % 2, ' ', p_name)
                              WHEN 2 THEN concat(p_partkey, ' - ', p_name, ' - x') ELSE concat('AID-OAA - ', p_name) END"""
    )
    return t.read("part").select("p_partkey", text.listed_mechanism_name(entry).alias("mech_name"))


@query(
    "nd_suffix",
    with_sql(
        """SELECT CASE WHEN nd IS NULL THEN NULL WHEN nd = 'D' THEN indicator || '_D' ELSE indicator END AS indicator,
                  'FY' || right(CAST(fiscal_year AS VARCHAR), 2) || ' ' || 'results' AS period, sum(value) AS value
           FROM (SELECT *, CASE WHEN ageasentered IS NULL THEN NULL ELSE numeratordenom END AS nd FROM lines) GROUP BY 1, 2""",
        "lines",
    ),
)
def nd_suffix(t: Tables) -> DataFrame:
    rows = t.lines(["indicator", "numeratordenom", "ageasentered", "fiscal_year", "value"])
    nd = F.when(F.col("ageasentered").isNotNull(), F.col("numeratordenom"))
    named = rows.select(
        with_denominator_suffix("indicator", nd).alias("indicator"),
        unite(periods.year_label("fiscal_year"), F.lit("results"), sep=" ").alias("period"),
        "value",
    )
    return sum_by(named, ["indicator", "period"], ["value"])


@query(
    "three_way_conditional",
    with_sql(
        """SELECT CASE WHEN ageasentered IS NULL THEN NULL WHEN ageasentered = 'SMALL' THEN 'small' ELSE 'other' END AS band,
                  count(*) AS n FROM lines GROUP BY 1""",
        "lines",
    ),
)
def three_way_conditional(t: Tables) -> DataFrame:
    band = if_else(F.col("ageasentered") == "SMALL", F.lit("small"), F.lit("other"))
    return t.lines(["ageasentered"]).groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "select_by_name",
    "SELECT l_returnflag, l_linestatus, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem",
)
def select_by_name(t: Tables) -> DataFrame:
    lines = t.read("lineitem")
    kept = lines.select(*without(lines, ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate"]))
    return leading(kept, ["l_returnflag", "l_linestatus"]).select(
        "l_returnflag", "l_linestatus", *span(lines, "l_quantity", "l_tax")
    )
