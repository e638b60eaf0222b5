"""The driver's tables seen as indicator data: fact, roster, map, series, feeds.

Only the joins a query's columns need are built, so a query on line-item
columns alone is a single pruned scan. ``with_sql`` writes the same views as
common table expressions for the SQL side.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quartermill.functions.periods import fiscal_quarter, fiscal_year, in_fiscal_years
from quartermill.operators.joins import match

QUARTERS = ("qtr1", "qtr2", "qtr3", "qtr4")
#: Columns that follow from the site.
SITE_ATTRIBUTES = ("snu1", "psnu", "sitename")

# Column -> (expression, dimension tables it needs).
_LINE_COLUMNS = {
    "snu1": ("r_name", ("supplier", "area")),
    "psnu": ("n_name", ("supplier", "area")),
    "orgunituid": ("CAST(l_suppkey AS STRING)", ()),
    "sitename": ("s_name", ("supplier",)),
    "mech_code": ("p_brand", ("part",)),
    "ageasentered": ("NULLIF(p_type, 'ECONOMY')", ("part",)),
    "item_size": ("p_size", ("part",)),
    "regimen": ("p_type", ("part",)),
    "funding_agency": ("o_orderstatus", ("orders",)),
    "standardizeddisaggregate": ("c_mktsegment", ("orders", "customer")),
    "indicator": ("l_returnflag", ()),
    "numeratordenom": ("IF(l_linestatus = 'F', 'D', 'N')", ()),
    "value": ("l_quantity", ()),
    "target": ("CAST(FLOOR(l_extendedprice / 1000) AS DOUBLE)", ()),
    "l_orderkey": ("l_orderkey", ()),
    "l_linenumber": ("l_linenumber", ()),
    "l_partkey": ("l_partkey", ()),
    "l_shipdate": ("l_shipdate", ()),
}


class Tables:
    """Lazy access to the parquet tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def read(self, name: str) -> DataFrame:
        """One table."""
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def years(self) -> range:
        """Fiscal years of the fact, from its first and last day."""
        day = self.read("lineitem").agg(F.min("l_shipdate").alias("a"), F.max("l_shipdate").alias("b"))
        first, last = day.select(fiscal_year("a"), fiscal_year("b")).first()
        return range(first or 0, (last if last is not None else -1) + 1)

    def areas(self) -> DataFrame:
        """Area attributes: psnu, snu1 and a yes/no programme flag."""
        nation, region = self.read("nation"), self.read("region")
        joined = nation.join(region, nation.n_regionkey == region.r_regionkey)
        return joined.select(
            "n_nationkey",
            F.col("n_name").alias("psnu"),
            F.col("r_name").alias("snu1"),
            F.when(F.col("r_name").isin("AFRICA", "ASIA"), "Yes").otherwise("No").alias("DSP"),
        )

    def sites(self) -> DataFrame:
        """Every site with its area."""
        supplier, areas = self.read("supplier"), self.areas()
        return supplier.join(areas, supplier.s_nationkey == areas.n_nationkey).select(
            F.col("s_suppkey").cast("string").alias("orgunituid"),
            F.col("s_name").alias("sitename"),
            "psnu",
            "snu1",
            F.col("s_acctbal").alias("balance"),
        )

    def roster(self) -> DataFrame:
        """Facility list: the sites in good standing, so some reporting sites are missing."""
        return self.sites().filter(F.col("balance") >= 0).drop("balance")

    def lines(self, columns: Sequence[str], years: Iterable[int] | None = None, where: Column | None = None) -> DataFrame:
        """Fact rows before any grouping, with only the requested columns and their joins.

        ``years`` and ``where`` (on line-item columns) are applied at the scan.
        """
        df = self.read("lineitem")
        if where is not None:
            df = df.filter(where)
        if years is not None:
            df = df.filter(in_fiscal_years("l_shipdate", years))
        need = {t for c in columns if c in _LINE_COLUMNS for t in _LINE_COLUMNS[c][1]}
        if "part" in need:
            df = match(df, self.read("part"), {"l_partkey": "p_partkey"}, "inner")
        # Dimensions are joined to each other first: the fact then moves once per key, not once per table.
        if "orders" in need:
            orders = self.read("orders")
            if "customer" in need:
                orders = match(orders, self.read("customer"), {"o_custkey": "c_custkey"}, "inner")
            df = match(df, orders, {"l_orderkey": "o_orderkey"}, "inner")
        if "supplier" in need:
            sites = self.read("supplier")
            if "area" in need:
                areas = self.areas().select("n_nationkey", F.col("psnu").alias("n_name"), F.col("snu1").alias("r_name"))
                sites = match(sites, areas, {"s_nationkey": "n_nationkey"}, "inner")
            df = match(df, sites, {"l_suppkey": "s_suppkey"}, "inner")
        return df.select(*[self._column(c) for c in columns])

    @staticmethod
    def _column(name: str) -> Column:
        if name == "fiscal_year":
            return fiscal_year("l_shipdate").alias(name)
        if name == "quarter":
            return fiscal_quarter("l_shipdate").alias(name)
        return F.expr(_LINE_COLUMNS[name][0]).alias(name)

    def wide(self, dims: Sequence[str], years: Iterable[int] | None = None) -> DataFrame:
        """Wide fact: one row per dims and fiscal year with quarters, cumulative and targets.

        Attributes that follow from the site are joined after the grouping when
        the site itself is a dim: same groups, and no join on the line rows.
        """
        late = [d for d in dims if d in SITE_ATTRIBUTES] if "orgunituid" in dims else []
        if late:
            summed = self.wide([d for d in dims if d not in late], years)
            return self.with_site(summed, late).select(*dims, "fiscal_year", *QUARTERS, "cumulative", "targets")
        if any(d in SITE_ATTRIBUTES for d in dims) and not small_enough(self.sites()):
            # By site first, then its attributes, then without the site: no area join on line rows.
            # A site table that fits a broadcast is joined on the map side instead, for one grouping.
            own = [d for d in dims if d not in SITE_ATTRIBUTES]
            summed = self.with_site(self.wide([*own, "orgunituid"], years), [d for d in dims if d in SITE_ATTRIBUTES])
            measures = (*QUARTERS, "cumulative", "targets")
            return summed.groupBy(*dims, "fiscal_year").agg(*[F.sum(m).alias(m) for m in measures])
        rows = self.lines([*dims, "fiscal_year", "quarter", "value", "target"], years)
        quarters = [F.sum(F.when(F.col("quarter") == i, F.col("value"))).alias(q) for i, q in enumerate(QUARTERS, 1)]
        return rows.groupBy(*dims, "fiscal_year").agg(
            *quarters, F.sum("value").alias("cumulative"), F.sum("target").alias("targets")
        )

    def with_site(self, df: DataFrame, columns: Sequence[str] = ("sitename", "psnu", "snu1")) -> DataFrame:
        """Site attributes of an aggregate that carries ``orgunituid``."""
        return match(df, self.sites().select("orgunituid", *columns), ["orgunituid"], "inner")

    def element_keys(self) -> DataFrame:
        """Every combination of the code lists that elements are made of; one of the ages is NULL.

        Indicators and sides are fixed lists; the others come from their own tables, as
        the lists of a map do, so that the fact is not read for it.
        """
        ages = self.read("part").agg(F.collect_set("p_type")).scalar()
        segments = self.read("customer").select(F.col("c_mktsegment").alias("standardizeddisaggregate")).distinct().withColumn("ages", ages)
        each = [("indicator", ("A", "N", "R")), ("numeratordenom", ("D", "N"))]
        for name, codes in each:
            segments = segments.withColumn(name, F.explode(F.array(*[F.lit(c) for c in codes])))
        return segments.withColumn("age", F.explode("ages")).select(
            "indicator", "numeratordenom", "standardizeddisaggregate", F.expr("nullif(age, 'ECONOMY')").alias("ageasentered"))

    def elements(self) -> DataFrame:
        """Disaggregate map with NULL keys and without one disaggregate."""
        kept = self.element_keys().filter(F.col("standardizeddisaggregate") != "FURNITURE")
        text = "concat(indicator, ' (', numeratordenom, ', DSD, ', standardizeddisaggregate"
        return kept.withColumns(
            {
                "element": F.expr(f"{text}, '/', coalesce(ageasentered, 'none'), '): text')"),
                "element_group": F.expr(f"{text}, '): text')"),
            }
        )

    def series(self) -> DataFrame:
        """Events summed by user, type and day: a series with gaps."""
        return (
            self.read("events")
            .withColumn("day", F.col("ts").cast("date"))
            .groupBy(F.col("user_id").cast("string").alias("facility"), "event_type", "day")
            .agg(F.round(F.sum("value"), 2).alias("value"), F.count(F.lit(1)).alias("n"))
        )

    def cadres(self) -> DataFrame:
        """Staffing sheet: one row per facility, one count column per cadre."""
        kinds = ("click", "error", "purchase", "signup", "view")
        return (
            self.read("events")
            .groupBy(F.col("user_id").cast("string").alias("OrgUnit"))
            .agg(*[F.sum(F.when(F.col("event_type") == k, F.lit(1.0))).alias(f"{k} - Position Count") for k in kinds])
        )


def small_enough(df: DataFrame) -> bool:
    """Whether Spark's own estimate of a table is below its broadcast threshold."""
    threshold = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= threshold


def iso(df: DataFrame, *columns: str) -> DataFrame:
    """Date columns as ISO text, the form in which results are reported."""
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


# --- the same views as SQL -------------------------------------------------

_SQL = {
    "lines": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, r_name AS snu1, n_name AS psnu,
               CAST(l_suppkey AS VARCHAR) AS orgunituid, s_name AS sitename, p_brand AS mech_code,
               nullif(p_type, 'ECONOMY') AS ageasentered, p_size AS item_size, p_type AS regimen,
               o_orderstatus AS funding_agency, c_mktsegment AS standardizeddisaggregate,
               l_returnflag AS indicator, CASE WHEN l_linestatus = 'F' THEN 'D' ELSE 'N' END AS numeratordenom,
               CAST(year(l_shipdate + INTERVAL 3 MONTH) AS INTEGER) AS fiscal_year,
               CAST(quarter(l_shipdate + INTERVAL 3 MONTH) AS INTEGER) AS quarter,
               l_quantity AS value, CAST(floor(l_extendedprice / 1000) AS DOUBLE) AS target
        FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
             JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
             JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "areas": """
        SELECT n_nationkey, n_name AS psnu, r_name AS snu1,
               CASE WHEN r_name IN ('AFRICA', 'ASIA') THEN 'Yes' ELSE 'No' END AS DSP
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "sites": """
        SELECT CAST(s_suppkey AS VARCHAR) AS orgunituid, s_name AS sitename, n_name AS psnu, r_name AS snu1,
               s_acctbal AS balance
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "roster": "SELECT orgunituid, sitename, psnu, snu1 FROM sites WHERE balance >= 0",
    "elements": """
        SELECT DISTINCT indicator, numeratordenom, standardizeddisaggregate, ageasentered,
               indicator || ' (' || numeratordenom || ', DSD, ' || standardizeddisaggregate || '/'
                   || coalesce(ageasentered, 'none') || '): text' AS element,
               indicator || ' (' || numeratordenom || ', DSD, ' || standardizeddisaggregate || '): text' AS element_group
        FROM lines WHERE standardizeddisaggregate <> 'FURNITURE'""",
    "series": """
        SELECT CAST(user_id AS VARCHAR) AS facility, event_type, CAST(ts AS DATE) AS day,
               round(sum(value), 2) AS value, count(*) AS n
        FROM events GROUP BY ALL""",
    "cadres": """
        SELECT CAST(user_id AS VARCHAR) AS OrgUnit,
               CAST(sum(CASE WHEN event_type = 'click' THEN 1 END) AS DOUBLE) AS click,
               CAST(sum(CASE WHEN event_type = 'error' THEN 1 END) AS DOUBLE) AS error,
               CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 END) AS DOUBLE) AS purchase,
               CAST(sum(CASE WHEN event_type = 'signup' THEN 1 END) AS DOUBLE) AS signup,
               CAST(sum(CASE WHEN event_type = 'view' THEN 1 END) AS DOUBLE) AS "view"
        FROM events GROUP BY 1""",
}
_NEEDS = {"roster": ["sites"], "elements": ["lines"]}


def wide_sql(dims: Sequence[str], where: str = "true") -> str:
    """Body of the wide fact at the given dims."""
    names = ", ".join([*dims, "fiscal_year"])
    quarters = ", ".join(f"sum(CASE WHEN quarter = {i} THEN value END) AS {q}" for i, q in enumerate(QUARTERS, 1))
    return (
        f"SELECT {names}, {quarters}, sum(value) AS cumulative, sum(target) AS targets "
        f"FROM lines WHERE {where} GROUP BY {names}"
    )


def long_sql(dims: Sequence[str], source: str = "wide") -> str:
    """Body of the long form of a wide view."""
    names = ", ".join(dims)
    year = "'FY' || right(CAST(fiscal_year AS VARCHAR), 2)"
    parts = [
        f"SELECT {names}, {year} || 'Q{i}' AS period, 'results' AS period_type, {q} AS value FROM {source} WHERE {q} IS NOT NULL"
        for i, q in enumerate(QUARTERS, 1)
    ] + [
        f"SELECT {names}, {year} AS period, '{m}' AS period_type, {m} AS value FROM {source} WHERE {m} IS NOT NULL"
        for m in ("cumulative", "targets")
    ]
    return " UNION ALL ".join(parts)


def with_sql(body: str, *views: str, **extra: str) -> str:
    """``WITH`` the named shared views and the extra ones, then the body."""
    names: list[str] = []
    for v in views:
        for n in [*_NEEDS.get(v, []), v]:
            if n not in names:
                names.append(n)
    ctes = [f"{n} AS ({_SQL[n]})" for n in names] + [f"{n} AS ({sql})" for n, sql in extra.items()]
    return f"WITH {', '.join(ctes)} {body}" if ctes else body
