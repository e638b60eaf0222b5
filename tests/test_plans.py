"""The physical plans are the ones meant: no pair joins, no needless shuffles, filters at the scan."""

import io
import re
from contextlib import redirect_stdout

import pytest

from quartermill.catalog import load
from quartermill.catalog.tables import Tables
from quartermill.functions.semantics import not_in
from quartermill.operators import reshape, setops, windows

FOLDER = "/root/testdata/sf0.001"
EAGER: set[str] = set()


def plan(df) -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture
def unhinted(spark):
    """Plans as they are when no side is small enough to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", sorted(set(load()) - EAGER))
def test_no_pair_join_and_no_python(unhinted, name):
    text = plan(load()[name](unhinted, FOLDER))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas"):
        assert bad not in text, name
    assert "BroadcastHashJoin" not in text, f"{name} forces a broadcast"


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(load()["scan_filter"](spark, FOLDER))
    pushed = re.search(r"PushedFilters: \[(.*)\]", text).group(1)
    assert "In(l_returnflag, [A,R])" in pushed and "l_shipdate" in pushed and "Not(EqualTo(l_linestatus,F))" in pushed
    kept = plan(Tables(spark, FOLDER).read("part").filter(not_in("p_type", ["PROMO"])))
    assert "PushedFilters: [Or(IsNull(p_type),Not(" in kept
    schema = re.search(r"ReadSchema: struct<(.*)>", text).group(1)
    assert "l_extendedprice" not in schema and "l_tax" not in schema


def test_mirror_and_long_form_add_no_shuffle(spark):
    wide = Tables(spark, FOLDER).read("lineitem").selectExpr(
        "l_returnflag AS indicator", "year(l_shipdate) AS fiscal_year", "l_quantity AS qtr1", "l_tax AS cumulative"
    )
    text = plan(reshape.mirror_columns(reshape.reshape_long(wide), "indicator", ["A", "N"]))
    assert "Exchange" not in text


def test_hot_keys_are_cut_before_the_shuffle(spark):
    lines = Tables(spark, FOLDER).read("lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    first = plan(windows.first_per_key(lines, ["l_orderkey"], ["l_linenumber", "l_partkey"]))
    assert first.count("WindowGroupLimit") >= 2
    shares = plan(windows.share_of_total(lines, "l_linenumber", ["l_orderkey"]))
    assert not re.search(r"\) Window\b", shares)


def test_rules_share_one_pass(spark):
    t = Tables(spark, FOLDER)
    from quartermill.catalog import quality as q

    every = [q.N_OVER_D, q.A_LESS_R, q.A_NOT_N, q.LARGE_OVER_TOTAL, q.PARTS, q.CROSS, q.RATIO]
    assert plan(q.yearly_findings(t, every)).count("lineitem.parquet") == plan(q.yearly_findings(t, [q.CROSS])).count("lineitem.parquet")


def test_grid_needs_no_join(spark):
    series = Tables(spark, FOLDER).series()
    text = plan(reshape.complete_grid(series, "day", ["facility", "event_type"], {"value": 0.0}))
    assert "Join" not in text


def test_vintages_read_only_their_partitions(spark, tmp_path):
    path = str(tmp_path / "fact")
    spark.range(6).selectExpr("id", "cast(2019 + id AS int) AS fiscal_year").write.partitionBy("fiscal_year").parquet(path)
    frozen, current = spark.read.parquet(path), spark.read.parquet(path)
    both = setops.join_vintages(frozen, current, [2019, 2020], [2023])
    text = plan(both)
    assert re.findall(r"PartitionFilters: \[.*fiscal_year#\d+ (?:IN \(2019,2020\)|= 2023)", text)
    assert sorted(r.fiscal_year for r in both.collect()) == [2019, 2020, 2023]


def test_site_joins_do_not_touch_fact_rows(unhinted):
    t = Tables(unhinted, FOLDER)
    text = plan(t.wide(["psnu", "orgunituid", "indicator"]))
    body = text[text.index("== Physical Plan =="):]
    # In the tree the top join is above the aggregate of the line items.
    lines = body.splitlines()
    first_join = next(i for i, x in enumerate(lines) if "SortMergeJoin" in x)
    first_aggregate = next(i for i, x in enumerate(lines) if "HashAggregate" in x)
    assert first_join < first_aggregate


def test_adaptive_execution_splits_a_hot_key(unhinted):
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: unhinted.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        unhinted.conf.set(k, v)
    try:
        rows = unhinted.range(0, 300_000, 1, 8).selectExpr(
            "id", "if(id % 3 = 0, 'hot', concat('g', id % 5000)) AS g", "cast(id % 7 AS double) AS v"
        )
        shared = windows.share_of_total(rows, "v", ["g"])
        assert len(shared.collect()) == 300_000
        assert "skewed" in plan(shared) and "SortMergeJoin(skew=true)" in plan(shared)
    finally:
        for k, v in before.items():
            if v is None:
                unhinted.conf.unset(k)
            else:
                unhinted.conf.set(k, v)
