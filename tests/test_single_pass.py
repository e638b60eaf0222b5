"""Queries read the fact, or the events, once."""

import io
import re
from contextlib import redirect_stdout

import pytest

from quartermill.catalog import load

FOLDER = "/root/testdata/sf0.001"
ONCE = {
    "events": ["complete_grid", "lag_periods", "fill_downup", "rule_lagged"],
    "lineitem": [
        "product_treatment", "product_site_lag", "conform_map", "null_safe_map", "partial_key_map", "semi_unmapped", "denominator_variants",
        "delete_file", "left_composite", "aggregate_compare", "value_mismatch", "number_label", "code_repair", "programme_report", "reshape_long", "reshape_semi_wide",
    ],
}


@pytest.fixture
def static(spark):
    """Plans with reuse but without broadcasts and adaptive changes."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def scans(df, table: str) -> list[str]:
    """The columns of each scan of a table."""
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return re.findall(rf"Location: InMemoryFileIndex \[file:{FOLDER}/{table}\.parquet\].*?ReadSchema: (\S+)", out.getvalue(), re.S)


@pytest.mark.parametrize("table,name", [(t, n) for t, names in ONCE.items() for n in names])
def test_one_scan(static, table, name):
    assert len(scans(load()[name](static, FOLDER), table)) == 1


def test_both_levels_scan_the_fact_once_and_its_dates(static):
    found = scans(load()["findings_by_level"](static, FOLDER), "lineitem")
    assert sorted(len(s.split(",")) for s in found)[0] == 1 and len(found) == 2
