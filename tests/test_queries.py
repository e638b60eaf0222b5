"""Every registered query against its SQL in DuckDB, at the smallest scale."""

import pytest
from compare import compare, connect

from quartermill.catalog import load

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    with connect(FOLDER) as c:
        yield c


@pytest.mark.parametrize("name", sorted(load()))
def test_same_rows(spark, con, name):
    ok, note = compare(spark, con, load()[name], FOLDER)
    assert ok, note
