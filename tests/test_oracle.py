"""Every registered query with SQL against DuckDB; the others must run and give rows."""

import pytest
from oracle import compare, connect

from quillframe.registry import load_catalog

PATH = "/root/testdata/sf0.001"
CATALOG = load_catalog()


@pytest.fixture(scope="module")
def con():
    return connect(PATH)


@pytest.mark.parametrize("name", list(CATALOG))
def test_query(spark, con, name):
    q = CATALOG[name]
    df = q(spark, PATH)
    if q.sql:
        assert compare(df, con, q.sql) == ""
    else:
        assert df.count() > 0
