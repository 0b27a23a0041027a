"""Every registered query against its DuckDB oracle on sf0.001 (row count,
column names, order-insensitive values) -- the driver's gate runs the same
comparison at sf0.01 (``python tools/check_oracles.py``)."""

import os
import sys

import pytest

from conftest import SF_SMALL

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracles import compare, duck_conn  # noqa: E402

from ripplerec.plans.registry import QUERIES as NAMES  # noqa: E402

# the training-data queries have tests of their own
QUERIES = {k: v for k, v in E.queries().items() if k in NAMES}
ORACLES = {k: v for k, v in E.oracle_sql().items() if k in NAMES}


@pytest.fixture(scope="module")
def con():
    return duck_conn(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["window_end", "rank", "item_id", "cnt"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, QUERIES[name], ORACLES[name], SF_SMALL, con)
    assert r["cols"], (r["s_cols"], r["d_cols"])
    assert r["spark_rows"] == r["duck_rows"]
    assert r["values"], (r["s_sample"], r["d_sample"])
