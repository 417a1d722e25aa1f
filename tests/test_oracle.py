"""Every registered query with an oracle equals its DuckDB SQL on sf0.001;
the model queries (no oracle) run and return rows."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_oracle import compare, duck  # noqa: E402

SF = "/root/testdata/sf0.001"
ORACLE_NAMES = sorted(entry.oracle_sql())
MODEL_NAMES = sorted(set(entry.queries()) - set(entry.oracle_sql()))


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_is_registered_with_matching_keys():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) >= 60


@pytest.mark.parametrize("name", ORACLE_NAMES)
def test_query_matches_oracle(spark, con, name):
    status, msg = compare(spark, con, name, SF)
    assert status in ("OK", "OK~"), msg


@pytest.mark.parametrize("name", MODEL_NAMES)
def test_model_query_runs(spark, con, name):
    status, msg = compare(spark, con, name, SF)
    assert status == "ROWS", msg
    assert not msg.startswith("0 rows")


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "close_price_usd" in df.columns
