"""Every registered query against its DuckDB oracle on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                                "scripts"))

import __spark_entry__ as entry  # noqa: E402
from conftest import SF_SMALL  # noqa: E402
from tramline.plans import registry  # noqa: E402
from oracle_check import compare, duck_connection  # noqa: E402

QUERIES = registry.queries()
SQL = registry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF_SMALL)


def test_every_query_is_registered_and_has_an_oracle():
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    report = compare(spark, con, name, QUERIES[name], SQL.get(name), SF_SMALL)
    assert report["ok"], report


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["hour", "percentage", "numMeasurements", "congestionMeasurements"]
    assert df.count() >= 0
