"""Every registered query against its SQL on DuckDB, at the smallest size."""

import os

import pytest

from claimtide.plans import check, load_all
from claimtide.plans.catalog import ORACLES, QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
load_all()


@pytest.fixture(scope="module")
def con():
    return check.connect(FOLDER)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLES])
def test_same_rows(spark, con, name):
    result = check.compare(spark, con, name, FOLDER)
    assert [p for p in result["problems"] if p != "no rows"] == []


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES])
def test_runs(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry_module(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns == ["fact_id", "lang", "count"]
