"""Every registered query against its checking SQL."""

import os

import pytest

import __spark_entry__ as entry_point
from tests import harness

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = entry_point.queries(), entry_point.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return harness.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    if name in ORACLES:
        report = harness.compare(con, df, ORACLES[name])
        assert report.startswith("ok"), report
        assert "types" not in report, report
    else:
        assert df.count() > 0


def test_entry(spark):
    rows = entry_point.entry(spark).collect()
    assert sum(r["n_requests"] for r in rows) > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
