"""Every registered query against its SQL in DuckDB."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import check_oracles  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from forkline.plans import registered  # noqa: E402

SF = os.environ.get("FORKLINE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return check_oracles.connect(SF)


@pytest.mark.parametrize("name", list(registered.QUERIES))
def test_query_matches_sql(spark, con, name):
    assert name in entry.oracle_sql()
    diff, _ = check_oracles.compare(spark, con, name, SF)
    assert diff is None, diff


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
