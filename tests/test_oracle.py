"""Every registered query against DuckDB on the smallest tables (the driver repeats this at sf0.01)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import check_oracle  # noqa: E402
import workload  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return check_oracle.duck(SF)


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")
@pytest.mark.parametrize("name", sorted(workload.QUERIES))
def test_query(spark, db, name):
    problem, _, _ = check_oracle.compare(spark, db, SF, name)
    assert problem is None
