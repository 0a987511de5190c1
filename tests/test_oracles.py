"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

from insight.plans.registry import ORACLES, QUERIES, load_all
from tests.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
load_all()
#: Queries whose limits no row of the small tables exceeds; each has a counterpart that is not empty.
EMPTY = {"high_corr", "distinct_diff", "outlier_rows", "anti_join", "user_recs"}
SLOW = {"grid_search"}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n not in SLOW))
def test_query_matches_oracle(spark, con, name):
    status, n, _, msg = compare(spark, con, name, QUERIES[name], ORACLES.get(name), SF)
    assert status in ("OK", "ROWS"), msg
    if name in EMPTY:
        return
    assert n > 0
