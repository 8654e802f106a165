"""Every SQL-expressible query equals its DuckDB oracle on sf0.001."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from oracle_check import check  # noqa: E402

from quarry.plans.catalog import ORACLE  # noqa: E402

from conftest import SMALL  # noqa: E402


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck_small, name):
    ok, msg = check(spark, duck_small, name, SMALL)
    assert ok, msg
