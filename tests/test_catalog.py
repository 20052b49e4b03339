"""Every catalog query against its DuckDB SQL (rows, columns, values), on sf0.001."""

import pytest

from conftest import SF_SMALL

import __spark_entry__ as E
from driftlog.plans.catalog import QUERIES
from driftlog.plans.oracle import SQL

NAMES = list(QUERIES)


def test_every_query_has_an_oracle():
    assert set(SQL) == set(NAMES)
    assert set(NAMES) <= set(E.queries()) and set(SQL) <= set(E.oracle_sql())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert len(df.columns) == 19


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, name):
    import sys, os
    sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(__file__)), "tools"))
    from oracle_check import check

    res = check(spark, SF_SMALL, [name], verbose=False)[name]
    assert res["match"], res
