"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from tools.check import duck, normal

QUERIES, SQL = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def con(small):
    return duck(small)


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert contract.entry(spark).columns == ["report_date", "cum_cases", "moving_avg", "growth_pct"]


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, small, name):
    df = QUERIES[name](spark, small)
    cursor = con.execute(SQL[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert normal(df.columns, [tuple(r) for r in df.collect()]) == normal(columns, cursor.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_others_run(spark, small, name):
    assert QUERIES[name](spark, small).count() > 0
