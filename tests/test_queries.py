"""Every registered query against its SQL on DuckDB."""

import pytest
from check_oracle import connect, differences

import __spark_entry__ as entry
from sparkinfer.plans.queries import REGISTRY

SF = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_sql(spark, duck, name):
    ours = QUERIES[name](spark, SF).toPandas()
    assert len(ours) > 0
    if name in SQL:
        assert not differences(ours, duck.execute(SQL[name]).fetchdf())


def test_every_query_has_sql():
    assert not set(REGISTRY) - set(SQL)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() == 4
