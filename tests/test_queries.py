"""Every registered query against its SQL at the smallest scale."""

import pytest
from conftest import DATA

from __spark_entry__ import entry, oracle_sql, queries
from check_oracles import compare, connect
from namewright.plans.oracles import ORACLES
from namewright.plans.queries import QUERIES


@pytest.fixture(scope="module")
def con():
    return connect(DATA)


def test_every_query_of_the_datasets_has_sql():
    assert set(QUERIES) == set(ORACLES) <= set(queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_its_sql(spark, con, name):
    assert compare(spark, con, DATA, name) == ""


def test_entry(spark):
    sizes = {(row.language, row.split): row["count"] for row in entry(spark).collect()}
    assert len(sizes) == 9 and all(sizes.values())
