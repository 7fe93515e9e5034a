"""Every registered query against its SQL on the small tables."""

import pytest

import __spark_entry__ as entry
from compare import compare, connect
from conftest import SMALL
from shelfline.workload.oracles import ORACLES
from shelfline.workload.queries import QUERIES

#: Queries that rightly find nothing in the small tables.
MAY_BE_EMPTY: frozenset[str] = frozenset()


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    found = compare(spark, con, QUERIES[name], ORACLES[name], SMALL)
    assert found == "" or (found == "no rows" and name in MAY_BE_EMPTY)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["slug", "n_links", "n_pages"] and df.count() > 0
