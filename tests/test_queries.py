"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as registry
from docflow import catalog
from check_oracles import connect, differences

QUERIES = catalog.by_name()


@pytest.fixture(scope="module")
def db(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(registry.oracle_sql()) & set(registry.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_its_sql(spark, db, sf_dir, name):
    got = QUERIES[name](spark, sf_dir).toPandas()
    assert len(got) > 0
    assert differences(got, db.execute(registry.oracle_sql()[name]).df()) is None
