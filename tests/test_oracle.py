"""Every registered query against its SQL twin in DuckDB."""

from __future__ import annotations

import oracle
import pytest

from tidemark.plans import catalog

QUERIES, ORACLES = catalog.queries(), catalog.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, sf_dir, con):
    df = QUERIES[name](spark, sf_dir)
    if name in ORACLES:
        assert oracle.difference(df, con, ORACLES[name]) is None
    else:
        assert df.count() > 0
    spark.catalog.clearCache()


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
