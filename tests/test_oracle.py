"""Every registered query against its SQL twin on the smallest data."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import compare, connect


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, con, sf, name):
    assert compare(spark, con, sf, name) == ""


def test_every_twin_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_every_register_query_has_a_twin():
    from ledgerline.registry import ORACLES, QUERIES

    assert set(QUERIES) == {name for name, sql in ORACLES.items() if sql}


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["num", "year", "reference", "ca", "marge_nette", "croissance_ca"]
    assert df.count() > 0
