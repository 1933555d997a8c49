"""Every registered query agrees with its SQL on whole tables."""

from __future__ import annotations

import pytest

from landflow.catalog import load_all
from tests import oracle

QUERIES = load_all()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = oracle.connect(sf_dir)
    yield con
    con.close()


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql])
def test_query_equals_sql(spark, sf_dir, duck, name):
    q = QUERIES[name]
    assert oracle.difference(q.build(spark, sf_dir), duck, q.sql) is None


def test_every_query_has_sql():
    assert [n for n, q in QUERIES.items() if q.sql is None] == []


def test_entry_runs(spark):
    import __spark_entry__ as contract

    df = contract.entry(spark)
    assert df.columns == ["sap_order_key", "revenue"]
    assert df.count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())
