"""Every registered query against its DuckDB statement (sf0.001)."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from oracle_harness import compare

from shopflow.plans import catalog

NAMES = sorted(catalog.QUERIES)


def test_every_query_has_an_oracle():
    assert set(catalog.ORACLE) == set(catalog.QUERIES)
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, name):
    res = compare(spark, SF_SMALL, [name], verbose=False)[name]
    assert res[0] == "OK", res


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["order_id", "customer_id", "product_id", "price", "freight_value",
                          "purchase_timestamp"]
    assert df.count() > 0
