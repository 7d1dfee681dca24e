"""Every query against its SQL, on the smallest test tables."""

import pytest

import __spark_entry__ as driver
from tests.compare import connect, differences
from tests.conftest import SMALL

ORACLE = driver.oracle_sql()
QUERIES = driver.queries()


@pytest.fixture(scope="module")
def tables():
    return connect(SMALL)


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, tables, name):
    assert differences(QUERIES[name](spark, SMALL), tables, ORACLE[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs_without_oracle(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0


def test_approximate_counts_are_close(spark):
    approx = {r[0]: r for r in QUERIES["approx_customer_reach"](spark, SMALL).collect()}
    exact = QUERIES["vw_sales_by_store"](spark, SMALL).select("StoreKey", "UniqueCustomers", "ProductsOffered").collect()
    for key, customers, products in exact:
        assert approx[key][1] == pytest.approx(customers, rel=0.2, abs=1)
        assert approx[key][2] == pytest.approx(products, rel=0.2, abs=1)


def test_entry_has_rows(spark):
    df = driver.entry(spark)
    assert df.columns[:3] == ["SalesDateKey", "StoreKey", "ProductCategoryKey"]
    assert df.count() > 0
