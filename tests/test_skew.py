"""Hot and missing keys in shuffled joins: nothing lost or doubled, and no partition that holds them all."""

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from starloom.operators.fk import resolve_fks
from starloom.operators.skew import heavy_keys, split_left_join
from starloom.plans import views
from starloom.plans.warehouse import Warehouse
from starloom.sources.tpch import AS_OF, CALENDAR_START, tpch_sources
from tests.conftest import SMALL

PARTITIONS = 8


@contextmanager
def settings(spark, **values):
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def shuffled(spark):
    """No broadcasts and no help from adaptive execution."""
    return settings(
        spark,
        **{"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": str(PARTITIONS)},
    )


def largest_share(df):
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    return max(sizes) / sum(sizes)


def skewed(spark, n=20_000):
    """Half the rows have key 0, a fifth key 7, a tenth none, the others keys of their own."""
    kind = F.col("id") % 10
    key = F.when(kind < 5, 0).when(kind < 7, 7).when(kind < 8, F.lit(None)).otherwise(F.col("id"))
    return spark.range(n).select(F.col("id").alias("row"), key.cast("bigint").alias("k"))


def members(spark):
    return spark.createDataFrame([(7, "a"), (7, "b"), (8, "c"), (9, "d"), (None, "nobody")], "k BIGINT, name STRING")


def test_heavy_keys_are_counted_over_all_rows(spark):
    assert heavy_keys(skewed(spark), "k", 0.1) == [0, 7]
    assert heavy_keys(skewed(spark), "k", 0.3) == [0]
    assert heavy_keys(skewed(spark).limit(0), "k") == []
    assert heavy_keys(spark.createDataFrame([(None,)] * 3, "k BIGINT"), "k") == []
    ties = spark.createDataFrame([(2,), (1,), (2,), (1,)], "k BIGINT")
    assert heavy_keys(ties, "k", 0.5) == [1, 2]
    with pytest.raises(ValueError):
        heavy_keys(ties, "k", 0)


@pytest.mark.parametrize("hot", [[], [0], [0, 7], [7, None, 7, 123456]])
def test_split_join_is_a_left_join(spark, hot):
    rows = skewed(spark, 500).unionByName(skewed(spark, 500))
    plain = rows.join(members(spark), "k", "left").select("row", "k", "name")
    split = split_left_join(rows, members(spark), "k", hot, ["row"]).select("row", "k", "name")
    order = lambda r: tuple(str(v) for v in r)
    assert sorted(map(tuple, split.collect()), key=order) == sorted(map(tuple, plain.collect()), key=order)
    assert split_left_join(rows.limit(0), members(spark), "k", hot, ["row"]).count() == 0
    assert split_left_join(rows, members(spark).limit(0), "k", hot, ["row"]).where("name IS NULL").count() == 1000


def test_no_partition_gets_the_hot_rows(spark):
    with shuffled(spark):
        rows, side = skewed(spark), spark.range(7, 20_000).select(F.col("id").alias("k"), F.lit("x").alias("name"))
        assert largest_share(rows.join(side, "k", "left")) > 0.5
        assert largest_share(split_left_join(rows, side, "k", heavy_keys(rows, "k"), ["row"])) < 2 / PARTITIONS


def test_required_foreign_keys_with_hot_members(spark):
    """The same rows and misses with and without a split; hot and NULL keys lie in many partitions."""
    with shuffled(spark):
        wh = Warehouse.from_sources(spark, tpch_sources(spark, SMALL), AS_OF, calendar_start=CALENDAR_START)
        extract = wh.table("extract:FactSales")
        one = extract.select("ProductID").first()[0]
        number = F.crc32(F.concat_ws("|", "CustomerID", "SalesRevenue", "ProductID")) % 10
        hot_product = F.when(number < 5, F.lit(one)).when(number < 7, F.lit(None)).otherwise(F.col("ProductID"))
        rows = extract.withColumn("ProductID", hot_product).checkpoint()
        hot = {"ProductID": heavy_keys(rows, "ProductID", 0.1)}
        assert hot == {"ProductID": [one]}
        plain, split = resolve_fks(rows, "FactSales", wh.key_map), resolve_fks(rows, "FactSales", wh.key_map, hot=hot)
        names = plain.tagged.columns
        as_text = F.sha2(F.to_json(F.struct(*sorted(names))), 256).alias("t")
        assert sorted(plain.tagged.select(as_text).collect()) == sorted(split.tagged.select(as_text).collect())
        assert split.rejected.count() == rows.where("ProductID IS NULL").count() > 0


@pytest.fixture(scope="module")
def warehouse(spark):
    return Warehouse.from_sources(spark, tpch_sources(spark, SMALL), AS_OF, calendar_start=CALENDAR_START)


@pytest.mark.parametrize(
    "build", [views.sales_extended_full, views.inventory_snapshot, views.returns_analysis]
)
def test_views_lead_facts_without_member_past_the_join(spark, warehouse, build):
    text = F.sha2(F.to_json(F.struct("*")), 256).alias("t")
    broadcast = sorted(r[0] for r in build(warehouse).select(text).collect())
    with shuffled(spark):
        wh = Warehouse.from_sources(spark, tpch_sources(spark, SMALL), AS_OF, calendar_start=CALENDAR_START)
        assert wh.hot_keys("StoreKey") == [0]
        view = build(wh)
        assert "_slot" in view._jdf.queryExecution().optimizedPlan().toString()
        assert sorted(r[0] for r in view.select(text).collect()) == broadcast
        assert 0 in wh.measure_hot_keys("FactSales", "StoreKey")["StoreKey"]
        assert wh.hot_keys("StoreKey").count(0) == 1


def test_sales_without_a_store_lie_in_all_partitions(spark):
    with shuffled(spark):
        wh = Warehouse.from_sources(spark, tpch_sources(spark, SMALL), AS_OF, calendar_start=CALENDAR_START)
        columns = {"StoreName": "StoreName"}
        joined = views._attach(wh.table("FactSales"), wh, "DimStore", "StoreKey", **columns).where("StoreKey = 0")
        assert joined.count() > 1000
        assert largest_share(joined) < 3 / PARTITIONS


def test_wide_view_shuffles_the_facts_before_it_widens_them(spark, warehouse, monkeypatch):
    """Members whose join is shuffled are attached first, then those that are broadcast and the calendar."""
    order, attach, calendar = [], views._attach, views._calendar
    monkeypatch.setattr(warehouse, "broadcastable", lambda name: name in ("DimCustomer", "DimEmployee"))
    monkeypatch.setattr(views, "_attach", lambda f, wh, name, *a, **k: (order.append(name), attach(f, wh, name, *a, **k))[1])
    monkeypatch.setattr(views, "_calendar", lambda *a, **k: (order.append("DimDate"), calendar(*a, **k))[1])
    views.sales_extended_full(warehouse)
    assert order == ["DimProduct", "DimStore", "DimCustomer", "DimEmployee", "DimDate"]


def test_wide_view_shuffles_the_texts_of_customers_once(spark, warehouse, monkeypatch):
    """Where all joins are shuffled, the employees, whom few sales have, come first and the customers last."""
    order, attach = [], views._attach
    monkeypatch.setattr(warehouse, "broadcastable", lambda name: False)
    monkeypatch.setattr(views, "_attach", lambda f, wh, name, *a, **k: (order.append(name), attach(f, wh, name, *a, **k))[1])
    view = views.sales_extended_full(warehouse)
    assert order == ["DimEmployee", "DimProduct", "DimStore", "DimCustomer"]
    assert view.columns.index("CustomerName") < view.columns.index("ProductName") < view.columns.index("EmployeeName")
