"""Distinct counts merged from stored words, against sets kept in Python."""

import datetime as dt
import random
import re

from pyspark.sql import functions as F

from starloom.operators.reach import load_reach, merged_counts, reach_items, reach_words, register_values
from starloom.plans import views
from starloom.plans.warehouse import Warehouse
from starloom.sources.tpch import AS_OF, CALENDAR_START, tpch_sources
from tests.conftest import SMALL

SCHEMA = "store BIGINT, day DATE, customer BIGINT, product BIGINT"
KEYS = ["customer", "product"]
COUNTS = {"Days": "day", "Customers": "customer", "Products": "product"}


def facts(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def random_rows(n, seed=3):
    """Store 0 holds half the rows; some customers are NULL; keys are as large as hashed ones, days lie before 1970 too."""
    draw = random.Random(seed)
    return [
        (draw.choice([0, 0, 0, 1 << 59, 5, 6]), dt.date(1969, 11, 1) + dt.timedelta(draw.randrange(120)),
         draw.choice([None, 0, draw.randrange(200) * 7919 << 40]), draw.randrange(90))
        for _ in range(n)
    ]


def expected(rows):
    found = {}
    for store, day, customer, product in rows:
        sets = found.setdefault(store, (set(), set(), set()))
        for values, value in zip(sets, (day, customer, product)):
            if value is not None:
                values.add(value)
    return {s: tuple(map(len, sets)) for s, sets in found.items()}


def counted(spark, path):
    return {r[0]: tuple(r[1:]) for r in merged_counts(spark.read.parquet(f"{path}/words"), COUNTS).collect()}


def test_loads_merge_to_the_distinct_counts(spark, tmp_path):
    path, rows = str(tmp_path), random_rows(3000)
    early = [r for r in rows if r[1] < dt.date(1970, 1, 1)]
    load_reach(facts(spark, early), path, "v1", "store", "day", KEYS)
    assert counted(spark, path) == expected(early)
    late = [r for r in rows if r[1] >= dt.date(1970, 1, 1)]
    for _ in range(2):  # a load that runs again changes nothing
        load_reach(facts(spark, late), path, "v2", "store", "day", KEYS)
        assert counted(spark, path) == expected(rows)
    january = [(7, dt.date(1970, 1, 9), 1, 1)]  # a month replaced by other facts
    load_reach(facts(spark, january), path, "v3", "store", "day", KEYS)
    assert counted(spark, path) == expected([r for r in rows if (r[1].year, r[1].month) != (1970, 1)] + january)


def test_numbers_stay_and_are_dense(spark, tmp_path):
    def items(values):
        return spark.createDataFrame([("customer", v) for v in values], "Kind STRING, Value BIGINT")

    path, keys = str(tmp_path), ["customer"]
    first = {r.Value: r.Number for r in register_values(items(range(1000, 3000)), path, "a", keys, buckets=8).collect()}
    grown = {r.Value: r.Number for r in register_values(items(range(0, 2500)), path, "b", keys, buckets=8).collect()}
    assert len(grown) == len(set(grown.values())) == 3000
    assert all(grown[v] == n for v, n in first.items())
    assert max(grown.values()) < 1.3 * 3000
    again = {r.Value: r.Number for r in register_values(items([9999]), path, "b", keys, buckets=8).collect()}
    assert again == grown
    # 64 numbers in a word: far fewer words than values
    words = reach_words(
        items(range(3000)).select(F.lit(1).alias("Member"), F.lit("p").alias("Period"), "*"), spark.read.parquet(f"{path}/b")
    )
    assert words.count() < 3000 / 30
    assert merged_counts(words, {"n": "customer"}).collect()[0].n == 3000


def test_empty_and_null_rows(spark, tmp_path):
    path = str(tmp_path)
    load_reach(facts(spark, [(None, dt.date(2001, 1, 1), None, None), (3, None, None, 4)]), path, "v", "store", "day", KEYS)
    assert counted(spark, path) == {None: (1, 0, 0), 3: (0, 0, 1)}
    assert reach_items(facts(spark, []), "store", "day", KEYS).count() == 0


def test_view_on_words_does_not_expand_the_facts(spark, tmp_path):
    path = str(tmp_path)
    wh = Warehouse.from_sources(spark, tpch_sources(spark, SMALL), AS_OF, calendar_start=CALENDAR_START)
    load_reach(wh.table("FactSales"), path, "v", "StoreKey", "SalesDateKey", ["CustomerKey", "ProductKey", "EmployeeKey"])
    merged = views.sales_by_store(wh.replaced(**{"reach:StoreKey": spark.read.parquet(f"{path}/words")}))
    plain = views.sales_by_store(wh)
    assert "Expand" in plain._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in merged._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, merged.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


def test_counted_columns_repeat_no_sums(spark):
    """Rows that Spark repeats per counted column hold keys alone; a product that is listed twice counts its sales twice, as in a join."""
    draw = random.Random(5)
    sales = [
        (draw.choice([0, 0, 7, None, 9]), draw.choice([1, 2, 3, None]), draw.choice([4, 5, None]), draw.choice([6, 8]), dt.date(2001, 1, draw.randint(1, 9)), draw.randint(1, 5), 10, 1)
        for _ in range(300)
    ]
    names = ("CustomerKey", "ProductKey", "StoreKey", "EmployeeKey", "SalesDateKey", "QuantitySold", "SalesRevenue", "DiscountAmount")
    money, keys = "decimal(18,2)", "CustomerKey BIGINT, ProductKey BIGINT, StoreKey BIGINT, EmployeeKey BIGINT"
    facts = spark.createDataFrame(sales, f"{keys}, SalesDateKey DATE, QuantitySold INT, SalesRevenue INT, DiscountAmount INT")
    facts = facts.withColumns({c: F.col(c).cast(money) for c in ("SalesRevenue", "DiscountAmount")})
    costs = {1: [2], 2: [3, 4]}
    products = spark.createDataFrame([(p, c) for p, of in costs.items() for c in of], "ProductKey BIGINT, Cost INT").withColumn("Cost", F.col("Cost").cast(money))
    wh = Warehouse(spark, {"FactSales": lambda: facts, "DimProduct": lambda: products})
    counts = {"days": "SalesDateKey", "stores": "StoreKey", "products": "ProductKey", "employees": "EmployeeKey"}
    stats = views._sales_by(wh, "CustomerKey", counts, False)
    expands = re.findall(r"Expand .*", stats._jdf.queryExecution().optimizedPlan().toString())
    assert expands and not any("SalesRevenue" in e for e in expands)
    found = {r["_member"]: r for r in stats.collect()}
    for member in (0, 7, 9):
        own = [dict(zip(names, r)) for r in sales if r[0] == member]
        joined = [(r, c) for r in own for c in costs.get(r["ProductKey"], [None])]
        assert [found[member][n] for n in counts] == [len({r[c] for r in own} - {None}) for c in counts.values()]
        assert (found[member]["_rows"], found[member]["_revenue"]) == (len(joined), 10 * len(joined))
        assert found[member]["_gross"] == sum(9 - r["QuantitySold"] * c for r, c in joined if c is not None)
        assert found[member]["_quantity"] == sum(r["QuantitySold"] for r, _ in joined)


def test_merged_view_resolves_the_facts_once(spark, monkeypatch):
    """The loads and the view read the stored facts, not the sources."""
    from starloom.plans import operations

    read, load = [], operations.load_reach
    monkeypatch.setattr(operations, "load_reach", lambda facts, *rest: (read.append(facts.inputFiles()), load(facts, *rest)))
    operations._sales_by_stored_reach(spark, SMALL, "StoreKey", lambda wh: read.append(wh.table("FactSales").inputFiles()))
    assert len(read) == 4
    assert all(files and all("/facts/" in f for f in files) for files in read)
