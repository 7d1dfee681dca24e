"""Operations on stored tables as queries: each writes under the shared folder, reads back and returns what is stored.

All of them take whole test tables; the folders are the session's scratch folders.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.dates import truncate
from starloom.functions.keys import wide_decimal_key
from starloom.operators import sinks, validation
from starloom.operators.facts import FACTS
from starloom.operators.identities import register_numbers
from starloom.operators.joins import range_join
from starloom.operators.ledger import Ledger, covered_ranges
from starloom.operators.reach import load_reach
from starloom.plans import batch, views
from starloom.plans.warehouse import Warehouse
from starloom.session import scratch_dir
from starloom.sources.tpch import AS_OF, CALENDAR_START, read_test_table, tpch_sources

LOADED_AT = dt.datetime(2001, 12, 1)
SPLIT_DAY, RELOAD_FROM = dt.date(2001, 3, 31), dt.date(2000, 1, 1)


class Interrupted(RuntimeError):
    """Stands for a lost driver in the queries below."""


def batch_restart_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Two batches, the second one interrupted after two of its steps and run again.

    The first loads order lines up to a day while some customers and products are unknown; the second has them, loads
    the rest, retries the misses and refreshes the roll-ups of the periods touched.  Orders are dated by their month
    here, which makes a folder a month.  Per month: the stored roll-up, the stored facts and the open errors.
    """
    root, src = scratch_dir(spark, "batch"), tpch_sources(spark, folder)
    by_month = src["Sales.SalesOrderHeader"].withColumn("OrderDate", truncate("month", "OrderDate"))
    src = src.replaced(Sales__SalesOrderHeader=by_month)
    late = src.replaced(
        Sales__Customer=src["Sales.Customer"].filter("CustomerID % 50 <> 7"),
        Production__Product=src["Production.Product"].filter("ProductID % 40 <> 3"),
    )
    options = {"facts": ["FactSales"], "rollups": ["agg_daily_sales"], "calendar_start": CALENDAR_START, "loaded_at": LOADED_AT}
    batch.run_batch(spark, src, root, AS_OF, "b1", until=SPLIT_DAY, members=late, **options)

    def die_after(wanted):
        def check(kind, table):
            if (kind, table) == wanted:
                raise Interrupted(kind)

        return check

    for wanted in (("fact", "FactSales"), ("retry", "FactSales"), None):
        try:
            batch.run_batch(spark, src, root, AS_OF, "b2", since=SPLIT_DAY, after_step=die_after(wanted), **options)
        except Interrupted:
            pass
    wh, month = Warehouse.from_storage(spark, root), truncate("month", "SalesDateKey").alias("Month")
    daily = sinks.read_table(spark, f"{root}/agg_daily_sales").groupBy(month).agg(
        F.sum("RevenueSum").cast("decimal(18,2)").alias("RollupRevenue"), F.sum("TransactionCount").alias("RollupLines")
    )
    facts = wh.table("FactSales").groupBy(month).agg(
        F.sum("SalesRevenue").cast("decimal(18,2)").alias("FactRevenue"), F.count(F.lit(1)).alias("FactLines")
    )
    still_open = wh.table("error_records").filter("IsResolved = 0").agg(F.count(F.lit(1)).alias("OpenErrors"))
    return daily.join(facts, "Month", "full_outer").crossJoin(F.broadcast(still_open))  # one row


def load_validation_errors(spark: SparkSession, folder: str) -> DataFrame:
    """Errors of a load in which some order lines have no line id, too large a quantity, or bad measures."""
    spec, src = FACTS["FactSales"], tpch_sources(spark, folder)
    rows = spec.build(src, AS_OF).withColumns(
        {
            "SalesOrderDetailID": F.expr("CASE WHEN ProductID % 50 = 3 THEN NULL ELSE SalesOrderDetailID END"),
            "QuantitySold": F.expr("CASE WHEN ProductID % 50 = 4 THEN QuantitySold * 1000000000L ELSE QuantitySold END"),
            "SalesRevenue": F.expr("CASE WHEN ProductID % 50 IN (1, 3) THEN -SalesRevenue ELSE SalesRevenue END"),
        }
    )
    checked = validation.checked(rows, spec)
    errors = validation.validation_errors(checked.filter(~validation.is_valid()), spec, "b1", LOADED_AT)
    return errors.groupBy("ErrorType", "ErrorSeverity", "ErrorMessage", "IsRecoverable").agg(
        F.count(F.lit(1)).alias("ErrorRows"), F.count_distinct("RecordNaturalKey").alias("Records")
    )


def _monthly_orders(spark: SparkSession, folder: str) -> DataFrame:
    return read_test_table(spark, folder, "orders").selectExpr(
        "cast(date_trunc('month', o_orderdate) as date) AS OrderMonth", "o_orderkey AS SalesOrderID", "o_custkey AS CustomerID",
        "cast(o_totalprice as decimal(18,2)) AS TotalDue",
    )


def reload_emptied_periods(spark: SparkSession, folder: str) -> DataFrame:
    """Orders by month, then a reload from a month on at whose source some months have lost all of their orders."""
    path, orders = scratch_dir(spark, "reload"), _monthly_orders(spark, folder)
    everything = [(dt.date(1, 1, 1), dt.date(9999, 12, 31))]
    sinks.replace_ranges(orders, f"{path}/orders", "OrderMonth", everything, f"{path}/staged-1", ["CustomerID"])
    lost = F.month("OrderMonth").isin(2, 7)
    again = orders.filter((F.col("OrderMonth") >= F.lit(RELOAD_FROM)) & ~lost)
    sinks.replace_ranges(again, f"{path}/orders", "OrderMonth", [(RELOAD_FROM, dt.date(9999, 12, 31))], f"{path}/staged-2")
    stored = sinks.read_table(spark, f"{path}/orders")
    return stored.groupBy("OrderMonth").agg(F.count(F.lit(1)).alias("Orders"), F.sum("TotalDue").cast("decimal(18,2)").alias("TotalDue"))


def loaded_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """Days covered by the loads that the ledger holds: one load for each month in which part of the customers order."""
    path = scratch_dir(spark, "ledger")
    months = (
        read_test_table(spark, folder, "orders").filter("o_custkey % 10 = 3 AND month(o_orderdate) NOT IN (3, 8)")
        .select(truncate("month", "o_orderdate").alias("m")).distinct().orderBy("m").collect()
    )
    for r in months:  # a load per month of the calendar
        end = (r.m.replace(day=28) + dt.timedelta(days=4)).replace(day=1) - dt.timedelta(days=1)
        Ledger(spark, path, f"{r.m:%Y%m}").commit("fact", "FactSales", FirstDay=r.m, LastDay=end)
    return covered_ranges(Ledger(spark, path, "none").frame())


def retention_then_load(spark: SparkSession, folder: str) -> DataFrame:
    """Months past their retention are moved to an archive, later ones are loaded afterwards into the same table."""
    path, orders = scratch_dir(spark, "retention"), _monthly_orders(spark, folder)
    table, archive, first_new = f"{path}/orders", f"{path}/archive", dt.date(2001, 6, 1)
    sinks.overwrite_partitions(orders.filter(F.col("OrderMonth") < F.lit(first_new)), table, "OrderMonth")
    for _ in range(2):
        sinks.drop_expired(spark, table, "OrderMonth", AS_OF, archive, months=24)
    sinks.overwrite_partitions(orders.filter(F.col("OrderMonth") >= F.lit(first_new)), table, "OrderMonth")
    kept = sinks.read_table(spark, table).select("*", F.lit("live").alias("Place"))
    gone = spark.read.schema(orders.schema).parquet(archive).select(*orders.columns, F.lit("archive").alias("Place"))
    return kept.unionByName(gone).groupBy("Place", "OrderMonth").agg(F.count(F.lit(1)).alias("Orders"))


def duplicates_removed_in_place(spark: SparkSession, folder: str) -> DataFrame:
    """A table in which the orders of some customers were loaded twice, without the repeated rows."""
    path, orders = scratch_dir(spark, "distinct"), _monthly_orders(spark, folder)
    again = orders.filter("CustomerID % 40 = 9")
    sinks.append(orders.unionByName(again), f"{path}/orders", "OrderMonth")
    sinks.drop_duplicates_in_place(spark, f"{path}/orders", "OrderMonth", f"{path}/staged")
    return sinks.read_table(spark, f"{path}/orders").groupBy("OrderMonth").agg(
        F.count(F.lit(1)).alias("Orders"), F.count_distinct("SalesOrderID").alias("DistinctOrders")
    )


def appended_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows appended in two loads, by year."""
    path, orders = scratch_dir(spark, "append"), _monthly_orders(spark, folder)
    for half in (0, 1):
        sinks.append(orders.filter(f"SalesOrderID % 2 = {half}"), f"{path}/orders", sort=["CustomerID"])
    stored = spark.read.parquet(f"{path}/orders")
    return stored.groupBy(F.year("OrderMonth").alias("Year")).agg(F.count(F.lit(1)).alias("Orders"))


def truncated_and_inserted(spark: SparkSession, folder: str) -> DataFrame:
    """A lookup table replaced as a whole by a smaller one."""
    path, parts = scratch_dir(spark, "replace"), read_test_table(spark, folder, "part").select("p_partkey", "p_brand")
    sinks.overwrite(parts, f"{path}/parts")
    sinks.overwrite(parts.filter("p_partkey % 3 = 0"), f"{path}/parts")
    return spark.read.parquet(f"{path}/parts").withColumn("WideKey", wide_decimal_key("p_partkey", "p_brand").cast("string"))


def logged_errors(spark: SparkSession, folder: str) -> DataFrame:
    """Errors of two batches appended to the log, one of them run twice."""
    path, spec = scratch_dir(spark, "log"), FACTS["FactSales"]
    rows = spec.build(tpch_sources(spark, folder), AS_OF).withColumn("SalesRevenue", F.expr("-SalesRevenue"))
    checked = validation.checked(rows, spec)
    for name, share in (("b1", 0), ("b2", 1), ("b1", 0)):
        errors = validation.validation_errors(checked.filter(f"CustomerID % 4 = {share}"), spec, name, LOADED_AT)
        sinks.append_errors(errors, f"{path}/error_records", name, spec.name)
    return spark.read.parquet(f"{path}/error_records").groupBy("ProcessingBatchID", "ErrorType").agg(F.count(F.lit(1)).alias("Errors"))


def region_numbers_kept(spark: SparkSession, folder: str) -> DataFrame:
    """Numbers of the territories after some were added that sort before the others: the first ones keep theirs."""
    path, region = scratch_dir(spark, "registry"), read_test_table(spark, folder, "region")
    nations = read_test_table(spark, folder, "nation").join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    members = nations.selectExpr("r_name AS RegionName", "n_name AS Country", "n_regionkey")
    natural = ["RegionName", "Country"]
    register_numbers(members.filter("n_regionkey > 1"), f"{path}/numbers", natural, "RegionID", natural, "b1")
    for _ in range(2):
        register_numbers(members, f"{path}/numbers", natural, "RegionID", natural, "b2")
    return sinks.read_table(spark, f"{path}/numbers")


def regional_growth_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """Regional growth after two months were loaded late: only these months are read again from the facts."""
    from starloom.operators.rollups import regional_sales, regional_sales_refresh
    from starloom.plans.registry import warehouse

    wh, path = warehouse(spark, folder), scratch_dir(spark, "growth")
    months = [dt.date(1997, 5, 1), dt.date(1999, 11, 1)]
    late = truncate("month", "SalesDateKey").isin(months)
    facts = wh.table("FactSales")
    sinks.overwrite(regional_sales(wh.replaced(FactSales=facts.filter(~late))), f"{path}/agg", "MonthStartDateKey")
    stored, touched = sinks.read_table(spark, f"{path}/agg"), F.col("MonthStartDateKey").isin(months)
    rows = regional_sales_refresh(wh.replaced(FactSales=facts.filter(late)), stored, months[0], touched)
    sinks.replace_ranges(rows.select(*stored.columns), f"{path}/agg", "MonthStartDateKey", [(months[0], dt.date(9999, 12, 31))], f"{path}/staged")
    return sinks.read_table(spark, f"{path}/agg")


def range_join_far_values(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines in price bands of very different width, some without an end, some prices far out or NULL."""
    lines = read_test_table(spark, folder, "lineitem").selectExpr(
        "l_orderkey", "CASE WHEN l_linenumber = 7 THEN NULL WHEN l_suppkey = 3 THEN 1000000000000"
        " WHEN l_suppkey = 4 THEN -1000000000000 ELSE cast(l_extendedprice as bigint) END AS price",
    )
    bands = read_test_table(spark, folder, "supplier").selectExpr(
        "s_suppkey AS band", "CASE WHEN s_suppkey % 50 = 1 THEN NULL ELSE s_suppkey * 611 % 60000 END AS low",
        "CASE WHEN s_suppkey % 50 = 2 THEN NULL WHEN s_suppkey % 50 = 3 THEN 2000000000000"
        " ELSE s_suppkey * 611 % 60000 + s_nationkey * s_nationkey * 20 - 30 END AS high",
    )
    # Lines of one price meet the same bands, so they are joined as one row.
    prices = lines.groupBy("price").agg(F.count(F.lit(1)).alias("n"))
    joined = range_join(prices, bands, "price", "low", "high", ["band"])
    total = F.sum(F.col("price") * F.col("n")).cast("decimal(38,0)").cast("string")
    return joined.groupBy("band").agg(F.sum("n").alias("Lines"), total.alias("PriceSum"))


def _sales_by_stored_reach(spark: SparkSession, folder: str, key: str, build) -> DataFrame:
    """A view per member whose distinct counts are merged from words stored in two loads, a month of which runs twice."""
    from starloom.plans.registry import warehouse

    wh, path = warehouse(spark, folder), scratch_dir(spark, "reach")
    kinds = [k for k in ("CustomerKey", "ProductKey", "StoreKey", "EmployeeKey") if k != key]
    # The facts are resolved once and stored, as in a warehouse; the loads and the view read them there.
    day, measures = F.col("SalesDateKey"), ["QuantitySold", "SalesRevenue", "DiscountAmount"]
    sinks.overwrite(wh.table("FactSales").select("SalesDateKey", key, *kinds, *measures), f"{path}/facts")
    facts = sinks.read_table(spark, f"{path}/facts")
    loads = [day < F.lit(dt.date(1998, 3, 1)), day >= F.lit(dt.date(1998, 3, 1)), truncate("month", "SalesDateKey") == F.lit(dt.date(1997, 5, 1))]
    for number, load in enumerate(loads):
        load_reach(facts.filter(load), path, f"load{number}", key, "SalesDateKey", kinds)
    return build(wh.replaced(**{"FactSales": facts, f"reach:{key}": spark.read.parquet(f"{path}/words")}))


def sales_by_store_merged(spark: SparkSession, folder: str) -> DataFrame:
    """Sales per store, distinct counts from stored words."""
    return _sales_by_stored_reach(spark, folder, "StoreKey", views.sales_by_store)


def sales_by_customer_merged(spark: SparkSession, folder: str) -> DataFrame:
    """Sales per customer, distinct counts from stored words."""
    return _sales_by_stored_reach(spark, folder, "CustomerKey", views.sales_by_customer)


QUERIES = {
    f.__name__: f
    for f in (
        batch_restart_totals, load_validation_errors, reload_emptied_periods, loaded_ranges, retention_then_load,
        duplicates_removed_in_place, appended_facts, truncated_and_inserted, logged_errors, region_numbers_kept,
        regional_growth_refresh, range_join_far_values, sales_by_store_merged, sales_by_customer_merged,
    )
}
