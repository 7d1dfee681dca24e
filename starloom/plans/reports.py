"""Reports that are more than one operator."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.keys import hash_uniform
from starloom.functions.measures import exact_avg, money_sum
from starloom.operators.scd import as_of_join


def top_sales(wh, since: dt.date, limit: int = 10) -> DataFrame:
    """The best-selling (day, customer, product) combinations since a day.

    Grouped by key, so names are attached to the surviving rows only; ties are
    broken by the names to make the list reproducible.
    """
    customers = wh.current_side("DimCustomer", "CustomerKey", "CustomerName")
    products = wh.current_side("DimProduct", "ProductKey", "ProductName")
    return (
        wh.table("FactSales")
        .filter(F.col("SalesDateKey") >= F.lit(since))
        .groupBy("SalesDateKey", "CustomerKey", "ProductKey")
        .agg(money_sum("SalesRevenue").alias("_revenue"), F.count(F.lit(1)).alias("_rows"))
        .join(customers, "CustomerKey")
        .join(products, "ProductKey")
        .groupBy("SalesDateKey", "CustomerName", "ProductName")
        .agg(money_sum("_revenue").alias("TotalRevenue"), F.sum("_rows").alias("TransactionCount"))
        .orderBy(F.desc("TotalRevenue"), "SalesDateKey", "CustomerName", "ProductName")
        .limit(limit)
    )


def sales_of_year(wh, year: int) -> DataFrame:
    """Monthly sales of one calendar year, selected through the calendar.

    On a stored fact the year filter prunes date partitions at run time.
    """
    days = wh.bounded(wh.table("DimDate").filter(F.col("Year") == year).select("DateKey", "Month"), "DimDate")
    return (
        wh.table("FactSales")
        .join(days, F.col("SalesDateKey") == F.col("DateKey"))
        .groupBy("Month")
        .agg(money_sum("SalesRevenue").alias("TotalRevenue"), F.count(F.lit(1)).alias("TransactionCount"))
    )


def sales_of_quarter(wh, year: int, quarter: int) -> DataFrame:
    """Daily revenue of a quarter; the calendar only selects (semi join)."""
    days = wh.table("DimDate").filter((F.col("Year") == year) & (F.col("Quarter") == quarter)).select("DateKey")
    return (
        wh.table("FactSales")
        .join(wh.bounded(days, "DimDate"), F.col("SalesDateKey") == F.col("DateKey"), "left_semi")
        .groupBy("SalesDateKey")
        .agg(money_sum("SalesRevenue").alias("TotalRevenue"))
    )


def sales_by_segment_as_sold(orders: DataFrame, versions: DataFrame) -> DataFrame:
    """Revenue by the segment each customer had on the day of the order."""
    dated = as_of_join(orders, versions, "CustomerID", "OrderDate", ["CustomerSegment"])
    return dated.groupBy(F.coalesce("CustomerSegment", F.lit("Unknown")).alias("CustomerSegment")).agg(
        money_sum("TotalDue").alias("TotalRevenue"), F.count(F.lit(1)).alias("OrderCount")
    )


def sampled_average_revenue(facts: DataFrame, fraction: float, key: tuple[str, ...]) -> DataFrame:
    """Average revenue per product over a reproducible sample of the rows."""
    return (
        facts.filter(hash_uniform("sample", *key) < fraction)
        .groupBy("ProductKey")
        .agg(exact_avg("SalesRevenue").alias("AvgRevenue"), F.count(F.lit(1)).alias("SampledRows"))
    )


__all__ = [
    "sales_by_segment_as_sold",
    "sales_of_quarter",
    "sales_of_year",
    "sampled_average_revenue",
    "top_sales",
]
