"""Roll-up tables over the facts, as batch functions of a warehouse.

``wh`` is a ``plans.warehouse.Warehouse``.  Fact rows are joined to small
dimensions first and then combined per task before the one shuffle of each
roll-up.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starloom.functions.dates import truncate
from starloom.functions.measures import exact_avg, money_sum
from starloom.operators.joins import literal_range_key
from starloom.sources.literals import LITERAL_TABLES


def _or_zero(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(0).cast("bigint")).alias(column)


def with_category(facts: DataFrame, wh) -> DataFrame:
    """Adds the category key by way of the product's category name; unknown = 0."""
    keys = wh.side("DimProductCategory").select("ProductCategoryKey", F.col("CategoryName").alias("Category"))
    products = wh.table("DimProduct").select("ProductKey", "Category").join(keys, "Category", "left")
    products = wh.bounded(products.select("ProductKey", "ProductCategoryKey"), "DimProduct")
    return facts.join(products, "ProductKey", "left").withColumn("ProductCategoryKey", _or_zero("ProductCategoryKey"))


def region_bridge(wh) -> DataFrame:
    """One RegionKey per region name.

    The region table repeats a name once per territory; joining it by name
    would multiply the facts, so the first region of each name stands for it.
    """
    return (
        wh.table("DimRegion")
        .groupBy(F.col("RegionName").alias("Region"))
        .agg(F.min_by("RegionKey", "RegionID").alias("RegionKey"))
    )


def with_region(facts: DataFrame, wh, territory: bool = False) -> DataFrame:
    """Adds the region key (and the territory key) of the store, by name; unknown = 0."""
    names = ["Region", "Territory"] if territory else ["Region"]
    stores = wh.table("DimStore").select("StoreKey", *names).join(
        wh.bounded(region_bridge(wh), "DimRegion"), "Region", "left"
    )
    keys = ["RegionKey"]
    if territory:
        areas = wh.side("DimSalesTerritory").select(
            F.col("TerritoryName").alias("Territory"), F.col("TerritoryKey").alias("SalesTerritoryKey")
        )
        stores = stores.join(areas, "Territory", "left")
        keys.append("SalesTerritoryKey")
    stores = wh.bounded(stores.select("StoreKey", *keys), "DimStore")
    return facts.join(stores, "StoreKey", "left").withColumns({k: _or_zero(k) for k in keys})


def with_segment(facts: DataFrame, wh) -> DataFrame:
    segments = wh.side("DimCustomerSegment").select(
        F.col("SegmentName").alias("CustomerSegment"), F.col("SegmentKey").alias("CustomerSegmentKey")
    )
    customers = wh.table("DimCustomer").select("CustomerKey", "CustomerSegment").join(segments, "CustomerSegment", "left")
    customers = wh.bounded(customers.select("CustomerKey", "CustomerSegmentKey"), "DimCustomer")
    return facts.join(customers, "CustomerKey", "left").withColumn("CustomerSegmentKey", _or_zero("CustomerSegmentKey"))


def _revenue(alias: str = "RevenueSum") -> Column:
    return money_sum("SalesRevenue").alias(alias)


def daily_sales(wh, facts: DataFrame | None = None) -> DataFrame:
    facts = facts if facts is not None else wh.table("FactSales")
    return (
        with_category(facts, wh)
        .groupBy("SalesDateKey", "StoreKey", "ProductCategoryKey")
        .agg(
            _revenue(),
            F.sum("QuantitySold").alias("QuantitySum"),
            money_sum("DiscountAmount").alias("DiscountSum"),
            F.sum("NumberOfTransactions").alias("TransactionCount"),
        )
    )


def daily_sales_increment(wh, day: dt.date) -> DataFrame:
    """The daily roll-up of one day only; the day filter reaches the scan of a stored fact table.

    Rows whose product has no known category are left out here.
    """
    facts = wh.table("FactSales").filter(F.col("SalesDateKey") == F.lit(day))
    return daily_sales(wh, facts).filter("ProductCategoryKey <> 0")


def _per_period(facts: DataFrame, unit: str, period: str, *keys: str) -> DataFrame:
    """Mergeable sums per period and fact keys.

    Facts are reduced before any dimension is joined, so a join sees a key once per period, also key 0, which may be a
    third of all facts.
    """
    value = F.col("SalesRevenue")
    return facts.groupBy(truncate(unit, "SalesDateKey").alias(period), *keys).agg(
        F.sum(value).alias("_sum"), F.count(value).alias("_n"), F.min(value).alias("_min"), F.max(value).alias("_max"),
        F.sum("QuantitySold").alias("_quantity"),
    )


def _merged_avg() -> Column:
    average = F.try_divide(F.sum("_sum").cast("double"), F.sum("_n").cast("double"))
    return F.round(average, 2).cast("decimal(18,2)")


def weekly_sales(wh) -> DataFrame:
    facts = _per_period(wh.table("FactSales"), "week", "WeekStartDateKey", "StoreKey", "ProductKey")
    return with_region(with_category(facts, wh), wh).groupBy("WeekStartDateKey", "RegionKey", "ProductCategoryKey").agg(
        money_sum("_sum").alias("RevenueSum"),
        _merged_avg().alias("RevenueAvg"),
        F.min("_min").alias("RevenueMin"),
        F.max("_max").alias("RevenueMax"),
        F.sum("_quantity").alias("QuantitySum"),
    )


def monthly_sales(wh) -> DataFrame:
    facts = _per_period(wh.table("FactSales"), "month", "MonthStartDateKey", "StoreKey", "CustomerKey")
    return with_region(with_segment(facts, wh), wh).groupBy("MonthStartDateKey", "CustomerSegmentKey", "RegionKey").agg(
        money_sum("_sum").alias("RevenueSum"),
        _merged_avg().alias("AvgOrderValue"),
        F.countDistinct("CustomerKey").alias("DistinctCustomers"),
    )


def aging_tier_key(days: Column) -> Column:
    """Key of the aging tier, straight from the fixed tier table."""
    return literal_range_key(days, LITERAL_TABLES["DimAgingTier"][1], 3, 4)


def daily_inventory(wh) -> DataFrame:
    prices = wh.bounded(
        wh.table("DimProduct").select("ProductKey", F.coalesce("Cost", "ListPrice").alias("_price")), "DimProduct"
    )
    rows = (
        with_category(wh.table("FactInventory"), wh)
        .join(prices, "ProductKey", "left")
        .withColumn("AgingTierKey", F.coalesce(aging_tier_key(F.col("StockAging")), F.lit(0)).cast("bigint"))
    )
    value = F.col("QuantityOnHand") * F.coalesce(F.col("_price"), F.lit(0).cast("decimal(18,2)"))
    return (
        rows.groupBy("InventoryDateKey", "WarehouseKey", "ProductCategoryKey", "AgingTierKey")
        .agg(exact_avg(value).alias("_value"), exact_avg("QuantityOnHand").alias("AvgQuantityOnHand"))
        .select(
            "InventoryDateKey",
            "WarehouseKey",
            "ProductCategoryKey",
            "AgingTierKey",
            F.round("_value", 2).cast("decimal(18,2)").alias("AvgInventoryValue"),
            "AvgQuantityOnHand",
        )
    )


def monthly_product_performance(wh) -> DataFrame:
    keys = ["MonthStartDateKey", "ProductKey", "StoreKey"]
    sales = (
        wh.table("FactSales")
        .groupBy(truncate("month", "SalesDateKey").alias("MonthStartDateKey"), "ProductKey", "StoreKey")
        .agg(_revenue(), F.sum("QuantitySold").alias("UnitsSold"))
    )
    returns = (
        wh.table("FactReturns")
        .groupBy(truncate("month", "ReturnDateKey").alias("MonthStartDateKey"), "ProductKey", "StoreKey")
        .agg(F.sum("ReturnedQuantity").alias("ReturnsQty"))
    )
    returned = F.coalesce("ReturnsQty", F.lit(0))
    share = F.try_divide(returned.cast("double"), F.col("UnitsSold").cast("double")) * 100.0
    return sales.join(returns, keys, "left").select(
        *keys,
        "RevenueSum",
        "UnitsSold",
        returned.cast("bigint").alias("ReturnsQty"),
        F.round(F.coalesce(share, F.lit(0.0)), 4).cast("decimal(10,4)").alias("ReturnsRatePct"),
        F.lit(None).cast("decimal(5,2)").alias("AvgRating"),
    )


def growth_rate(value: Column, previous: Column) -> Column:
    """Percent change; 0 when there is no previous value or it is 0."""
    change = F.try_divide((value - previous).cast("double"), previous.cast("double")) * 100.0
    return F.round(F.coalesce(change, F.lit(0.0)), 4).cast("decimal(10,4)")


_AREA = ("RegionKey", "SalesTerritoryKey")


def _regional_revenue(wh) -> DataFrame:
    facts = _per_period(wh.table("FactSales"), "month", "MonthStartDateKey", "StoreKey")
    areas = with_region(facts, wh, territory=True).groupBy("MonthStartDateKey", *_AREA)
    return areas.agg(money_sum("_sum").alias("RevenueSum"))


def _with_growth(rows: DataFrame) -> DataFrame:
    previous = F.lag("RevenueSum").over(Window.partitionBy(*_AREA).orderBy("MonthStartDateKey"))
    return rows.select("*", growth_rate(F.col("RevenueSum"), previous).alias("GrowthRatePct"))


def regional_sales(wh) -> DataFrame:
    """Monthly revenue with growth over the previous month that has any.

    The window runs over the roll-up, so a partition holds one row per month.
    """
    return _with_growth(_regional_revenue(wh))


def regional_sales_refresh(wh, stored: DataFrame, first: dt.date, touched: Column) -> DataFrame:
    """The roll-up from month ``first`` on, after the months that ``touched`` marks have changed.

    ``wh`` needs the facts of the touched months only.  Of the months before, the last one with revenue per area is
    carried over from the stored roll-up, and the untouched ones after ``first`` are read from it.
    """
    names, month = ["MonthStartDateKey", *_AREA, "RevenueSum"], F.col("MonthStartDateKey")
    before = stored.filter(month < F.lit(first)).groupBy(*_AREA)
    boundary = before.agg(
        F.max("MonthStartDateKey").alias("MonthStartDateKey"), F.max_by("RevenueSum", "MonthStartDateKey").alias("RevenueSum")
    )
    after = stored.filter((month >= F.lit(first)) & ~touched)
    rows = boundary.select(*names).unionByName(after.select(*names)).unionByName(_regional_revenue(wh).select(*names))
    return _with_growth(rows).filter(month >= F.lit(first))


def hourly_sales(facts: DataFrame, time: str = "SalesDateKey") -> DataFrame:
    """Sums per hour and product; on a DATE column every row falls into hour 0."""
    return facts.groupBy(F.date_trunc("hour", F.col(time)).alias("SalesHour"), "ProductKey").agg(
        money_sum("SalesRevenue").alias("Revenue"),
        F.sum("QuantitySold").alias("Quantity"),
        F.count(F.lit(1)).alias("TransactionCount"),
    )


def daily_revenue_from_rollup(daily: DataFrame) -> DataFrame:
    """Day totals re-aggregated from the daily roll-up instead of the fact table."""
    return daily.groupBy("SalesDateKey").agg(
        money_sum("RevenueSum").alias("TotalRevenue"),
        F.sum("QuantitySum").alias("TotalQuantity"),
        F.sum("TransactionCount").alias("Transactions"),
    )


def with_profit(facts: DataFrame, wh) -> DataFrame:
    """Adds ProfitAmount at load time, so that reports need no product join."""
    costs = wh.bounded(wh.table("DimProduct").select("ProductKey", "Cost"), "DimProduct")
    profit = F.col("SalesRevenue") - F.col("QuantitySold") * F.col("Cost")
    return facts.join(costs, "ProductKey", "left").withColumn("ProfitAmount", profit.cast("decimal(18,2)")).drop("Cost")


def profit_by_product(facts_with_profit: DataFrame) -> DataFrame:
    margin = F.try_divide(F.col("Profit").cast("double"), F.col("_revenue").cast("double")) * 100.0
    return (
        facts_with_profit.groupBy("ProductKey")
        .agg(money_sum("ProfitAmount").alias("Profit"), money_sum("SalesRevenue").alias("_revenue"))
        .select("ProductKey", "Profit", F.round(margin, 2).alias("Margin"))
    )


ROLLUPS = {
    "agg_daily_sales": (daily_sales, "SalesDateKey"),
    "agg_weekly_sales": (weekly_sales, "WeekStartDateKey"),
    "agg_monthly_sales": (monthly_sales, "MonthStartDateKey"),
    "agg_daily_inventory": (daily_inventory, "InventoryDateKey"),
    "agg_monthly_product_performance": (monthly_product_performance, "MonthStartDateKey"),
    "agg_regional_sales": (regional_sales, "MonthStartDateKey"),
}


#: The facts each roll-up is made of; others depend on all.
ROLLUP_FACTS = {
    "agg_daily_sales": ("FactSales",),
    "agg_weekly_sales": ("FactSales",),
    "agg_monthly_sales": ("FactSales",),
    "agg_daily_inventory": ("FactInventory",),
    "agg_monthly_product_performance": ("FactSales", "FactReturns"),
    "agg_regional_sales": ("FactSales",),
}


def register_rollup(name: str, build, period_column: str) -> None:
    """Add a roll-up of your own to the batch run."""
    ROLLUPS[name] = (build, period_column)


#: What a stored roll-up can answer: its keys and its additive measures.
ADDITIVE = {
    "agg_daily_sales": (
        {"SalesDateKey", "StoreKey", "ProductCategoryKey"},
        {"RevenueSum", "QuantitySum", "DiscountSum", "TransactionCount"},
    ),
    "agg_weekly_sales": ({"WeekStartDateKey", "RegionKey", "ProductCategoryKey"}, {"RevenueSum", "QuantitySum"}),
    "agg_monthly_sales": ({"MonthStartDateKey", "CustomerSegmentKey", "RegionKey"}, {"RevenueSum"}),
    "agg_monthly_product_performance": (
        {"MonthStartDateKey", "ProductKey", "StoreKey"},
        {"RevenueSum", "UnitsSold", "ReturnsQty"},
    ),
    "agg_regional_sales": ({"MonthStartDateKey", "RegionKey", "SalesTerritoryKey"}, {"RevenueSum"}),
}


def choose_rollup(keys, measures) -> str | None:
    """The roll-up with the fewest keys that covers the wanted keys and sums, or None."""
    fitting = [n for n, (k, m) in ADDITIVE.items() if set(keys) <= k and set(measures) <= m]
    return min(fitting, key=lambda n: (len(ADDITIVE[n][0]), n), default=None)
