"""The analytical views.

Each is a function of a warehouse.  Per-row views join small sides to the fact.
Per-member views aggregate the fact by the surrogate key first and then attach
the member's attributes, so that the shuffle carries keys and partial sums
instead of a dozen descriptive columns.

Misses of an outer join are NULL (not 0 or ''), as in standard SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.bands import band, first_match
from starloom.functions.measures import exact_avg, percent, ratio
from starloom.operators.reach import merged_counts
from starloom.operators.skew import split_left_join

CALENDAR = ["DateKey", "Year", "Month", "MonthName"]

# The banding ladders, tested top-down.
AGING_BANDS = (
    ("<=", 30, "Fresh (0-30 days)"),
    ("<=", 90, "Aged (31-90 days)"),
    ("<=", 180, "Very Aged (91-180 days)"),
)
AGING_LAST = "Obsolete (180+ days)"
SCRAP_BANDS = ((">", 10, "High"), (">", 5, "Medium"))
SATISFACTION_BANDS = ((">=", 4.5, "Excellent"), (">=", 3.5, "Good"), (">=", 2.5, "Fair"))
RESOLUTION_BANDS = (("<=", 24, "Very Fast"), ("<=", 72, "Fast"), ("<=", 168, "Moderate"))
ROI_BANDS = ((">", 300, "Excellent"), (">", 150, "Good"), (">", 0, "Positive"))
DELAY_BANDS = (("=", 0, "On Time"), ("<=", 10, "Slightly Late"), ("<=", 30, "Late"))
CREDIT_BANDS = ((">=", 90, "Critical"), (">=", 75, "High"), (">=", 50, "Medium"))
HIGH_MARGIN, MEDIUM_MARGIN = "0.30", "0.15"
OBSOLETE_DAYS, OVERSTOCK_FACTOR, HIGH_COST_SHARE = 180, 3, "0.8"
REASON_COLUMNS = {"Defective": "DefectiveReturns", "Wrong Item": "WrongItemReturns", "Changed Mind": "ChangedMindReturns"}


def _share(value: str, scale: int = 2) -> Column:
    return F.lit(value).cast(f"decimal(3,{scale})")


def _calendar(facts: DataFrame, wh, day: str, columns=CALENDAR) -> DataFrame:
    """Calendar attributes of the fact's date key."""
    days = wh.bounded(wh.table("DimDate").select(*columns), "DimDate")
    return facts.join(days, F.col(day) == F.col("DateKey"), "left")


def _attach(facts: DataFrame, wh, name: str, key: str, version: str = "current", fact_key: str | None = None, **columns):
    """Member attributes by surrogate key; ``columns`` maps output names to member columns.

    ``version="current"`` attaches current versions only: facts of an expired
    version lose their attributes.  ``"as_loaded"`` keeps them.
    """
    members = wh.table(name) if version == "as_loaded" or name == "DimPromotion" else wh.current(name)
    wanted = [F.col(c).alias(n) for n, c in columns.items()]
    fact_key = fact_key or key
    if wh.broadcastable(name):
        side = members.select(F.col(key).alias("_member"), *wanted)
        return facts.join(wh.bounded(side, name), F.col(fact_key) == F.col("_member"), "left").drop("_member")
    # A shuffled join: facts without a member, and what was measured as hot, are dealt over all partitions.
    side = members.select(F.col(key).alias(fact_key), *wanted)
    apart = [c for c in facts.columns if c.endswith("Key") and c != fact_key]  # few columns, so that others are pruned
    return split_left_join(facts, side, fact_key, wh.hot_keys(fact_key), apart)


def _same(*names: str) -> dict[str, str]:
    return {n: n for n in names}


def _literal(facts: DataFrame, wh, name: str, key: str, column: str) -> DataFrame:
    return facts.join(wh.side(name).select(key, column), key, "left")


def _distinct(column: str, approximate: bool) -> Column:
    return F.approx_count_distinct(column) if approximate else F.countDistinct(column)


def sales_extended_full(wh, version: str = "current") -> DataFrame:
    f = wh.table("FactSales")
    customer = ["CustomerName", "City", "StateProvince", "Country", "CustomerSegment", "CustomerType",
                "AccountStatus", "CreditLimit"]
    product = ["ProductName", "SKU", "Category", "SubCategory", "Brand", "ListPrice", "Cost", "ProductStatus"]
    store = ["StoreName", "Region", "Territory", "StoreType", "SquareFootage", "StoreStatus"]
    members = [
        ("DimCustomer", "CustomerKey", _same(*customer)),
        ("DimProduct", "ProductKey", _same(*product)),
        ("DimStore", "StoreKey", {"StoreCity": "City", **_same(*store)}),
        ("DimEmployee", "EmployeeKey", {"EmployeeRegion": "Region", "EmployeeTerritory": "Territory",
                                        **_same("EmployeeName", "JobTitle", "Department", "SalesQuota")}),
    ]
    # Joins that shuffle the facts come first, so what is broadcast does not move with them.  Of these the employees come first,
    # whom few sales have, and the customers last, so their texts are not shuffled again.
    late = ["DimEmployee", "DimProduct", "DimStore", "DimCustomer"]
    shuffled = sorted((m for m in members if not wh.broadcastable(m[0])), key=lambda m: late.index(m[0]))
    for name, key, columns in [*shuffled, *(m for m in members if m not in shuffled)]:
        f = _attach(f, wh, name, key, version, **columns)
    f = _calendar(f, wh, "SalesDateKey", [*CALENDAR, "Quarter", "Week", "DayOfWeek", "FiscalYear", "Season"])
    net = F.col("SalesRevenue") - F.col("DiscountAmount")
    gross = net - F.col("QuantitySold") * F.col("Cost")
    margin = first_match(
        [(gross > net * _share(HIGH_MARGIN), "High Margin"), (gross > net * _share(MEDIUM_MARGIN), "Medium Margin")],
        "Low Margin",
    )
    return f.select(
        "SalesDateKey",
        "DateKey", "Year", "Quarter", "Month", "MonthName", "Week", "DayOfWeek", "FiscalYear", "Season",
        "CustomerKey", *customer,
        "ProductKey", *product,
        "StoreKey", "StoreName", "StoreCity", *store[1:],
        "EmployeeKey", "EmployeeName", "JobTitle", "Department", "EmployeeRegion", "EmployeeTerritory", "SalesQuota",
        F.col("SalesRevenue").alias("SalesAmount"),
        F.col("QuantitySold").alias("Quantity"),
        "DiscountAmount",
        F.col("NumberOfTransactions").alias("TransactionCount"),
        ratio("SalesRevenue", "QuantitySold").alias("UnitPrice"),
        percent("DiscountAmount", "SalesRevenue").alias("DiscountPercentage"),
        percent(net, "SalesRevenue").alias("NetRevenuePercent"),
        net.alias("NetRevenue"),
        gross.alias("GrossProfit"),
        percent(gross, "SalesRevenue").alias("ProfitMarginPercent"),
        margin.alias("MarginCategory"),
    )


def _sales_by(wh, key: str, distinct: dict[str, str], approximate: bool) -> DataFrame:
    """Sums and distinct counts of the sales per member key.

    The counts come from the stored words of ``reach:<key>`` where the warehouse
    has that table (see ``operators.reach``).  Otherwise the products are counted
    with the sums, as the facts lie by product there, and the other columns apart:
    Spark repeats a row per column that it counts, and those rows are to carry no sums.
    It spreads each (key, value) pair before counting, so a hot member is not counted in one task.
    """
    stored = f"reach:{key}" if f"reach:{key}" in wh and not approximate else None
    sales = wh.table("FactSales")
    costs = wh.bounded(wh.table("DimProduct").select("ProductKey", "Cost"), "DimProduct")
    net = F.col("SalesRevenue") - F.col("DiscountAmount")
    gross = net - F.col("QuantitySold") * F.col("Cost")
    together = {} if stored else {n: c for n, c in distinct.items() if approximate or c == "ProductKey"}
    apart = {} if stored else {n: c for n, c in distinct.items() if n not in together}
    stats = (
        sales.join(costs, "ProductKey", "left")
        .groupBy(F.col(key).alias("_member"))
        .agg(
            *[_distinct(column, approximate).alias(name) for name, column in together.items()],
            F.sum("QuantitySold").alias("_quantity"),
            F.sum("SalesRevenue").alias("_revenue"),
            F.sum("DiscountAmount").alias("_discount"),
            F.sum(gross).alias("_gross"),
            exact_avg("SalesRevenue").alias("_average"),
            F.min("SalesDateKey").alias("_first"),
            F.max("SalesDateKey").alias("_last"),
            F.count(F.lit(1)).alias("_rows"),
        )
        # The measures are never NULL, so the sum of the differences is the difference of the sums.
        .withColumn("_net", F.col("_revenue") - F.col("_discount"))
    )
    if apart:
        counts = sales.groupBy(F.col(key).alias("_member")).agg(*[_distinct(column, False).alias(name) for name, column in apart.items()])
        stats = stats.join(counts, "_member", "left")
    return stats.join(merged_counts(wh.table(stored), distinct, "_member"), "_member", "left") if stored else stats


def _per_member(wh, name: str, key: str, attributes: list[str], stats: DataFrame) -> DataFrame:
    """Every current member with its statistics; members without facts stay."""
    members = wh.current(name).select(key, *attributes)
    return members.join(stats, F.col(key) == F.col("_member"), "left")


def _count(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0).cast("bigint")).alias(name)


def sales_by_customer(wh, approximate: bool = False) -> DataFrame:
    attributes = ["CustomerID", "CustomerName", "City", "StateProvince", "Country", "CustomerSegment", "CustomerType",
                  "AccountStatus", "CreditLimit", "AnnualIncome", "YearsSinceFirstPurchase"]
    counts = {"PurchaseDays": "SalesDateKey", "StoresVisited": "StoreKey", "UniqueProductsPurchased": "ProductKey",
              "EmployeesInteracted": "EmployeeKey"}
    rows = _per_member(
        wh, "DimCustomer", "CustomerKey", attributes, _sales_by(wh, "CustomerKey", counts, approximate)
    )
    return rows.select(
        "CustomerKey", *attributes, *[_count(c) for c in counts],
        F.col("_quantity").alias("TotalQuantityPurchased"),
        F.col("_revenue").alias("TotalRevenue"),
        F.col("_net").alias("NetRevenue"),
        F.col("_gross").alias("TotalProfit"),
        percent("_gross", "_revenue").alias("AvgProfitMarginPercent"),
        F.col("_average").alias("AvgOrderValue"),
        F.col("_last").alias("LastPurchaseDate"),
        F.col("_first").alias("FirstPurchaseDate"),
        percent("_discount", "_revenue").alias("AvgDiscountPercentage"),
        # A member without facts still is one row of the outer join.
        F.coalesce("_rows", F.lit(1)).alias("TotalTransactions"),
    )


def sales_by_product(wh, approximate: bool = False) -> DataFrame:
    attributes = ["ProductID", "ProductName", "SKU", "Category", "SubCategory", "Brand", "ListPrice", "Cost",
                  "ProductStatus", "Color", "Size"]
    counts = {"SalesDays": "SalesDateKey", "StoresOffering": "StoreKey", "UniqueCustomers": "CustomerKey"}
    rows = _per_member(wh, "DimProduct", "ProductKey", attributes, _sales_by(wh, "ProductKey", counts, approximate))
    return rows.select(
        "ProductKey", *attributes, *[_count(c) for c in counts],
        F.col("_quantity").alias("TotalUnitsSold"),
        F.col("_revenue").alias("TotalRevenue"),
        F.col("_net").alias("NetRevenue"),
        F.col("_gross").alias("GrossProfit"),
        percent("_gross", "_revenue").alias("ProfitMarginPercent"),
        ratio("_revenue", "SalesDays").alias("DailyAvenueRevenue"),
        ratio("_quantity", "SalesDays").alias("DailyAverageUnits"),
        percent("_discount", "_revenue").alias("AvgDiscountPercentage"),
        F.round("_average", 2).alias("AvgOrderValue"),
    )


def sales_by_store(wh, approximate: bool = False) -> DataFrame:
    attributes = ["StoreID", "StoreName", "City", "StateProvince", "Region", "Territory", "StoreType", "StoreStatus",
                  "SquareFootage", "OpeningDate"]
    counts = {"ActiveSalesDays": "SalesDateKey", "UniqueCustomers": "CustomerKey", "ProductsOffered": "ProductKey",
              "ActiveEmployees": "EmployeeKey"}
    rows = _per_member(wh, "DimStore", "StoreKey", attributes, _sales_by(wh, "StoreKey", counts, approximate))
    return rows.select(
        "StoreKey", *attributes, *[_count(c) for c in counts],
        F.col("_quantity").alias("TotalUnitsSold"),
        F.col("_revenue").alias("TotalRevenue"),
        F.col("_net").alias("NetRevenue"),
        F.col("_gross").alias("GrossProfit"),
        ratio("_revenue", "SquareFootage").alias("SalesPerSqFt"),
        ratio("_net", "SquareFootage").alias("NetRevenuePerSqFt"),
        F.col("_average").alias("AvgTransactionValue"),
        percent("_discount", "_revenue").alias("AvgDiscountPercentage"),
        F.col("_last").alias("LastSalesDate"),
    )


def sales_by_employee(wh, approximate: bool = False) -> DataFrame:
    attributes = ["EmployeeID", "EmployeeName", "JobTitle", "Department", "Region", "Territory", "SalesQuota",
                  "EmployeeStatus", "HireDate"]
    counts = {"ActiveSalesDays": "SalesDateKey", "CustomersServed": "CustomerKey", "ProductsSold": "ProductKey",
              "StoresWorked": "StoreKey"}
    rows = _per_member(
        wh, "DimEmployee", "EmployeeKey", attributes, _sales_by(wh, "EmployeeKey", counts, approximate)
    )
    return rows.select(
        "EmployeeKey", *attributes, *[_count(c) for c in counts],
        F.col("_quantity").alias("TotalUnitsSold"),
        F.col("_revenue").alias("TotalRevenue"),
        F.col("_net").alias("NetRevenue"),
        F.col("_gross").alias("GrossProfit"),
        percent("_net", "SalesQuota").alias("QuotaAttainmentPercent"),
        ratio("_net", "ActiveSalesDays").alias("DailyAverageRevenue"),
        F.col("_average").alias("AvgOrderValue"),
        percent("_discount", "_revenue").alias("AvgDiscountPercentage"),
        F.col("_last").alias("LastSalesDate"),
    )


def _surplus(more: str, less: str) -> Column:
    """The positive part of a difference; NULL when either side is."""
    gap = F.col(more).cast("bigint") - F.col(less).cast("bigint")
    return F.when(gap.isNotNull(), F.greatest(F.lit(0).cast("bigint"), gap))


def inventory_snapshot(wh, version: str = "current") -> DataFrame:
    f = _calendar(wh.table("FactInventory"), wh, "InventoryDateKey")
    product = ["ProductName", "SKU", "Category", "SubCategory", "ListPrice", "Cost"]
    store = ["StoreName", "Region", "Territory"]
    f = _attach(f, wh, "DimProduct", "ProductKey", version, **_same(*product))
    f = _attach(f, wh, "DimStore", "StoreKey", version, **_same(*store))
    stock, reorder = F.col("QuantityOnHand"), F.col("ReorderLevel")
    status = first_match(
        [
            (stock <= reorder, "Critical"),
            (stock <= F.col("SafetyStockLevels"), "Low"),
            (stock >= reorder * OVERSTOCK_FACTOR, "Overstock"),
        ],
        "Normal",
    )
    return f.select(
        "InventoryDateKey", *CALENDAR, "ProductKey", *product, "StoreKey", *store,
        "QuantityOnHand",
        F.round(stock * F.col("ListPrice"), 2).alias("InventoryValueAtListPrice"),
        F.round(stock * F.col("Cost"), 2).alias("InventoryValueAtCost"),
        "ReorderLevel", "SafetyStockLevels", "StockAging",
        band("StockAging", AGING_BANDS, AGING_LAST).alias("AgingCategory"),
        status.alias("StockStatus"),
        _surplus("QuantityOnHand", "ReorderLevel").alias("ExcessQuantity"),
        _surplus("ReorderLevel", "QuantityOnHand").alias("ShortageQuantity"),
    )


def inventory_by_product(wh, approximate: bool = False) -> DataFrame:
    attributes = ["ProductID", "ProductName", "SKU", "Category", "SubCategory", "ListPrice", "Cost", "ProductStatus"]
    stock, reorder = F.col("QuantityOnHand"), F.col("ReorderLevel")
    stats = (
        wh.table("FactInventory")
        .groupBy(F.col("ProductKey").alias("_member"))
        .agg(
            F.sum(stock).alias("_stock"),
            _distinct("StoreKey", approximate).alias("StoresStockingProduct"),
            exact_avg("StockAging").alias("_aging"),
            F.max("StockAging").alias("MaxStockAgingDays"),
            F.count_if(stock <= reorder).alias("LocationsBelowReorderLevel"),
            F.count_if(stock <= F.col("SafetyStockLevels")).alias("LocationsAtRiskLevel"),
            F.count_if(stock >= reorder * OVERSTOCK_FACTOR).alias("OverstockedLocations"),
            F.sum(_surplus("QuantityOnHand", "ReorderLevel")).alias("_excess"),
        )
    )
    counts = ["LocationsBelowReorderLevel", "LocationsAtRiskLevel", "OverstockedLocations"]
    rows = _per_member(wh, "DimProduct", "ProductKey", attributes, stats)
    return rows.select(
        "ProductKey", *attributes,
        F.col("_stock").alias("TotalQuantityOnHand"),
        _count("StoresStockingProduct"),
        # The price is the same for all rows of a product, so it multiplies the sum.
        F.round(F.col("_stock") * F.col("ListPrice"), 2).alias("TotalInventoryValueAtListPrice"),
        F.round(F.col("_stock") * F.col("Cost"), 2).alias("TotalInventoryValueAtCost"),
        F.round("_aging", 2).alias("AvgStockAgingDays"),
        "MaxStockAgingDays",
        *[_count(c) for c in counts],
        percent("_excess", "_stock").alias("ExcessPercentage"),
    )


def inventory_by_warehouse(wh, approximate: bool = False) -> DataFrame:
    attributes = ["WarehouseID", "WarehouseName", "Location", "WarehouseType"]
    f = _attach(
        wh.table("FactInventory"), wh, "DimProduct", "ProductKey", **_same("ListPrice", "Cost")
    )
    stock = F.col("QuantityOnHand")
    old = F.col("StockAging") > OBSOLETE_DAYS
    stats = f.groupBy(F.col("WarehouseKey").alias("_member")).agg(
        F.sum(stock).alias("TotalQuantityOnHand"),
        _distinct("ProductKey", approximate).alias("UniqueProductsStored"),
        _distinct("StoreKey", approximate).alias("ServicedLocations"),
        F.round(F.sum(stock * F.col("ListPrice")), 2).alias("TotalInventoryValueAtListPrice"),
        F.round(F.sum(stock * F.col("Cost")), 2).alias("TotalInventoryValueAtCost"),
        F.count_if(stock <= F.col("ReorderLevel")).alias("CriticalStockItems"),
        F.round(exact_avg("StockAging"), 1).alias("AvgStockAgingDays"),
        F.sum(F.when(old, stock)).alias("_old_stock"),
        F.sum(F.when(old, stock * F.col("Cost"))).alias("_old_value"),
    )
    rows = _per_member(wh, "DimWarehouse", "WarehouseKey", attributes, stats)
    return rows.select(
        "WarehouseKey", *attributes,
        "TotalQuantityOnHand",
        _count("UniqueProductsStored"),
        _count("ServicedLocations"),
        "TotalInventoryValueAtListPrice",
        "TotalInventoryValueAtCost",
        _count("CriticalStockItems"),
        "AvgStockAgingDays",
        F.coalesce("_old_stock", F.lit(0).cast("bigint")).alias("ObsoleteQuantity"),
        F.round(F.coalesce("_old_value", F.lit(0).cast("decimal(18,2)")), 2).alias("ObsoleteValueAtCost"),
    )


def purchases_extended_full(wh, version: str = "current") -> DataFrame:
    f = _calendar(wh.table("FactPurchases"), wh, "PurchaseDateKey")
    product = ["ProductName", "SKU", "Category", "SubCategory", "Brand", "ListPrice", "Cost"]
    vendor = ["VendorName", "ContactPerson", "City", "Country", "VendorRating", "OnTimeDeliveryRate", "QualityScore",
              "PaymentTerms", "VendorStatus"]
    f = _attach(f, wh, "DimProduct", "ProductKey", version, **_same(*product))
    f = _attach(f, wh, "DimVendor", "VendorKey", version, **_same(*vendor))
    net = F.col("PurchaseAmount") - F.col("DiscountAmount")
    return f.select(
        "PurchaseDateKey", *CALENDAR, "ProductKey", *product, "VendorKey", *vendor,
        "PurchaseAmount", "QuantityBought", "UnitPrice", "DiscountAmount",
        net.alias("NetPurchaseAmount"),
        ratio("PurchaseAmount", "QuantityBought", 4).alias("EffectiveUnitCost"),
        percent("DiscountAmount", "PurchaseAmount").alias("DiscountPercentage"),
        percent(net - F.col("QuantityBought") * F.col("Cost"), net).alias("CostSavingPercent"),
    )


def vendor_performance(wh, approximate: bool = False) -> DataFrame:
    attributes = ["VendorID", "VendorName", "ContactPerson", "City", "Country", "VendorRating", "OnTimeDeliveryRate",
                  "QualityScore", "PaymentTerms", "VendorStatus"]
    f = _attach(wh.table("FactPurchases"), wh, "DimProduct", "ProductKey", **_same("ListPrice"))
    costly = F.col("UnitPrice") > F.col("ListPrice") * _share(HIGH_COST_SHARE, 1)
    stats = f.groupBy(F.col("VendorKey").alias("_member")).agg(
        _distinct("PurchaseDateKey", approximate).alias("PurchaseDays"),
        _distinct("ProductKey", approximate).alias("UniqueProductsPurchased"),
        F.sum("QuantityBought").alias("TotalQuantityPurchased"),
        F.sum("PurchaseAmount").alias("TotalPurchaseAmount"),
        F.sum(F.col("PurchaseAmount") - F.col("DiscountAmount")).alias("NetPurchaseAmount"),
        F.sum("DiscountAmount").alias("TotalDiscountsReceived"),
        exact_avg("PurchaseAmount").alias("AvgOrderValue"),
        F.sum(F.when(costly, F.col("QuantityBought"))).alias("_costly"),
    )
    rows = _per_member(wh, "DimVendor", "VendorKey", attributes, stats)
    return rows.select(
        "VendorKey", *attributes,
        _count("PurchaseDays"),
        _count("UniqueProductsPurchased"),
        "TotalQuantityPurchased",
        "TotalPurchaseAmount",
        "NetPurchaseAmount",
        "TotalDiscountsReceived",
        percent("TotalDiscountsReceived", "TotalPurchaseAmount").alias("AvgDiscountPercent"),
        "AvgOrderValue",
        F.coalesce("_costly", F.lit(0).cast("bigint")).alias("HighCostPurchasesQty"),
        # Averages over rows of one vendor: the vendor's own value.
        F.round(F.col("VendorRating").cast("double"), 2).alias("EffectiveVendorRating"),
        F.round(F.col("OnTimeDeliveryRate").cast("double"), 2).alias("EffectiveOnTimeRate"),
    )


def production_metrics(wh, version: str = "current") -> DataFrame:
    f = _calendar(wh.table("FactProduction"), wh, "ProductionDateKey")
    product = ["ProductName", "SKU", "Category", "Brand"]
    staff = ["EmployeeName", "JobTitle", "Department"]
    f = _attach(f, wh, "DimProduct", "ProductKey", version, **_same(*product))
    f = _attach(f, wh, "DimEmployee", "EmployeeKey", version, fact_key="SupervisorKey", **_same(*staff))
    scrap = F.col("ScrapRatePercent").cast("double")
    good = F.col("UnitsProduced").cast("double") * (F.lit(1.0) - scrap / 100.0)
    return f.select(
        "ProductionDateKey", *CALENDAR, "ProductKey", *product, "SupervisorKey", *staff,
        "UnitsProduced", "ProductionTimeHours", "ScrapRatePercent", "DefectCount",
        ratio("UnitsProduced", "ProductionTimeHours").alias("UnitsPerHour"),
        ratio(good, "ProductionTimeHours").alias("GoodUnitsPerHour"),
        (F.lit(100).cast("decimal(5,2)") - F.col("ScrapRatePercent")).alias("YieldPercent"),
        percent("DefectCount", "UnitsProduced").alias("DefectRate"),
        band("ScrapRatePercent", SCRAP_BANDS, "Low").alias("ScrapRiskLevel"),
    )


def feedback_analysis(wh, version: str = "current") -> DataFrame:
    f = _calendar(wh.table("FactCustomerFeedback"), wh, "FeedbackDateKey")
    customer = ["CustomerName", "City", "Country", "CustomerSegment"]
    f = _attach(f, wh, "DimCustomer", "CustomerKey", version, **_same(*customer))
    f = _literal(f, wh, "DimFeedbackCategory", "FeedbackCategoryKey", "CategoryName")
    return f.select(
        "FeedbackDateKey", *CALENDAR, "CustomerKey", *customer, "CategoryName",
        "FeedbackScore", "ComplaintCount", "ResolutionTimeHours", "CSATScore",
        band("FeedbackScore", SATISFACTION_BANDS, "Poor").alias("SatisfactionLevel"),
        band("ResolutionTimeHours", RESOLUTION_BANDS, "Slow").alias("ResolutionSpeed"),
    )


def feedback_summary(wh) -> DataFrame:
    known = wh.side("DimFeedbackCategory").select(
        "FeedbackCategoryKey", "CategoryName", F.col("FeedbackCategoryKey").alias("_category")
    )
    stats = (
        wh.table("FactCustomerFeedback")
        .join(known, "FeedbackCategoryKey", "left")
        .groupBy(F.col("_category").alias("FeedbackCategoryKey"), "CategoryName")
        .agg(
            F.count(F.lit(1)).alias("TotalFeedbackCount"),
            exact_avg("FeedbackScore").alias("AvgFeedbackScore"),
            exact_avg("CSATScore").alias("AvgCSATScore"),
            F.sum("ComplaintCount").alias("TotalComplaints"),
            exact_avg("ResolutionTimeHours").alias("AvgResolutionTimeHours"),
            F.count_if(F.col("FeedbackScore") >= 4).alias("PositiveFeedbackCount"),
            F.count_if(F.col("FeedbackScore") < 3).alias("NegativeFeedbackCount"),
        )
    )
    return stats


def promotion_response(wh, version: str = "current") -> DataFrame:
    f = _calendar(wh.table("FactPromotionResponse"), wh, "PromotionDateKey")
    product, store = ["ProductName", "Category", "SubCategory"], ["StoreName", "Region"]
    promotion = ["PromotionName", "PromotionType", "DiscountPercentage"]
    f = _attach(f, wh, "DimProduct", "ProductKey", version, **_same(*product))
    f = _attach(f, wh, "DimStore", "StoreKey", version, **_same(*store))
    f = _attach(f, wh, "DimPromotion", "PromotionKey", version, **_same(*promotion))
    return f.select(
        "PromotionDateKey", *CALENDAR, "ProductKey", *product, "StoreKey", *store, "PromotionKey", *promotion,
        "SalesDuringCampaign", "DiscountUsageCount", "CustomerUptakeRate", "PromotionROI",
        band("PromotionROI", ROI_BANDS, "Negative").alias("ROICategory"),
    )


def finance_analysis(wh, version: str = "current") -> DataFrame:
    f = _calendar(wh.table("FactFinance"), wh, "InvoiceDateKey")
    customer, store = ["CustomerName", "City", "Country", "CustomerSegment", "CreditLimit"], ["StoreName", "Region"]
    f = _attach(f, wh, "DimCustomer", "CustomerKey", version, **_same(*customer))
    f = _attach(f, wh, "DimStore", "StoreKey", version, **_same(*store))
    f = _literal(f, wh, "DimFinanceCategory", "FinanceCategoryKey", "CategoryName")
    return f.select(
        "InvoiceDateKey", *CALENDAR, "CustomerKey", *customer, "StoreKey", *store, "CategoryName",
        "InvoiceAmount", "PaymentDelayDays", "CreditUsagePct", "InterestCharges",
        (F.col("InvoiceAmount") - F.col("InterestCharges")).alias("NetInvoiceAmount"),
        # An early payment (negative delay) falls to the second rung.
        band("PaymentDelayDays", DELAY_BANDS, "Very Late").alias("DelayStatus"),
        band("CreditUsagePct", CREDIT_BANDS, "Low").alias("CreditRiskLevel"),
    )


def returns_analysis(wh, version: str = "current") -> DataFrame:
    f = _calendar(wh.table("FactReturns"), wh, "ReturnDateKey")
    customer, product = ["CustomerName", "City", "Country", "CustomerSegment"], ["ProductName", "Category", "SubCategory"]
    store = ["StoreName", "Region"]
    f = _attach(f, wh, "DimCustomer", "CustomerKey", version, **_same(*customer))
    f = _attach(f, wh, "DimProduct", "ProductKey", version, **_same(*product))
    f = _attach(f, wh, "DimStore", "StoreKey", version, **_same(*store))
    f = _literal(f, wh, "DimReturnReason", "ReturnReasonKey", "ReturnReasonName")
    net = F.col("RefundAmount") - F.col("RestockingFee")
    return f.select(
        "ReturnDateKey", *CALENDAR, "CustomerKey", *customer, "ProductKey", *product, "StoreKey", *store,
        "ReturnReasonName", "ReturnedQuantity", "RefundAmount", "RestockingFee",
        net.alias("NetRefundAmount"),
        percent(net, "RefundAmount").alias("NetRefundPercent"),
    )


def return_analysis_by_product(wh) -> DataFrame:
    """Returns per product against what was sold.

    Returns and sales are aggregated apart and joined per product; joining the
    two facts row by row would count every return once per sale.
    """
    attributes = ["ProductID", "ProductName", "Category", "SubCategory", "ListPrice", "Cost"]
    reasons = wh.side("DimReturnReason").select("ReturnReasonKey", "ReturnReasonName")
    returns = (
        wh.table("FactReturns")
        .join(reasons, "ReturnReasonKey", "left")
        .groupBy(F.col("ProductKey").alias("_member"))
        .agg(
            F.count(F.lit(1)).alias("_events"),
            F.sum("ReturnedQuantity").alias("TotalReturnedQuantity"),
            F.sum("RefundAmount").alias("TotalRefundAmount"),
            F.sum("RestockingFee").alias("TotalRestockingFees"),
            *[F.count_if(F.col("ReturnReasonName") == r).alias(n) for r, n in REASON_COLUMNS.items()],
        )
    )
    sales = (
        wh.table("FactSales")
        .groupBy(F.col("ProductKey").alias("_sold"))
        .agg(F.countDistinct("SalesDateKey").alias("_days"), F.sum("QuantitySold").alias("_units"))
    )
    rows = _per_member(wh, "DimProduct", "ProductKey", attributes, returns).join(
        sales, F.col("ProductKey") == F.col("_sold"), "left"
    )
    return rows.select(
        "ProductKey", *attributes,
        F.coalesce("_events", F.lit(1)).alias("TotalReturnEvents"),
        "TotalReturnedQuantity",
        "TotalRefundAmount",
        "TotalRestockingFees",
        ratio("TotalRefundAmount", "_days").alias("AvgRefundAmount"),
        percent("TotalReturnedQuantity", "_units").alias("ReturnRatePercent"),
        *[_count(n) for n in REASON_COLUMNS.values()],
    )


VIEWS = {
    "vw_sales_extended_full": sales_extended_full,
    "vw_sales_by_customer": sales_by_customer,
    "vw_sales_by_product": sales_by_product,
    "vw_sales_by_store": sales_by_store,
    "vw_sales_by_employee": sales_by_employee,
    "vw_inventory_snapshot": inventory_snapshot,
    "vw_inventory_by_product": inventory_by_product,
    "vw_inventory_by_warehouse": inventory_by_warehouse,
    "vw_purchases_extended_full": purchases_extended_full,
    "vw_vendor_performance": vendor_performance,
    "vw_production_metrics": production_metrics,
    "vw_feedback_analysis": feedback_analysis,
    "vw_feedback_summary_by_category": feedback_summary,
    "vw_promotion_response": promotion_response,
    "vw_finance_analysis": finance_analysis,
    "vw_returns_analysis": returns_analysis,
    "vw_return_analysis_by_product": return_analysis_by_product,
}


def create_views(wh) -> None:
    """Register every view (and table of the warehouse) for use from SQL."""
    for name, build in VIEWS.items():
        build(wh).createOrReplaceTempView(name)
