"""Fact builders: operational tables -> fact rows with natural keys.

Builders never sort (the writer does) and never look up surrogate keys
(``operators.fk`` does).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.bands import first_match
from starloom.functions.keys import WIDE_KEYS, KeyPolicy, hash_uniform, surrogate_key
from starloom.functions.lookups import nullable_left_join, small_side

Sources = Mapping[str, DataFrame]

# Finance categories by invoice amount (5 = paid by credit card).
FINANCE_BY_CARD, FINANCE_LARGEST = 5, 4
FINANCE_BY_AMOUNT = (("<", 100, 1), ("<", 1000, 2), ("<=", 10000, 3))
# The synthetic returns.
RETURN_SHARE = 0.08
RETURN_DAYS_FIRST, RETURN_DAYS_SPREAD = 15, 45
RETURN_REASONS = ((0.15, 4), (0.35, 3), (0.60, 2))
RETURN_REASON_DEFAULT = 1
RETURN_CONDITIONS = ((0.15, "Damaged"), (0.30, "Opened"), (0.50, "Like New"))
RETURN_CONDITION_DEFAULT = "New/Sealed"
NO_FEE_SHARE, FEE_RATE, MAIL_SHARE = 0.7, "0.15", 0.5
SHIPPED_STATUS = 5


def _money(value: Column) -> Column:
    return value.cast("decimal(18,2)")


def _lineage(df: DataFrame, batch_id: str, loaded_at: dt.datetime | None, stamp: str = "LoadTimestamp") -> DataFrame:
    when = F.lit(loaded_at) if loaded_at else F.current_timestamp()
    return df.withColumn("ETLBatchID", F.lit(batch_id)).withColumn(stamp, when.cast("timestamp"))


def _customer_store(src: Sources) -> DataFrame:
    return src["Sales.Customer"].select("CustomerID", "StoreID")


def _small_orders(orders: DataFrame, source: DataFrame, *used: str) -> DataFrame:
    """Orders with their customer's columns as a join side: one row per source order."""
    return small_side(orders, source.select(*used))


def _known_product(src: Sources) -> DataFrame:
    return src["Production.Product"].select("ProductID")


def build_fact_sales(src: Sources, as_of: dt.date, **_) -> DataFrame:
    """One row per order line."""
    customer = _customer_store(src)
    product = _known_product(src)
    # Orders are fewer than lines: what depends on the order is joined to it first.
    header = (
        src["Sales.SalesOrderHeader"]
        .select(
            "SalesOrderID", F.col("OrderDate").cast("date").alias("SalesDateKey"),
            F.col("CustomerID").alias("_buyer"), F.col("SalesPersonID").alias("EmployeeID"),
        )
        .join(customer, F.col("_buyer") == customer["CustomerID"], "left")
    )
    detail = src["Sales.SalesOrderDetail"].withColumnRenamed("ProductID", "_item")
    price, quantity, share = F.col("UnitPrice"), F.col("OrderQty"), F.col("UnitPriceDiscount")
    return (
        detail.join(_small_orders(header, src["Sales.SalesOrderHeader"], "SalesOrderID", "CustomerID"), "SalesOrderID")
        .join(product, F.col("_item") == product["ProductID"], "left")
        .select(
            "SalesDateKey",
            "CustomerID",
            "ProductID",
            "StoreID",
            "EmployeeID",
            "SalesOrderID",
            "SalesOrderDetailID",
            quantity.cast("int").alias("QuantitySold"),
            _money(price * quantity).alias("SalesRevenue"),
            _money(price * quantity * share).alias("DiscountAmount"),
            F.lit(1).alias("NumberOfTransactions"),
            _money(price).alias("UnitPrice"),
            share.cast("decimal(18,4)").alias("UnitPriceDiscount"),
            _money(price * quantity * (F.lit(1).cast("decimal(1,0)") - share)).alias("LineTotal"),
        )
    )


def build_fact_purchases(src: Sources, as_of: dt.date, **_) -> DataFrame:
    """One row per purchase-order line; purchases carry no discount."""
    vendor = src["Purchasing.Vendor"].select(F.col("BusinessEntityID").alias("VendorID"))
    header = (
        src["Purchasing.PurchaseOrderHeader"]
        .select("PurchaseOrderID", F.col("OrderDate").cast("date").alias("PurchaseDateKey"), "VendorID")
        .join(vendor, "VendorID")
    )
    price, quantity = F.col("UnitPrice"), F.col("OrderQty")
    amount = _money(price * quantity)
    return (
        src["Purchasing.PurchaseOrderDetail"]
        .join(_small_orders(header, src["Purchasing.PurchaseOrderHeader"], "PurchaseOrderID"), "PurchaseOrderID")
        .join(_known_product(src), "ProductID")
        .select(
            "PurchaseDateKey",
            "VendorID",
            "ProductID",
            "PurchaseOrderID",
            "PurchaseOrderDetailID",
            quantity.cast("int").alias("QuantityBought"),
            amount.alias("PurchaseAmount"),
            _money(F.lit(0)).alias("DiscountAmount"),
            F.lit(1).alias("NumberOfTransactions"),
            _money(price).alias("UnitPrice"),
            F.lit(0).cast("decimal(18,4)").alias("UnitPriceDiscount"),
            amount.alias("LineTotal"),
        )
    )


def latest_store_by_product(src: Sources) -> DataFrame:
    """The store that bought each product last.

    An aggregate with map-side combine instead of a top-1 query per product:
    each task sends at most one row per product, however hot the product.
    """
    store = src["Sales.Store"].select(F.col("BusinessEntityID").alias("StoreID"))
    buyers = _customer_store(src).join(small_side(store), "StoreID", "left_semi")
    header = (
        src["Sales.SalesOrderHeader"].select("SalesOrderID", "OrderDate", "CustomerID").join(buyers, "CustomerID")
    )
    return (
        src["Sales.SalesOrderDetail"]
        .select("SalesOrderID", "ProductID")
        .join(_small_orders(header, src["Sales.SalesOrderHeader"], "SalesOrderID", "CustomerID"), "SalesOrderID")
        .groupBy("ProductID")
        .agg(F.max(F.struct("OrderDate", "SalesOrderID", "StoreID")).alias("_last"))
        .select("ProductID", F.col("_last.StoreID").alias("StoreID"))
    )


def build_fact_inventory(
    src: Sources, as_of: dt.date, batch_id: str = "manual", loaded_at: dt.datetime | None = None, **_
) -> DataFrame:
    """Stock per product and location, with the product's latest store."""
    product = src["Production.Product"].select("ProductID", "SellStartDate", "ReorderPoint", "SafetyStockLevel")
    location = src["Production.Location"].select("LocationID")
    rows = (
        src["Production.ProductInventory"]
        .join(product, "ProductID")
        .join(location, "LocationID")
        .join(latest_store_by_product(src), "ProductID", "left")
        .select(
            F.col("ModifiedDate").cast("date").alias("InventoryDateKey"),
            "ProductID",
            "StoreID",
            F.col("LocationID").alias("WarehouseID"),
            F.col("Quantity").alias("QuantityOnHand"),
            F.datediff(F.lit(as_of), F.col("SellStartDate").cast("date")).alias("StockAging"),
            F.col("ReorderPoint").alias("ReorderLevel"),
            F.col("SafetyStockLevel").alias("SafetyStockLevels"),
        )
    )
    return _lineage(rows, batch_id, loaded_at, "SnapshotCreatedDateTime")


def build_fact_production(
    src: Sources, as_of: dt.date, batch_id: str = "manual", loaded_at: dt.datetime | None = None,
    keys: KeyPolicy = WIDE_KEYS, **_,
) -> DataFrame:
    """One row per work order."""
    end = F.coalesce(F.col("EndDate"), F.lit(as_of)).cast("timestamp")
    seconds = F.unix_timestamp(end) - F.unix_timestamp(F.col("StartDate").cast("timestamp"))
    ordered, scrapped = F.col("OrderQty"), F.col("ScrappedQty")
    scrap = F.when(ordered > 0, F.try_divide(scrapped.cast("double"), ordered.cast("double")) * 100.0).otherwise(0.0)
    rows = (
        src["Production.WorkOrder"]
        .join(_known_product(src), "ProductID")
        .select(
            surrogate_key("WorkOrderID", "ProductID", policy=keys).alias("ProductionRunID"),
            F.col("StartDate").cast("date").alias("ProductionDateKey"),
            "ProductID",
            F.lit(None).cast("bigint").alias("SupervisorID"),
            ordered.cast("int").alias("UnitsProduced"),
            (seconds / F.lit(3600)).cast("decimal(10,2)").alias("ProductionTimeHours"),
            F.round(scrap, 2).cast("decimal(5,2)").alias("ScrapRatePercent"),
            scrapped.alias("DefectCount"),
        )
    )
    return _lineage(rows, batch_id, loaded_at)


def build_fact_employee_sales(
    src: Sources, as_of: dt.date, batch_id: str = "manual", loaded_at: dt.datetime | None = None, **_
) -> DataFrame:
    """Sales per day, sales person, store and territory against the monthly quota."""
    store = src["Sales.Store"].select(F.col("BusinessEntityID").alias("StoreID"), F.lit(True).alias("_known"))
    # The store belongs to the customer, so it is checked there, not once per order.
    buyers = nullable_left_join(_customer_store(src), small_side(store), "StoreID", ["CustomerID"]).select(
        "CustomerID", F.when(F.col("_known"), F.col("StoreID")).alias("StoreID")
    )
    territory = src["Sales.SalesTerritory"].select(F.col("TerritoryID"), F.lit(True).alias("_area_known"))
    seller = (
        src["Sales.SalesPerson"]
        .join(src["HumanResources.Employee"].select("BusinessEntityID"), "BusinessEntityID", "left_semi")
        .join(small_side(territory), "TerritoryID", "left")
        .select(
            F.col("BusinessEntityID").alias("EmployeeID"),
            F.when(F.col("_area_known"), F.col("TerritoryID")).alias("TerritoryID"),
            "SalesQuota",
        )
    )
    target = F.coalesce(F.col("SalesQuota"), F.lit(0).cast("decimal(18,2)")) / F.lit(12)
    attainment = F.when(
        F.col("SalesQuota") > 0,
        F.try_divide(F.col("_sales").cast("double"), F.col("SalesQuota").cast("double") / 12.0) * 100.0,
    ).otherwise(0.0)
    rows = (
        src["Sales.SalesOrderHeader"]
        .select(
            F.col("OrderDate").cast("date").alias("SalesDateKey"), F.col("SalesPersonID").alias("EmployeeID"),
            "CustomerID", "SubTotal",
        )
        .join(seller, "EmployeeID")
        .join(buyers, "CustomerID", "left")
        .groupBy("SalesDateKey", "EmployeeID", "StoreID", "TerritoryID", "SalesQuota")
        .agg(F.sum("SubTotal").alias("_sales"), F.countDistinct("CustomerID").alias("CustomerContactsCount"))
        .select(
            "SalesDateKey",
            "EmployeeID",
            "StoreID",
            "TerritoryID",
            _money(F.col("_sales")).alias("SalesAmount"),
            _money(target).alias("SalesTarget"),
            F.round(attainment, 4).cast("decimal(10,4)").alias("TargetAttainment"),
            "CustomerContactsCount",
        )
    )
    return _lineage(rows, batch_id, loaded_at)


def build_fact_customer_feedback(
    src: Sources, as_of: dt.date, batch_id: str = "manual", loaded_at: dt.datetime | None = None, **_
) -> DataFrame:
    """One row per review; the reviewer is found by e-mail, whatever its case."""
    product = src["Production.Product"].select("ProductID", "ProductSubcategoryID")
    subcategory = src["Production.ProductSubcategory"].select("ProductSubcategoryID", "ProductCategoryID")
    category = src["Production.ProductCategory"].select("ProductCategoryID", F.lit(True).alias("_known"))
    address = src["Person.EmailAddress"].select(
        F.lower("EmailAddress").alias("_mail"), F.col("BusinessEntityID").alias("_person")
    )
    customer = src["Sales.Customer"].select("CustomerID", F.col("PersonID").alias("_person"))
    employee = src["HumanResources.Employee"].select(
        F.col("BusinessEntityID").alias("EmployeeID"), F.col("BusinessEntityID").alias("_person")
    )
    score = F.col("Rating")
    rows = (
        src["Production.ProductReview"]
        .withColumn("_mail", F.lower("EmailAddress"))
        .join(product, "ProductID")
        .join(subcategory, "ProductSubcategoryID", "left")
        .join(category, "ProductCategoryID", "left")
        .transform(nullable_left_join, address, "_mail", ["ProductReviewID"])
        .transform(nullable_left_join, customer, "_person", ["ProductReviewID"])
        .transform(nullable_left_join, employee, "_person", ["ProductReviewID"])
        .select(
            F.col("ReviewDate").cast("date").alias("FeedbackDateKey"),
            "CustomerID",
            "EmployeeID",
            F.when(F.col("_known"), F.col("ProductCategoryID")).alias("FeedbackCategoryID"),
            score.alias("FeedbackScore"),
            F.when(score < 3, 1).otherwise(0).alias("ComplaintCount"),
            F.lit(0).cast("decimal(10,2)").alias("ResolutionTimeHours"),
            (score * 20).cast("decimal(5,2)").alias("CSATScore"),
            F.coalesce("Comments", F.lit("")).alias("Comments"),
            F.lit("Online").alias("Channel"),
        )
    )
    return _lineage(rows, batch_id, loaded_at)


def build_fact_promotion_response(
    src: Sources, as_of: dt.date, batch_id: str = "manual", loaded_at: dt.datetime | None = None, **_
) -> DataFrame:
    """Sales per day, product, store and offer."""
    customer = src["Sales.Customer"].select(F.col("CustomerID").alias("_buyer"), "StoreID")
    header = (
        src["Sales.SalesOrderHeader"]
        .select(
            "SalesOrderID", F.col("OrderDate").cast("date").alias("PromotionDateKey"),
            F.col("CustomerID").alias("_buyer"),
        )
        .join(customer, "_buyer", "left")
    )
    offer = src["Sales.SpecialOffer"].select("SpecialOfferID")
    offered = (
        src["Sales.SpecialOfferProduct"]
        .select("SpecialOfferID", "ProductID")
        .join(_known_product(src), "ProductID", "left_semi")
        .join(offer, "SpecialOfferID", "left_semi")
    )
    net = F.col("UnitPrice") * F.col("OrderQty") * (F.lit(1).cast("decimal(1,0)") - F.col("UnitPriceDiscount"))
    uptake = F.try_divide(F.col("_buyers").cast("double"), F.col("DiscountUsageCount").cast("double"))
    rows = (
        src["Sales.SalesOrderDetail"]
        .join(offered, ["SpecialOfferID", "ProductID"])
        .join(_small_orders(header, src["Sales.SalesOrderHeader"], "SalesOrderID", "CustomerID"), "SalesOrderID")
        .groupBy("PromotionDateKey", "ProductID", "StoreID", F.col("SpecialOfferID").alias("PromotionID"))
        .agg(
            _money(F.sum(net)).alias("SalesDuringCampaign"),
            F.count(F.lit(1)).alias("DiscountUsageCount"),
            F.countDistinct("_buyer").alias("_buyers"),
        )
        .select(
            "PromotionDateKey",
            "ProductID",
            "StoreID",
            "PromotionID",
            "SalesDuringCampaign",
            "DiscountUsageCount",
            F.round(uptake, 4).cast("decimal(10,4)").alias("CustomerUptakeRate"),
            F.lit(0).cast("decimal(10,4)").alias("PromotionROI"),
        )
    )
    return _lineage(rows, batch_id, loaded_at)


def finance_category(card: Column, amount: Column) -> Column:
    tests = {"<": lambda n: amount < n, "<=": lambda n: amount <= n}
    rungs = [(card.isNotNull(), FINANCE_BY_CARD)] + [(tests[op](n), c) for op, n, c in FINANCE_BY_AMOUNT]
    return first_match(rungs, FINANCE_LARGEST).cast("bigint")


def build_fact_finance(
    src: Sources, as_of: dt.date, batch_id: str = "manual", loaded_at: dt.datetime | None = None, **_
) -> DataFrame:
    """One row per invoice; an early payment has a negative delay."""
    delay = F.datediff(F.col("ShipDate").cast("date"), F.col("DueDate").cast("date"))
    rows = (
        src["Sales.SalesOrderHeader"]
        .join(_customer_store(src), "CustomerID")
        .select(
            F.col("OrderDate").cast("date").alias("InvoiceDateKey"),
            "CustomerID",
            "StoreID",
            finance_category(F.col("CreditCardID"), F.col("TotalDue")).alias("FinanceCategoryKey"),
            _money(F.col("TotalDue")).alias("InvoiceAmount"),
            F.coalesce(delay, F.lit(0)).alias("PaymentDelayDays"),
            F.lit(0).cast("decimal(10,4)").alias("CreditUsagePct"),
            _money(F.lit(0)).alias("InterestCharges"),
            F.col("SalesOrderID").cast("string").alias("InvoiceNumber"),
            F.when(F.col("Status") == SHIPPED_STATUS, "Shipped").otherwise("Pending").alias("PaymentStatus"),
            F.lit("USD").alias("CurrencyCode"),
        )
    )
    return _lineage(rows, batch_id, loaded_at)


def build_fact_returns(
    src: Sources, as_of: dt.date, batch_id: str = "manual", loaded_at: dt.datetime | None = None, **_
) -> DataFrame:
    """A reproducible 8% sample of the shipped lines, returned within 60 days.

    Each purpose has its own draw per line, so quantity, refund and fee of a
    return agree with each other.
    """
    line = ("SalesOrderID", "SalesOrderDetailID", "ProductID", "UnitPrice")

    def draw(purpose):
        return hash_uniform(purpose, *line)

    header = (
        src["Sales.SalesOrderHeader"]
        .filter((F.col("Status") == SHIPPED_STATUS) & F.col("OrderDate").isNotNull())
        .select("SalesOrderID", "OrderDate", "OnlineOrderFlag", "CustomerID")
        .join(_customer_store(src), "CustomerID")
    )
    quantity, price = F.col("OrderQty"), F.col("UnitPrice")
    part = F.greatest(F.lit(1), F.round(quantity * draw("quantity") * 0.5).cast("int"))
    returned = F.when(quantity == 1, F.lit(1)).otherwise(part)
    reason, state = draw("reason"), draw("condition")
    fee = F.when(draw("fee") < NO_FEE_SHARE, F.lit(0)).otherwise(
        price * F.lit(FEE_RATE).cast("decimal(3,2)") * F.col("ReturnedQuantity")
    )
    rows = (
        src["Sales.SalesOrderDetail"]
        .filter(draw("sample") < RETURN_SHARE)
        .join(_small_orders(header, src["Sales.SalesOrderHeader"], "SalesOrderID", "CustomerID"), "SalesOrderID")
        .join(_known_product(src), "ProductID")
        .withColumn("ReturnedQuantity", returned)
        .select(
            F.date_add(
                F.col("OrderDate").cast("date"),
                F.lit(RETURN_DAYS_FIRST) + F.round(draw("days") * RETURN_DAYS_SPREAD).cast("int"),
            ).alias("ReturnDateKey"),
            "ProductID",
            "CustomerID",
            "StoreID",
            first_match([(reason < p, key) for p, key in RETURN_REASONS], RETURN_REASON_DEFAULT)
            .cast("bigint")
            .alias("ReturnReasonKey"),
            "ReturnedQuantity",
            _money(price * F.col("ReturnedQuantity")).alias("RefundAmount"),
            _money(fee).alias("RestockingFee"),
            F.concat_ws("-", F.lit("RET"), F.col("SalesOrderID"), F.col("SalesOrderDetailID")).alias("ReturnID"),
            F.col("SalesOrderID").cast("string").alias("OriginalSalesID"),
            F.when(~F.col("OnlineOrderFlag"), "Direct")
            .when(draw("method") < MAIL_SHARE, "Mail")
            .otherwise("Store")
            .alias("ReturnMethod"),
            first_match([(state < p, name) for p, name in RETURN_CONDITIONS], RETURN_CONDITION_DEFAULT).alias(
                "ConditionOnReturn"
            ),
        )
    )
    return _lineage(rows, batch_id, loaded_at)


@dataclass(frozen=True)
class FKSpec:
    """``insert`` <- surrogate key of the member of ``dim`` whose natural key is ``extract``."""

    insert: str
    dim: str
    natural_key: str
    extract: str
    required: bool
    scd2: bool = True
    default: int = 0


@dataclass(frozen=True)
class FactSpec:
    name: str
    date_key: str
    build: Callable[..., DataFrame]
    fks: tuple[FKSpec, ...]
    #: columns identifying a record in the error log
    record_key: tuple[str, ...]
    #: leading sort columns inside a date partition
    sort: tuple[str, ...]


_CUSTOMER = ("CustomerKey", "DimCustomer", "CustomerID", "CustomerID")
_PRODUCT = ("ProductKey", "DimProduct", "ProductID", "ProductID")
_STORE = ("StoreKey", "DimStore", "StoreID", "StoreID")
_EMPLOYEE = ("EmployeeKey", "DimEmployee", "EmployeeID", "EmployeeID")

FACTS = {
    spec.name: spec
    for spec in (
        FactSpec(
            "FactSales", "SalesDateKey", build_fact_sales,
            (FKSpec(*_CUSTOMER, True), FKSpec(*_PRODUCT, True), FKSpec(*_STORE, False), FKSpec(*_EMPLOYEE, False)),
            ("SalesOrderID", "SalesOrderDetailID"), ("ProductKey", "CustomerKey", "StoreKey"),
        ),
        FactSpec(
            "FactPurchases", "PurchaseDateKey", build_fact_purchases,
            (FKSpec("VendorKey", "DimVendor", "VendorID", "VendorID", True), FKSpec(*_PRODUCT, True)),
            ("PurchaseOrderID", "PurchaseOrderDetailID"), ("ProductKey", "VendorKey"),
        ),
        FactSpec(
            "FactInventory", "InventoryDateKey", build_fact_inventory,
            (FKSpec(*_PRODUCT, True), FKSpec(*_STORE, False),
             FKSpec("WarehouseKey", "DimWarehouse", "WarehouseID", "WarehouseID", True)),
            ("InventoryDateKey", "ProductID", "WarehouseID"), ("ProductKey", "WarehouseKey", "StoreKey"),
        ),
        FactSpec(
            "FactProduction", "ProductionDateKey", build_fact_production,
            (FKSpec(*_PRODUCT, True), FKSpec("SupervisorKey", "DimEmployee", "EmployeeID", "SupervisorID", False)),
            ("ProductionRunID",), ("ProductKey", "ProductionRunID"),
        ),
        FactSpec(
            "FactEmployeeSales", "SalesDateKey", build_fact_employee_sales,
            (FKSpec(*_EMPLOYEE, True), FKSpec(*_STORE, False),
             FKSpec("SalesTerritoryKey", "DimSalesTerritory", "TerritoryID", "TerritoryID", False, scd2=False)),
            ("SalesDateKey", "EmployeeID"), ("EmployeeKey", "StoreKey", "SalesTerritoryKey"),
        ),
        FactSpec(
            "FactCustomerFeedback", "FeedbackDateKey", build_fact_customer_feedback,
            (FKSpec(*_CUSTOMER, False), FKSpec(*_EMPLOYEE, False),
             FKSpec("FeedbackCategoryKey", "DimFeedbackCategory", "FeedbackCategoryID", "FeedbackCategoryID", False,
                    scd2=False)),
            ("FeedbackDateKey", "CustomerID"), ("CustomerKey", "EmployeeKey", "FeedbackCategoryKey"),
        ),
        FactSpec(
            "FactPromotionResponse", "PromotionDateKey", build_fact_promotion_response,
            (FKSpec(*_PRODUCT, True), FKSpec(*_STORE, False),
             FKSpec("PromotionKey", "DimPromotion", "PromotionID", "PromotionID", True, scd2=False)),
            ("PromotionDateKey", "PromotionID", "ProductID"), ("ProductKey", "PromotionKey", "StoreKey"),
        ),
        FactSpec(
            "FactFinance", "InvoiceDateKey", build_fact_finance,
            (FKSpec(*_CUSTOMER, True), FKSpec(*_STORE, False)),
            ("InvoiceNumber",), ("CustomerKey", "StoreKey", "FinanceCategoryKey"),
        ),
        FactSpec(
            "FactReturns", "ReturnDateKey", build_fact_returns,
            (FKSpec(*_PRODUCT, True), FKSpec(*_CUSTOMER, True), FKSpec(*_STORE, False)),
            ("ReturnID",), ("ProductKey", "CustomerKey", "StoreKey", "ReturnReasonKey"),
        ),
    )
}


def register_fact(spec: FactSpec) -> None:
    """Add a fact of your own to the batch run."""
    FACTS[spec.name] = spec


def record_natural_key(df: DataFrame, fact: str | FactSpec) -> Column:
    """Text identifying a record in the error log; unknown facts use their first two columns."""
    spec = FACTS.get(fact) if isinstance(fact, str) else fact
    names = spec.record_key if spec and all(c in df.columns for c in spec.record_key) else tuple(df.columns[:2])
    return F.concat_ws("-", *[F.coalesce(F.col(c).cast("string"), F.lit("None")) for c in names])
