"""Column names and types of every stored table, and the cast to them on write."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_VERSIONS = "ValidFromDate DATE, ValidToDate DATE, IsCurrent INT"

# The table definitions of the warehouse.
TABLES = {
    "DimDate": "DateKey DATE, Year INT, Quarter INT, Month INT, MonthName STRING, Week INT, DayOfWeek INT, DayName STRING,"
    " DayOfMonth INT, DayOfYear INT, WeekOfYear INT, IsWeekend INT, IsHoliday INT, HolidayName STRING, FiscalYear INT,"
    " FiscalQuarter INT, FiscalMonth INT, Season STRING",
    "DimCustomer": "CustomerKey BIGINT, CustomerID BIGINT, CustomerName STRING, Email STRING, Phone STRING, City STRING,"
    " StateProvince STRING, Country STRING, PostalCode STRING, CustomerSegment STRING, CustomerType STRING,"
    " AccountStatus STRING, CreditLimit DECIMAL(18,2), AnnualIncome DECIMAL(18,2), YearsSinceFirstPurchase INT,"
    f" {_VERSIONS}, SourceUpdateDate DATE, EffectiveStartDate DATE, EffectiveEndDate DATE, Version BIGINT",
    "DimProduct": "ProductKey BIGINT, ProductID BIGINT, ProductName STRING, SKU STRING, Category STRING,"
    " SubCategory STRING, Brand STRING, ListPrice DECIMAL(18,2), Cost DECIMAL(18,2), ProductStatus STRING, Color STRING,"
    f" Size STRING, Weight DECIMAL(10,3), {_VERSIONS}, SourceUpdateDate DATE, EffectiveStartDate DATE,"
    " EffectiveEndDate DATE, Version BIGINT",
    "DimStore": "StoreKey BIGINT, StoreID BIGINT, StoreName STRING, StoreNumber BIGINT, Address STRING, City STRING,"
    " StateProvince STRING, Country STRING, PostalCode STRING, Region STRING, Territory STRING, StoreType STRING,"
    f" StoreStatus STRING, ManagerName STRING, OpeningDate DATE, SquareFootage INT, {_VERSIONS}, SourceUpdateDate DATE,"
    " Version BIGINT",
    "DimEmployee": "EmployeeKey BIGINT, EmployeeID BIGINT, EmployeeName STRING, JobTitle STRING, Department STRING,"
    " ReportingManagerKey BIGINT, HireDate DATE, EmployeeStatus STRING, Region STRING, Territory STRING,"
    f" SalesQuota DECIMAL(18,2), {_VERSIONS}, SourceUpdateDate DATE, Version BIGINT",
    "DimPromotion": "PromotionKey BIGINT, PromotionID BIGINT, PromotionName STRING, PromotionDescription STRING,"
    " PromotionType STRING, DiscountPercentage DECIMAL(5,2), DiscountAmount DECIMAL(18,2), PromotionStatus STRING,"
    " TargetCustomerSegment STRING, CampaignID BIGINT, TargetProductKey BIGINT, StartDate DATE, EndDate DATE, IsActive INT",
    "DimProductCategory": "ProductCategoryKey BIGINT, ProductCategoryID BIGINT, CategoryName STRING,"
    " CategoryDescription STRING",
    "DimWarehouse": "WarehouseKey BIGINT, WarehouseID BIGINT, WarehouseName STRING, Location STRING,"
    f" WarehouseType STRING, ManagerKey BIGINT, {_VERSIONS}, Version BIGINT",
    "DimSalesTerritory": "TerritoryKey BIGINT, TerritoryID BIGINT, TerritoryName STRING, SalesRegion STRING,"
    " Country STRING, Manager STRING, SalesTarget DECIMAL(18,2)",
    "DimVendor": "VendorKey BIGINT, VendorID BIGINT, VendorName STRING, ContactPerson STRING, Email STRING, Phone STRING,"
    " Address STRING, City STRING, Country STRING, VendorRating DECIMAL(3,2), OnTimeDeliveryRate DECIMAL(5,2),"
    f" QualityScore DECIMAL(5,2), PaymentTerms STRING, VendorStatus STRING, {_VERSIONS}, SourceUpdateDate DATE,"
    " Version BIGINT",
    "DimRegion": "RegionKey BIGINT, RegionID BIGINT, RegionName STRING, Country STRING, Continent STRING, TimeZone STRING",
    "FactSales": "SalesDateKey DATE, CustomerKey BIGINT, ProductKey BIGINT, StoreKey BIGINT, EmployeeKey BIGINT,"
    " SalesOrderID BIGINT, SalesOrderDetailID BIGINT, QuantitySold INT, SalesRevenue DECIMAL(18,2),"
    " DiscountAmount DECIMAL(18,2), NumberOfTransactions INT, UnitPrice DECIMAL(18,2), UnitPriceDiscount DECIMAL(18,4),"
    " LineTotal DECIMAL(18,2)",
    "FactPurchases": "PurchaseDateKey DATE, VendorKey BIGINT, ProductKey BIGINT, PurchaseOrderID BIGINT,"
    " PurchaseOrderDetailID BIGINT, QuantityBought INT, PurchaseAmount DECIMAL(18,2), DiscountAmount DECIMAL(18,2),"
    " NumberOfTransactions INT, UnitPrice DECIMAL(18,2), UnitPriceDiscount DECIMAL(18,4), LineTotal DECIMAL(18,2)",
    "FactInventory": "InventoryDateKey DATE, ProductKey BIGINT, StoreKey BIGINT, WarehouseKey BIGINT,"
    " QuantityOnHand BIGINT, StockAging INT, ReorderLevel INT, SafetyStockLevels INT, SnapshotCreatedDateTime TIMESTAMP,"
    " ETLBatchID STRING",
    "FactProduction": "ProductionRunID BIGINT, ProductionDateKey DATE, ProductKey BIGINT, SupervisorKey BIGINT,"
    " UnitsProduced INT, ProductionTimeHours DECIMAL(10,2), ScrapRatePercent DECIMAL(5,2), DefectCount INT,"
    " ETLBatchID STRING, LoadTimestamp TIMESTAMP",
    "FactEmployeeSales": "SalesDateKey DATE, EmployeeKey BIGINT, StoreKey BIGINT, SalesTerritoryKey BIGINT,"
    " SalesAmount DECIMAL(18,2), SalesTarget DECIMAL(18,2), TargetAttainment DECIMAL(10,4), CustomerContactsCount BIGINT,"
    " ETLBatchID STRING, LoadTimestamp TIMESTAMP",
    "FactCustomerFeedback": "FeedbackDateKey DATE, CustomerKey BIGINT, EmployeeKey BIGINT, FeedbackCategoryKey BIGINT,"
    " FeedbackScore INT, ComplaintCount INT, ResolutionTimeHours DECIMAL(10,2), CSATScore DECIMAL(5,2), Comments STRING,"
    " Channel STRING, ETLBatchID STRING, LoadTimestamp TIMESTAMP",
    "FactPromotionResponse": "PromotionDateKey DATE, ProductKey BIGINT, StoreKey BIGINT, PromotionKey BIGINT,"
    " SalesDuringCampaign DECIMAL(18,2), DiscountUsageCount BIGINT, CustomerUptakeRate DECIMAL(10,4),"
    " PromotionROI DECIMAL(10,4), ETLBatchID STRING, LoadTimestamp TIMESTAMP",
    "FactFinance": "InvoiceDateKey DATE, CustomerKey BIGINT, StoreKey BIGINT, FinanceCategoryKey BIGINT,"
    " InvoiceAmount DECIMAL(18,2), PaymentDelayDays INT, CreditUsagePct DECIMAL(10,4), InterestCharges DECIMAL(18,2),"
    " InvoiceNumber STRING, PaymentStatus STRING, CurrencyCode STRING, ETLBatchID STRING, LoadTimestamp TIMESTAMP",
    "FactReturns": "ReturnDateKey DATE, ProductKey BIGINT, CustomerKey BIGINT, StoreKey BIGINT, ReturnReasonKey BIGINT,"
    " ReturnedQuantity INT, RefundAmount DECIMAL(18,2), RestockingFee DECIMAL(18,2), ReturnID STRING,"
    " OriginalSalesID STRING, ReturnMethod STRING, ConditionOnReturn STRING, ETLBatchID STRING, LoadTimestamp TIMESTAMP",
    "agg_daily_sales": "SalesDateKey DATE, StoreKey BIGINT, ProductCategoryKey BIGINT, RevenueSum DECIMAL(18,2),"
    " QuantitySum BIGINT, DiscountSum DECIMAL(18,2), TransactionCount BIGINT",
    "agg_weekly_sales": "WeekStartDateKey DATE, RegionKey BIGINT, ProductCategoryKey BIGINT, RevenueSum DECIMAL(18,2),"
    " RevenueAvg DECIMAL(18,2), RevenueMin DECIMAL(18,2), RevenueMax DECIMAL(18,2), QuantitySum BIGINT",
    "agg_monthly_sales": "MonthStartDateKey DATE, CustomerSegmentKey BIGINT, RegionKey BIGINT, RevenueSum DECIMAL(18,2),"
    " AvgOrderValue DECIMAL(18,2), DistinctCustomers BIGINT",
    "agg_daily_inventory": "InventoryDateKey DATE, WarehouseKey BIGINT, ProductCategoryKey BIGINT, AgingTierKey BIGINT,"
    " AvgInventoryValue DECIMAL(18,2), AvgQuantityOnHand DOUBLE",
    "agg_monthly_product_performance": "MonthStartDateKey DATE, ProductKey BIGINT, StoreKey BIGINT,"
    " RevenueSum DECIMAL(18,2), UnitsSold BIGINT, ReturnsQty BIGINT, ReturnsRatePct DECIMAL(10,4), AvgRating DECIMAL(5,2)",
    "agg_regional_sales": "MonthStartDateKey DATE, RegionKey BIGINT, SalesTerritoryKey BIGINT, RevenueSum DECIMAL(18,2),"
    " GrowthRatePct DECIMAL(10,4)",
    "error_records": "ErrorID BIGINT, ErrorDate TIMESTAMP, SourceTable STRING, RecordNaturalKey STRING, ErrorType STRING,"
    " ErrorSeverity STRING, ErrorMessage STRING, FailedData STRING, ProcessingBatchID STRING, TaskName STRING,"
    " IsRecoverable INT, RetryCount INT, LastAttemptDate TIMESTAMP, IsResolved INT, ResolutionComment STRING",
}


class SchemaMismatch(ValueError):
    """A required column is missing or has another type."""


def column_names(name: str) -> list[str]:
    """Column names without a session."""
    return re.findall(r"(\w+) [A-Z]+", TABLES[name])


def table_schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(TABLES[name])


def conform(df: DataFrame, name: str) -> DataFrame:
    """The columns of a stored table, in order and cast; fails before any data is read.

    Tables registered by users have no definition here and pass unchanged.
    """
    if name not in TABLES:
        return df
    fields = table_schema(name).fields
    missing = [f.name for f in fields if f.name not in df.columns]
    if missing:
        raise SchemaMismatch(f"SCHEMA_MISMATCH: {name} lacks {', '.join(missing)}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])
