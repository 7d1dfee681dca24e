"""Lookup tables with fixed content."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

# The five lookup tables of the warehouse.
LITERAL_TABLES = {
    "DimFeedbackCategory": (
        "FeedbackCategoryKey BIGINT, FeedbackCategoryID BIGINT, CategoryName STRING, CategoryDescription STRING",
        [
            (1, 1, "Product Quality", "Issues related to product quality"),
            (2, 2, "Service", "Customer service related feedback"),
            (3, 3, "Delivery", "Shipping and delivery feedback"),
            (4, 4, "Pricing", "Price-related feedback"),
            (5, 5, "General", "General comments"),
        ],
    ),
    "DimCustomerSegment": (
        "SegmentKey BIGINT, SegmentID BIGINT, SegmentName STRING, SegmentDescription STRING,"
        " DiscountTierStart DECIMAL(5,2), DiscountTierEnd DECIMAL(5,2)",
        [
            (1, 1, "Premium", "Customers with income > $150K", Decimal("20.00"), Decimal("100.00")),
            (2, 2, "Gold", "Customers with income $100K-$150K", Decimal("15.00"), Decimal("19.99")),
            (3, 3, "Silver", "Customers with income $50K-$100K", Decimal("10.00"), Decimal("14.99")),
            (4, 4, "Bronze", "Customers with income $25K-$50K", Decimal("5.00"), Decimal("9.99")),
            (5, 5, "Standard", "Customers with income < $25K", Decimal("0.00"), Decimal("4.99")),
            (6, 6, "Business", "B2B customers", Decimal("15.00"), Decimal("100.00")),
        ],
    ),
    "DimAgingTier": (
        "AgingTierKey BIGINT, AgingTierID BIGINT, AgingTierName STRING, MinAgingDays INT, MaxAgingDays INT",
        [
            (1, 1, "Fresh", 0, 30),
            (2, 2, "Aging", 31, 90),
            (3, 3, "Old", 91, 180),
            (4, 4, "Obsolete", 181, 999999),
        ],
    ),
    "DimFinanceCategory": (
        "FinanceCategoryKey BIGINT, FinanceCategoryID BIGINT, CategoryName STRING, CategoryDescription STRING",
        [
            (1, 1, "Small Transaction", "Transaction < $100"),
            (2, 2, "Medium Transaction", "Transaction $100-$1000"),
            (3, 3, "Large Transaction", "Transaction $1000-$10000"),
            (4, 4, "Enterprise Transaction", "Transaction > $10000"),
            (5, 5, "Credit Transaction", "Credit-based purchases"),
        ],
    ),
    "DimReturnReason": (
        "ReturnReasonKey BIGINT, ReturnReasonID BIGINT, ReturnReasonName STRING, ReturnReasonDescription STRING",
        [
            (1, 1, "Defective", "Product or it's part/s are defective"),
            (2, 2, "Wrong Item", "Wrong Product Received"),
            (3, 3, "Changed Mind", "Don't want this product after all"),
            (4, 4, "Damaged", "Received a damaged product"),
        ],
    ),
}

# Error type, whether a retry may help (None = sometimes), severity, handling.
ERROR_TAXONOMY = (
    ("FK_MISS", 1, "WARNING", "Skip row, log, retry tomorrow"),
    ("NULL_PK", 0, "CRITICAL", "Stop load, escalate"),
    ("TYPE_MISMATCH", None, "WARNING", "Try conversion, log if fail"),
    ("DUPLICATE_PK", 1, "WARNING", "Skip duplicate, log"),
    ("OUT_OF_RANGE", 1, "WARNING", "Skip row, log"),
    ("VALIDATION_FAIL", 1, "WARNING", "Skip row, log"),
    ("SCHEMA_MISMATCH", 0, "CRITICAL", "Stop load, manual fix"),
    ("TIMEOUT", 1, "WARNING", "Retry with backoff"),
    ("DISK_FULL", 0, "CRITICAL", "Stop load, add storage"),
    ("PERMISSION_DENIED", 0, "CRITICAL", "Stop load, fix permissions"),
)


def literal_table(spark: SparkSession, name: str) -> DataFrame:
    schema, rows = LITERAL_TABLES[name]
    return spark.createDataFrame(rows, schema)


def error_taxonomy(spark: SparkSession) -> DataFrame:
    schema = "ErrorType STRING, TypeRecoverable INT, TypeSeverity STRING, Handling STRING"
    return spark.createDataFrame(list(ERROR_TAXONOMY), schema)
