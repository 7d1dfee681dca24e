"""Builders on inline rows the test tables cannot show."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starloom.operators import dimensions as dims
from starloom.operators import facts
from starloom.operators.rollups import choose_rollup, growth_rate
from starloom.sources.literals import LITERAL_TABLES, literal_table

D = dt.date
DAY = D(2020, 1, 1)


def test_store_survey_is_read_from_xml(spark):
    xml = (
        '<StoreSurvey xmlns="http://example.org/survey"><BusinessType>BM</BusinessType>'
        "<YearOpened>1990</YearOpened><SquareFeet>0</SquareFeet></StoreSurvey>"
    )
    src = {
        "Sales.Store": spark.createDataFrame(
            [(1, "A", 7, xml, DAY), (2, "B", None, None, DAY), (3, "C", None, xml.replace(">0<", ">2500<"), DAY)],
            "BusinessEntityID BIGINT, Name STRING, SalesPersonID BIGINT, Demographics STRING, ModifiedDate DATE",
        ),
        "Sales.SalesPerson": spark.createDataFrame([(7,)], "BusinessEntityID BIGINT"),
        "Sales.SalesTerritory": spark.createDataFrame([], "TerritoryID INT, Name STRING, `Group` STRING"),
        "Person.Person": spark.createDataFrame([(7, "Ann", "Lee")], "BusinessEntityID BIGINT, FirstName STRING, LastName STRING"),
        "Person.BusinessEntityAddress": spark.createDataFrame([(1, 1), (2, 2)], "BusinessEntityID BIGINT, AddressID BIGINT"),
        "Person.Address": spark.createDataFrame(
            [(1, " 1 Main ", None, "X", "0", 1), (2, None, None, "Y", None, 1)],
            "AddressID BIGINT, AddressLine1 STRING, AddressLine2 STRING, City STRING, PostalCode STRING, StateProvinceID INT",
        ),
        "Person.StateProvince": spark.createDataFrame(
            [], "StateProvinceID INT, Name STRING, CountryRegionCode STRING, TerritoryID INT"
        ),
        "Person.CountryRegion": spark.createDataFrame([], "CountryRegionCode STRING, Name STRING"),
    }
    a, b, c = dims.build_dim_store(src, DAY).orderBy("StoreID").collect()
    assert (a.StoreType, a.OpeningDate, a.SquareFootage) == ("BM", D(1990, 1, 1), 1000)
    assert (a.Address, a.ManagerName, a.StateProvince) == ("1 Main", "Ann Lee", "Unknown")
    assert (b.StoreType, b.OpeningDate, b.SquareFootage) == ("Retail", DAY, 1000)
    assert (b.Address, b.PostalCode, b.ManagerName, b.Region) == ("Unknown", "00000", "Unassigned", "Unassigned")
    assert (c.SquareFootage, c.City) == (2500, "Unknown")


@pytest.mark.parametrize(
    "store,orders,lifetime,income,expected",
    [
        (False, None, None, None, "1000.00"),
        (False, 1, 500, None, "1500.00"),
        (False, 5, 10001, "25000-50000", "2400.00"),
        (False, 10, 50001, "75000-100000", "4500.00"),
        (True, 20, 100001, "Greater than 150000", "90000.00"),
        (True, 20, 100000, "50000-75000", "54000.00"),
    ],
)
def test_credit_limit_ladders(spark, store, orders, lifetime, income, expected):
    df = spark.createDataFrame([(store, orders, lifetime, income)], "s BOOLEAN, o INT, l INT, i STRING")
    row = df.select(dims.credit_limit(F.col("s"), F.col("o"), F.col("l"), F.col("i"))).collect()[0]
    assert row[0] == Decimal(expected)


def _sale(spark, quantity, price, share):
    return {
        "Sales.SalesOrderHeader": spark.createDataFrame(
            [(1, DAY, 500, None)], "SalesOrderID INT, OrderDate DATE, CustomerID INT, SalesPersonID INT"
        ),
        "Sales.SalesOrderDetail": spark.createDataFrame(
            [(1, 3, 123, quantity, Decimal(price), Decimal(share))],
            "SalesOrderID INT, SalesOrderDetailID INT, ProductID INT, OrderQty SMALLINT, UnitPrice DECIMAL(19,4),"
            " UnitPriceDiscount DECIMAL(10,4)",
        ),
        "Sales.Customer": spark.createDataFrame([(500, None)], "CustomerID INT, StoreID INT"),
        "Production.Product": spark.createDataFrame([(123,)], "ProductID INT"),
    }


def test_sale_measures(spark):
    (row,) = facts.build_fact_sales(_sale(spark, 2, "225.25", "0.10"), DAY).collect()
    assert (row.SalesRevenue, row.DiscountAmount, row.LineTotal) == (
        Decimal("450.50"), Decimal("45.05"), Decimal("405.45")
    )
    assert (row.CustomerID, row.StoreID, row.EmployeeID, row.NumberOfTransactions) == (500, None, None, 1)


def test_sale_of_an_unknown_customer_keeps_the_row(spark):
    src = _sale(spark, 1, "1", "0")
    src["Sales.Customer"] = src["Sales.Customer"].filter("false")
    (row,) = facts.build_fact_sales(src, DAY).collect()
    assert row.CustomerID is None and row.ProductID == 123


def test_reviewer_is_found_whatever_the_case_of_the_address(spark):
    src = {
        "Production.ProductReview": spark.createDataFrame(
            [(1, 9, DAY, 2, None, "A@X.com"), (2, 9, DAY, 4, "ok", "nobody@x.com")],
            "ProductReviewID INT, ProductID INT, ReviewDate DATE, Rating INT, Comments STRING, EmailAddress STRING",
        ),
        "Production.Product": spark.createDataFrame([(9, None)], "ProductID INT, ProductSubcategoryID INT"),
        "Production.ProductSubcategory": spark.createDataFrame([], "ProductSubcategoryID INT, ProductCategoryID INT"),
        "Production.ProductCategory": spark.createDataFrame([], "ProductCategoryID INT"),
        "Person.EmailAddress": spark.createDataFrame([(77, "a@x.COM")], "BusinessEntityID INT, EmailAddress STRING"),
        "Sales.Customer": spark.createDataFrame([(5, 77)], "CustomerID INT, PersonID INT"),
        "HumanResources.Employee": spark.createDataFrame([(77,)], "BusinessEntityID INT"),
    }
    a, b = facts.build_fact_customer_feedback(src, DAY).orderBy("FeedbackScore").collect()
    assert (a.CustomerID, a.EmployeeID, a.ComplaintCount, a.CSATScore, a.Comments) == (5, 77, 1, Decimal("40.00"), "")
    assert (b.CustomerID, b.EmployeeID, b.ComplaintCount) == (None, None, 0)


@pytest.mark.parametrize(
    "card,amount,category", [(1, 5, 5), (None, 99, 1), (None, 100, 2), (None, 1000, 3), (None, 10000, 3), (None, 10001, 4)]
)
def test_finance_categories(spark, card, amount, category):
    df = spark.createDataFrame([(card, amount)], "c INT, a INT")
    assert df.select(facts.finance_category(F.col("c"), F.col("a"))).collect()[0][0] == category


def test_scrap_of_an_empty_order_is_zero(spark):
    src = {
        "Production.WorkOrder": spark.createDataFrame(
            [(1, 9, 0, 0, dt.datetime(2020, 1, 1), None), (2, 9, 8, 1, dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 1, 1, 30))],
            "WorkOrderID INT, ProductID INT, OrderQty INT, ScrappedQty INT, StartDate TIMESTAMP, EndDate TIMESTAMP",
        ),
        "Production.Product": spark.createDataFrame([(9,)], "ProductID INT"),
    }
    a, b = facts.build_fact_production(src, D(2020, 1, 2)).orderBy("UnitsProduced").collect()
    assert (a.ScrapRatePercent, a.ProductionTimeHours) == (Decimal("0.00"), Decimal("24.00"))
    assert (b.ScrapRatePercent, b.ProductionTimeHours) == (Decimal("12.50"), Decimal("1.50"))


def test_growth_over_the_previous_existing_month(spark):
    df = spark.createDataFrame([(100, None), (150, 100), (0, 150), (50, 0)], "v INT, p INT")
    got = [r[0] for r in df.select(growth_rate(F.col("v"), F.col("p"))).collect()]
    assert got == [Decimal("0.0000"), Decimal("50.0000"), Decimal("-100.0000"), Decimal("0.0000")]


def test_record_keys(spark):
    df = spark.createDataFrame([(7, 3, 1)], "SalesOrderID INT, SalesOrderDetailID INT, X INT")
    assert df.select(facts.record_natural_key(df, "FactSales")).collect()[0][0] == "7-3"
    assert df.select(facts.record_natural_key(df, "SomethingElse")).collect()[0][0] == "7-3"


def test_literal_tables(spark):
    counts = {n: literal_table(spark, n).count() for n in LITERAL_TABLES}
    assert counts == {
        "DimFeedbackCategory": 5, "DimCustomerSegment": 6, "DimAgingTier": 4, "DimFinanceCategory": 5, "DimReturnReason": 4
    }


def test_smallest_covering_rollup():
    assert choose_rollup(["SalesDateKey"], ["RevenueSum"]) == "agg_daily_sales"
    assert choose_rollup(["MonthStartDateKey"], ["RevenueSum"]) in ("agg_monthly_sales", "agg_regional_sales", "agg_monthly_product_performance")
    assert choose_rollup(["CustomerKey"], ["RevenueSum"]) is None
