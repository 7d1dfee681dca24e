"""Operational source tables derived from the TPC-H-like test tables.

Every table is a projection of (or a small aggregate over) one test table, so
that the same builders run on them as on a real source database.  The choices
give every branch of the builders some rows: missing persons and stores, online
orders without a sales person, open orders, ended products, and so on.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.lookups import spread
from starloom.sources.catalog import Sources

#: Reference date: later than every order and ship date of the test tables.
AS_OF = dt.date(2001, 12, 1)
CALENDAR_START = dt.date(1995, 1, 1)

#: Declared schemas: no footer is read while a query is being planned.
TEST_TABLES = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,"
    " o_orderdate TIMESTAMP, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE,"
    " l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING,"
    " l_shipdate TIMESTAMP",
    "events": "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}

# Product categories by name.
CATEGORY_IDS = {"ECONOMY": 1, "LARGE": 2, "MEDIUM": 3, "PROMO": 4, "SMALL": 5, "STANDARD": 6}

_CATEGORY_ID = "CASE p_type " + " ".join(f"WHEN '{n}' THEN {i}" for n, i in CATEGORY_IDS.items()) + " ELSE 0 END"
_BRAND_ID = "cast(substring(p_brand, 7) as bigint)"

_SURVEY = """concat(
    '<StoreSurvey xmlns="http://example.org/StoreSurvey">',
    '<BusinessType>', elt(1 + cast(s_suppkey % 3 as int), 'BM', 'BS', ''), '</BusinessType>',
    '<YearOpened>', cast(1970 + s_suppkey % 30 as string), '</YearOpened>',
    '<SquareFeet>', cast(case when s_suppkey % 6 = 1 then 0 else 1000 + 10 * s_suppkey end as string), '</SquareFeet>',
    '</StoreSurvey>')"""


def read_test_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A lazy frame over one Parquet file; filters and columns are pushed into the scan."""
    return spark.read.schema(TEST_TABLES[name]).parquet(f"{folder}/{name}.parquet")


def _lines(t: Sources) -> DataFrame:
    lines = t["lineitem"]
    return lines if lines.isStreaming else spread(lines, "l_orderkey", "l_linenumber", "l_partkey")


def stream_test_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One test table as a stream of its files."""
    reader = spark.readStream.schema(TEST_TABLES[name]).option("pathGlobFilter", f"{name}.parquet")
    return reader.parquet(folder)


def read_test_tables(spark: SparkSession, folder: str) -> Sources:
    return Sources({name: (lambda n=name: read_test_table(spark, folder, n)) for name in TEST_TABLES})


def tpch_sources(spark: SparkSession, folder: str, **tables: DataFrame) -> Sources:
    """The operational tables over ``folder``; test tables can be replaced, e.g. by streams."""
    t = read_test_tables(spark, folder).replaced(**tables)

    def orders_header():
        return t["orders"].selectExpr(
            "o_orderkey AS SalesOrderID",
            "cast(o_orderdate as date) AS OrderDate",
            "date_add(cast(o_orderdate as date), 30) AS DueDate",
            "CASE WHEN o_orderstatus <> 'O'"
            " THEN date_add(cast(o_orderdate as date), cast(o_orderkey * 7 % 75 as int)) END AS ShipDate",
            "CASE WHEN o_orderstatus = 'F' THEN 5 ELSE 1 END AS Status",
            "o_orderkey % 2 = 0 AS OnlineOrderFlag",
            "o_custkey AS CustomerID",
            "CASE WHEN o_orderkey % 2 = 1 THEN o_orderkey % 97 END AS SalesPersonID",
            "CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderkey END AS CreditCardID",
            "cast(o_totalprice as decimal(18,2)) AS SubTotal",
            "cast(o_totalprice as decimal(18,2)) AS TotalDue",
        )

    def order_detail():
        return _lines(t).selectExpr(
            "l_orderkey AS SalesOrderID",
            "l_linenumber AS SalesOrderDetailID",
            "l_partkey AS ProductID",
            "cast(l_quantity as smallint) AS OrderQty",
            "cast(cast(l_extendedprice as decimal(18,2)) / cast(l_quantity as smallint) as decimal(12,4)) AS UnitPrice",
            "cast(l_discount as decimal(18,4)) AS UnitPriceDiscount",
            "cast(round(l_discount * 100) as bigint) AS SpecialOfferID",
        )

    def sales_customer():
        return t["customer"].selectExpr(
            "c_custkey AS CustomerID",
            "CASE WHEN c_custkey % 5 <> 4 THEN -(c_custkey + 1) END AS PersonID",
            "CASE WHEN c_custkey % 3 <> 0 THEN c_custkey % 97 END AS StoreID",
            "date_add(DATE'1994-01-01', cast(c_custkey % 365 as int)) AS ModifiedDate",
        )

    def person():
        customers = t["customer"].selectExpr(
            "-(c_custkey + 1) AS BusinessEntityID",
            "c_mktsegment AS FirstName",
            "CASE WHEN c_custkey % 2 = 1 THEN 'Q' END AS MiddleName",
            "c_name AS LastName",
        )
        staff = t["supplier"].selectExpr(
            "s_suppkey AS BusinessEntityID",
            "'Agent' AS FirstName",
            "CASE WHEN s_suppkey % 4 = 0 THEN 'J' END AS MiddleName",
            "s_name AS LastName",
        )
        return customers.unionByName(staff)

    def email():
        customers = t["customer"].selectExpr(
            "-(c_custkey + 1) AS BusinessEntityID", "concat(lower(c_name), '@example.com') AS EmailAddress"
        )
        staff = t["supplier"].selectExpr(
            "s_suppkey AS BusinessEntityID", "concat(lower(s_name), '@example.com') AS EmailAddress"
        )
        return customers.unionByName(staff)

    def phone():
        return (
            t["customer"]
            .filter("c_custkey % 7 <> 0")
            .selectExpr(
                "-(c_custkey + 1) AS BusinessEntityID",
                "concat('555-', lpad(cast(c_custkey % 10000 as string), 4, '0')) AS PhoneNumber",
            )
        )

    def entity_address():
        customers = (
            t["customer"]
            .filter("c_custkey % 31 <> 0")
            .selectExpr("-(c_custkey + 1) AS BusinessEntityID", "-(c_custkey + 1) AS AddressID")
        )
        sites = t["supplier"].selectExpr("s_suppkey AS BusinessEntityID", "s_suppkey AS AddressID")
        return customers.unionByName(sites)

    def address():
        columns = ["AddressID", "AddressLine1", "AddressLine2", "City", "PostalCode", "StateProvinceID"]
        customers = t["customer"].selectExpr(
            "-(c_custkey + 1)",
            "concat(cast(c_custkey as string), ' Main St')",
            "CASE WHEN c_custkey % 4 = 0 THEN 'Suite 1' END",
            "concat('City ', cast(c_nationkey as string))",
            "lpad(cast(c_nationkey as string), 5, '0')",
            "c_nationkey",
        )
        sites = t["supplier"].selectExpr(
            "s_suppkey",
            "CASE WHEN s_suppkey % 8 <> 0 THEN concat(cast(s_suppkey as string), ' Dock Rd') END",
            "CASE WHEN s_suppkey % 16 = 3 THEN 'Hall B' END",
            "concat('City ', cast(s_nationkey as string))",
            "lpad(cast(s_nationkey as string), 5, '0')",
            "s_nationkey",
        )
        return customers.toDF(*columns).unionByName(sites.toDF(*columns))

    def state():
        return t["nation"].selectExpr(
            "n_nationkey AS StateProvinceID",
            "concat(n_name, ' State') AS Name",
            "concat('C', cast(n_nationkey as string)) AS CountryRegionCode",
            "n_nationkey AS TerritoryID",
        )

    def country():
        return t["nation"].selectExpr(
            "concat('C', cast(n_nationkey as string)) AS CountryRegionCode", "n_name AS Name"
        )

    def territory():
        return (
            t["nation"]
            .join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
            .selectExpr(
                "n_nationkey AS TerritoryID",
                "n_name AS Name",
                "r_name AS `Group`",
                "concat('C', cast(n_nationkey as string)) AS CountryRegionCode",
                "cast(n_nationkey * 1000.5 as decimal(18,2)) AS CostYTD",
            )
        )

    def demographics():
        return t["customer"].selectExpr(
            "-(c_custkey + 1) AS BusinessEntityID",
            "CASE WHEN c_acctbal >= 8000 THEN 'Greater than 150000'"
            " WHEN c_acctbal >= 6500 THEN '100000-150000'"
            " WHEN c_acctbal >= 5000 THEN '75000-100000'"
            " WHEN c_acctbal >= 3500 THEN '50000-75000'"
            " WHEN c_acctbal >= 2000 THEN '25000-50000'"
            " WHEN c_acctbal >= 0 THEN '10000-25000' END AS YearlyIncome",
        )

    def store():
        return t["supplier"].selectExpr(
            "s_suppkey AS BusinessEntityID",
            "s_name AS Name",
            "CASE WHEN s_suppkey % 9 <> 0 THEN s_suppkey % 10 END AS SalesPersonID",
            f"CASE WHEN s_suppkey % 7 <> 0 THEN {_SURVEY} END AS Demographics",
            "DATE'1995-01-01' AS ModifiedDate",
        )

    def sales_person():
        return (
            t["supplier"]
            .filter("s_suppkey % 10 <> 9")
            .selectExpr(
                "s_suppkey AS BusinessEntityID",
                "CASE WHEN s_suppkey % 10 <> 8 THEN cast(1200000 + 1200 * (s_suppkey % 50) as decimal(18,2)) END"
                " AS SalesQuota",
                "CASE WHEN s_suppkey % 6 <> 0 THEN s_nationkey END AS TerritoryID",
            )
        )

    def employee():
        return t["supplier"].selectExpr(
            "s_suppkey AS BusinessEntityID",
            "elt(1 + cast(s_suppkey % 3 as int), 'Sales Representative', 'Buyer', 'Supervisor') AS JobTitle",
            "date_add(DATE'1990-01-01', cast(s_suppkey % 1000 as int)) AS HireDate",
            "s_suppkey % 13 <> 12 AS CurrentFlag",
            "DATE'1995-01-01' AS ModifiedDate",
        )

    def department_history():
        # One row is current (open end) and every third employee has an ended one too.
        now = t["supplier"].selectExpr(
            "s_suppkey AS BusinessEntityID",
            "cast(1 + s_suppkey % 5 as int) AS DepartmentID",
            "CASE WHEN s_suppkey % 7 = 5 THEN DATE'1999-12-31' END AS EndDate",
        )
        past = (
            t["supplier"]
            .filter("s_suppkey % 3 = 0")
            .selectExpr(
                "s_suppkey AS BusinessEntityID",
                "cast(1 + (s_suppkey + 1) % 5 as int) AS DepartmentID",
                "DATE'1996-06-30' AS EndDate",
            )
        )
        return now.unionByName(past)

    def department():
        return t["region"].selectExpr("r_regionkey + 1 AS DepartmentID", "concat('Department ', r_name) AS Name")

    def product():
        return t["part"].selectExpr(
            "p_partkey AS ProductID",
            "p_name AS Name",
            "concat('PN-', cast(p_partkey as string)) AS ProductNumber",
            f"CASE WHEN p_partkey % 37 <> 0 THEN ({_CATEGORY_ID}) * 1000 + {_BRAND_ID} END AS ProductSubcategoryID",
            f"CASE WHEN p_partkey % 4 <> 0 THEN {_BRAND_ID} END AS ProductModelID",
            "CASE cast(p_partkey % 5 as int) WHEN 0 THEN 'R' WHEN 1 THEN 'M' WHEN 2 THEN 'T' WHEN 3 THEN 'S' END"
            " AS ProductLine",
            "cast(p_retailprice as decimal(18,2)) AS ListPrice",
            "cast(cast(p_retailprice as decimal(18,2)) * 0.6 as decimal(18,2)) AS StandardCost",
            "CASE WHEN p_partkey % 23 = 0 THEN DATE'2000-01-01' END AS DiscontinuedDate",
            "CASE WHEN p_partkey % 29 = 0 THEN DATE'2002-06-01'"
            " ELSE date_sub(DATE'2001-12-01', cast(p_partkey % 400 as int)) END AS SellStartDate",
            "CASE WHEN p_partkey % 11 = 0 THEN DATE'2001-06-30'"
            " WHEN p_partkey % 11 = 1 THEN DATE'2003-01-01' END AS SellEndDate",
            "CASE WHEN p_partkey % 6 <> 0 THEN elt(1 + cast(p_partkey % 3 as int), 'Red', 'Black', 'Blue') END AS Color",
            "CASE WHEN p_partkey % 10 <> 0 THEN cast(p_size as string) END AS Size",
            "CASE WHEN p_partkey % 9 <> 0 THEN cast(p_size * 1.125 as decimal(10,3)) END AS Weight",
            "2 * p_size AS ReorderPoint",
            "3 * p_size AS SafetyStockLevel",
            "DATE'1995-01-01' AS ModifiedDate",
        )

    def subcategory():
        return t["part"].selectExpr(
            f"({_CATEGORY_ID}) * 1000 + {_BRAND_ID} AS ProductSubcategoryID",
            "concat(p_type, ' ', p_brand) AS Name",
            f"{_CATEGORY_ID} AS ProductCategoryID",
        ).distinct()

    def category():
        return t["part"].selectExpr(f"{_CATEGORY_ID} AS ProductCategoryID", "p_type AS Name").distinct()

    def model():
        return t["part"].selectExpr(f"{_BRAND_ID} AS ProductModelID", "p_brand AS Name").distinct()

    def inventory():
        return (
            t["lineitem"]
            .groupBy(
                F.col("l_partkey").alias("ProductID"),
                (F.col("l_suppkey") % 5).cast("int").alias("LocationID"),
            )
            .agg(
                F.sum(F.col("l_quantity").cast("bigint")).alias("Quantity"),
                F.max(F.col("l_shipdate").cast("date")).alias("ModifiedDate"),
            )
        )

    def review():
        return t["events"].selectExpr(
            "event_id AS ProductReviewID",
            "event_id DIV 5 AS ProductID",
            "cast(ts as date) AS ReviewDate",
            "cast(1 + event_id % 5 as int) AS Rating",
            "CASE WHEN event_id % 4 <> 0 THEN props END AS Comments",
            "concat('CUSTOMER#', lpad(cast(user_id as string), 9, '0'), '@Example.COM') AS EmailAddress",
        )

    def location():
        return t["region"].selectExpr("r_regionkey AS LocationID", "r_name AS Name", "DATE'1995-01-01' AS ModifiedDate")

    def work_order():
        return _lines(t).selectExpr(
            "concat_ws('-', cast(l_orderkey as string), cast(l_linenumber as string), cast(l_suppkey as string))"
            " AS WorkOrderID",
            "l_partkey AS ProductID",
            "cast(l_quantity as smallint) AS OrderQty",
            "cast(cast(l_quantity as bigint) * cast(round(l_tax * 100) as bigint) DIV 50 as int) AS ScrappedQty",
            "l_shipdate AS StartDate",
            "CASE WHEN l_linestatus = 'F' THEN timestampadd(HOUR, cast(6 * (l_partkey % 40) as int), l_shipdate) END"
            " AS EndDate",
        )

    def vendor():
        return t["supplier"].selectExpr(
            "s_suppkey AS BusinessEntityID",
            "concat('Vendor ', s_name) AS Name",
            "cast(1 + s_suppkey % 5 as int) AS CreditRating",
            "s_suppkey % 12 <> 11 AS ActiveFlag",
            "DATE'1995-01-01' AS ModifiedDate",
        )

    def vendor_contact():
        return (
            t["supplier"]
            .filter("s_suppkey % 6 <> 5")
            .selectExpr("s_suppkey AS BusinessEntityID", "-(s_suppkey + 1) AS PersonID")
        )

    def purchase_header():
        return t["orders"].selectExpr(
            "o_orderkey AS PurchaseOrderID",
            "o_orderkey % 97 AS VendorID",
            "cast(o_orderdate as date) AS OrderDate",
            "CASE WHEN o_orderstatus <> 'P'"
            " THEN date_add(cast(o_orderdate as date), cast(o_orderkey % 15 as int)) END AS ShipDate",
        )

    def purchase_detail():
        return _lines(t).selectExpr(
            "l_orderkey AS PurchaseOrderID",
            "l_linenumber AS PurchaseOrderDetailID",
            "l_partkey AS ProductID",
            "cast(l_quantity as smallint) AS OrderQty",
            "cast(cast(l_extendedprice as decimal(18,2)) / cast(l_quantity as smallint) as decimal(12,4)) AS UnitPrice",
        )

    def offer():
        return (
            t["lineitem"]
            .selectExpr("cast(round(l_discount * 100) as bigint) AS SpecialOfferID")
            .distinct()
            .selectExpr(
                "SpecialOfferID",
                "concat('Offer ', cast(SpecialOfferID as string)) AS Description",
                "CASE WHEN SpecialOfferID = 0 THEN 'No Discount' ELSE 'Volume Discount' END AS Type",
                "CASE WHEN SpecialOfferID % 2 = 0 THEN 'Reseller' ELSE 'Customer' END AS Category",
                "cast(SpecialOfferID * 0.01 as decimal(10,4)) AS DiscountPct",
                "date_add(DATE'1995-01-01', cast(SpecialOfferID * 300 as int)) AS StartDate",
                "date_add(DATE'1995-01-01', cast(SpecialOfferID * 300 + 400 as int)) AS EndDate",
                "DATE'1995-01-01' AS ModifiedDate",
            )
        )

    def offer_product():
        return (
            t["lineitem"]
            .selectExpr("cast(round(l_discount * 100) as bigint) AS SpecialOfferID", "l_partkey AS ProductID")
            .distinct()
        )

    return Sources(
        {
            "Sales.SalesOrderHeader": orders_header,
            "Sales.SalesOrderDetail": order_detail,
            "Sales.Customer": sales_customer,
            "Sales.Store": store,
            "Sales.SalesPerson": sales_person,
            "Sales.SalesTerritory": territory,
            "Sales.SpecialOffer": offer,
            "Sales.SpecialOfferProduct": offer_product,
            "Sales.vPersonDemographics": demographics,
            "Person.Person": person,
            "Person.EmailAddress": email,
            "Person.PersonPhone": phone,
            "Person.Address": address,
            "Person.BusinessEntityAddress": entity_address,
            "Person.BusinessEntityContact": vendor_contact,
            "Person.StateProvince": state,
            "Person.CountryRegion": country,
            "Production.Product": product,
            "Production.ProductSubcategory": subcategory,
            "Production.ProductCategory": category,
            "Production.ProductModel": model,
            "Production.ProductInventory": inventory,
            "Production.ProductReview": review,
            "Production.Location": location,
            "Production.WorkOrder": work_order,
            "Purchasing.Vendor": vendor,
            "Purchasing.PurchaseOrderHeader": purchase_header,
            "Purchasing.PurchaseOrderDetail": purchase_detail,
            "HumanResources.Employee": employee,
            "HumanResources.EmployeeDepartmentHistory": department_history,
            "HumanResources.Department": department,
        }
    )


def test_error_records(spark: SparkSession, folder: str) -> DataFrame:
    """Error log derived from the ``error`` events (its last day is 2024-01-30)."""
    events = read_test_table(spark, folder, "events").filter("event_type = 'error'")
    return events.withColumn("k", F.get_json_object("props", "$.k").cast("int")).selectExpr(
        "event_id AS ErrorID",
        "ts AS ErrorDate",
        "elt(1 + cast(user_id % 3 as int), 'FactSales', 'FactPurchases', 'FactReturns') AS SourceTable",
        "concat_ws('-', cast(user_id as string), cast(event_id as string)) AS RecordNaturalKey",
        "CASE WHEN k < 50 THEN 'FK_MISS' WHEN k < 65 THEN 'VALIDATION_FAIL' WHEN k < 75 THEN 'OUT_OF_RANGE'"
        " WHEN k < 85 THEN 'TYPE_MISMATCH' WHEN k < 92 THEN 'NULL_PK' ELSE 'TIMEOUT' END AS ErrorType",
        "CASE WHEN k BETWEEN 85 AND 91 THEN 'CRITICAL' ELSE 'WARNING' END AS ErrorSeverity",
        "concat('CustomerID=', cast(user_id as string), ' not found') AS ErrorMessage",
        "to_json(named_struct('CustomerID', user_id, 'Amount', value)) AS FailedData",
        "concat('batch-', date_format(ts, 'yyyyMMdd')) AS ProcessingBatchID",
        "'load_fact' AS TaskName",
        "cast(k % 4 <> 0 as int) AS IsRecoverable",
        "k % 5 AS RetryCount",
        "CASE WHEN k % 5 > 0 THEN timestampadd(HOUR, k % 24, ts) END AS LastAttemptDate",
        "cast(k % 3 = 0 as int) AS IsResolved",
        "CASE WHEN k % 3 = 0 THEN 'Fixed by hand' END AS ResolutionComment",
    )
