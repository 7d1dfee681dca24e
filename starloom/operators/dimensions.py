"""Dimension builders: operational tables -> dimension rows.

Each builder returns the source image of a dimension, one row per member.  What
happens to it next (insert, new version, overwrite) is decided in
``operators.scd``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starloom.functions.bands import band, first_match
from starloom.functions.dates import FAR_FUTURE, whole_years
from starloom.functions.keys import WIDE_KEYS, KeyPolicy, surrogate_key
from starloom.functions.lookups import nullable_left_join

Sources = Mapping[str, DataFrame]

# The income texts of the source and what they stand for.
SEGMENT_BY_INCOME = (
    ("%Greater%150000%", "Premium"),
    ("%75000%100000%", "Gold"),
    ("%50000%75000%", "Silver"),
    ("%25000%50000%", "Bronze"),
)
INCOME_MIDPOINTS = (
    ("%Greater%150000%", 175000),
    ("%100000%150000%", 125000),
    ("%75000%100000%", 87500),
    ("%50000%75000%", 62500),
    ("%25000%50000%", 37500),
    ("%10000%25000%", 17500),
)
# Credit limit = base x one factor from each ladder.
CREDIT_BASE_STORE, CREDIT_BASE_PERSON = 10000, 1000
CREDIT_BY_ORDERS = ((20, "3.0"), (10, "2.5"), (5, "2.0"), (1, "1.5"))
CREDIT_BY_LIFETIME = ((100000, "2.0"), (50000, "1.5"), (10000, "1.2"))
CREDIT_BY_INCOME = (("%Greater%150000%", "1.5"), ("%75000%", "1.2"))
# Brand of a product without model, by product line.
BRAND_BY_LINE = {"R": "Road", "M": "Mountain", "T": "Touring", "S": "Standard"}
# Vendor constants and the on-time window.
VENDOR_QUALITY, VENDOR_TERMS, ON_TIME_DAYS = "85.00", "Net 30", 7
DEFAULT_SQUARE_FEET = 1000


def _or(column: str, default) -> Column:
    return F.coalesce(F.col(column), F.lit(default)).alias(column)


def _decimal(value, precision: int = 18, scale: int = 2) -> Column:
    return (F.lit(value) if not isinstance(value, Column) else value).cast(f"decimal({precision},{scale})")


def _full_name(first="FirstName", middle="MiddleName", last="LastName") -> Column:
    middle_part = F.coalesce(F.concat(F.col(middle), F.lit(" ")), F.lit(""))
    return F.concat(F.col(first), F.lit(" "), middle_part, F.col(last))


def _versioning(valid_from: Column, source_date: Column | None = None) -> list[Column]:
    columns = [
        valid_from.cast("date").alias("ValidFromDate"),
        F.lit(FAR_FUTURE).alias("ValidToDate"),
        F.lit(1).alias("IsCurrent"),
    ]
    if source_date is not None:
        columns.append(source_date.cast("date").alias("SourceUpdateDate"))
    return columns + [F.lit(1).cast("bigint").alias("Version")]


def order_totals_by_customer(src: Sources) -> DataFrame:
    return (
        src["Sales.SalesOrderHeader"]
        .groupBy(F.col("CustomerID").alias("_buyer"))
        .agg(
            F.count(F.lit(1)).alias("OrderCount"),
            F.sum("TotalDue").alias("LifetimeValue"),
            F.min("OrderDate").alias("FirstOrderDate"),
        )
    )


def credit_limit(is_store: Column, orders: Column, lifetime: Column, income: Column) -> Column:
    """Product of the base and one factor per ladder, rounded to cents."""
    base = F.when(is_store, _decimal(CREDIT_BASE_STORE)).otherwise(_decimal(CREDIT_BASE_PERSON))
    one = _decimal("1.0", 3, 1)
    by_orders = first_match([(orders >= n, _decimal(f, 3, 1)) for n, f in CREDIT_BY_ORDERS], one)
    by_value = first_match([(lifetime > n, _decimal(f, 3, 1)) for n, f in CREDIT_BY_LIFETIME], one)
    by_income = first_match([(income.like(p), _decimal(f, 3, 1)) for p, f in CREDIT_BY_INCOME], one)
    return F.round(base * by_orders * by_value * by_income, 2).cast("decimal(18,2)")


def build_dim_customer(src: Sources, as_of: dt.date, keys: KeyPolicy = WIDE_KEYS) -> DataFrame:
    person = src["Person.Person"].select(
        F.col("BusinessEntityID").alias("PersonID"), _full_name().alias("_person_name"), F.lit(True).alias("_has_person")
    )
    store = src["Sales.Store"].select(F.col("BusinessEntityID").alias("StoreID"), F.col("Name").alias("_store_name"))
    email = src["Person.EmailAddress"].select(
        F.col("BusinessEntityID").alias("PersonID"), F.col("EmailAddress").alias("Email")
    )
    phone = src["Person.PersonPhone"].select(
        F.col("BusinessEntityID").alias("PersonID"), F.col("PhoneNumber").alias("Phone")
    )
    income = src["Sales.vPersonDemographics"].select(
        F.col("BusinessEntityID").alias("PersonID"), F.col("YearlyIncome").alias("_income")
    )
    # Joins on the same key sit next to each other, so beyond the broadcast
    # limit the customers are shuffled once for all four.
    base = src["Sales.Customer"]
    for side in (person, email, phone, income):
        base = nullable_left_join(base, side, "PersonID", ["CustomerID"])
    base = nullable_left_join(base, store, "StoreID", ["CustomerID"])
    base = base.withColumn("_entity", F.coalesce("PersonID", "StoreID"))
    base = _with_address(base, src, "_entity")
    base = base.join(order_totals_by_customer(src), F.col("CustomerID") == F.col("_buyer"), "left")

    has_person, has_store = F.col("PersonID").isNotNull(), F.col("StoreID").isNotNull()
    year_ago = F.add_months(F.lit(as_of), -12)
    has_orders = F.col("OrderCount") > 0
    changed = F.coalesce(F.col("ModifiedDate").cast("date"), F.lit(as_of))
    return base.select(
        surrogate_key("CustomerID", "ModifiedDate", policy=keys).alias("CustomerKey"),
        "CustomerID",
        first_match(
            [
                (has_person, F.coalesce("_person_name", F.lit("Unknown"))),
                (has_store, F.coalesce("_store_name", F.lit("Unknown Store"))),
            ],
            "Unknown Customer",
        ).alias("CustomerName"),
        _or("Email", ""),
        _or("Phone", ""),
        _or("City", "Unknown"),
        _or("StateProvince", "Unknown"),
        _or("Country", "Unknown"),
        _or("PostalCode", "00000"),
        first_match(
            [(F.col("_income").like(p), name) for p, name in SEGMENT_BY_INCOME] + [(has_store, "Business")], "Standard"
        ).alias("CustomerSegment"),
        first_match([(has_store, "Business"), (has_person, "Individual")], "Unknown").alias("CustomerType"),
        first_match(
            [(has_orders & (F.col("FirstOrderDate") > year_ago), "Active"), (has_orders, "Inactive")], "New"
        ).alias("AccountStatus"),
        credit_limit(has_store, F.col("OrderCount"), F.col("LifetimeValue"), F.col("_income")).alias("CreditLimit"),
        band("_income", [("like", p, value) for p, value in INCOME_MIDPOINTS], 0)
        .cast("decimal(18,2)")
        .alias("AnnualIncome"),
        F.coalesce(whole_years(F.col("FirstOrderDate"), F.lit(as_of)), F.lit(0)).alias("YearsSinceFirstPurchase"),
        *_versioning(changed, changed)[:-1],
        changed.alias("EffectiveStartDate"),
        F.lit(FAR_FUTURE).alias("EffectiveEndDate"),
        F.lit(1).cast("bigint").alias("Version"),
    )


def _with_address(base: DataFrame, src: Sources, entity: str) -> DataFrame:
    """Address, state and country of ``entity``; territory comes with the state."""
    link = src["Person.BusinessEntityAddress"].select(F.col("BusinessEntityID").alias(entity), "AddressID")
    address = src["Person.Address"].select(
        "AddressID", "AddressLine1", "AddressLine2", "City", "PostalCode", "StateProvinceID"
    )
    state = src["Person.StateProvince"].select(
        "StateProvinceID", F.col("Name").alias("StateProvince"), "CountryRegionCode", F.col("TerritoryID").alias("_area")
    )
    country = src["Person.CountryRegion"].select("CountryRegionCode", F.col("Name").alias("Country"))
    own = list(base.columns)  # members without an entity or an address are dealt by their own columns
    return (
        nullable_left_join(base, link, entity, own)
        .transform(nullable_left_join, address, "AddressID", own)
        .join(state, "StateProvinceID", "left")
        .join(country, "CountryRegionCode", "left")
    )


def build_dim_product(src: Sources, as_of: dt.date, keys: KeyPolicy = WIDE_KEYS) -> DataFrame:
    subcategory = src["Production.ProductSubcategory"].select(
        "ProductSubcategoryID", F.col("Name").alias("SubCategory"), "ProductCategoryID"
    )
    category = src["Production.ProductCategory"].select("ProductCategoryID", F.col("Name").alias("Category"))
    model = src["Production.ProductModel"].select("ProductModelID", F.col("Name").alias("_model"))
    # The two category levels are joined first: both are small, and the result
    # is then joined to the products once.
    groups = subcategory.join(category, "ProductCategoryID", "left")
    base = src["Production.Product"].join(groups, "ProductSubcategoryID", "left").join(model, "ProductModelID", "left")
    line_brand = first_match([(F.col("ProductLine") == k, v) for k, v in BRAND_BY_LINE.items()], "Generic")
    start = F.coalesce("SellStartDate", "ModifiedDate").cast("date")
    today = F.lit(as_of)
    return base.select(
        surrogate_key("ProductID", "ModifiedDate", policy=keys).alias("ProductKey"),
        "ProductID",
        F.col("Name").alias("ProductName"),
        F.col("ProductNumber").alias("SKU"),
        _or("Category", "Uncategorized"),
        _or("SubCategory", "None"),
        F.coalesce(F.col("_model"), line_brand).alias("Brand"),
        F.col("ListPrice").cast("decimal(18,2)").alias("ListPrice"),
        F.col("StandardCost").cast("decimal(18,2)").alias("Cost"),
        first_match(
            [
                (F.col("DiscontinuedDate").isNotNull(), "Discontinued"),
                (F.col("SellEndDate") < today, "Inactive"),
                (F.col("SellStartDate") > today, "Pending"),
            ],
            "Active",
        ).alias("ProductStatus"),
        _or("Color", "N/A"),
        _or("Size", "N/A"),
        F.coalesce(F.col("Weight").cast("decimal(10,3)"), _decimal(0, 10, 3)).alias("Weight"),
        *_versioning(start, F.col("ModifiedDate"))[:-1],
        start.alias("EffectiveStartDate"),
        F.coalesce(F.col("SellEndDate").cast("date"), F.lit(FAR_FUTURE)).alias("EffectiveEndDate"),
        F.lit(1).cast("bigint").alias("Version"),
    )


def survey_text(xml: Column, element: str) -> Column:
    """Text of one element of the store survey; NULL when absent or empty."""
    return F.nullif(F.xpath_string(xml, F.lit(f"/StoreSurvey/{element}")), F.lit(""))


def build_dim_store(src: Sources, as_of: dt.date, keys: KeyPolicy = WIDE_KEYS) -> DataFrame:
    territory = src["Sales.SalesTerritory"].select(
        F.col("TerritoryID").alias("_area"), F.col("Group").alias("Region"), F.col("Name").alias("Territory")
    )
    manager = (
        src["Sales.SalesPerson"]
        .select(F.col("BusinessEntityID").alias("SalesPersonID"))
        .join(
            src["Person.Person"].select(
                F.col("BusinessEntityID").alias("SalesPersonID"),
                F.concat("FirstName", F.lit(" "), "LastName").alias("ManagerName"),
            ),
            "SalesPersonID",
        )
    )
    base = _with_address(src["Sales.Store"].withColumnRenamed("Name", "StoreName"), src, "BusinessEntityID")
    base = base.join(territory, "_area", "left").join(manager, "SalesPersonID", "left")
    xml = F.col("Demographics")
    opened = F.try_to_date(F.concat(survey_text(xml, "YearOpened"), F.lit("-01-01")), "yyyy-MM-dd")
    square_feet = F.nullif(survey_text(xml, "SquareFeet").try_cast("int"), F.lit(0))
    line = F.trim(
        F.concat(F.coalesce("AddressLine1", F.lit("")), F.lit(" "), F.coalesce("AddressLine2", F.lit("")))
    )
    return base.select(
        surrogate_key("BusinessEntityID", "ModifiedDate", policy=keys).alias("StoreKey"),
        F.col("BusinessEntityID").alias("StoreID"),
        "StoreName",
        F.col("BusinessEntityID").alias("StoreNumber"),
        F.coalesce(F.nullif(line, F.lit("")), F.lit("Unknown")).alias("Address"),
        _or("City", "Unknown"),
        _or("StateProvince", "Unknown"),
        _or("Country", "Unknown"),
        _or("PostalCode", "00000"),
        _or("Region", "Unassigned"),
        _or("Territory", "Unassigned"),
        F.coalesce(survey_text(xml, "BusinessType"), F.lit("Retail")).alias("StoreType"),
        F.lit("Active").alias("StoreStatus"),
        _or("ManagerName", "Unassigned"),
        F.coalesce(opened, F.col("ModifiedDate").cast("date")).alias("OpeningDate"),
        F.coalesce(square_feet, F.lit(DEFAULT_SQUARE_FEET)).alias("SquareFootage"),
        *_versioning(F.col("ModifiedDate"), F.col("ModifiedDate")),
    )


def build_dim_employee(src: Sources, as_of: dt.date, keys: KeyPolicy = WIDE_KEYS) -> DataFrame:
    person = src["Person.Person"].select("BusinessEntityID", _full_name().alias("EmployeeName"))
    # Filtering the history before a left join equals the predicate in its ON clause.
    department = (
        src["HumanResources.EmployeeDepartmentHistory"]
        .filter(F.col("EndDate").isNull())
        .join(src["HumanResources.Department"].select("DepartmentID", F.col("Name").alias("Department")), "DepartmentID")
        .select("BusinessEntityID", "Department")
    )
    territory = src["Sales.SalesTerritory"].select(
        "TerritoryID", F.col("Group").alias("Region"), F.col("Name").alias("Territory")
    )
    seller = src["Sales.SalesPerson"].select("BusinessEntityID", "SalesQuota", "TerritoryID")
    base = (
        src["HumanResources.Employee"]
        .join(person, "BusinessEntityID")
        .join(department, "BusinessEntityID", "left")
        .join(seller, "BusinessEntityID", "left")
        .join(territory, "TerritoryID", "left")
    )
    return base.select(
        surrogate_key("BusinessEntityID", "ModifiedDate", policy=keys).alias("EmployeeKey"),
        F.col("BusinessEntityID").alias("EmployeeID"),
        "EmployeeName",
        "JobTitle",
        _or("Department", "Unassigned"),
        F.lit(None).cast("bigint").alias("ReportingManagerKey"),
        F.col("HireDate").cast("date").alias("HireDate"),
        F.when(F.col("CurrentFlag"), "Active").otherwise("Inactive").alias("EmployeeStatus"),
        _or("Region", "N/A"),
        _or("Territory", "N/A"),
        F.coalesce(F.col("SalesQuota").cast("decimal(18,2)"), _decimal(0)).alias("SalesQuota"),
        *_versioning(F.col("HireDate"), F.col("ModifiedDate")),
    )


def build_dim_promotion(src: Sources, as_of: dt.date, keys: KeyPolicy = WIDE_KEYS) -> DataFrame:
    today = F.lit(as_of)
    running = today.between(F.col("StartDate"), F.col("EndDate"))
    return src["Sales.SpecialOffer"].select(
        surrogate_key("SpecialOfferID", "ModifiedDate", policy=keys).alias("PromotionKey"),
        F.col("SpecialOfferID").alias("PromotionID"),
        F.col("Description").alias("PromotionName"),
        F.col("Description").alias("PromotionDescription"),
        F.col("Type").alias("PromotionType"),
        (F.col("DiscountPct") * 100).cast("decimal(5,2)").alias("DiscountPercentage"),
        _decimal(0).alias("DiscountAmount"),
        first_match([(running, "Active"), (today < F.col("StartDate"), "Scheduled")], "Expired").alias(
            "PromotionStatus"
        ),
        F.col("Category").alias("TargetCustomerSegment"),
        F.col("SpecialOfferID").alias("CampaignID"),
        F.lit(None).cast("bigint").alias("TargetProductKey"),
        F.col("StartDate").cast("date").alias("StartDate"),
        F.col("EndDate").cast("date").alias("EndDate"),
        F.coalesce(running.cast("int"), F.lit(0)).alias("IsActive"),
    )


def build_dim_product_category(src: Sources, as_of: dt.date, keys: KeyPolicy = WIDE_KEYS) -> DataFrame:
    return src["Production.ProductCategory"].select(
        surrogate_key("ProductCategoryID", "Name", "Name", policy=keys).alias("ProductCategoryKey"),
        "ProductCategoryID",
        F.col("Name").alias("CategoryName"),
        F.col("Name").alias("CategoryDescription"),
    )


def build_dim_warehouse(src: Sources, as_of: dt.date, keys: KeyPolicy = WIDE_KEYS) -> DataFrame:
    return src["Production.Location"].select(
        surrogate_key("LocationID", "ModifiedDate", policy=keys).alias("WarehouseKey"),
        F.col("LocationID").alias("WarehouseID"),
        F.col("Name").alias("WarehouseName"),
        F.col("Name").alias("Location"),
        F.lit("Manufacturing").alias("WarehouseType"),
        F.lit(None).cast("bigint").alias("ManagerKey"),
        *_versioning(F.col("ModifiedDate")),
    )


def build_dim_sales_territory(src: Sources, as_of: dt.date, keys: KeyPolicy = WIDE_KEYS) -> DataFrame:
    return src["Sales.SalesTerritory"].select(
        surrogate_key("TerritoryID", "Name", "Group", "CountryRegionCode", policy=keys).alias("TerritoryKey"),
        "TerritoryID",
        F.col("Name").alias("TerritoryName"),
        F.col("Group").alias("SalesRegion"),
        F.col("CountryRegionCode").alias("Country"),
        F.lit("TBD").alias("Manager"),
        F.col("CostYTD").cast("decimal(18,2)").alias("SalesTarget"),
    )


def vendor_delivery(src: Sources) -> DataFrame:
    """Orders and on-time orders per vendor."""
    on_time = F.col("ShipDate") <= F.date_add("OrderDate", ON_TIME_DAYS)
    return (
        src["Purchasing.PurchaseOrderHeader"]
        .groupBy(F.col("VendorID").alias("_vendor"))
        .agg(F.count(F.lit(1)).alias("_orders"), F.count_if(on_time).alias("_on_time"))
    )


def build_dim_vendor(src: Sources, as_of: dt.date, keys: KeyPolicy = WIDE_KEYS) -> DataFrame:
    contact = src["Person.BusinessEntityContact"].select("BusinessEntityID", "PersonID")
    person = src["Person.Person"].select(
        F.col("BusinessEntityID").alias("PersonID"), F.concat("FirstName", F.lit(" "), "LastName").alias("ContactPerson")
    )
    email = src["Person.EmailAddress"].select(
        F.col("BusinessEntityID").alias("PersonID"), F.col("EmailAddress").alias("Email")
    )
    phone = src["Person.PersonPhone"].select(
        F.col("BusinessEntityID").alias("PersonID"), F.col("PhoneNumber").alias("Phone")
    )
    base = (
        src["Purchasing.Vendor"]
        .withColumnRenamed("Name", "VendorName")
        .join(contact, "BusinessEntityID", "left")
        .join(person, "PersonID", "left")
        .join(email, "PersonID", "left")
        .join(phone, "PersonID", "left")
    )
    base = _with_address(base, src, "BusinessEntityID")
    base = base.join(vendor_delivery(src), F.col("BusinessEntityID") == F.col("_vendor"), "left")
    share = F.try_divide(F.col("_on_time").cast("double"), F.col("_orders").cast("double")) * 100.0
    return base.select(
        surrogate_key("BusinessEntityID", "ModifiedDate", policy=keys).alias("VendorKey"),
        F.col("BusinessEntityID").alias("VendorID"),
        "VendorName",
        _or("ContactPerson", "Unknown"),
        _or("Email", ""),
        _or("Phone", ""),
        F.concat(
            F.coalesce("AddressLine1", F.lit("")),
            F.coalesce(F.concat(F.lit(", "), F.col("AddressLine2")), F.lit("")),
        ).alias("Address"),
        _or("City", "Unknown"),
        _or("Country", "Unknown"),
        (F.col("CreditRating") / 5.0).cast("decimal(3,2)").alias("VendorRating"),
        F.coalesce(F.round(share, 2), F.lit(0.0)).cast("decimal(5,2)").alias("OnTimeDeliveryRate"),
        _decimal(VENDOR_QUALITY, 5, 2).alias("QualityScore"),
        F.lit(VENDOR_TERMS).alias("PaymentTerms"),
        F.when(F.col("ActiveFlag"), "Active").otherwise("Inactive").alias("VendorStatus"),
        *_versioning(F.col("ModifiedDate"), F.col("ModifiedDate")),
    )


def build_dim_region(src: Sources, as_of: dt.date, keys: KeyPolicy = WIDE_KEYS) -> DataFrame:
    """One row per territory, numbered by group and country.

    The numbering needs a total order, hence one task; the territories are a
    list of countries, not data that grows.
    """
    country = src["Person.CountryRegion"].select("CountryRegionCode", F.col("Name").alias("_country"))
    numbered = (
        src["Sales.SalesTerritory"]
        .join(country, "CountryRegionCode")
        .withColumn("RegionID", F.row_number().over(Window.orderBy("Group", "_country", "TerritoryID")).cast("bigint"))
    )
    tail = F.concat_ws("|", F.coalesce("Group", F.lit("")), F.coalesce("_country", F.lit("")))
    return numbered.select(
        surrogate_key(F.concat(F.col("RegionID").cast("string"), tail), policy=keys).alias("RegionKey"),
        "RegionID",
        F.col("Group").alias("RegionName"),
        F.col("Name").alias("Country"),
        F.col("Group").alias("Continent"),
        F.lit("UTC").alias("TimeZone"),
    )


@dataclass(frozen=True)
class DimSpec:
    """What the pipeline has to know about a dimension."""

    name: str
    key: str
    natural_key: str
    build: Callable[..., DataFrame]
    driver: str
    scd2: bool = True
    #: columns of ``driver`` that make up the surrogate key, natural key first
    key_parts: tuple[str, ...] = field(default=())
    #: what really identifies a member where ``natural_key`` is a position; the batch keeps positions in a registry
    registry: tuple[str, ...] = field(default=())

    def key_map(self, src: Sources, keys: KeyPolicy = WIDE_KEYS) -> DataFrame:
        """(natural key, surrogate key) of the members, without their attributes."""
        return src[self.driver].select(
            F.col(self.key_parts[0]).alias(self.natural_key), surrogate_key(*self.key_parts, policy=keys).alias(self.key)
        )


_ENTITY = ("BusinessEntityID", "ModifiedDate")

DIMENSIONS = {
    spec.name: spec
    for spec in (
        DimSpec("DimCustomer", "CustomerKey", "CustomerID", build_dim_customer, "Sales.Customer", True,
                ("CustomerID", "ModifiedDate")),
        DimSpec("DimProduct", "ProductKey", "ProductID", build_dim_product, "Production.Product", True,
                ("ProductID", "ModifiedDate")),
        DimSpec("DimStore", "StoreKey", "StoreID", build_dim_store, "Sales.Store", True, _ENTITY),
        DimSpec("DimEmployee", "EmployeeKey", "EmployeeID", build_dim_employee, "HumanResources.Employee", True, _ENTITY),
        DimSpec("DimPromotion", "PromotionKey", "PromotionID", build_dim_promotion, "Sales.SpecialOffer", False,
                ("SpecialOfferID", "ModifiedDate")),
        DimSpec("DimProductCategory", "ProductCategoryKey", "ProductCategoryID", build_dim_product_category,
                "Production.ProductCategory", False, ("ProductCategoryID", "Name", "Name")),
        DimSpec("DimWarehouse", "WarehouseKey", "WarehouseID", build_dim_warehouse, "Production.Location", True,
                ("LocationID", "ModifiedDate")),
        DimSpec("DimSalesTerritory", "TerritoryKey", "TerritoryID", build_dim_sales_territory, "Sales.SalesTerritory",
                False, ("TerritoryID", "Name", "Group", "CountryRegionCode")),
        DimSpec("DimVendor", "VendorKey", "VendorID", build_dim_vendor, "Purchasing.Vendor", True, _ENTITY),
        DimSpec(
            "DimRegion", "RegionKey", "RegionID", build_dim_region, "Sales.SalesTerritory", False, registry=("RegionName", "Country")
        ),
    )
}


def register_dimension(spec: DimSpec) -> None:
    """Add a dimension of your own to the batch run."""
    DIMENSIONS[spec.name] = spec
