"""Every operator as a query over the test tables.

Each query takes (spark, folder) and reads whole tables.  Decimals leave as
DOUBLE, so that engines with other decimal rules can be compared.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions import cleaning
from starloom.functions.dates import coerce_date, truncate
from starloom.functions.keys import COMPACT_KEYS, WIDE_KEYS, surrogate_key
from starloom.functions.measures import exact_avg, money_sum
from starloom.operators import facts as fact_builders
from starloom.operators import fk as fk_ops
from starloom.operators import joins, quality, quarantine, rollups, scd, sinks
from starloom.plans import operations, reports, views
from starloom.plans.warehouse import Warehouse
from starloom.sources import calendar
from starloom.sources.literals import literal_table
from starloom.session import scratch_dir
from starloom.sources.tpch import (
    AS_OF,
    CALENDAR_START,
    read_test_table,
    stream_test_table,
    test_error_records,
    tpch_sources,
)
from starloom.streaming.changes import ChangeLog
from starloom.streaming.loads import load_fact_stream
from starloom.streaming.rollups import (
    RollupState, hourly_sums, maintain_hours, maintain_rollup, read_hours, read_rollup, write_updates,
)
from starloom.streaming.waiting import WaitingLoad

Query = Callable[[SparkSession, str], DataFrame]

LOADED_AT = dt.datetime(2001, 12, 1)
#: Reference day of the error log derived from the events.
ERRORS_AS_OF = dt.date(2024, 1, 30)
#: The calendar has to reach the events of 2024.
YEARS_AHEAD = 30
CHANGE_DAY = dt.date(2000, 1, 1)
RETURN_DAY = dt.date(2001, 1, 1)
LINEAGE = ("ETLBatchID", "LoadTimestamp", "SnapshotCreatedDateTime")


def portable(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _test_warehouse(spark: SparkSession, sources) -> Warehouse:
    return Warehouse.from_sources(
        spark, sources, AS_OF, calendar_start=CALENDAR_START, years_ahead=YEARS_AHEAD, loaded_at=LOADED_AT
    )


_SHARED: dict[tuple, object] = {}


def _shared(kind: str, spark: SparkSession, folder: str, build):
    """One set of lazy tables per session and folder: plans are shared, never data."""
    key = (kind, spark.sparkContext.applicationId, spark._jsparkSession.hashCode(), folder)
    if key not in _SHARED:
        _SHARED[key] = build()
    return _SHARED[key]


def warehouse(spark: SparkSession, folder: str) -> Warehouse:
    return _shared("full", spark, folder, lambda: _test_warehouse(spark, tpch_sources(spark, folder)))


def gapped_warehouse(spark: SparkSession, folder: str) -> Warehouse:
    """A warehouse whose customers and products are incomplete, so that keys miss."""
    return _shared("gapped", spark, folder, lambda: _gapped(spark, folder))


def _gapped(spark: SparkSession, folder: str) -> Warehouse:
    src = tpch_sources(spark, folder)
    late = src.replaced(
        Sales__Customer=src["Sales.Customer"].filter("CustomerID % 50 <> 7"),
        Production__Product=src["Production.Product"].filter("ProductID % 40 <> 3"),
    )
    partial = _test_warehouse(spark, late)
    # The facts come from the full source; only the dimensions lag behind.
    return partial.with_extract("FactSales", lambda: warehouse(spark, folder).table("extract:FactSales"))


# -- customer versions over three days ---------------------------------------


def _segment(shift: str) -> str:
    return (
        f"CASE WHEN {shift} THEN concat('NEXT ', c_mktsegment) ELSE c_mktsegment END AS CustomerSegment"
    )


def customer_feed(spark: SparkSession, folder: str, day: int) -> DataFrame:
    """Three daily images of the customer master.

    Day 2 moves every tenth customer to another segment, moves one more without
    advancing its date (to be ignored), adds withheld customers and drops some;
    day 3 brings the dropped ones back.
    """
    customers = read_test_table(spark, folder, "customer")
    moved, stale = "c_custkey % 10 = 3", "c_custkey % 10 = 4"
    if day == 1:
        rows, since, segment = customers.filter("c_custkey % 13 <> 1"), "DATE'1996-01-01'", _segment("false")
    else:
        since = f"CASE WHEN {moved} OR c_custkey % 13 = 1 THEN DATE'2000-01-01' ELSE DATE'1996-01-01' END"
        segment = _segment(f"{moved} OR {stale}")
        rows = customers
        if day == 2:
            rows = rows.filter("c_custkey % 17 <> 5")
        else:
            since = f"CASE WHEN c_custkey % 17 = 5 THEN DATE'2001-01-01' ELSE {since} END"
    frame = rows.selectExpr("c_custkey AS CustomerID", "c_name AS CustomerName", segment, f"{since} AS ValidFromDate")
    return scd.initial_versions(frame).select(
        surrogate_key("CustomerID", "ValidFromDate").alias("CustomerKey"), *frame.columns, "ValidToDate", "IsCurrent",
        "Version",
    )


def customer_history(spark: SparkSession, folder: str, days: int = 2) -> DataFrame:
    dim = scd.initial_versions(customer_feed(spark, folder, 1))
    for day, when in ((2, CHANGE_DAY), (3, RETURN_DAY)):
        if day <= days:
            dim = scd.scd2_merge(customer_feed(spark, folder, day), dim, "CustomerID", "CustomerKey", when)
    return dim


def customer_changes(spark: SparkSession, folder: str) -> DataFrame:
    dim = scd.initial_versions(customer_feed(spark, folder, 1))
    return scd.scd2_changes(customer_feed(spark, folder, 2), dim, "CustomerID", "CustomerKey")


def part_feed(spark: SparkSession, folder: str, day: int) -> DataFrame:
    parts = read_test_table(spark, folder, "part")
    rows = parts.filter("p_partkey % 19 <> 4") if day == 1 else parts.filter("p_partkey % 23 <> 6")
    price = "p_retailprice" if day == 1 else "CASE WHEN p_partkey % 7 = 2 THEN p_retailprice + 10 ELSE p_retailprice END"
    frame = rows.selectExpr(
        "p_partkey AS ProductID", "p_name AS ProductName", f"cast({price} as decimal(18,2)) AS ListPrice"
    )
    return frame.select(surrogate_key("ProductID", F.lit(day)).alias("ProductKey"), *frame.columns)


# -- queries -------------------------------------------------------------------

QUERIES: dict[str, Query] = {}


def query(name: str):
    def add(build: Query) -> Query:
        QUERIES[name] = lambda spark, folder: portable(build(spark, folder))
        return build

    return add


def _dimension(name: str):
    return lambda spark, folder: warehouse(spark, folder).table(name)


def _extract(name: str):
    return lambda spark, folder: warehouse(spark, folder).table(f"extract:{name}").drop(*LINEAGE)


def _of_warehouse(build):
    return lambda spark, folder: build(warehouse(spark, folder))


for _query, _table in {
    "dim_customer_build": "DimCustomer",
    "dim_product_build": "DimProduct",
    "dim_store_build": "DimStore",
    "dim_employee_build": "DimEmployee",
    "dim_promotion_build": "DimPromotion",
    "dim_product_category_build": "DimProductCategory",
    "dim_warehouse_build": "DimWarehouse",
    "dim_sales_territory_build": "DimSalesTerritory",
    "dim_vendor_build": "DimVendor",
    "dim_region_build": "DimRegion",
}.items():
    query(_query)(_dimension(_table))

for _query, _table in {
    "fact_sales_build": "FactSales",
    "fact_purchases_build": "FactPurchases",
    "fact_inventory_build": "FactInventory",
    "fact_production_build": "FactProduction",
    "fact_employee_sales_build": "FactEmployeeSales",
    "fact_customer_feedback_build": "FactCustomerFeedback",
    "fact_promotion_response_build": "FactPromotionResponse",
    "fact_finance_build": "FactFinance",
    "fact_returns_build": "FactReturns",
}.items():
    query(_query)(_extract(_table))

for _query, _build in {
    "agg_daily_sales": rollups.daily_sales,
    "agg_weekly_sales": rollups.weekly_sales,
    "agg_monthly_sales": rollups.monthly_sales,
    "agg_daily_inventory": rollups.daily_inventory,
    "agg_monthly_product_performance": rollups.monthly_product_performance,
    "agg_regional_sales": rollups.regional_sales,
    "vw_sales_extended_full": views.sales_extended_full,
    "vw_sales_by_customer": views.sales_by_customer,
    "vw_sales_by_product": views.sales_by_product,
    "vw_sales_by_store": views.sales_by_store,
    "vw_sales_by_employee": views.sales_by_employee,
    "vw_inventory_snapshot": views.inventory_snapshot,
    "vw_inventory_by_product": views.inventory_by_product,
    "vw_inventory_by_warehouse": views.inventory_by_warehouse,
    "vw_purchases_extended_full": views.purchases_extended_full,
    "vw_vendor_performance": views.vendor_performance,
    "vw_production_metrics": views.production_metrics,
    "vw_feedback_analysis": views.feedback_analysis,
    "vw_feedback_summary": views.feedback_summary,
    "vw_promotion_response": views.promotion_response,
    "vw_finance_analysis": views.finance_analysis,
    "vw_returns_analysis": views.returns_analysis,
    "vw_return_by_product": views.return_analysis_by_product,
}.items():
    query(_query)(_of_warehouse(_build))


@query("dim_date_build")
def dim_date_build(spark, folder):
    """The calendar from the first to the last order day."""
    orders = read_test_table(spark, folder, "orders")
    span = orders.agg(F.min(F.to_date("o_orderdate")).alias("a"), F.max(F.to_date("o_orderdate")).alias("b"))
    return calendar.calendar_columns(span.select(F.explode(F.sequence("a", "b")).alias("DateKey")))


@query("fact_sales_resolved")
def fact_sales_resolved(spark, folder):
    return warehouse(spark, folder).table("FactSales")


@query("fk_resolve_valid")
def fk_resolve_valid(spark, folder):
    return gapped_warehouse(spark, folder).resolve("FactSales").valid


@query("fk_resolve_errors")
def fk_resolve_errors(spark, folder):
    resolved = gapped_warehouse(spark, folder).resolve("FactSales")
    return resolved.rejected.select(
        fact_builders.record_natural_key(resolved.tagged, "FactSales").alias("RecordNaturalKey"),
        F.concat_ws("; ", "_fk_misses").alias("ErrorMessage"),
    )


@query("error_records_build")
def error_records_build(spark, folder):
    resolved = gapped_warehouse(spark, folder).resolve("FactSales")
    return resolved.errors("batch_1", LOADED_AT, payload_columns=quarantine.PAYLOAD_COLUMNS)


@query("late_dim_default")
def late_dim_default(spark, folder):
    """Late members: the row is loaded with key 0 instead of being quarantined."""
    rows = gapped_warehouse(spark, folder).resolve("FactSales", on_missing="default").valid
    unknown = F.count_if(F.col("CustomerKey") == 0), F.count_if(F.col("ProductKey") == 0)
    return rows.groupBy(F.year("SalesDateKey").alias("SalesYear")).agg(
        F.count(F.lit(1)).alias("LoadedRows"), unknown[0].alias("UnknownCustomers"), unknown[1].alias("UnknownProducts"),
        money_sum("SalesRevenue").alias("Revenue"),
    )


@query("late_dim_query_time")
def late_dim_query_time(spark, folder):
    """Late members: the fact keeps its natural key and is joined when queried."""
    wh = gapped_warehouse(spark, folder)
    rows = fk_ops.attach_current(
        wh.table("extract:FactSales"), wh.table("DimCustomer"), "CustomerID", ["CustomerSegment"]
    )
    return rows.groupBy("CustomerSegment").agg(
        F.count(F.lit(1)).alias("SalesRows"), money_sum("SalesRevenue").alias("Revenue")
    )


@query("dq_fk_miss_rate")
def dq_fk_miss_rate(spark, folder):
    resolved = gapped_warehouse(spark, folder).resolve("FactSales", on_missing="default")
    return fk_ops.miss_rates(resolved.tagged, resolved.spec.fks)


# -- versions --


@query("scd2_history")
def scd2_history(spark, folder):
    return customer_history(spark, folder)


@query("scd2_current")
def scd2_current(spark, folder):
    return customer_history(spark, folder).filter("IsCurrent = 1")


@query("scd2_expired")
def scd2_expired(spark, folder):
    return customer_history(spark, folder).filter("IsCurrent = 0")


@query("scd2_new")
def scd2_new(spark, folder):
    changes = customer_changes(spark, folder).filter(F.col("action").isin(scd.NEW, scd.CHANGED))
    return changes.select("CustomerID", "action", "s.CustomerSegment", "s.ValidFromDate")


@query("scd2_reappeared")
def scd2_reappeared(spark, folder):
    """A member that left and came back goes on from its last version."""
    return customer_history(spark, folder, 3)


@query("sync_summary")
def sync_summary(spark, folder):
    return scd.sync_summary(customer_changes(spark, folder))


@query("scd1_upsert")
def scd1_upsert(spark, folder):
    return scd.scd1_sync(part_feed(spark, folder, 2), part_feed(spark, folder, 1), "ProductID", "ProductKey")


@query("scd1_summary")
def scd1_summary(spark, folder):
    return scd.sync_summary(
        scd.scd1_changes(part_feed(spark, folder, 2), part_feed(spark, folder, 1), "ProductID", "ProductKey")
    )


@query("dedup_latest")
def dedup_latest(spark, folder):
    """The last order of each customer."""
    orders = read_test_table(spark, folder, "orders").selectExpr(
        "o_custkey AS CustomerID", "o_orderkey AS SalesOrderID", "cast(o_orderdate as date) AS OrderDate"
    )
    return scd.dedup_latest(orders, "CustomerID", [F.desc("OrderDate"), F.desc("SalesOrderID")])


@query("latest_versions")
def latest_versions(spark, folder):
    """Re-appended versions collapse to the highest one per member and start."""
    history = customer_history(spark, folder)
    again = history.filter("CustomerID % 3 = 0").withColumn("Version", F.col("Version") + 5)
    return scd.latest_versions(history.unionByName(again), "CustomerID")


@query("asof_dim_lookup")
def asof_dim_lookup(spark, folder):
    return scd.as_of_members(customer_history(spark, folder), dt.date(1999, 6, 1))


def _dated_orders(spark, folder):
    return tpch_sources(spark, folder)["Sales.SalesOrderHeader"].select("SalesOrderID", "CustomerID", "OrderDate", "TotalDue")


@query("asof_sales_by_region")
def asof_sales_by_region(spark, folder):
    return reports.sales_by_segment_as_sold(_dated_orders(spark, folder), customer_history(spark, folder))


# -- cleaning and types --


@query("clean_values")
def clean_values(spark, folder):
    """Raw text dates, missing values and a far-future date, cleaned."""
    raw = read_test_table(spark, folder, "orders").selectExpr(
        "o_orderkey AS OrderID",
        "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_custkey END AS CustomerID",
        "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_custkey END AS Contacts",
        "CASE WHEN o_orderkey % 9 = 0 THEN 'n/a' ELSE date_format(o_orderdate, 'yyyy-MM-dd') END AS OrderDateText",
        "CASE WHEN o_orderkey % 11 = 0 THEN DATE'9999-12-31' ELSE cast(o_orderdate as date) END AS DueDate",
        "cast(o_totalprice as decimal(18,2)) AS Total",
    )
    return cleaning.clean_values(raw, keep=["CustomerID"])


@query("coerce_date")
def coerce_date_query(spark, folder):
    return read_test_table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("OrderID"),
        coerce_date(
            F.when(F.col("o_orderkey") % 4 == 0, F.lit("soon"))
            .when(F.col("o_orderkey") % 4 == 1, F.lit(None))
            .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")),
            AS_OF,
        ).alias("OrderDay"),
    )


@query("surrogate_keys")
def surrogate_keys(spark, folder):
    """Compact and wide keys of every customer."""
    return read_test_table(spark, folder, "customer").select(
        F.col("c_custkey").alias("CustomerID"),
        surrogate_key("c_custkey", F.lit("2014-09-12"), policy=COMPACT_KEYS).alias("CompactKey"),
        surrogate_key("c_custkey", F.lit("2014-09-12"), policy=WIDE_KEYS).alias("WideKey"),
    )


@query("key_collisions")
def key_collisions(spark, folder):
    """Compact keys of the order lines that several (order, product) pairs share."""
    lines = read_test_table(spark, folder, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey").alias("LineID")
    )
    keyed = lines.withColumn("LineKey", surrogate_key("LineID", policy=COMPACT_KEYS))
    return quality.key_collisions(keyed, "LineKey", "LineID")


# -- roll-up variants --


@query("agg_hourly_sales")
def agg_hourly_sales(spark, folder):
    """Purchases per hour and product of the event stream."""
    events = read_test_table(spark, folder, "events").filter("event_type = 'purchase'")
    sales = events.selectExpr(
        "ts AS SoldAt", "event_id DIV 5 AS ProductKey", "cast(value as decimal(18,2)) AS SalesRevenue", "1 AS QuantitySold"
    )
    return rollups.hourly_sales(sales, "SoldAt")


@query("agg_daily_sales_increment")
def agg_daily_sales_increment(spark, folder):
    return rollups.daily_sales_increment(warehouse(spark, folder), dt.date(1998, 3, 2))


@query("rollup_from_agg")
def rollup_from_agg(spark, folder):
    return rollups.daily_revenue_from_rollup(rollups.daily_sales(warehouse(spark, folder)))


@query("precalc_profit")
def precalc_profit(spark, folder):
    wh = warehouse(spark, folder)
    return rollups.profit_by_product(rollups.with_profit(wh.table("FactSales"), wh))


# -- reports and primitives --


@query("report_top_products")
def report_top_products(spark, folder):
    return reports.top_sales(warehouse(spark, folder), dt.date(1998, 1, 1))


@query("sales_by_year")
def sales_by_year(spark, folder):
    return reports.sales_of_year(warehouse(spark, folder), 1998)


@query("sales_by_quarter_semi")
def sales_by_quarter_semi(spark, folder):
    return reports.sales_of_quarter(warehouse(spark, folder), 1999, 2)


@query("sample_avg_revenue")
def sample_avg_revenue(spark, folder):
    sales = warehouse(spark, folder).table("FactSales")
    return reports.sampled_average_revenue(
        sales, 0.1, ("SalesOrderID", "SalesOrderDetailID", "CustomerKey", "StoreKey", "ProductKey")
    )


@query("lateral_latest_store")
def lateral_latest_store(spark, folder):
    return fact_builders.latest_store_by_product(tpch_sources(spark, folder))


@query("range_join_aging")
def range_join_aging(spark, folder):
    """Stock by aging tier through the general range join."""
    stock = _extract("FactInventory")(spark, folder)
    tiers = literal_table(spark, "DimAgingTier")
    joined = joins.range_join(stock, tiers, "StockAging", "MinAgingDays", "MaxAgingDays", ["AgingTierName"])
    return joined.groupBy("AgingTierName").agg(
        F.count(F.lit(1)).alias("StockRows"), F.sum("QuantityOnHand").alias("Quantity")
    )


@query("incremental_extract")
def incremental_extract(spark, folder):
    """Order lines newer than the last loaded day."""
    return sinks.newer_than(_extract("FactSales")(spark, folder), "SalesDateKey", dt.date(2001, 7, 1))


@query("retention_keep")
def retention_keep(spark, folder):
    """What 24 months of retention keep of the sales."""
    kept = sinks.within_retention(_extract("FactSales")(spark, folder), "SalesDateKey", AS_OF, months=24)
    return kept.groupBy("SalesDateKey").agg(F.count(F.lit(1)).alias("KeptRows"))


@query("upsert_keys")
def upsert_keys(spark, folder):
    """Delete and insert by natural key."""
    return sinks.upsert_rows(part_feed(spark, folder, 1), part_feed(spark, folder, 2), ["ProductID"])


@query("delete_by_key")
def delete_by_key(spark, folder):
    gone = part_feed(spark, folder, 1).filter("ListPrice < 950").select("ProductID")
    return sinks.delete_rows(part_feed(spark, folder, 1), gone, ["ProductID"])


@query("update_current_by_key")
def update_current_by_key(spark, folder):
    """Expire the current versions of a list of members."""
    dim = customer_history(spark, folder)
    members = read_test_table(spark, folder, "customer").filter("c_acctbal < 0").selectExpr("c_custkey AS CustomerID")
    return sinks.update_rows(
        dim, members, ["CustomerID"], {"IsCurrent": F.lit(0), "ValidToDate": F.lit(AS_OF)}, F.col("IsCurrent") == 1
    )


# -- errors --


def _errors(spark, folder):
    return test_error_records(spark, folder)


@query("error_classify")
def error_classify(spark, folder):
    return (
        quarantine.classify_errors(_errors(spark, folder))
        .groupBy("ErrorType", "TypeSeverity", "TypeRecoverable", "Handling")
        .agg(F.count(F.lit(1)).alias("ErrorCount"))
    )


def retry_run(spark, folder):
    """Retry all open errors; customers with an even key have arrived by now."""
    when = dt.datetime(2024, 1, 30)
    due = quarantine.retry_candidates(_errors(spark, folder), when)
    spec = fact_builders.FactSpec(
        "Payment", "PaidOn", None, (fact_builders.FKSpec("CustomerKey", "DimCustomer", "CustomerID", "CustomerID", True),),
        ("CustomerID",), (),
    )
    members = (
        read_test_table(spark, folder, "customer")
        .filter("c_custkey % 2 = 0")
        .select(F.col("c_custkey").alias("CustomerID"), surrogate_key("c_custkey").alias("CustomerKey"))
    )
    schema = T.StructType([T.StructField("CustomerID", T.LongType()), T.StructField("Amount", T.DoubleType())])
    # The derived log keeps its record at the top level of the JSON text.
    due = due.withColumn("FailedData", F.concat(F.lit('{"sample":'), "FailedData", F.lit("}")))
    return quarantine.retry_errors(
        due, schema, lambda rows: fk_ops.resolve_fks(rows, spec, lambda fk: members), when
    )


@query("reprocess_resolved")
def reprocess_resolved(spark, folder):
    return retry_run(spark, folder).facts


@query("reprocess_retry")
def reprocess_retry(spark, folder):
    return retry_run(spark, folder).errors.select(
        "ErrorID", "RetryCount", "LastAttemptDate", "IsResolved", "ResolutionComment"
    )


for _query, _build in {
    "mon_error_summary": quality.error_summary,
    "mon_unresolved_critical": quality.unresolved_critical,
    "mon_recovery_rate": quality.recovery_rate,
    "mon_error_trend": quality.error_trend,
    "mon_error_by_table": quality.errors_by_table,
}.items():
    query(_query)(lambda spark, folder, b=_build: b(_errors(spark, folder), ERRORS_AS_OF))


@query("mon_stuck_errors")
def mon_stuck_errors(spark, folder):
    return quality.stuck_errors(_errors(spark, folder))


@query("mon_error_volume")
def mon_error_volume(spark, folder):
    return quality.error_volume_alerts(_errors(spark, folder), limit=70)


@query("mon_daily_trend")
def mon_daily_trend(spark, folder):
    return quality.daily_trend(warehouse(spark, folder).table("FactSales"), "SalesDateKey", dt.date(2001, 8, 1))


@query("mon_freshness")
def mon_freshness(spark, folder):
    """Order lines against their latest shipment, which stands for the load time."""
    lines = read_test_table(spark, folder, "lineitem").select("l_orderkey", "l_shipdate")
    orders = read_test_table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    rows = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return quality.freshness(rows, "l_shipdate", "o_orderdate").drop("LastLoad", "LastEvent")


# -- data quality --


@query("dq_validate_measures")
def dq_validate_measures(spark, folder):
    """Sales with some corrected and some broken rows."""
    rows = read_test_table(spark, folder, "lineitem").selectExpr(
        "l_orderkey AS SalesOrderID",
        "l_linenumber AS SalesOrderDetailID",
        "cast(CASE WHEN l_partkey % 50 = 1 THEN -l_extendedprice WHEN l_partkey % 50 = 2 THEN 0.001"
        " ELSE l_extendedprice END as decimal(18,2)) AS SalesRevenue",
        "cast(CASE WHEN l_suppkey % 10 = 3 THEN 0 ELSE l_quantity END as int) AS QuantitySold",
    )
    failed = quality.MEASURE_RULES.failures(rows)
    return failed.withColumn("Violations", F.concat_ws("; ", "Violations"))


@query("dq_validate_ranges")
def dq_validate_ranges(spark, folder):
    rows = read_test_table(spark, folder, "part").selectExpr(
        "p_partkey AS ProductID",
        "CASE WHEN p_partkey % 31 = 0 THEN 130 ELSE p_size END AS Age",
        "CASE WHEN p_partkey % 17 = 0 THEN -1 ELSE p_size END AS Quantity",
        "cast(CASE WHEN p_partkey % 13 = 0 THEN -p_retailprice ELSE p_retailprice END as decimal(18,2)) AS Price",
        "cast(905 as decimal(18,2)) AS Cost",
    )
    return quality.RANGE_RULES.check(rows).select(
        "ProductID", F.size("Violations").alias("ViolationCount"), F.concat_ws("; ", "Violations").alias("Violations")
    )


@query("dq_null_defaults")
def dq_null_defaults(spark, folder):
    rows = read_test_table(spark, folder, "customer").selectExpr(
        "c_custkey AS CustomerID",
        "CASE WHEN c_custkey % 3 <> 0 THEN c_name END AS CustomerName",
        "CASE WHEN c_custkey % 4 <> 0 THEN lower(c_name) END AS Email",
        "CASE WHEN c_custkey % 5 <> 0 THEN c_nationkey END AS Age",
        "CASE WHEN c_custkey % 6 <> 0 THEN c_acctbal END AS Amount",
    )
    return cleaning.null_defaults(rows, quality.NULL_DEFAULTS)


@query("dq_type_convert")
def dq_type_convert(spark, folder):
    rows = read_test_table(spark, folder, "orders").selectExpr(
        "o_orderkey AS OrderID",
        "CASE WHEN o_orderkey % 10 = 0 THEN 'ABC' ELSE cast(o_custkey as string) END AS Customer",
        "CASE WHEN o_orderkey % 10 = 1 THEN '12/31/1999' ELSE date_format(o_orderdate, 'yyyy-MM-dd') END AS Ordered",
    )
    converted = cleaning.convert_types(rows, {"Customer": "bigint", "Ordered": "date"})
    return converted.withColumn("ConversionErrors", F.concat_ws("; ", "ConversionErrors"))


def _doubled_lines(spark, folder):
    """The order lines with a third of them loaded twice."""
    lines = read_test_table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"
    )
    return lines.unionByName(lines.filter("l_partkey % 3 = 0"))


@query("dq_distinct")
def dq_distinct(spark, folder):
    return quality.distinct_rows(_doubled_lines(spark, folder))


@query("dq_unique_only")
def dq_unique_only(spark, folder):
    return quality.keys_occurring_once(_doubled_lines(spark, folder), ["l_orderkey", "l_linenumber"])


@query("dq_duplicate_grain")
def dq_duplicate_grain(spark, folder):
    return quality.duplicate_grain(_extract("FactSales")(spark, folder), ["SalesOrderID", "SalesOrderDetailID"])


@query("dq_multi_current")
def dq_multi_current(spark, folder):
    """A history in which the expiry of some members was forgotten."""
    history = customer_history(spark, folder)
    broken = history.withColumn(
        "IsCurrent", F.when(F.col("CustomerID") % 20 == 3, F.lit(1)).otherwise(F.col("IsCurrent"))
    )
    return quality.multiple_current(broken, "CustomerID")


@query("dq_load_anomaly")
def dq_load_anomaly(spark, folder):
    return quality.load_anomalies(_extract("FactSales")(spark, folder), "SalesDateKey")


@query("dq_null_profile")
def dq_null_profile(spark, folder):
    return quality.null_profile(
        _extract("FactSales")(spark, folder), ["CustomerID", "ProductID", "StoreID", "EmployeeID", "SalesRevenue"]
    )


@query("dq_negative_amounts")
def dq_negative_amounts(spark, folder):
    accounts = read_test_table(spark, folder, "customer").select("c_custkey", "c_acctbal")
    return quality.negative_amounts(accounts, "c_acctbal", ["c_acctbal", "c_custkey"])


@query("dq_rowcount_drift")
def dq_rowcount_drift(spark, folder):
    return quality.rowcount_drift(_extract("FactSales")(spark, folder), "SalesDateKey", low=10, high=40)


@query("dq_orphan_fk")
def dq_orphan_fk(spark, folder):
    wh = warehouse(spark, folder)
    stores = wh.table("DimStore").filter("StoreID % 11 <> 5")
    return quality.orphan_keys(wh.table("FactSales"), "StoreKey", stores, "StoreKey")


@query("dq_reconcile")
def dq_reconcile(spark, folder):
    """Extracted against loaded sales while some members are late."""
    wh = gapped_warehouse(spark, folder)
    return quality.reconcile(
        wh.table("extract:FactSales"), wh.resolve("FactSales").valid, "SalesDateKey", "SalesRevenue"
    )


@query("dq_pk_checks")
def dq_pk_checks(spark, folder):
    rows = read_test_table(spark, folder, "lineitem").selectExpr(
        "CASE WHEN l_partkey % 100 = 0 THEN NULL ELSE l_orderkey END AS OrderID", "l_linenumber AS LineID"
    )
    checked = quality.primary_key_checks(quality.assert_schema(rows, ["OrderID", "LineID"]), ["OrderID", "LineID"])
    return checked.groupBy("KeyCheck").agg(F.count(F.lit(1)).alias("CheckedRows"))


@query("approx_customer_reach")
def approx_customer_reach(spark, folder):
    """The approximate variant of the distinct counts (no exact answer to compare with)."""
    wh = warehouse(spark, folder)
    return views.sales_by_store(wh, approximate=True).select("StoreKey", "UniqueCustomers", "ProductsOffered")


@query("customer_order_averages")
def customer_order_averages(spark, folder):
    """Aggregates with zero guards over the orders of each customer."""
    header = tpch_sources(spark, folder)["Sales.SalesOrderHeader"]
    return header.groupBy("CustomerID").agg(
        F.count(F.lit(1)).alias("OrderCount"),
        money_sum("TotalDue").alias("LifetimeValue"),
        exact_avg("TotalDue").alias("AvgOrderValue"),
        F.min("OrderDate").alias("FirstOrderDate"),
        F.max("OrderDate").alias("LastOrderDate"),
    )


# -- streams: the table's files arrive, the query runs until it has taken them all --


@query("stream_monthly_sales")
def stream_monthly_sales(spark, folder):
    """Monthly sales from partial states kept per micro-batch."""
    src = tpch_sources(spark, folder, lineitem=stream_test_table(spark, folder, "lineitem"))
    sales = fact_builders.build_fact_sales(src, AS_OF).withColumn("Month", truncate("month", "SalesDateKey"))
    state = RollupState(keys=("Month",), measure="SalesRevenue", distinct="CustomerID")
    path = scratch_dir(spark, "stream")
    maintain_rollup(sales, state, f"{path}/state", f"{path}/checkpoint").awaitTermination()
    return read_rollup(spark, state, f"{path}/state")


@query("stream_hourly_events")
def stream_hourly_events(spark, folder):
    """Event values per hour and type in tumbling windows with a watermark."""
    events = stream_test_table(spark, folder, "events")
    hours = hourly_sums(events, "ts", ["event_type"], F.col("value").cast("decimal(18,2)"))
    path = scratch_dir(spark, "stream")
    write_updates(hours, f"{path}/hours", f"{path}/checkpoint").awaitTermination()
    updates = spark.read.parquet(f"{path}/hours")
    return scd.dedup_latest(updates, ["SalesHour", "event_type"], [F.desc("batch_id")]).drop("batch_id")


@query("stream_fact_load")
def stream_fact_load(spark, folder):
    """Order lines resolved as they arrive, while some members are late."""
    src = tpch_sources(spark, folder, lineitem=stream_test_table(spark, folder, "lineitem"))
    sales, path = fact_builders.build_fact_sales(src, AS_OF), scratch_dir(spark, "stream")
    key_maps = gapped_warehouse(spark, folder).key_map
    load_fact_stream(
        sales, fact_builders.FACTS["FactSales"], key_maps, path, f"{path}/checkpoint", LOADED_AT
    ).awaitTermination()
    return spark.read.parquet(f"{path}/FactSales").drop("batch_id")


def _arrive(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


@query("stream_late_hours")
def stream_late_hours(spark, folder):
    """Event values per hour in four blocks, the last one with events that are up to weeks late."""
    events, path = read_test_table(spark, folder, "events"), scratch_dir(spark, "stream")
    late, amount = "event_id % 10 = 7", F.col("value").cast("decimal(18,2)")
    parts = [f"NOT {late} AND ts < '2024-01-11'", f"NOT {late} AND ts >= '2024-01-11' AND ts < '2024-01-21'", f"NOT {late} AND ts >= '2024-01-21'", late]
    for part in parts:
        _arrive(events.filter(part), f"{path}/events")
        stream = spark.readStream.schema(events.schema).parquet(f"{path}/events")
        maintain_hours(stream, "ts", ["event_type"], amount, f"{path}/state", f"{path}/checkpoint").awaitTermination()
    return read_hours(spark, f"{path}/state", ["event_type"])


@query("stream_waiting_facts")
def stream_waiting_facts(spark, folder):
    """Order lines in three blocks; those of unknown customers and products wait until these are known."""
    lines, path = read_test_table(spark, folder, "lineitem"), scratch_dir(spark, "stream")
    _arrive(lines.limit(0), f"{path}/lines")  # the folder has to be there
    stream = spark.readStream.schema(lines.schema).parquet(f"{path}/lines")
    sales = fact_builders.build_fact_sales(tpch_sources(spark, folder, lineitem=stream), AS_OF)
    members = [gapped_warehouse(spark, folder)]
    load = WaitingLoad(spark, fact_builders.FACTS["FactSales"], sales.schema, lambda fk: members[-1].key_map(fk), path)
    for number, part in enumerate(("l_linenumber <= 2", "l_linenumber IN (3, 4)", "l_linenumber > 4")):
        if number == 2:
            members.append(warehouse(spark, folder))  # the late members are here
        _arrive(lines.filter(part), f"{path}/lines")
        load.start(sales, f"{path}/checkpoint").awaitTermination()
        for _ in range(2):
            load.release(number)
    return load.facts()


@query("stream_dimension_merge")
def stream_dimension_merge(spark, folder):
    """Customer versions from a change feed in three blocks: several versions of a member in one of them, one out of order."""
    customers, path = read_test_table(spark, folder, "customer"), scratch_dir(spark, "stream")

    def change(where: str, day: str, segment: str = "c_mktsegment") -> DataFrame:
        rows = customers.filter(where).selectExpr(
            "c_custkey AS CustomerID", "c_name AS CustomerName", f"{segment} AS CustomerSegment", f"DATE'{day}' AS ValidFromDate"
        )
        return rows.select(surrogate_key("CustomerID", "ValidFromDate").alias("CustomerKey"), *rows.columns)

    def union(*parts: DataFrame) -> DataFrame:
        return reduce(DataFrame.unionByName, parts)

    moved, repeated, new = "c_custkey % 10 = 3", "c_custkey % 10 = 4", "c_custkey % 13 = 1"
    blocks = (
        change(f"NOT {new}", "1996-01-01"),
        union(
            change(moved, "2001-01-01", "concat('A ', c_mktsegment)"), change(moved, "2000-06-01", "concat('B ', c_mktsegment)"),
            change(moved, "2000-01-01", "concat('A ', c_mktsegment)"), change(repeated, "2000-03-01"), change(f"{new} AND NOT {moved}", "2000-01-01"),
        ),
        union(change(moved, "1998-01-01", "concat('EARLY ', c_mktsegment)"), change(repeated, "1996-01-01", "'OTHER'")),
    )
    log = ChangeLog(spark, f"{path}/DimCustomer", "CustomerID", "CustomerKey", buckets=4)
    for block in blocks:
        _arrive(block, f"{path}/feed")
        log.start(spark.readStream.schema(block.schema).parquet(f"{path}/feed"), f"{path}/checkpoint").awaitTermination()
    log.fold(at_least=3)
    return log.versions()


# -- operations on stored tables ------------------------------------------------------

for _query, _build in operations.QUERIES.items():
    query(_query)(_build)
