"""Key resolution, quarantine, retry, sinks and the batch run."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators import quality, quarantine, sinks
from starloom.operators.facts import FACTS, FactSpec, FKSpec
from starloom.operators.fk import key_map, miss_rates, resolve_fks
from starloom.operators.rollups import ROLLUPS
from starloom.plans import batch, views
from starloom.plans.registry import warehouse
from starloom.plans.warehouse import Warehouse
from starloom.sources.catalog import Sources
from starloom.sources.tpch import AS_OF, CALENDAR_START, tpch_sources
from tests.conftest import SMALL

D = dt.date
NOW = dt.datetime(2025, 11, 11, 3)

SPEC = FactSpec(
    "FactSales", "SalesDateKey", None,
    (FKSpec("CustomerKey", "DimCustomer", "CustomerID", "CustomerID", True),
     FKSpec("StoreKey", "DimStore", "StoreID", "StoreID", False)),
    ("SalesOrderID", "SalesOrderDetailID"), ("CustomerKey",),
)
FACT = "SalesDateKey DATE, CustomerID BIGINT, StoreID BIGINT, SalesOrderID INT, SalesOrderDetailID INT, SalesRevenue DOUBLE"


def members(spark):
    customers = spark.createDataFrame(
        [(500, 1001, 0), (500, 1002, 1), (0, 1000, 1)], "CustomerID BIGINT, CustomerKey BIGINT, IsCurrent INT"
    )
    stores = spark.createDataFrame([(1, 11, 1)], "StoreID BIGINT, StoreKey BIGINT, IsCurrent INT")
    tables = {"DimCustomer": (customers, "CustomerKey"), "DimStore": (stores, "StoreKey")}
    return lambda fk: key_map(tables[fk.dim][0], fk, tables[fk.dim][1])


def rows(spark):
    return spark.createDataFrame(
        [
            (D(2025, 11, 1), 500, 1, 1, 1, 10.0),
            (D(2025, 11, 1), 500, None, 2, 1, 20.0),
            (D(2025, 11, 2), 500, 99, 3, 1, 30.0),
            (D(2025, 11, 2), 999, 1, 4, 3, 450.5),
            (D(2025, 11, 2), None, 1, 5, 1, 50.0),
            (D(2025, 11, 2), 0, 1, 6, 1, 60.0),
        ],
        FACT,
    )


def test_misses_are_quarantined_and_nothing_is_lost(spark):
    resolved = resolve_fks(rows(spark), SPEC, members(spark))
    valid = {r.SalesOrderID: (r.CustomerKey, r.StoreKey) for r in resolved.valid.collect()}
    assert valid == {1: (1002, 11), 2: (1002, 0), 3: (1002, 0), 6: (1000, 11)}
    errors = {r.RecordNaturalKey: r for r in resolved.errors("b1", NOW).collect()}
    assert {k: e.ErrorMessage for k, e in errors.items()} == {
        "4-3": "FK miss: DimCustomer.CustomerID=999 not found (IsCurrent=1)",
        "5-1": "CustomerID is NULL (required for CustomerKey)",
    }
    error = errors["4-3"]
    assert list(error.asDict()) == list(quarantine.ERROR_COLUMNS)
    assert (error.ErrorType, error.ErrorSeverity, error.IsRecoverable, error.RetryCount, error.IsResolved) == (
        "FK_MISS", "WARNING", 1, 0, 0
    )
    assert json.loads(errors["5-1"].FailedData)["sample"]["CustomerID"] is None
    assert json.loads(error.FailedData)["sample"]["SalesRevenue"] == 450.5
    assert len(valid) + len(errors) == rows(spark).count()


def test_error_ids_do_not_depend_on_the_run(spark):
    ids = [
        {r.ErrorID for r in resolve_fks(rows(spark), SPEC, members(spark)).errors("b1", NOW).collect()} for _ in range(2)
    ]
    assert ids[0] == ids[1] and len(ids[0]) == 2


def test_late_members_can_be_loaded_with_the_default_key(spark):
    resolved = resolve_fks(rows(spark), SPEC, members(spark), on_missing="default")
    assert resolved.valid.count() == 6 and resolved.rejected.count() == 0
    rates = {r.ForeignKey: r for r in miss_rates(resolved.tagged, SPEC.fks).collect()}
    assert (rates["CustomerKey"].Misses, rates["CustomerKey"].Alert) == (2, 1)
    with pytest.raises(ValueError):
        resolve_fks(rows(spark), SPEC, members(spark), on_missing="guess")


def test_retry_resolves_or_counts_and_keeps_every_error(spark):
    schema = T.StructType.fromDDL(FACT)
    errors = resolve_fks(rows(spark), SPEC, members(spark)).errors("b1", NOW, payload_columns=None)
    exhausted = errors.filter("RecordNaturalKey = '5-1'").withColumns(
        {"ErrorID": F.lit(1).cast("bigint"), "RetryCount": F.lit(3)}
    )
    log = errors.unionByName(exhausted)
    arrived = spark.createDataFrame([(999, 1999, 1)], "CustomerID BIGINT, CustomerKey BIGINT, IsCurrent INT")
    known = members(spark)

    def maps(fk):
        return known(fk).unionByName(arrived.select("CustomerID", "CustomerKey")) if fk.dim == "DimCustomer" else known(fk)

    later = NOW + dt.timedelta(hours=1)
    due = quarantine.retry_candidates(log, later)
    assert due.count() == 2
    outcome = quarantine.retry_errors(due, schema, lambda r: resolve_fks(r, SPEC, maps), later)
    (fact,) = outcome.facts.collect()
    assert (fact.CustomerKey, fact.StoreKey, fact.SalesRevenue, fact.SalesDateKey) == (1999, 11, 450.5, D(2025, 11, 2))
    after = {(r.RecordNaturalKey, r.ErrorID == 1): r for r in quarantine.apply_error_updates(log, outcome.errors).collect()}
    solved, retried, untouched = after["4-3", False], after["5-1", False], after["5-1", True]
    assert (solved.IsResolved, solved.ResolutionComment, solved.RetryCount) == (1, "Auto-resolved on retry", 0)
    assert (retried.IsResolved, retried.RetryCount, retried.LastAttemptDate) == (0, 1, later)
    assert (untouched.RetryCount, untouched.LastAttemptDate) == (3, None)
    assert len(after) == 3


def test_retry_takes_the_longest_waiting_first(spark):
    log = spark.createDataFrame(
        [(i, NOW, 0, 1, 0, NOW - dt.timedelta(hours=i) if i else None) for i in range(5)],
        "ErrorID INT, ErrorDate TIMESTAMP, IsResolved INT, IsRecoverable INT, RetryCount INT, LastAttemptDate TIMESTAMP",
    )
    assert [r.ErrorID for r in quarantine.retry_candidates(log, NOW, limit=3).collect()] == [0, 4, 3]
    assert quarantine.retry_candidates(log, NOW, limit=None).count() == 5


def test_hot_and_missing_keys_keep_all_rows(spark):
    facts = spark.range(30000).selectExpr(
        "DATE'2025-01-01' AS SalesDateKey", "500L AS CustomerID", "IF(id % 3 = 0, NULL, 1L) AS StoreID",
        "cast(id as int) AS SalesOrderID", "1 AS SalesOrderDetailID", "1.0D AS SalesRevenue",
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        valid = resolve_fks(facts, SPEC, members(spark)).valid
        assert "SortMergeJoin" in valid._jdf.queryExecution().toString()
        counts = {r.StoreKey: r["count"] for r in valid.groupBy("StoreKey").count().collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert counts == {0: 10000, 11: 20000}


def test_schema_check(spark):
    df = spark.range(1)
    assert quality.assert_schema(df, ["id"]) is df
    with pytest.raises(quality.SchemaMismatch, match="missing"):
        quality.assert_schema(df, ["missing"])
    with pytest.raises(quality.SchemaMismatch):
        quality.assert_schema(df, T.StructType([T.StructField("id", T.StringType())]))


def test_loading_a_day_twice_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    day = spark.createDataFrame([(D(2025, 1, d), d * 10 + i) for d in (1, 2) for i in range(3)], "day DATE, v INT")
    for _ in range(2):
        sinks.overwrite_partitions(day, path, "day", ["v"])
    sinks.overwrite_partitions(day.filter("v < 11").withColumn("v", F.lit(99)), path, "day")
    got = sorted((r.day.day, r.v) for r in spark.read.parquet(path).collect())
    assert got == [(1, 99), (2, 20), (2, 21), (2, 22)]
    plan = spark.read.parquet(path).filter("day = DATE'2025-01-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_append_adds_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(2):
        sinks.append(spark.range(3).toDF("v"), path)
    assert spark.read.parquet(path).count() == 6


def test_versions_retention_and_distinct_rebuild(spark, tmp_path):
    path, archive = str(tmp_path / "t"), str(tmp_path / "old")
    assert sinks.current_version(spark, path) is None
    df = spark.createDataFrame([(D(2020, 1, 1), 1), (D(2025, 1, 1), 2), (D(2025, 1, 1), 2)], "day DATE, v INT")
    sinks.publish(df, path, "v1")
    sinks.rebuild_distinct(spark, path, "v2")
    assert sinks.current_version(spark, path) == "v2" and sinks.read_table(spark, path).count() == 2
    sinks.apply_retention(spark, path, "day", D(2025, 11, 11), "v3", archive, months=24)
    assert [r.v for r in sinks.read_table(spark, path).collect()] == [2]
    assert [r.v for r in spark.read.parquet(archive).collect()] == [1]
    with pytest.raises(ValueError):
        sinks.within_retention(df, "day", D(2025, 1, 1))


def test_update_delete_upsert(spark):
    table = spark.createDataFrame([(1, "a", 1), (2, "b", 0), (3, "c", 1)], "k INT, v STRING, live INT")
    keys = spark.createDataFrame([(1,), (2,)], "k INT")
    updated = sinks.update_rows(table, keys, ["k"], {"v": F.lit("x")}, F.col("live") == 1)
    assert sorted(tuple(r) for r in updated.collect()) == [(1, "x", 1), (2, "b", 0), (3, "c", 1)]
    assert [r.k for r in sinks.delete_rows(table, keys, ["k"]).collect()] == [3]
    new = spark.createDataFrame([(3, "z", 1), (4, "d", 1)], "k INT, v STRING, live INT")
    assert sorted(r.v for r in sinks.upsert_rows(table, new, ["k"]).collect()) == ["a", "b", "d", "z"]


def test_files_as_source(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "Sales" / "Customer"))
    src = Sources.from_files(spark, str(tmp_path))
    assert src["Sales.Customer"].count() == 3
    assert "Sales.Store" in src and len(src) == 31


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """A batch whose sales miss some customers, then a second one in which they have arrived."""
    root = str(tmp_path_factory.mktemp("warehouse"))
    src = tpch_sources(spark, SMALL)
    # A few months of orders: the facts have one folder per day.
    src = src.replaced(Sales__SalesOrderHeader=src["Sales.SalesOrderHeader"].filter("OrderDate >= DATE'2001-06-01'"))
    late = src.replaced(Sales__Customer=src["Sales.Customer"].filter("CustomerID % 50 <> 7"))
    batch.load_dimensions(spark, late, root, AS_OF, "b1", calendar_start=CALENDAR_START)
    loaded = dt.datetime(2001, 12, 1, 2)
    names = ["FactSales", "FactReturns", "FactInventory"]
    batch.load_facts(spark, src, root, AS_OF, "b1", names=names, loaded_at=loaded)
    return root, src, names, loaded


def test_batch_accounts_for_every_row_and_is_repeatable(spark, stored):
    root, src, names, loaded = stored
    def counts():
        wh = Warehouse.from_storage(spark, root)
        errors = wh.table("error_records").groupBy("SourceTable").count().collect()
        return wh.table("FactSales").count(), {r.SourceTable: r["count"] for r in errors}

    first = counts()
    assert first[0] + first[1]["FactSales"] == FACTS["FactSales"].build(src, AS_OF).count()
    assert first[1]["FactSales"] > 0
    batch.load_facts(spark, src, root, AS_OF, "b1", names=names, loaded_at=loaded)
    assert counts() == first


def test_stored_rollups_conserve_revenue_and_refresh_by_period(spark, stored):
    root = stored[0]
    wh = Warehouse.from_storage(spark, root)
    total = wh.table("FactSales").agg(F.sum("SalesRevenue")).collect()[0][0]
    for name in ROLLUPS:
        batch.refresh_rollup(spark, root, name)
        rows = sinks.read_table(spark, f"{root}/{name}")
        if "RevenueSum" in rows.columns:
            assert rows.agg(F.sum("RevenueSum")).collect()[0][0] == total, name
    before = sorted(map(str, sinks.read_table(spark, f"{root}/agg_weekly_sales").collect()))
    batch.refresh_rollup(spark, root, "agg_weekly_sales", since=D(2001, 7, 4))
    assert sorted(map(str, sinks.read_table(spark, f"{root}/agg_weekly_sales").collect())) == before


def test_views_run_on_the_stored_warehouse(spark, stored):
    wh = Warehouse.from_storage(spark, stored[0])
    assert views.sales_by_customer(wh).count() == wh.current("DimCustomer").count()
    assert views.sales_extended_full(wh).count() == wh.table("FactSales").count()


def test_arrived_members_are_retried(spark, stored):
    root, src, _, loaded = stored
    batch.load_dimensions(spark, src, root, AS_OF, "b2", names=["DimCustomer"], calendar_start=CALENDAR_START)
    spec = FACTS["FactSales"]
    before = Warehouse.from_storage(spark, root)
    open_errors = before.table("error_records").filter("SourceTable = 'FactSales' AND IsResolved = 0").count()
    facts = before.table("FactSales").count()
    schema = batch.record_schema(src, spec, AS_OF)
    batch.retry_fact(spark, spec, schema, root, "r1", loaded + dt.timedelta(hours=1), limit=None)
    after = Warehouse.from_storage(spark, root)
    assert after.table("FactSales").count() == facts + open_errors
    log = after.table("error_records").filter("SourceTable = 'FactSales'")
    assert log.filter("IsResolved = 0").count() == 0 and log.count() == open_errors


def test_facts_of_expired_versions_lose_attributes_unless_asked_for(spark):
    wh = warehouse(spark, SMALL)
    expired = wh.table("DimCustomer").withColumn("IsCurrent", F.when(F.col("CustomerID") % 2 == 0, 1).otherwise(0))
    wh = wh.replaced(DimCustomer=expired, FactSales=wh.table("FactSales"))
    missing = F.count_if(F.col("CustomerName").isNull())
    assert views.sales_extended_full(wh).agg(missing).collect()[0][0] > 0
    assert views.sales_extended_full(wh, version="as_loaded").agg(missing).collect()[0][0] == 0


def test_views_can_be_queried_by_name(spark):
    views.create_views(warehouse(spark, SMALL))
    row = spark.sql("SELECT count(*) AS n, count(DISTINCT StoreKey) AS s FROM vw_sales_by_store").collect()[0]
    assert row.n == row.s == 10


def test_tables_are_written_with_their_declared_types(spark, stored):
    from starloom.schemas import TABLES, table_schema

    wh = Warehouse.from_storage(spark, stored[0])
    for name in ("DimCustomer", "DimProduct", "DimStore", "DimVendor", "DimDate", "FactSales", "FactReturns"):
        assert {f.name: f.dataType for f in wh.table(name).schema} == {
            f.name: f.dataType for f in table_schema(name)
        }, name
    for view in TABLES:
        table_schema(view)


def test_plans_have_no_cross_joins_and_prune_columns(spark):
    from starloom.plans.registry import QUERIES

    for name in ("agg_daily_sales", "agg_daily_inventory", "vw_sales_extended_full", "vw_return_by_product"):
        plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan, name
    plan = QUERIES["mon_error_summary"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(event_type,error)" in plan and "user_id" not in plan.split("ReadSchema")[1]


def test_year_filter_on_the_calendar_prunes_stored_days(spark, stored):
    from starloom.plans.reports import sales_of_quarter, sales_of_year

    wh = Warehouse.from_storage(spark, stored[0])
    for report in (sales_of_year(wh, 2001), sales_of_quarter(wh, 2001, 3)):
        assert "dynamicpruning" in report._jdf.queryExecution().executedPlan().toString()
    laid = sinks.laid_out(wh.table("FactSales"), "SalesDateKey", ["ProductKey"])
    assert "Rebalance" in laid._jdf.queryExecution().optimizedPlan().toString()


def test_upsert_matches_null_keys(spark):
    table = spark.createDataFrame([(1, None, 5), (1, "a", 6), (None, None, 7)], "k int, l string, v int")
    rows = spark.createDataFrame([(1, None, 50), (None, None, 70)], "k int, l string, v int")
    once = sinks.upsert_rows(table, rows, ["k", "l"])
    assert sorted(r.v for r in sinks.upsert_rows(once, rows, ["k", "l"]).collect()) == [6, 50, 70]


def test_pointer_is_replaced_whole(spark, tmp_path):
    path = str(tmp_path / "t")
    for version in ("v1", "v2"):
        sinks.publish(spark.createDataFrame([(version,)], "v string"), path, version)
    assert sinks.current_version(spark, path) == "v2" and not list((tmp_path / "t").glob("_NEXT-*"))
    (tmp_path / "t" / "._CURRENT.crc").unlink(missing_ok=True)
    (tmp_path / "t" / "_CURRENT").write_text("")
    with pytest.raises(ValueError):
        sinks.read_table(spark, path)


def test_repeated_archive_keeps_each_row_once(spark, tmp_path):
    path, archive = str(tmp_path / "t"), str(tmp_path / "old")
    rows = spark.createDataFrame([(D(2020, 1, 1), 1), (D(2025, 11, 1), 2)], "day date, v int")
    sinks.publish(rows, path, "v1")
    for _ in range(2):  # the second run starts from the table as it was
        sinks.publish(rows, path, "v1")
        sinks.apply_retention(spark, path, "day", D(2025, 11, 11), "v2", archive, months=24)
    sinks.apply_retention(spark, path, "day", D(2025, 11, 11), "v2b", archive, months=24)
    assert [r.v for r in spark.read.parquet(archive).collect()] == [1]
