import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starloom.operators import scd, sinks
from starloom.operators.facts import FactSpec, FKSpec
from starloom.streaming.loads import load_fact_stream, merge_dimension_stream
from starloom.streaming.rollups import (
    RollupState,
    compact_partials,
    hourly_sums,
    maintain_rollup,
    read_rollup,
    write_updates,
)

D = dt.date
SALES = "Month DATE, CustomerID INT, SalesRevenue DECIMAL(18,2)"


def arrive(spark, rows, schema, folder):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def stream(spark, schema, folder):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


@pytest.mark.parametrize("sketch", [False, True])
def test_streamed_rollup_equals_batch(spark, tmp_path, sketch):
    folder, path = str(tmp_path / "in"), str(tmp_path / "state")
    rows = [(D(2025, 1 + i % 3, 1), i % 7, i) for i in range(60)]
    state = RollupState(("Month",), "SalesRevenue", "CustomerID", sketch)
    for part in (rows[:20], rows[20:25], rows[25:]):
        arrive(spark, [(m, c, Decimal(v)) for m, c, v in part], SALES, folder)
        maintain_rollup(stream(spark, SALES, folder), state, path, str(tmp_path / "cp")).awaitTermination()
    compact_partials(spark, state, path, str(tmp_path / "compact"))
    for place in (path, str(tmp_path / "compact")):
        got = {r.Month.month: r for r in read_rollup(spark, state, place).collect()}
        for month in (1, 2, 3):
            values = [v for m, _, v in rows if m.month == month]
            r = got[month]
            assert (r.RevenueSum, r.RowCount, r.RevenueMin, r.RevenueMax) == (
                sum(values), len(values), min(values), max(values)
            )
            assert r.DistinctMembers == 7
    assert len(list((tmp_path / "state" / "partials").glob("batch_id=*"))) == 3


def test_replayed_block_counts_once(spark, tmp_path):
    folder, path = str(tmp_path / "in"), str(tmp_path / "state")
    state = RollupState(("Month",), "SalesRevenue")
    arrive(spark, [(D(2025, 1, 1), 1, Decimal(5))], SALES, folder)
    for checkpoint in ("a", "b"):  # a lost checkpoint replays batch 0
        maintain_rollup(stream(spark, SALES, folder), state, path, str(tmp_path / checkpoint)).awaitTermination()
    assert read_rollup(spark, state, path).collect()[0].RevenueSum == 5


def test_hours_take_updates_and_drop_what_is_too_late(spark, tmp_path):
    folder, path = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "ts TIMESTAMP, k STRING, v INT"
    T = dt.datetime
    for rows in ([(T(2025, 1, 1, 10, 5), "a", 1)], [(T(2025, 1, 1, 10, 50), "a", 2), (T(2025, 1, 1, 14), "a", 3)],
                 [(T(2025, 1, 1, 10, 59), "a", 100)]):
        arrive(spark, rows, schema, folder)
        hours = hourly_sums(stream(spark, schema, folder), "ts", ["k"], F.col("v"))
        write_updates(hours, path, str(tmp_path / "cp")).awaitTermination()
    latest = scd.dedup_latest(spark.read.parquet(path), ["SalesHour", "k"], [F.desc("batch_id")])
    assert {r.SalesHour.hour: r.Revenue for r in latest.collect()} == {10: 3, 14: 3}


def test_fact_stream_splits_valid_rows_and_errors(spark, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "SalesDateKey DATE, CustomerID INT, SalesOrderID INT"
    spec = FactSpec(
        "FactSales", "SalesDateKey", None, (FKSpec("CustomerKey", "DimCustomer", "CustomerID", "CustomerID", True),),
        ("SalesOrderID",), (),
    )
    known = spark.createDataFrame([(1, 101)], "CustomerID INT, CustomerKey BIGINT")
    arrive(spark, [(D(2025, 1, 1), 1, 1), (D(2025, 1, 1), 2, 2)], schema, folder)
    arrive(spark, [(D(2025, 1, 2), 1, 3)], schema, folder)
    load_fact_stream(stream(spark, schema, folder), spec, lambda fk: known, root, str(tmp_path / "cp")).awaitTermination()
    facts = sorted((r.CustomerKey, r.SalesOrderID) for r in spark.read.parquet(f"{root}/FactSales").collect())
    assert facts == [(101, 1), (101, 3)]
    (error,) = spark.read.parquet(f"{root}/error_records").collect()
    assert error.RecordNaturalKey == "2" and '"CustomerID":2' in error.FailedData


def test_change_feed_keeps_members_it_does_not_mention(spark, tmp_path):
    folder, path = str(tmp_path / "in"), str(tmp_path / "dim")
    schema = "K BIGINT, ID BIGINT, Name STRING, ValidFromDate DATE, ValidToDate DATE, IsCurrent INT, Version BIGINT"

    def feed(*rows):
        arrive(spark, [(k, i, n, d, None, 1, 1) for k, i, n, d in rows], schema, folder)
        merge_dimension_stream(
            stream(spark, schema, folder), path, "ID", "K", str(tmp_path / "cp")
        ).awaitTermination()

    feed((1, 1, "a", D(2020, 1, 1)), (2, 2, "b", D(2020, 1, 1)))
    feed((3, 1, "A", D(2021, 1, 1)))
    rows = sorted((r.ID, r.Version, r.Name, r.IsCurrent) for r in sinks.read_table(spark, path).collect())
    assert rows == [(1, 1, "a", 0), (1, 2, "A", 1), (2, 1, "b", 1)]
