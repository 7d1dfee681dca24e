"""Streams that keep late rows, waiting facts and several versions of a member in one block."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators import files
from starloom.operators.facts import FactSpec, FKSpec
from starloom.streaming.changes import ChangeLog
from starloom.streaming.rollups import maintain_hours, read_hours
from starloom.streaming.waiting import WaitingLoad

D, NOW = dt.date, dt.datetime(2025, 1, 9)
SPEC = FactSpec(
    "FactOther", "Day", None, (FKSpec("CustomerKey", "DimCustomer", "CustomerID", "CustomerID", True),), ("OrderID",), (),
)
FACT = "Day DATE, CustomerID INT, OrderID INT"


def known(spark, *ids):
    return lambda fk: spark.createDataFrame([(i, 100 + i) for i in ids], "CustomerID INT, CustomerKey BIGINT")


def test_late_rows_reach_closed_hours(spark, tmp_path):
    path, schema, at = str(tmp_path), "ts TIMESTAMP, k STRING, v INT", lambda d, h, m=0: dt.datetime(2025, 1, d, h, m)
    blocks = [
        [(at(1, 10, 5), "a", 1), (at(1, 10, 50), None, 2)], [(at(5, 14), "a", 3)],
        [(at(1, 10, 59), "a", 100), (at(1, 9), None, 7), (at(5, 13, 59), "a", 9)], [],
    ]
    for rows in blocks:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{path}/in")
        stream = spark.readStream.schema(schema).parquet(f"{path}/in")
        maintain_hours(stream, "ts", ["k"], F.col("v"), f"{path}/state", f"{path}/cp").awaitTermination()
    wanted = {(1, 10, "a"): (101, 2, 1), (1, 10, None): (2, 1, 0), (1, 9, None): (7, 1, 1), (5, 14, "a"): (3, 1, 0), (5, 13, "a"): (9, 1, 0)}

    def hours():
        return {(r.SalesHour.day, r.SalesHour.hour, r.k): (r.Revenue, r.TransactionCount, r.LateCount) for r in read_hours(spark, f"{path}/state", ["k"]).collect()}

    assert hours() == wanted
    # all blocks again as one, under the numbers of the first: a replay replaces, it does not add
    maintain_hours(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in"), "ts", ["k"], F.col("v"), f"{path}/state", f"{path}/cp2").awaitTermination()
    assert sum(v[1] for v in hours().values()) == 6


def test_facts_wait_for_their_members(spark, tmp_path):
    schema = T.StructType.fromDDL(FACT)
    load = WaitingLoad(spark, SPEC, schema, known(spark, 1), str(tmp_path / "w"))
    day = D(2025, 1, 1)
    blocks = [[(day, 1, 1), (day, 2, 2), (day, 2, 2), (day, None, 3)], [(day, 3, 4), (day, 1, None)]]
    for number, rows in enumerate(blocks):
        for _ in range(2):  # a replayed block replaces itself
            load.take(spark.createDataFrame(rows, schema), number)

    def facts():
        return sorted((r.CustomerKey, r.OrderID) for r in load.facts().collect())

    assert facts() == [(101, 1)] and load.waiting().count() == 4
    load.release(0)
    load.key_maps = known(spark, 1, 2)
    for _ in range(2):
        load.release(1)
    assert facts() == [(101, 1), (102, 2), (102, 2)]  # equal rows stay two
    load.key_maps = known(spark, 1, 2, 3)
    load.release(2)
    assert facts() == [(101, 1), (102, 2), (102, 2), (103, 4)]
    errors = {(e.RecordNaturalKey, e.ErrorType) for e in load.errors("b", NOW).collect()}
    assert errors == {("3", "FK_MISS"), ("None", "NULL_PK")}


def test_versions_in_the_order_of_their_dates(spark, tmp_path):
    path, schema = str(tmp_path / "d"), "ID INT, Name STRING, ValidFromDate DATE, Seq INT"
    log = ChangeLog(spark, path, "ID", sequence="Seq", tracked=["Name"], buckets=2)
    blocks = [
        [(1, "a", D(2020, 1, 1), 1), (2, "x", D(2020, 1, 1), 1), (None, "n", D(2020, 1, 1), 1)],
        [(1, "d", D(2023, 1, 1), 1), (1, "b", D(2021, 1, 1), 1), (1, "c", D(2022, 1, 1), 2), (1, "z", D(2022, 1, 1), 3), (1, "d", D(2024, 1, 1), 1)],
        [(1, "early", D(2019, 1, 1), 1), (1, "q", D(2020, 1, 1), 1)],
    ]
    for number, rows in enumerate(blocks):
        for _ in range(2):
            log.add(spark.createDataFrame(rows, schema), number)

    def versions():
        return sorted(((r.ID or 0, r.Version, r.Name, r.ValidFromDate.year, r.ValidToDate.year, r.IsCurrent) for r in log.versions().collect()))

    wanted = [
        (0, 1, "n", 2020, 2100, 1), (1, 1, "early", 2019, 2020, 0), (1, 2, "a", 2020, 2021, 0), (1, 3, "b", 2021, 2022, 0),
        (1, 4, "c", 2022, 2023, 0), (1, 5, "d", 2023, 2100, 1), (2, 1, "x", 2020, 2100, 1),
    ]
    assert versions() == wanted
    others = {b: files.children(spark, f"{path}/_bucket={b}") for b in log._folders()}
    grown = log.fold(at_least=3)
    assert versions() == wanted and len(grown) >= 1
    for bucket, names in others.items():
        assert (files.children(spark, f"{path}/_bucket={bucket}") == names) == (bucket not in grown)
    log.add(spark.createDataFrame([(2, "y", D(2021, 1, 1), 1)], schema), 3)
    assert (2, 2, "y", 2021, 2100, 1) in versions()
