"""The ledger and the batch that resumes from it, coverage, in-place maintenance of stored tables, number registry."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from starloom.operators import files, sinks, validation
from starloom.operators.facts import FACTS
from starloom.operators.identities import register_numbers, with_registered_numbers
from starloom.operators.joins import range_join
from starloom.operators.ledger import Ledger, covered_ranges, missing_ranges
from starloom.operators.quality import Rule, RuleSet
from starloom.plans import batch
from starloom.plans.warehouse import Warehouse
from starloom.sources.tpch import AS_OF, CALENDAR_START, tpch_sources
from tests.conftest import SMALL

D = dt.date
ALL = [(D(1, 1, 1), D(9999, 12, 31))]
DAYS = "day DATE, v INT"


class Killed(RuntimeError):
    pass


def days(spark, *rows):
    return spark.createDataFrame([(D(2025, 1, d), v) for d, v in rows], DAYS)


def stored(spark, path):
    return sorted((r.day.day, r.v) for r in sinks.read_table(spark, path).collect())


# -- ledger ------------------------------------------------------------------------------


def test_a_committed_step_does_not_run_again(spark, tmp_path):
    ledger, runs = Ledger(spark, str(tmp_path), "b1"), []
    assert ledger.frame().count() == 0
    for _ in range(2):
        done = ledger.run("fact", "FactSales", lambda: runs.append(1) or {"RowsIn": 5, "Days": [D(2025, 1, 1)]})
    assert len(runs) == 1 and done["RowsIn"] == 5 and done["Days"] == ["2025-01-01"]
    (row,) = ledger.frame().collect()
    assert (row.BatchID, row.Step, row.SourceTable, row.RowsIn, row.Days) == ("b1", "fact", "FactSales", 5, [D(2025, 1, 1)])
    assert Ledger(spark, str(tmp_path), "b2").record("fact", "FactSales") is None


def test_coverage_and_what_is_missing(spark, tmp_path):
    loads = [(1, 5), (6, 8), (20, 25), (3, 4), (22, 28)]
    for i, (a, b) in enumerate(loads):
        Ledger(spark, str(tmp_path), f"b{i}").commit("fact", "FactSales", FirstDay=D(2025, 1, a), LastDay=D(2025, 1, b))
    Ledger(spark, str(tmp_path), "b0").commit("retry", "FactSales", FirstDay=D(2025, 1, 10), LastDay=D(2025, 1, 11))
    records = Ledger(spark, str(tmp_path), "x").frame()
    got = sorted((r.FirstDay.day, r.LastDay.day) for r in covered_ranges(records).collect())
    assert got == [(1, 8), (20, 28)]
    assert missing_ranges(records, "FactSales", D(2025, 1, 1), D(2025, 1, 31)) == [(D(2025, 1, 9), D(2025, 1, 19)), (D(2025, 1, 29), D(2025, 1, 31))]
    assert missing_ranges(records, "FactSales", D(2025, 1, 21), D(2025, 1, 22)) == []
    assert missing_ranges(records, "FactReturns", D(2025, 1, 1), D(2025, 1, 2)) == [(D(2025, 1, 1), D(2025, 1, 2))]


# -- ranges of days replaced in place --------------------------------------------------------


def test_a_reload_empties_the_days_it_no_longer_has(spark, tmp_path):
    path, staging = str(tmp_path / "t"), str(tmp_path / "s")
    sinks.replace_ranges(days(spark, (1, 1), (2, 2), (3, 3), (4, 4)), path, "day", ALL, staging)
    changed = sinks.replace_ranges(days(spark, (3, 30)), path, "day", [(D(2025, 1, 2), D(2025, 1, 3))], staging)
    assert stored(spark, path) == [(1, 1), (3, 30), (4, 4)] and [d.day for d in changed] == [2, 3]
    sinks.replace_ranges(days(spark, (3, 30)).limit(0), path, "day", [(D(2025, 1, 3), D(2025, 1, 3))], staging)
    assert stored(spark, path) == [(1, 1), (4, 4)]
    with pytest.raises(ValueError):
        sinks.replace_ranges(days(spark, (9, 9)), path, "day", [(D(2025, 1, 3), D(2025, 1, 3))], staging)


@pytest.mark.parametrize("moves", [0, 1, 2])
def test_an_interrupted_replacement_is_finished(spark, tmp_path, monkeypatch, moves):
    path, staging = str(tmp_path / "t"), str(tmp_path / "s")
    sinks.replace_ranges(days(spark, (1, 1), (2, 2), (3, 3)), path, "day", ALL, str(tmp_path / "first"))
    done, move = [], files.move

    def dies(*args):
        if len(done) == moves:
            raise Killed
        done.append(move(*args))

    monkeypatch.setattr(files, "move", dies)
    with pytest.raises(Killed):
        sinks.replace_ranges(days(spark, (1, 10), (2, 20), (4, 40)), path, "day", ALL, staging)
    monkeypatch.undo()
    sinks.recover(spark, path)
    wanted = [(1, 10), (2, 20), (4, 40)]
    assert stored(spark, path) == wanted
    assert [d.day for d in sinks.replace_staged(spark, staging, path, "day", ALL)] == [1, 2, 3, 4]  # again: nothing
    assert stored(spark, path) == wanted


def test_retention_moves_folders_and_later_loads_stay_visible(spark, tmp_path):
    path, archive = str(tmp_path / "t"), str(tmp_path / "old")
    sinks.overwrite_partitions(days(spark, (1, 1), (2, 2), (3, 3)), path, "day")
    names = sorted(p.name for p in (tmp_path / "t" / "day=2025-01-03").glob("*.parquet"))
    reads = spark.sparkContext.statusTracker().getJobIdsForGroup()
    for _ in range(2):
        sinks.apply_retention(spark, path, "day", D(2025, 1, 5), "v", archive, days=3)
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup()) == list(reads)  # no job ran
    assert sorted(p.name for p in (tmp_path / "t" / "day=2025-01-03").glob("*.parquet")) == names
    sinks.overwrite_partitions(days(spark, (1, 7), (6, 6)), path, "day")  # day 1 is past, readers don't see it
    assert stored(spark, path) == [(2, 2), (3, 3), (6, 6)]
    plan = sinks.read_table(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    sinks.drop_expired(spark, path, "day", D(2025, 1, 4), archive, days=3)  # an earlier cut-off gives nothing back
    assert stored(spark, path) == [(2, 2), (3, 3), (6, 6)]
    assert sorted((r.day.day, r.v) for r in spark.read.parquet(archive).collect()) == [(1, 1), (1, 7)]


def test_retention_cutoff_by_months():
    assert sinks._cutoff_day(D(2024, 3, 31), 1, None) == D(2024, 2, 29)
    assert sinks._cutoff_day(D(2025, 11, 11), 24, None) == D(2023, 11, 11)
    assert sinks._cutoff_day(D(2025, 1, 31), None, 31) == D(2024, 12, 31)


def test_duplicates_go_where_they_are(spark, tmp_path):
    path = tmp_path / "t"
    rows = spark.createDataFrame([(D(2025, 1, 1), 1), (D(2025, 1, 2), 2), (D(2025, 1, 2), 2), (D(2025, 1, 3), None), (D(2025, 1, 3), None)], DAYS)
    sinks.overwrite_partitions(rows, str(path), "day")
    untouched = sorted(p.name for p in (path / "day=2025-01-01").glob("*.parquet"))
    assert sinks.drop_duplicates_in_place(spark, str(path), "day", str(tmp_path / "s")) == ["2025-01-02", "2025-01-03"]
    assert sorted(p.name for p in (path / "day=2025-01-01").glob("*.parquet")) == untouched
    assert sinks.read_table(spark, str(path)).count() == 3
    assert sinks.drop_duplicates_in_place(spark, str(path), "day", str(tmp_path / "s2")) == []


# -- checks before the load ------------------------------------------------------------------


def test_bad_rows_cost_themselves_not_the_load(spark):
    rows = spark.createDataFrame(
        [(D(2025, 1, 1), 1, 1, 5, 10.0), (D(2025, 1, 1), 1, None, 5, 10.0), (D(2025, 1, 1), 1, 3, 3_000_000_000, 10.0),
         (D(2025, 1, 1), 1, 4, 5, -1.0), (None, 1, 5, 5, 10.0)],
        "SalesDateKey DATE, SalesOrderID BIGINT, SalesOrderDetailID BIGINT, QuantitySold BIGINT, SalesRevenue DOUBLE",
    )
    got = validation.checked(rows, FACTS["FactSales"])
    kinds = {(r.SalesDateKey is None, r.SalesOrderDetailID): [v.kind for v in r[validation.VIOLATIONS]] for r in got.collect()}
    assert kinds[False, 1] == [] and kinds[False, None] == ["NULL_PK"] and kinds[True, 5] == ["NULL_PK"]
    assert kinds[False, 3] == ["TYPE_MISMATCH", "VALIDATION_FAIL"] and kinds[False, 4] == ["VALIDATION_FAIL"] * 2
    errors = validation.validation_errors(got.filter(~validation.is_valid()), FACTS["FactSales"], "b1")
    assert {(e.RecordNaturalKey, e.IsRecoverable, e.ErrorSeverity) for e in errors.collect()} == {
        ("1-None", 0, "CRITICAL"), ("1-3", 1, "WARNING"), ("1-4", 1, "WARNING"), ("1-5", 0, "CRITICAL"),
    }
    validation.register_rules("FactOther", RuleSet("other", (Rule("too many", "QuantitySold > 4"),)))
    spec = FACTS["FactSales"].__class__("FactOther", "SalesDateKey", None, (), ("SalesOrderDetailID",), ())
    assert validation.checked(rows, spec).filter(~validation.is_valid()).count() == 5
    validation.RULES.pop("FactOther")


# -- the batch -------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def sources(spark):
    src = tpch_sources(spark, SMALL)
    orders = src["Sales.SalesOrderHeader"].filter("OrderDate >= DATE'2001-06-20'")
    return src.replaced(Sales__SalesOrderHeader=orders)


def run_twice(spark, src, root, **options):
    """A first batch whose dimensions lag behind the facts, then one that has them all and more days."""
    late = src.replaced(Sales__Customer=src["Sales.Customer"].filter("CustomerID % 50 <> 7"))
    common = {"facts": ["FactSales"], "rollups": ["agg_daily_sales", "agg_regional_sales"], "calendar_start": CALENDAR_START, "loaded_at": dt.datetime(2001, 12, 1)}
    batch.run_batch(spark, src, root, AS_OF, "b1", until=D(2001, 7, 15), members=late, **common)
    while True:
        try:
            return batch.run_batch(spark, src, root, AS_OF, "b2", since=D(2001, 7, 15), **common, **options)
        except Killed:
            pass


def contents(spark, wh, root):
    facts = sorted(map(str, wh.table("FactSales").collect()))
    errors = sorted(map(str, wh.table("error_records").drop("LastAttemptDate").collect()))
    rollups = [sorted(map(str, sinks.read_table(spark, f"{root}/{n}").collect())) for n in ("agg_daily_sales", "agg_regional_sales")]
    return facts, errors, rollups


def test_a_batch_killed_in_any_step_gives_the_same_tables(spark, sources, tmp_path, monkeypatch):
    plain, killed = str(tmp_path / "plain"), str(tmp_path / "killed")
    wanted = contents(spark, run_twice(spark, sources, plain), plain)
    died, commit = set(), Ledger.commit

    def dies_once(self, step, table, **figures):  # all work of the step is done, its record is not written
        if self.batch == "b2" and step != "dimension" and (step, table) not in died:
            died.add((step, table))
            raise Killed
        return commit(self, step, table, **figures)

    monkeypatch.setattr(Ledger, "commit", dies_once)
    wh = run_twice(spark, sources, killed)
    monkeypatch.undo()
    assert {step for step, _ in died} == {"fact", "retry_staged", "retry", "rollup"}
    assert contents(spark, wh, killed) == wanted
    facts, _, (daily, regional) = wanted
    spec = FACTS["FactSales"]
    assert len(facts) == spec.build(sources, AS_OF).count()  # equal lines stay, misses have come in
    assert wh.table("error_records").filter("IsResolved = 0").count() == 0
    for name, rows in (("agg_daily_sales", daily), ("agg_regional_sales", regional)):
        build, _ = batch.ROLLUPS[name]
        columns = sinks.read_table(spark, f"{killed}/{name}").columns
        assert sorted(map(str, batch.conform(build(wh), name).select(*columns).collect())) == rows, name
    records = {(r.BatchID, r.Step): r for r in Ledger(spark, killed, "x").frame().filter("SourceTable = 'FactSales'").collect()}
    assert records["b1", "fact"].RowsRejected == records["b2", "retry"].RowsLoaded > 0
    assert Warehouse.from_storage(spark, killed).table("FactSales").count() == len(facts)


def test_period_ranges():
    got = batch.period_ranges("MonthStartDateKey", [D(2025, 1, 31), D(2025, 2, 1), D(2025, 12, 5)])
    assert got == [(D(2025, 1, 1), D(2025, 2, 28)), (D(2025, 12, 1), D(2025, 12, 31))]
    assert batch.period_ranges("WeekStartDateKey", [D(2025, 1, 1)]) == [(D(2024, 12, 30), D(2025, 1, 5))]
    assert batch.period_ranges("SalesDateKey", [D(2025, 1, 1), D(2025, 1, 2)]) == [(D(2025, 1, 1), D(2025, 1, 2))]
    assert batch.period_ranges("SalesDateKey", []) == []


# -- numbers and ranges ------------------------------------------------------------------------


def test_registered_numbers_only_grow(spark, tmp_path):
    path, schema = str(tmp_path / "r"), "g STRING, c STRING, n BIGINT"
    first = spark.createDataFrame([("b", "x", 1), ("b", None, 2)], schema)
    register_numbers(first, path, ["g", "c"], "n", ["n"], "v1")
    second = spark.createDataFrame([("a", "y", 1), ("b", "x", 2), ("c", "z", 3)], schema)
    for _ in range(2):
        known = register_numbers(second, path, ["g", "c"], "n", ["n"], "v2")
    assert {(r.g, r.c): r.n for r in known.collect()} == {("b", "x"): 1, ("b", None): 2, ("a", "y"): 3, ("c", "z"): 4}
    assert {r.c: r.n for r in with_registered_numbers(second, known, ["g", "c"], "n").collect()} == {"y": 3, "x": 1, "z": 4}


@pytest.mark.parametrize("threshold", ["10m", "-1"])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_range_join_equals_the_plain_join(spark, threshold, how):
    values = [None, None, -(10**12), -1, 0, 1, 7, 8, 9, 63, 64, 10**12, 2**62]
    ranges = [(1, None, None), (2, None, 8), (3, 8, None), (4, 0, 0), (5, -5, 70), (6, 9, 3), (7, 2**62 - 1, 2**62), (8, 1, 8), (9, -(2**62), 2**62)]
    left = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id INT, v BIGINT")
    right = spark.createDataFrame(ranges, "r INT, lo BIGINT, hi BIGINT")
    want = set()
    for i, v in enumerate(values):
        hits = {(i, r) for r, lo, hi in ranges if v is not None and (lo is None or v >= lo) and (hi is None or v <= hi)}
        want |= hits or ({(i, None)} if how == "left" else set())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        assert sorted(((x.id, x.r) for x in range_join(left, right, "v", "lo", "hi", ["r"], how).collect()), key=str) == sorted(want, key=str)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_range_join_on_dates(spark):
    left = spark.createDataFrame([(D(2025, 1, d),) for d in (1, 10, 20)], "day DATE")
    right = spark.createDataFrame([("a", D(2024, 12, 1), D(2025, 1, 10)), ("b", D(2025, 1, 15), None)], "n STRING, lo DATE, hi DATE")
    assert {r.day.day: r.n for r in range_join(left, right, "day", "lo", "hi", ["n"]).collect()} == {1: "a", 10: "a", 20: "b"}
    assert range_join(left, right.limit(0), "day", "lo", "hi", ["n"]).count() == 3


def test_range_join_far_values_joins_each_price_once(spark, tmp_path, monkeypatch):
    from starloom.plans import operations

    lines = [(k, k % 4, 1 + k % 7, float(100 + k % 3)) for k in range(60)]
    spark.createDataFrame(lines, "l_orderkey long, l_suppkey long, l_linenumber int, l_extendedprice double").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(i, i % 3) for i in range(5)], "s_suppkey long, s_nationkey int").write.parquet(f"{tmp_path}/supplier.parquet")
    met = []
    monkeypatch.setattr(operations, "range_join", lambda left, *rest: (met.extend(r.price for r in left.collect()), range_join(left, *rest))[1])
    got = {r.band: (r.Lines, r.PriceSum) for r in operations.range_join_far_values(spark, str(tmp_path)).collect()}
    assert len(met) == len(set(met))
    price = lambda k, s, n, p: None if n == 7 else 10**12 if s == 3 else int(p)
    prices = [price(*line) for line in lines]
    bands = {i: (None if i % 50 == 1 else i * 611, None if i % 50 == 2 else 2 * 10**12 if i % 50 == 3 else i * 611 + (i % 3) ** 2 * 20 - 30) for i in range(5)}
    hits = {i: [p for p in prices if p is not None and (lo is None or p >= lo) and (hi is None or p <= hi)] for i, (lo, hi) in bands.items()}
    hits[None] = [p for p in prices if p is None or not any(p in h for h in hits.values())]
    assert got == {i: (len(h), str(sum(p for p in h if p is not None)) if any(p is not None for p in h) else None) for i, h in hits.items() if h}
