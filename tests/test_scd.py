"""Versioned and overwritten dimensions: worked examples and invariants."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from starloom.functions.dates import FAR_FUTURE
from starloom.operators import scd

SCHEMA = (
    "CustomerKey BIGINT, CustomerID BIGINT, Email STRING, ValidFromDate DATE, ValidToDate DATE, IsCurrent INT, Version BIGINT"
)
D = dt.date


def image(spark, *rows):
    """Source rows: (key, id, e-mail, valid from)."""
    return spark.createDataFrame([(k, i, e, d, FAR_FUTURE, 1, 1) for k, i, e, d in rows], SCHEMA)


def merge(src, dim, as_of=D(2025, 11, 11), **options):
    return scd.scd2_merge(src, dim, "CustomerID", "CustomerKey", as_of, **options)


def by_version(df):
    return [tuple(r) for r in df.orderBy("CustomerID", "Version", "ValidFromDate").collect()]


def test_worked_example_of_an_email_change(spark):
    dim = image(spark, (1001, 500, "old@example.com", D(2020, 1, 15)))
    src = image(spark, (1002, 500, "new@example.com", D(2025, 11, 11)))
    old, new = by_version(merge(src, dim))
    assert old == (1001, 500, "old@example.com", D(2020, 1, 15), D(2025, 11, 11), 0, 1)
    assert new == (1002, 500, "new@example.com", D(2025, 11, 11), FAR_FUTURE, 1, 2)
    (as_was,) = scd.as_of_members(merge(src, dim), D(2025, 6, 1)).collect()
    assert as_was.Email == "old@example.com"
    (as_is,) = scd.as_of_members(merge(src, dim), D(2025, 11, 11)).collect()
    assert as_is.Email == "new@example.com"


def test_expiry_variants(spark):
    dim = image(spark, (1, 1, "a", D(2020, 1, 1)), (2, 2, "b", D(2020, 1, 1)))
    src = image(spark, (3, 1, "x", D(2025, 3, 1)), (4, 2, "y", D(2025, 2, 1)))

    def closed(expiry):
        return [r[4] for r in by_version(merge(src, dim, expiry=expiry)) if r[5] == 0]

    assert closed("own") == [D(2025, 3, 1), D(2025, 2, 1)]
    assert closed("day_before") == [D(2025, 2, 28), D(2025, 1, 31)]
    assert closed("batch_min") == [D(2025, 2, 1), D(2025, 2, 1)]
    with pytest.raises(ValueError):
        merge(src, dim, expiry="never")


def test_new_unchanged_and_stale_members(spark):
    dim = image(spark, (1, 1, "a", D(2020, 1, 1)), (2, 2, "b", D(2020, 1, 1)))
    src = image(
        spark, (1, 1, "a", D(2021, 1, 1)), (9, 2, "changed", D(2020, 1, 1)), (3, 3, None, D(2025, 1, 1))
    )
    assert by_version(merge(src, dim)) == [
        (1, 1, "a", D(2020, 1, 1), FAR_FUTURE, 1, 1),  # same values
        (2, 2, "b", D(2020, 1, 1), FAR_FUTURE, 1, 1),  # the date did not advance
        (3, 3, None, D(2025, 1, 1), FAR_FUTURE, 1, 1),
    ]


def test_null_is_compared_as_a_value(spark):
    dim = image(spark, (1, 1, None, D(2020, 1, 1)))
    assert len(by_version(merge(image(spark, (2, 1, None, D(2021, 1, 1))), dim))) == 1
    assert len(by_version(merge(image(spark, (2, 1, "x", D(2021, 1, 1))), dim))) == 2


def test_member_leaves_and_comes_back(spark):
    start = image(spark, (1, 1, "a", D(2020, 1, 1)))
    gone = merge(image(spark), start, D(2021, 1, 1))
    assert by_version(gone) == [(1, 1, "a", D(2020, 1, 1), D(2021, 1, 1), 0, 1)]
    assert by_version(merge(image(spark), gone, D(2021, 6, 1))) == by_version(gone)
    back = merge(image(spark, (2, 1, "a", D(2022, 1, 1))), gone, D(2022, 1, 1))
    assert by_version(back)[1] == (2, 1, "a", D(2022, 1, 1), FAR_FUTURE, 1, 2)


def test_tracked_columns_limit_what_counts_as_change(spark):
    dim = image(spark, (1, 1, "a", D(2020, 1, 1)))
    src = image(spark, (2, 1, "b", D(2021, 1, 1)))
    assert len(by_version(merge(src, dim, tracked=["CustomerID"]))) == 1


def test_random_feeds_keep_the_invariants(spark):
    rng = random.Random(7)
    dim = scd.initial_versions(image(spark, *[(i, i, "v0", D(2020, 1, 1)) for i in range(12)]))
    emails = {i: ("v0", D(2020, 1, 1)) for i in range(12)}
    for step in range(1, 4):
        day = D(2020 + step, 1, 1)
        for i in rng.sample(range(20), 8):
            emails[i] = (f"v{step}", day)
        for i in rng.sample(sorted(emails), 3):
            del emails[i]
        src = image(spark, *[(100 * step + i, i, e, d) for i, (e, d) in emails.items()])
        dim = spark.createDataFrame(merge(src, dim, day).collect(), SCHEMA)
        again = merge(src, dim, day)
        assert by_version(again) == by_version(dim), "a second run changes nothing"
        live = {r.CustomerID: r.Email for r in dim.filter("IsCurrent = 1").collect()}
        assert live == {i: e for i, (e, _) in emails.items()}
    spans = {}
    for _, member, _, first, last, _, version in by_version(dim):
        spans.setdefault(member, []).append((version, first, last))
    for versions in spans.values():
        assert [v for v, _, _ in versions] == list(range(1, len(versions) + 1))
        for (_, _, end), (_, start, _) in zip(versions, versions[1:]):
            assert end <= start, "intervals are disjoint"
    today = scd.as_of_members(dim, D(2030, 1, 1)).count()
    assert today == dim.filter("IsCurrent = 1").count()


def test_summary_counts(spark):
    dim = image(spark, (1, 1, "a", D(2020, 1, 1)), (2, 2, "b", D(2020, 1, 1)))
    src = image(spark, (3, 1, "x", D(2021, 1, 1)), (4, 3, "c", D(2021, 1, 1)))
    changes = scd.scd2_changes(src, dim, "CustomerID", "CustomerKey")
    assert tuple(scd.sync_summary(changes).collect()[0]) == (2, 1, 1, 0)


def test_overwritten_dimension_keeps_surrogate_keys(spark):
    schema = "K BIGINT, ID BIGINT, Name STRING"
    dim = spark.createDataFrame([(1, 10, "a"), (2, 20, "b"), (3, 30, "c")], schema)
    src = spark.createDataFrame([(91, 10, "a"), (92, 20, "B"), (94, 40, None)], schema)
    rows = sorted(tuple(r) for r in scd.scd1_sync(src, dim, "ID", "K").collect())
    assert rows == [(1, 10, "a"), (2, 20, "B"), (94, 40, None)]
    changes = scd.scd1_changes(src, dim, "ID", "K")
    assert tuple(scd.sync_summary(changes).collect()[0]) == (1, 1, 1, 0)


def test_dedup_and_latest_version(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 1)], "id INT, v STRING, t INT")
    assert sorted(r.v for r in scd.dedup_latest(df, "id", [F.desc("t")]).collect()) == ["b", "c"]
    versions = spark.createDataFrame([(1, D(2020, 1, 1), 1), (1, D(2020, 1, 1), 3)], "id INT, ValidFromDate DATE, Version INT")
    assert [r.Version for r in scd.latest_versions(versions, "id").collect()] == [3]


def test_top_one_is_pruned_before_the_shuffle(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 3)
    plan = scd.dedup_latest(df, "k", [F.desc("id")])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_as_of_join_accepts_null_and_sentinel(spark):
    dim = spark.createDataFrame(
        [(1, "old", D(2020, 1, 1), D(2021, 1, 1)), (1, "new", D(2021, 1, 1), None), (2, "x", D(2020, 1, 1), FAR_FUTURE)],
        "id INT, seg STRING, ValidFromDate DATE, ValidToDate DATE",
    )
    facts = spark.createDataFrame(
        [(1, D(2020, 6, 1)), (1, D(2021, 1, 1)), (2, D(2024, 1, 1)), (2, D(2019, 1, 1))], "id INT, day DATE"
    )
    got = sorted((r.id, r.day, r.seg) for r in scd.as_of_join(facts, dim, "id", "day", ["seg"]).collect())
    assert [g[2] for g in got] == ["old", "new", None, "x"]


def test_is_versioned():
    assert scd.is_versioned(["A", "ValidFromDate", "ValidToDate", "IsCurrent", "Version"])
    assert not scd.is_versioned(["A", "IsCurrent"])


def test_member_comes_back_with_its_old_date(spark):
    start = image(spark, (1, 1, "a", D(2020, 1, 1)))
    gone = merge(image(spark), start, D(2021, 1, 1))
    back = merge(start, gone, D(2021, 6, 1))
    old, new = by_version(back)
    assert old == (1, 1, "a", D(2020, 1, 1), D(2021, 1, 1), 0, 1)
    assert new[0] != 1 and new[1:] == (1, "a", D(2021, 1, 1), FAR_FUTURE, 1, 2)
    assert scd.as_of_members(back, D(2020, 6, 1)).count() == scd.as_of_members(back, D(2021, 7, 1)).count() == 1
    assert by_version(merge(start, back, D(2021, 7, 1))) == [old, new]
