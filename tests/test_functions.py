import datetime as dt
import hashlib

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starloom.functions import dates
from starloom.functions.bands import band
from starloom.functions.cleaning import clean_values, convert_types, null_defaults
from starloom.functions.keys import COMPACT_KEYS, KeyPolicy, hash_uniform, surrogate_key, wide_decimal_key
from starloom.functions.lookups import _bytes, small_side, spread
from starloom.functions.measures import exact_avg, percent, ratio
from starloom.sources.calendar import CALENDAR_START, build_calendar, calendar_range


def one(df):
    return df.collect()[0]


def test_compact_key_is_the_first_32_bits_of_the_digest(spark):
    row = one(spark.createDataFrame([(500, "2020-01-15")], "id INT, day STRING").select(
        surrogate_key("id", "day", policy=COMPACT_KEYS), surrogate_key("id", "day"), wide_decimal_key("id", "day")
    ))
    assert row[0] == int(hashlib.md5(b"5002020-01-15").hexdigest()[:8], 16)
    assert row[1] == int(hashlib.md5(b"500|2020-01-15").hexdigest()[:15], 16)
    assert int(row[2]) == int(hashlib.md5(b"500|2020-01-15").hexdigest()[:16], 16)


def test_separator_keeps_parts_apart_and_null_counts_as_empty(spark):
    rows = spark.createDataFrame([("1", "23"), ("12", "3"), ("1", None)], "a STRING, b STRING").select(
        surrogate_key("a", "b").alias("k"), surrogate_key("a", "b", policy=COMPACT_KEYS).alias("c")
    ).collect()
    assert rows[0].k != rows[1].k
    assert rows[0].c == rows[1].c
    assert rows[2].k == int(hashlib.md5(b"1|").hexdigest()[:15], 16)


def test_key_width_is_checked():
    with pytest.raises(ValueError):
        KeyPolicy(bits=64)


def test_uniform_draws_are_uniform_and_repeatable(spark):
    draws = spark.range(20000).select(hash_uniform("x", "id").alias("u"), hash_uniform("y", "id").alias("v"))
    row = one(draws.agg(F.min("u"), F.max("u"), F.avg("u"), F.corr("u", "v")))
    assert 0 <= row[0] and row[1] < 1
    assert row[2] == pytest.approx(0.5, abs=0.02)
    assert abs(row[3]) < 0.05


@pytest.mark.parametrize(
    "day,holiday,weekend,fiscal_year,fiscal_month,fiscal_quarter,season",
    [
        ("2025-12-25", "Christmas Day", 0, 2026, 6, 2, "Winter"),
        ("2025-12-28", "", 1, 2026, 6, 2, "Winter"),
        ("2024-05-27", "Memorial Day", 0, 2024, 11, 4, "Spring"),
        ("2025-07-01", "", 0, 2026, 1, 1, "Summer"),
        ("2025-01-20", "Martin Luther King Jr. Day", 0, 2025, 7, 3, "Winter"),
        ("2025-02-17", "Presidents' Day", 0, 2025, 8, 3, "Winter"),
        ("2025-09-01", "Labor Day", 0, 2026, 3, 1, "Fall"),
        ("2025-10-13", "Columbus Day", 0, 2026, 4, 2, "Fall"),
        ("2025-11-27", "Thanksgiving", 0, 2026, 5, 2, "Fall"),
        ("2025-11-11", "Veterans Day", 0, 2026, 5, 2, "Fall"),
        ("2024-06-30", "", 1, 2024, 12, 4, "Summer"),
    ],
)
def test_calendar_rows(spark, day, holiday, weekend, fiscal_year, fiscal_month, fiscal_quarter, season):
    row = one(build_calendar(spark, dt.date(2025, 1, 1)).filter(F.col("DateKey") == F.lit(day).cast("date")))
    assert (row.HolidayName, row.IsWeekend, row.FiscalYear) == (holiday, weekend, fiscal_year)
    assert (row.FiscalMonth, row.FiscalQuarter, row.Season) == (fiscal_month, fiscal_quarter, season)
    assert row.IsHoliday == int(holiday != "")


def test_calendar_reaches_ten_years_ahead(spark):
    days = build_calendar(spark, dt.date(2024, 2, 29)).agg(F.min("DateKey"), F.max("DateKey"), F.count("*"))
    first, last, count = one(days)
    assert (first, last) == (CALENDAR_START, dt.date(2034, 2, 28)) == calendar_range(dt.date(2024, 2, 29))
    assert count == (last - first).days + 1


def test_bands_are_tested_top_down_and_null_falls_through(spark):
    df = spark.createDataFrame([(0,), (30,), (31,), (None,)], "d INT")
    got = [r[0] for r in df.select(band("d", [("<=", 30, "a"), ("<=", 90, "b")], "z")).collect()]
    assert got == ["a", "a", "b", "z"]


def test_guarded_ratios(spark):
    row = one(spark.createDataFrame([(5, 0, None)], "a INT, z INT, n INT").select(
        ratio("a", "z"), percent("a", "z"), ratio("a", "n"), percent("n", "a")
    ))
    assert tuple(row) == (5.0, 500.0, 5.0, None)


def test_exact_average_of_nothing_is_null(spark):
    df = spark.createDataFrame([(None,)], "x INT")
    assert one(df.agg(exact_avg("x")))[0] is None


def test_cleaning(spark):
    df = spark.sql(
        "SELECT CAST(NULL AS INT) AS n, CAST(NULL AS INT) AS fk, CAST(1.5 AS DECIMAL(9,2)) AS d, '2025-01-02' AS BirthDate,"
        " 'soon' AS DueDate, DATE'9999-12-31' AS EndDate, TIMESTAMP'2024-01-01 10:00:00' AS UpdateDate,"
        " CAST(NULL AS DATE) AS OpenDate"
    )
    row = one(clean_values(df, keep=["fk"]))
    assert (row.n, row.fk, row.d) == (0, None, 1.5)
    assert (row.BirthDate, row.DueDate) == ("2025-01-02 00:00:00", "soon")
    assert row.EndDate == dt.datetime(2100, 12, 31)
    assert row.UpdateDate == dt.datetime(2024, 1, 1, 10)
    assert row.OpenDate is None


def test_coerce_date(spark, as_of):
    df = spark.createDataFrame([("2025-01-02 10:00:00",), ("x",), (None,)], "s STRING")
    got = [r[0] for r in df.select(dates.coerce_date("s", as_of)).collect()]
    assert got == [dt.date(2025, 1, 2), as_of, as_of]


def test_type_conversion_collects_messages(spark):
    df = spark.createDataFrame([("ABC", "2025-13-01", "1.5"), ("7", "2025-01-01", None)], "i STRING, d STRING, f STRING")
    bad, good = convert_types(df, {"i": "int", "d": "date", "f": "float"}).collect()
    assert bad.ConversionErrors == [
        "TYPE_MISMATCH: cannot convert i to int", "TYPE_MISMATCH: cannot convert d to date"
    ]
    assert (good.i, good.d, good.f, good.ConversionErrors) == (7, dt.date(2025, 1, 1), None, [])


def test_null_defaults(spark):
    df = spark.createDataFrame([(None, None, 3)], "CustomerName STRING, Age INT, Other INT")
    assert tuple(one(null_defaults(df, {"CustomerName": "UNKNOWN", "Age": -1}))) == ("UNKNOWN", -1, 3)


def test_size_settings():
    assert [_bytes(x) for x in ("10485760", "10m", "10MB", "1g", "-1", "64kb")] == [
        10485760, 10485760, 10485760, 2**30, -1, 65536
    ]


def _hinted(df):
    return "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()


def test_only_small_sides_are_broadcast(spark):
    small, large = spark.range(10), spark.range(10**9)
    assert _hinted(small_side(small))
    assert not _hinted(small_side(large))
    assert not _hinted(small_side(small, driver=large))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert not _hinted(small_side(small))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_only_small_scans_are_spread(spark):
    large = spark.range(10**9)
    assert spread(large, "id") is large
    assert spread(spark.range(10), "id") is not large


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-400, 400), min_size=1, max_size=30))
def test_aging_tiers_cover_every_age(spark, ages):
    from starloom.operators.rollups import aging_tier_key

    def tier(age):
        return None if age < 0 else 1 if age <= 30 else 2 if age <= 90 else 3 if age <= 180 else 4

    rows = spark.createDataFrame([(a,) for a in ages], "a INT").select("a", aging_tier_key(F.col("a"))).collect()
    assert [r[1] for r in rows] == [tier(r[0]) for r in rows]


def test_range_join_has_open_ends(spark):
    from starloom.operators.joins import range_join

    stock = spark.createDataFrame([(-3,), (5,), (250,), (10_000,), (12_345_678,), (None,)], "age int")
    tiers = spark.createDataFrame([(0, 30, "new"), (31, 999, "old"), (1000, 2_000_000_000, "older"), (None, -1, "negative")], "low int, high int, tier string")
    got = {r.age: r.tier for r in range_join(stock, tiers, "age", "low", "high", ["tier"]).collect()}
    assert got == {-3: "negative", 5: "new", 250: "old", 10_000: "older", 12_345_678: "older", None: None}
    assert range_join(stock.limit(0), tiers, "age", "low", "high", ["tier"]).count() == 0
