"""Joins Spark has no single operator for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.bands import first_match
from starloom.functions.lookups import EXPANSION, broadcast_limit, nullable_left_join, planned_bytes


def literal_range_key(value: Column, rows: Sequence[tuple], low: int, high: int, result: int = 0) -> Column:
    """Key of the fixed range containing ``value``; NULL outside all of them.

    For lookup tables known as literals: one CASE per row, no join at all.
    ``low``, ``high`` and ``result`` are positions within a row.
    """
    return first_match([(value.between(r[low], r[high]), F.lit(r[result])) for r in rows], F.lit(None))


#: Each scale's bins are this many times as wide as those of the scale below.
STEP = 8
#: Scale of the ranges with an open end; all of them are in its one bin.
OPEN = -1
#: Slots that values are dealt over where they meet the open ranges in a shuffle.
SLOTS = 32


def _number(value: Column, kind: T.DataType) -> Column:
    """A DOUBLE that never falls when the value rises."""
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value).cast("double")
    return value.cast("double")


def range_join(
    left: DataFrame, ranges: DataFrame, value: str, low: str, high: str, columns: Sequence[str], how: str = "left"
) -> DataFrame:
    """``left`` with the columns of the ranges that contain its ``value``; both ends count, a NULL end is open.

    Ranges are indexed by scales: a range is listed on the scale whose bins are at least as wide as it is long, so under
    two or three bins, however long it is and wherever it lies.  Ranges with an open end are in one bin of their own.
    Each distinct value looks at one bin per scale in use, and the rows of ``left`` are then joined to the matches of
    their value: they are never multiplied before the match, and a hot value is looked up once.  ``how`` is "left" or
    "inner".
    """
    spark = left.sparkSession
    kind = left.schema[value].dataType
    start, end = _number(F.col("_low"), ranges.schema[low].dataType), _number(F.col("_high"), ranges.schema[high].dataType)
    length = F.log(F.greatest(end - start, F.lit(1.0))) / F.log(F.lit(float(STEP)))
    scale = F.when(F.col("_low").isNull() | F.col("_high").isNull(), OPEN).otherwise(F.ceil(length + 1e-9).cast("int"))
    indexed = ranges.select(F.col(low).alias("_low"), F.col(high).alias("_high"), *columns).withColumn("_scale", scale)
    indexed = indexed.filter("_low IS NULL OR _high IS NULL OR _low <= _high")

    used = sorted(r[0] for r in indexed.select("_scale").distinct().collect())  # a few dozen scales span all doubles
    width = F.pow(F.lit(float(STEP)), F.col("_scale"))
    first, last = _whole(start / width), _whole(end / width)
    bins = F.when(F.col("_scale") == OPEN, F.array(F.lit(0.0))).otherwise(
        F.array_distinct(F.array(first, _whole((first + last) / 2), last))
    )
    small = 0 <= planned_bytes(ranges) * EXPANSION <= broadcast_limit(spark)
    slots = 1 if small else SLOTS
    listed = indexed.withColumn("_bin", F.explode(bins)).withColumn(
        "_slot", F.explode(F.when(F.col("_scale") == OPEN, F.sequence(F.lit(0), F.lit(slots - 1))).otherwise(F.array(F.lit(0))))
    )
    scales = F.array(*[F.lit(s) for s in used]) if used else F.array().cast("array<int>")
    probes = left.select(F.col(value).alias("_value")).filter("_value IS NOT NULL").distinct().withColumn("_scale", F.explode(scales))
    place = F.when(F.col("_scale") == OPEN, F.lit(0.0)).otherwise(_whole(_number(F.col("_value"), kind) / width))
    slot = F.when(F.col("_scale") == OPEN, F.pmod(F.xxhash64("_value"), F.lit(slots)).cast("int")).otherwise(F.lit(0))
    probes = probes.select("_value", "_scale", place.alias("_bin"), slot.alias("_slot"))
    hits = probes.join(F.broadcast(listed) if small else listed, ["_scale", "_bin", "_slot"]).filter(
        (F.col("_low").isNull() | (F.col("_value") >= F.col("_low"))) & (F.col("_high").isNull() | (F.col("_value") <= F.col("_high")))
    )
    hits = hits.select("_value", *columns)
    if how == "inner":
        return left.join(hits, F.col(value) == F.col("_value")).drop("_value")
    rows = [c for c in left.columns if c != value]
    return nullable_left_join(left, hits.withColumnRenamed("_value", value), value, rows or [value]).drop(f"_slot_{value}")


def _whole(x: Column) -> Column:
    """The floor as a DOUBLE; beyond 2^53 doubles are whole already, and would not fit a BIGINT."""
    return F.when(F.abs(x) < 2.0**53, F.floor(x).cast("double")).otherwise(x)


def latest_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Top-1 row per key as an aggregate: tasks combine locally before the shuffle."""
    best = F.max(F.struct(*order, *[c for c in columns if c not in order])).alias("_best")
    return df.groupBy(*key).agg(best).select(*key, *[F.col(f"_best.{c}").alias(c) for c in columns])
