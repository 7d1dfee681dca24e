"""Exact distinct counts that merge: which values a member met in a period, as bits of 64-bit words.

Values get dense numbers from a stored registry that only grows.  A word holds 64 successive numbers, so a member's
words take between one bit (many values of many) and one row (few) a value; words of several periods merge by OR, and
their bits are the distinct count.  A load adds or replaces the words of the periods it touches; a view over any range
of periods reads words instead of spreading every fact once per counted column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starloom.functions.dates import truncate
from starloom.functions.lookups import small_enough
from starloom.operators import sinks
from starloom.operators.skew import NO_MEMBER, split_left_join

#: Numbers are dealt by buckets of the value's hash, each of which is numbered in a task of its own.
BUCKETS = 1024
WORD_BITS = 6


def reach_items(facts: DataFrame, member: str, day: str, keys: Sequence[str], unit: str = "month") -> DataFrame:
    """Distinct (Member, Period, Kind, Value): the values of ``keys`` and of the day itself that a member met.

    NULL is no value, as in COUNT(DISTINCT); days count by their number.  Repeats are removed in the tasks first.
    """
    values = {k: F.col(k).cast("bigint") for k in keys} | {day: F.unix_date(day).cast("bigint")}
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("Kind"), v.alias("Value")) for k, v in values.items()])).alias("item")
    rows = facts.select(F.col(member).alias("Member"), truncate(unit, day).alias("Period"), pairs)
    return rows.select("Member", "Period", "item.Kind", "item.Value").where(F.col("Value").isNotNull()).distinct()


def register_values(items: DataFrame, path: str, version: str, kinds: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """The registry (Kind, Value, Number) after the values of ``kinds`` in ``items`` were added.

    A known value keeps its number.  New ones are numbered within the buckets of their hash from where the bucket stands,
    and the buckets are interleaved, so numbers stay dense and no task sees more than a bucket.  ``buckets`` must not
    change between loads.  Registering under the live version changes nothing.
    """
    spark = items.sparkSession
    live = sinks.current_version(spark, path)
    if live == version:
        return sinks.read_table(spark, path)
    bucket = F.pmod(F.xxhash64("Value"), F.lit(buckets).cast("bigint"))
    fresh = items.where(F.col("Kind").isin(*kinds)).select("Kind", "Value").distinct()
    known = None if live is None else sinks.read_table(spark, path)
    if known is not None:
        fresh = fresh.join(known, ["Kind", "Value"], "left_anti")
        height = (F.max(F.expr(f"Number div {buckets}")) + 1).alias("_height")
        stand = known.groupBy("Kind", F.pmod("Number", F.lit(buckets).cast("bigint")).alias("_bucket")).agg(height)
        fresh = fresh.withColumn("_bucket", bucket).join(stand, ["Kind", "_bucket"], "left")
    else:
        fresh = fresh.withColumn("_bucket", bucket).withColumn("_height", F.lit(0))
    place = F.row_number().over(Window.partitionBy("Kind", "_bucket").orderBy("Value")) - 1
    number = ((F.coalesce("_height", F.lit(0)) + place).cast("bigint") * buckets + F.col("_bucket")).alias("Number")
    numbered = fresh.select("Kind", "Value", number)
    sinks.publish(numbered if known is None else known.unionByName(numbered), path, version)
    return sinks.read_table(spark, path)


def reach_words(items: DataFrame, numbers: DataFrame) -> DataFrame:
    """(Member, Period, Kind, Word, Bits) of ``items``; a kind without registered numbers counts by its values."""
    numbers = numbers.select("Kind", "Value", "Number")
    if small_enough(numbers):
        joined = items.join(F.broadcast(numbers), ["Kind", "Value"], "left")
    else:
        joined = split_left_join(items, numbers, "Value", [NO_MEMBER], ["Member", "Period"], also=["Kind"])
    numbered = joined.withColumn("Number", F.coalesce("Number", "Value"))
    return numbered.groupBy("Member", "Period", "Kind", F.expr(f"Number >> {WORD_BITS}").alias("Word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(Number & 63 AS INT))")).alias("Bits")
    )


def store_words(words: DataFrame, path: str) -> None:
    """Replace the words of exactly the periods in ``words``; storing a period twice is harmless."""
    sinks.overwrite_partitions(words, path, "Period", sort=["Member", "Kind", "Word"])


def load_reach(
    facts: DataFrame, path: str, version: str, member: str, day: str, keys: Sequence[str], unit: str = "month"
) -> None:
    """Add or replace the words of the periods that ``facts`` holds, in ``path``/words; the facts are read once.

    ``facts`` has all rows of each of its periods.  Run again under its version, a load leaves the same table.
    """
    items = f"{path}/items/{version}"
    sinks.overwrite(reach_items(facts, member, day, keys, unit), items)
    fixed = facts.sparkSession.read.parquet(items)
    store_words(reach_words(fixed, register_values(fixed, f"{path}/numbers", version, keys)), f"{path}/words")


def merged_counts(words: DataFrame, counts: Mapping[str, str], member: str = "Member") -> DataFrame:
    """Distinct values per member over all periods of ``words``: one column per name, of the kind it stands for.

    Words are OR-ed per member first, in the tasks and after the shuffle by word, so a hot member lies in many tasks.
    """
    merged = words.groupBy("Member", "Kind", "Word").agg(F.bit_or("Bits").alias("Bits"))
    bits = F.bit_count("Bits").cast("bigint")
    sums = [F.coalesce(F.sum(F.when(F.col("Kind") == kind, bits)), F.lit(0).cast("bigint")).alias(n) for n, kind in counts.items()]
    return merged.groupBy(F.col("Member").alias(member)).agg(*sums)
