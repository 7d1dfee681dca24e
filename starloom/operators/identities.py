"""Member numbers that never change: a stored table from natural key to number that only grows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starloom.operators import sinks


def register_numbers(members: DataFrame, path: str, natural: Sequence[str], number: str, order: Sequence[str], version: str) -> DataFrame:
    """The registry after ``members`` were added: (natural key, number).

    A known member keeps its number, also when it is missing from ``members``; new ones get the next numbers in
    ``order``.  They are numbered in one task, so this is for lists that grow by a few members, such as territories.
    A NULL in a natural key is a value.  Registering the same members again under the same version changes nothing.
    """
    spark = members.sparkSession
    live = sinks.current_version(spark, path)
    if live == version:
        return sinks.read_table(spark, path)
    fresh = members.select(*natural, *[c for c in order if c not in natural]).dropDuplicates(list(natural))
    rank = F.row_number().over(Window.orderBy(*order, *natural)).cast("bigint")
    if live is None:
        known = None
        numbered = fresh.select(*natural, rank.alias(number))
    else:
        known = sinks.read_table(spark, path)
        same = reduce(Column.__and__, [fresh[c].eqNullSafe(known[c]) for c in natural])
        last = F.broadcast(known.agg(F.max(number).alias("_last")))  # one row
        added = fresh.join(known, same, "left_anti").crossJoin(last)
        numbered = added.select(*natural, (rank + F.coalesce("_last", F.lit(0))).alias(number))
    sinks.publish(numbered if known is None else known.unionByName(numbered), path, version)
    return sinks.read_table(spark, path)


def with_registered_numbers(rows: DataFrame, registry: DataFrame, natural: Sequence[str], number: str) -> DataFrame:
    """``rows`` with ``number`` replaced by the registered one."""
    known = registry.select(*[F.col(c).alias(f"_{c}") for c in natural], F.col(number).alias("_number"))
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in natural])
    joined = rows.join(known, same, "left")
    return joined.select(*[F.col("_number").alias(c) if c == number else F.col(c) for c in rows.columns])
