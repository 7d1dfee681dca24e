"""Slowly changing dimensions: versioned merge, overwrite sync, as-of lookup."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starloom.functions.dates import FAR_FUTURE
from starloom.functions.keys import surrogate_key as hashed_key
from starloom.functions.lookups import current, small_side

VERSION_COLUMNS = ("ValidFromDate", "ValidToDate", "IsCurrent", "Version")
#: Lineage columns that follow the data but do not by themselves make a new version.
LINEAGE_COLUMNS = ("SourceUpdateDate", "EffectiveStartDate", "EffectiveEndDate")

NEW, CHANGED, DELETED, SAME = "NEW", "CHANGED", "DELETED", "SAME"


def is_versioned(columns: Iterable[str]) -> bool:
    return set(VERSION_COLUMNS) <= set(columns)


def dedup_latest(df: DataFrame, key: str | Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first under ``order`` (add a total order for stable results).

    The rank filter becomes a per-task top-1 before the shuffle, so a hot key
    sends one row per task, not all of them.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def latest_versions(dimension: DataFrame, natural_key: str) -> DataFrame:
    """Highest Version per (member, ValidFromDate): what a versioned-merge table would keep."""
    return dedup_latest(dimension, [natural_key, "ValidFromDate"], [F.col("Version").desc()])


def initial_versions(src: DataFrame) -> DataFrame:
    """First load: every member is current, version 1, open-ended."""
    return src.withColumns(
        {"ValidToDate": F.lit(FAR_FUTURE), "IsCurrent": F.lit(1), "Version": F.lit(1).cast("bigint")}
    )


def _default_tracked(columns: Iterable[str], surrogate_key: str, natural_key: str) -> list[str]:
    ignored = {surrogate_key, natural_key, *VERSION_COLUMNS, *LINEAGE_COLUMNS}
    return [c for c in columns if c not in ignored]


def scd2_changes(
    src: DataFrame, dim: DataFrame, natural_key: str, surrogate_key: str, tracked: Sequence[str] | None = None
) -> DataFrame:
    """Compare the source with the current versions.

    One row per member with its ``action``, the source row ``s``, the current
    row ``d``, and ``last_version`` and ``last_end`` of its closed versions.  A
    change counts only when the source's ValidFromDate is later than the
    current one; values are compared null-safe and by type.
    """
    tracked = list(tracked) if tracked else _default_tracked(src.columns, surrogate_key, natural_key)
    source = src.select(F.col(natural_key).alias("_sk_nk"), F.struct(*src.columns).alias("s"))
    live = current(dim).select(F.col(natural_key).alias("_d_nk"), F.struct(*dim.columns).alias("d"))
    past = (
        dim.filter("IsCurrent = 0")
        .groupBy(F.col(natural_key).alias("_p_nk"))
        .agg(F.max("Version").alias("last_version"), F.max("ValidToDate").alias("last_end"))
    )
    joined = source.join(live, F.col("_sk_nk") == F.col("_d_nk"), "full_outer").join(
        past, F.col("_sk_nk") == F.col("_p_nk"), "left"
    )
    differs = F.lit(False)
    for name in tracked:
        differs = differs | ~F.col(f"s.{name}").eqNullSafe(F.col(f"d.{name}"))
    advanced = F.col("s.ValidFromDate") > F.col("d.ValidFromDate")
    action = (
        F.when(F.col("d").isNull(), NEW)
        .when(F.col("s").isNull(), DELETED)
        .when(differs & advanced, CHANGED)
        .otherwise(SAME)
    )
    return joined.select(
        F.coalesce("_sk_nk", "_d_nk").alias(natural_key), action.alias("action"), "s", "d", "last_version", "last_end"
    )


def _expiry(expiry: str, changes: DataFrame, as_of: dt.date) -> Column:
    own = F.col("s.ValidFromDate")
    if expiry == "own":
        return own
    if expiry == "day_before":
        return F.date_sub(own, 1)
    if expiry == "batch_min":
        earliest = changes.filter(F.col("action") == CHANGED).agg(F.min("s.ValidFromDate").alias("m"))
        return earliest.scalar()
    raise ValueError("expiry is 'own', 'day_before' or 'batch_min'")


def scd2_merge(
    src: DataFrame,
    dim: DataFrame,
    natural_key: str,
    surrogate_key: str,
    as_of: dt.date,
    tracked: Sequence[str] | None = None,
    expiry: str = "own",
) -> DataFrame:
    """The next state of a versioned dimension.

    New members start at version 1 (or go on from their last version when they
    come back), changed ones get a new version and close the old one, members
    gone from the source are closed at ``as_of``, the rest stays untouched.
    By default a version ends where the next one starts (half-open intervals).
    A member that comes back opens no earlier than its last version ended; where
    that moves its start, its surrogate key follows from the new start.

    Every joined member emits its one or two rows through ``inline``, so the
    comparison runs once; the closed history is only appended to.
    """
    columns = dim.columns
    changes = scd2_changes(src, dim, natural_key, surrogate_key, tracked)
    kinds = {f.name: f.dataType for f in dim.schema.fields}
    action = F.col("action")
    closes_at = F.when(action == DELETED, F.lit(as_of)).otherwise(_expiry(expiry, changes, as_of))
    closing = action.isin(CHANGED, DELETED)

    def row(values) -> Column:
        return F.struct(*[values(c).cast(kinds[c]).alias(c) for c in columns])

    kept = row(
        lambda c: {
            "ValidToDate": F.when(closing, closes_at).otherwise(F.col("d.ValidToDate")),
            "IsCurrent": F.when(closing, F.lit(0)).otherwise(F.col("d.IsCurrent")),
        }.get(c, F.col(f"d.{c}"))
    )
    version = F.coalesce(F.col("d.Version"), F.col("last_version"), F.lit(0)) + 1
    returns_late = F.col("d").isNull() & (F.col("s.ValidFromDate") < F.col("last_end"))
    start = F.when(returns_late, F.col("last_end")).otherwise(F.col("s.ValidFromDate"))
    opened = row(
        lambda c: {
            surrogate_key: F.when(returns_late, hashed_key(F.col(f"s.{natural_key}"), F.col("last_end"))).otherwise(
                F.col(f"s.{surrogate_key}")
            ),
            "ValidFromDate": start,
            "ValidToDate": F.lit(FAR_FUTURE),
            "IsCurrent": F.lit(1),
            "Version": version,
        }.get(c, F.col(f"s.{c}") if c in src.columns else F.lit(None))
    )
    rows = F.array_compact(
        F.array(F.when(F.col("d").isNotNull(), kept), F.when(action.isin(NEW, CHANGED), opened))
    )
    merged = changes.select(F.inline(rows)).toDF(*columns)
    return dim.filter("IsCurrent = 0").unionByName(merged)


def scd1_changes(src: DataFrame, dim: DataFrame, natural_key: str, surrogate_key: str) -> DataFrame:
    """Compare an overwritten dimension with its source, surrogate key apart."""
    compared = [c for c in dim.columns if c not in (natural_key, surrogate_key)]
    source = src.select(F.col(natural_key).alias("_s_nk"), F.struct(*dim.columns).alias("s"))
    target = dim.select(F.col(natural_key).alias("_d_nk"), F.struct(*dim.columns).alias("d"))
    joined = source.join(target, F.col("_s_nk") == F.col("_d_nk"), "full_outer")
    differs = F.lit(False)
    for name in compared:
        differs = differs | ~F.col(f"s.{name}").eqNullSafe(F.col(f"d.{name}"))
    action = (
        F.when(F.col("d").isNull(), NEW).when(F.col("s").isNull(), DELETED).when(differs, CHANGED).otherwise(SAME)
    )
    return joined.select(F.coalesce("_s_nk", "_d_nk").alias(natural_key), action.alias("action"), "s", "d")


def scd1_sync(src: DataFrame, dim: DataFrame, natural_key: str, surrogate_key: str) -> DataFrame:
    """The next state of an overwritten dimension.

    New members are added, members gone from the source are removed, changed
    ones take the source's values; an existing member keeps its surrogate key.
    """
    changes = scd1_changes(src, dim, natural_key, surrogate_key)
    values = [
        F.coalesce(F.col(f"d.{c}"), F.col(f"s.{c}")).alias(c) if c == surrogate_key else F.col(f"s.{c}").alias(c)
        for c in dim.columns
    ]
    return changes.filter(F.col("action") != DELETED).select(*values)


def sync_summary(changes: DataFrame, errors: int = 0) -> DataFrame:
    """inserted / updated / deleted / errors of one sync.

    A changed versioned member counts as updated and, as it adds a row, as inserted.
    """
    versioned = "last_version" in changes.columns
    inserted = [NEW, CHANGED] if versioned else [NEW]
    return changes.agg(
        F.count_if(F.col("action").isin(*inserted)).alias("inserted"),
        F.count_if(F.col("action") == CHANGED).alias("updated"),
        F.count_if(F.col("action") == DELETED).alias("deleted"),
        F.lit(errors).cast("bigint").alias("errors"),
    )


def as_of_members(dimension: DataFrame, day: dt.date) -> DataFrame:
    """The members as they were on ``day``."""
    return dimension.filter(
        (F.col("ValidFromDate") <= F.lit(day))
        & (F.col("ValidToDate").isNull() | (F.col("ValidToDate") > F.lit(day)))
    )


def as_of_join(
    facts: DataFrame, dimension: DataFrame, natural_key: str, day: str, columns: Sequence[str], how: str = "left"
) -> DataFrame:
    """Each fact with the member version valid on its own day.

    An equi-join on the natural key with the interval as residual condition:
    it hashes or sorts on the key, and a member has few versions.
    """
    versions = dimension.select(
        F.col(natural_key).alias("_nk"), F.col("ValidFromDate").alias("_from"), F.col("ValidToDate").alias("_to"),
        *columns,
    )
    on = (
        (F.col(natural_key) == F.col("_nk"))
        & (F.col("_from") <= F.col(day))
        & (F.col("_to").isNull() | (F.col("_to") > F.col(day)))
    )
    return facts.join(small_side(versions), on, how).drop("_nk", "_from", "_to")
