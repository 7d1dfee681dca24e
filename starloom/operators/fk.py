"""Natural key -> surrogate key resolution with quarantine of the misses."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.lookups import current, nullable_left_join, small_side
from starloom.operators import validation
from starloom.operators.facts import FACTS, FactSpec, FKSpec, record_natural_key
from starloom.operators.quarantine import build_error_records, payload_json
from starloom.operators.skew import split_left_join

KeyMaps = Callable[[FKSpec], DataFrame]

_MISSES = "_fk_misses"


def key_map(dimension: DataFrame, fk: FKSpec, surrogate: str) -> DataFrame:
    """(natural key, surrogate key) of a stored dimension's current members."""
    members = current(dimension) if fk.scd2 else dimension
    return members.select(F.col(fk.natural_key), F.col(surrogate))


def _miss_message(fk: FKSpec) -> Column:
    # The two texts of a miss.
    suffix = " (IsCurrent=1)" if fk.scd2 else ""
    return F.when(
        F.col(fk.extract).isNull(), F.lit(f"{fk.extract} is NULL (required for {fk.insert})")
    ).otherwise(
        F.concat(F.lit(f"FK miss: {fk.dim}.{fk.natural_key}="), F.col(fk.extract).cast("string"), F.lit(f" not found{suffix}"))
    )


def _look_up(df: DataFrame, fk: FKSpec, members: DataFrame, row_key: list[str], hot: Sequence | None) -> DataFrame:
    natural, surrogate = members.columns[0], members.columns[1]
    if hot is not None:
        side = members.select(F.col(natural).alias(fk.extract), F.col(surrogate).alias(fk.insert))
        return split_left_join(df, side, fk.extract, hot, row_key)
    if fk.required:
        side = members.select(F.col(natural).alias("_nk"), F.col(surrogate).alias(fk.insert))
        return df.join(side, F.col(fk.extract) == F.col("_nk"), "left").drop("_nk")
    side = members.select(F.col(natural).alias(fk.extract), F.col(surrogate).alias(fk.insert))
    return nullable_left_join(df, side, fk.extract, row_key)


@dataclass
class Resolved:
    """Rows tagged with their misses; ``valid`` and ``errors`` partition them."""

    tagged: DataFrame
    spec: FactSpec
    extract_columns: list[str]

    @property
    def _passed(self) -> Column:
        return F.size(_MISSES) == 0

    def _insert_columns(self) -> list[str]:
        by_extract = {fk.extract: fk.insert for fk in self.spec.fks}
        return [by_extract.get(c, c) for c in self.extract_columns]

    @property
    def valid(self) -> DataFrame:
        return self.tagged.filter(self._passed).select(*self._insert_columns())

    @property
    def rejected(self) -> DataFrame:
        return self.tagged.filter(~self._passed)

    def errors(
        self,
        batch_id: str = "manual",
        error_time: dt.datetime | None = None,
        payload_columns: int | None = None,
        all_messages: bool = False,
    ) -> DataFrame:
        """One error record per rejected row.

        The message names the first missing key, or with ``all_messages`` every
        one.  Whole rows are recorded, so that they can be replayed later;
        ``payload_columns`` keeps only the first ones.
        """
        names = self.extract_columns[:payload_columns] if payload_columns else self.extract_columns
        message = F.concat_ws("; ", _MISSES) if all_messages else F.get(F.col(_MISSES), 0)
        return build_error_records(
            self.rejected,
            source_table=self.spec.name,
            natural_key=record_natural_key(self.tagged, self.spec),
            message=message,
            payload=payload_json(names),
            task_name=f"load_fact_{self.spec.name.lower()}",
            batch_id=batch_id,
            error_time=error_time,
        )


def resolve_fks(
    fact: DataFrame,
    spec: FactSpec | str,
    key_maps: KeyMaps,
    *,
    on_missing: str = "quarantine",
    fks: Iterable[FKSpec] | None = None,
    hot: Mapping[str, Sequence] | None = None,
) -> Resolved:
    """Attach the surrogate key of every foreign key in one pass.

    Keys are resolved against *all* current members and on raw values: a NULL
    key is a NULL key, not member 0.  A miss of a required key tags the row; an
    optional miss gets the default key.  With ``on_missing="default"`` required
    misses get the default key too (late-arriving members).

    ``hot`` names natural keys per extracted column (see ``skew.heavy_keys``) whose rows, like those of NULL, are dealt
    over the partitions of the join; needed where the member table is too large to be broadcast.
    """
    if on_missing not in ("quarantine", "default"):
        raise ValueError("on_missing is 'quarantine' or 'default'")
    spec = FACTS[spec] if isinstance(spec, str) else spec
    fks = tuple(fks) if fks is not None else spec.fks
    extract_columns = list(fact.columns)
    row_key = [fk.extract for fk in fks] + [c for c in spec.record_key if c in fact.columns]
    df = fact
    for fk in fks:
        df = _look_up(df, fk, key_maps(fk), row_key, (hot or {}).get(fk.extract))
    misses = [F.when(F.col(fk.insert).isNull(), _miss_message(fk)) for fk in fks if fk.required]
    if on_missing == "default" or not misses:
        tags = F.array().cast("array<string>")
    else:
        tags = F.array_compact(F.array(*misses))
    df = df.withColumn(_MISSES, tags).withColumns(
        {fk.insert: F.coalesce(F.col(fk.insert), F.lit(fk.default).cast("bigint")) for fk in fks}
    )
    kept = [*extract_columns, *[fk.insert for fk in fks], _MISSES]
    return Resolved(df.select(*kept), spec, extract_columns)


def resolve_checked(rows: DataFrame, spec: FactSpec, key_maps: KeyMaps) -> Resolved:
    """Check and resolve rows; what is wrong with a row counts as a miss, so that only sound rows are valid."""
    resolved = resolve_fks(validation.checked(rows, spec), spec, key_maps)
    resolved.extract_columns.remove(validation.VIOLATIONS)
    messages = F.transform(validation.VIOLATIONS, lambda v: v["message"])
    resolved.tagged = resolved.tagged.withColumn(_MISSES, F.concat(messages, _MISSES))
    return resolved


def attach_current(fact: DataFrame, dimension: DataFrame, natural_key: str, columns: Iterable[str]) -> DataFrame:
    """Query-time lookup by natural key, for facts that keep it: nothing is ever missing for good."""
    members = current(dimension).select(natural_key, *columns)
    return fact.join(small_side(members), natural_key, "left")


def miss_rates(tagged: DataFrame, fks: Iterable[FKSpec], threshold: float = 0.05) -> DataFrame:
    """Share of unresolved rows per foreign key, one row each, with an alert flag."""
    fks = list(fks)
    counts = tagged.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(fk.insert) == fk.default).alias(fk.insert) for fk in fks]
    )
    pairs = F.explode(F.create_map(*[x for fk in fks for x in (F.lit(fk.insert), F.col(fk.insert))]))
    share = F.round(F.try_divide(F.col("Misses").cast("double"), F.col("rows").cast("double")), 4)
    return counts.select("rows", pairs.alias("ForeignKey", "Misses")).select(
        "ForeignKey",
        F.col("rows").alias("RowCount"),
        "Misses",
        share.alias("MissRate"),
        (share > threshold).cast("int").alias("Alert"),
    )
