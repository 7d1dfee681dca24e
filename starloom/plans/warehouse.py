"""The warehouse as a set of lazily planned tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.keys import WIDE_KEYS, KeyPolicy
from starloom.functions.lookups import current, small_enough, small_side
from starloom.operators.dimensions import DIMENSIONS
from starloom.operators.facts import FACTS, FKSpec
from starloom.operators.fk import Resolved, key_map, resolve_fks
from starloom.operators.quarantine import ERROR_COLUMNS
from starloom.operators.scd import initial_versions
from starloom.operators.skew import NO_MEMBER, heavy_keys
from starloom.sources import calendar
from starloom.sources.literals import LITERAL_TABLES, literal_table


class Warehouse:
    """Dimensions, facts and lookups by name.

    Built either from source tables (everything is derived on the fly) or from
    stored tables.  Nothing is computed until a result is used; a table is
    planned once per instance.
    """

    def __init__(
        self,
        spark: SparkSession,
        tables: Mapping[str, Callable[[], DataFrame]],
        drivers: Mapping[str, Callable[[], DataFrame]] | None = None,
        key_maps: Mapping[str, Callable[[], DataFrame]] | None = None,
    ):
        self.spark = spark
        self._tables = dict(tables)
        self._drivers = dict(drivers or {})
        self._key_maps = dict(key_maps or {})
        self._planned: dict[str, DataFrame] = {}
        self._hot: dict[str, list] = {}

    # -- construction -------------------------------------------------------

    @classmethod
    def from_sources(
        cls,
        spark: SparkSession,
        sources: Mapping[str, DataFrame],
        as_of: dt.date,
        *,
        keys: KeyPolicy = WIDE_KEYS,
        batch_id: str = "manual",
        loaded_at: dt.datetime | None = None,
        calendar_start: dt.date = calendar.CALENDAR_START,
        years_ahead: int = 10,
    ) -> "Warehouse":
        """First load of everything, as of ``as_of``."""
        tables: dict[str, Callable[[], DataFrame]] = {
            name: (lambda n=name: literal_table(spark, n)) for name in LITERAL_TABLES
        }
        tables["DimDate"] = lambda: calendar.build_calendar(spark, as_of, calendar_start, years_ahead)
        drivers, maps = {}, {}
        for spec in DIMENSIONS.values():

            def load(s=spec):
                rows = s.build(sources, as_of, keys)
                return initial_versions(rows) if s.scd2 else rows

            tables[spec.name] = load
            drivers[spec.name] = lambda s=spec: sources[s.driver]
            if spec.key_parts:
                maps[spec.name] = lambda s=spec: s.key_map(sources, keys)
        warehouse = cls(spark, tables, drivers, maps)
        for spec in FACTS.values():

            def extract(s=spec):
                return s.build(sources, as_of, batch_id=batch_id, loaded_at=loaded_at, keys=keys)

            warehouse._tables[f"extract:{spec.name}"] = extract
            warehouse._tables[spec.name] = lambda s=spec: warehouse.resolve(s.name).valid
        return warehouse

    @classmethod
    def from_storage(cls, spark: SparkSession, root: str) -> "Warehouse":
        """Tables written by ``plans.batch``; file sizes let Spark choose the joins itself."""
        from starloom.operators.sinks import read_table

        names = [*DIMENSIONS, *LITERAL_TABLES, "DimDate", *FACTS]
        tables = {n: (lambda n=n: read_table(spark, f"{root}/{n}")) for n in names}
        tables["error_records"] = lambda: read_table(spark, f"{root}/error_records").select(*ERROR_COLUMNS)
        return cls(spark, tables)

    def replaced(self, **tables: DataFrame) -> "Warehouse":
        """A copy in which some tables are given."""
        copy = Warehouse(self.spark, self._tables, self._drivers, self._key_maps)
        copy._hot = dict(self._hot)
        for name, df in tables.items():
            copy._tables[name] = lambda df=df: df
            copy._drivers.pop(name, None)
            copy._key_maps.pop(name, None)
        for spec in FACTS.values():
            if spec.name not in tables and f"extract:{spec.name}" in copy._tables:
                copy._tables[spec.name] = lambda s=spec: copy.resolve(s.name).valid
        return copy

    def with_extract(self, fact: str, load: Callable[[], DataFrame]) -> "Warehouse":
        """A copy that resolves other extracted rows of one fact."""
        copy = self.replaced()
        copy._tables[f"extract:{fact}"] = load
        return copy

    # -- access -------------------------------------------------------------

    def __contains__(self, name: str) -> bool:
        return name in self._tables

    def table(self, name: str) -> DataFrame:
        if name not in self._planned:
            self._planned[name] = self._tables[name]()
        return self._planned[name]

    def current(self, name: str) -> DataFrame:
        return current(self.table(name))

    def bounded(self, df: DataFrame, dimension: str) -> DataFrame:
        """``df`` (at most one row per member of ``dimension``) as a join side.

        Broadcast when the table that drives the dimension is small enough; a
        stored dimension is left to Spark, which knows its size.
        """
        driver = self._drivers.get(dimension)
        return small_side(df, driver()) if driver else df

    def broadcastable(self, dimension: str) -> bool:
        """Whether ``dimension`` is joined without a shuffle: hinted by :meth:`bounded`, or stored and small by its files."""
        driver = self._drivers.get(dimension)
        if driver:
            return small_enough(driver(), derived=True)
        return small_enough(self.table(dimension))

    def measure_hot_keys(self, fact: str, *keys: str, least_share: float = 0.02) -> dict[str, list]:
        """Count the keys of a fact table; joins of the views on a column of that name deal out what holds at least ``least_share``."""
        self._hot |= {key: heavy_keys(self.table(fact), key, least_share) for key in keys}
        return {key: self._hot[key] for key in keys}

    def hot_keys(self, key: str) -> list:
        """Keys whose rows a shuffled join must not send to one task: no member, and the measured ones."""
        return [NO_MEMBER, *[v for v in self._hot.get(key, []) if v != NO_MEMBER]]

    def side(self, name: str) -> DataFrame:
        """A whole dimension as a join side."""
        if name in LITERAL_TABLES:
            return self.fixed(self.table(name))
        return self.bounded(self.table(name), name)

    @staticmethod
    def fixed(df: DataFrame) -> DataFrame:
        """A join side of fixed size (a literal table, one row per region name)."""
        return F.broadcast(df)

    def current_side(self, name: str, *columns: str) -> DataFrame:
        """Current members, reduced to ``columns``, as a join side."""
        return self.bounded(self.current(name).select(*columns), name)

    def key_map(self, fk: FKSpec) -> DataFrame:
        if fk.dim in self._key_maps:
            return self.bounded(self._key_maps[fk.dim](), fk.dim)
        surrogate = DIMENSIONS[fk.dim].key if fk.dim in DIMENSIONS else self.table(fk.dim).columns[0]
        members = key_map(self.table(fk.dim), fk, surrogate)
        return self.fixed(members) if fk.dim in LITERAL_TABLES else members

    def resolve(self, fact: str, **options) -> Resolved:
        """Extracted fact rows with their surrogate keys, misses tagged."""
        return resolve_fks(self.table(f"extract:{fact}"), fact, self.key_map, **options)
