"""A journal of committed steps, from which an interrupted batch goes on.

A step commits one small record per table, batch and kind of step, as a file that is renamed into place after the step's
own data are in place.  A step without a record runs again, and every step is written so that running it twice changes
nothing.  The same records say which days of a table a load has covered, so the next load takes what is still missing
and a reload replaces exactly its range, days that became empty included.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starloom.operators import files

RECORD = (
    "BatchID STRING, Step STRING, SourceTable STRING, FirstDay DATE, LastDay DATE, RowsIn BIGINT, RowsLoaded BIGINT,"
    " RowsRejected BIGINT, Days ARRAY<DATE>, CommittedAt TIMESTAMP"
)
#: Bounds of a load of everything.
BEGIN, FOREVER = dt.date(1, 1, 1), dt.date(9999, 12, 31)


class Ledger:
    """The records of one warehouse; ``batch`` is the run that commits through this object."""

    def __init__(self, spark: SparkSession, root: str, batch: str):
        self.spark, self.root, self.batch = spark, f"{root}/_ledger", batch

    def _path(self, step: str, table: str) -> str:
        return f"{self.root}/{self.batch}/{step}-{table}.json"

    def record(self, step: str, table: str) -> dict | None:
        text = files.read_text(self.spark, self._path(step, table))
        return None if text is None else json.loads(text)

    def commit(self, step: str, table: str, **figures) -> None:
        row = {"BatchID": self.batch, "Step": step, "SourceTable": table, "CommittedAt": dt.datetime.now(dt.timezone.utc), **figures}
        files.write_text(self.spark, self._path(step, table), json.dumps(row, default=lambda v: v.isoformat()))

    def run(self, step: str, table: str, work: Callable[[], dict | None]) -> dict:
        """The step's record; ``work`` runs and commits only where there is none yet."""
        done = self.record(step, table)
        if done is None:
            self.commit(step, table, **(work() or {}))
            done = self.record(step, table)
        return done

    def frame(self) -> DataFrame:
        """The records of all batches."""
        if not any(not name.startswith("_") for name in files.children(self.spark, self.root)):
            return self.spark.createDataFrame([], RECORD)
        return self.spark.read.schema(RECORD).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").json(self.root)


def covered_ranges(records: DataFrame) -> DataFrame:
    """Per table the days that loads have covered, as ranges that neither overlap nor touch.

    A record opens a new range when it begins more than a day after all before it have ended.
    """
    loads = records.filter((F.col("Step") == "fact") & F.col("FirstDay").isNotNull())
    by_start = Window.partitionBy("SourceTable").orderBy("FirstDay", "LastDay")
    reached = F.max("LastDay").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce((F.datediff("FirstDay", reached) > 1).cast("int"), F.lit(1))
    grouped = loads.withColumn("_opens", opens).withColumn("_range", F.sum("_opens").over(by_start.rowsBetween(Window.unboundedPreceding, 0)))
    return grouped.groupBy("SourceTable", "_range").agg(F.min("FirstDay").alias("FirstDay"), F.max("LastDay").alias("LastDay")).drop("_range")


def missing_ranges(records: DataFrame, table: str, first: dt.date, last: dt.date) -> list[tuple[dt.date, dt.date]]:
    """The ranges between ``first`` and ``last`` that no load of ``table`` has covered: one per gap, in order."""
    rows = covered_ranges(records.filter(F.col("SourceTable") == table)).orderBy("FirstDay").collect()
    gaps, start = [], first
    for r in rows:
        if r.FirstDay > last or start > last:
            break
        if r.FirstDay > start:
            gaps.append((start, r.FirstDay - dt.timedelta(days=1)))
        if r.LastDay >= start:
            start = r.LastDay + dt.timedelta(days=1) if r.LastDay < FOREVER else FOREVER
    if start <= last and start != FOREVER:
        gaps.append((start, last))
    return gaps


def contiguous(days: Iterable[dt.date], unit_end: Callable[[dt.date], dt.date]) -> list[tuple[dt.date, dt.date]]:
    """Periods, given by their first days, as few ranges [first day, day after the last]."""
    ranges: list[tuple[dt.date, dt.date]] = []
    for day in sorted(set(days)):
        end = unit_end(day)
        if ranges and day <= ranges[-1][1]:
            ranges[-1] = (ranges[-1][0], max(end, ranges[-1][1]))
        else:
            ranges.append((day, end))
    return ranges
