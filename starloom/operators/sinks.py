"""Writing tables: append, overwrite, upsert, retention, layout.

Plain Parquet has no row-level updates.  Changes are therefore rewrites, kept
small by the layout: facts replace whole date partitions, so re-running a load
gives the same table instead of a second copy of its rows.
"""

from __future__ import annotations

import calendar
import datetime as dt
import json
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators import files
from starloom.operators.quality import assert_schema

#: Above this many rows a task starts another file.
MAX_RECORDS_PER_FILE = 20_000_000


# -- row-level changes as frames ------------------------------------------------


def delete_rows(table: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """``table`` without the rows whose key is listed."""
    return table.join(keys.select(*on).distinct(), list(on), "left_anti")


def update_rows(
    table: DataFrame, keys: DataFrame, on: Sequence[str], values: Mapping[str, Column], condition: Column | None = None
) -> DataFrame:
    """``table`` with new ``values`` in the listed rows that also meet ``condition``."""
    marked = table.join(keys.select(*on).distinct().withColumn("_listed", F.lit(True)), list(on), "left")
    hit = F.col("_listed").isNotNull()
    if condition is not None:
        hit = hit & condition
    kinds = dict(table.dtypes)
    return marked.select(
        *[
            F.when(hit, values[c].cast(kinds[c])).otherwise(F.col(c)).alias(c) if c in values else F.col(c)
            for c in table.columns
        ]
    )


def upsert_rows(table: DataFrame, rows: DataFrame, on: Sequence[str]) -> DataFrame:
    """Delete the keys of ``rows`` from ``table``, then add ``rows``.  A NULL in a key equals a NULL."""
    keys = rows.select(*[F.col(c).alias(f"_key_{i}") for i, c in enumerate(on)]).distinct()
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_key_{i}")) for i, c in enumerate(on)])
    return table.join(keys, same, "left_anti").unionByName(rows)


def newer_than(df: DataFrame, day: str, watermark: dt.date | None) -> DataFrame:
    """Rows after the last loaded day; None means a full load."""
    return df if watermark is None else df.filter(F.col(day) > F.lit(watermark))


def within_retention(
    df: DataFrame, day: str, as_of: dt.date, *, months: int | None = None, days: int | None = None
) -> DataFrame:
    """Rows young enough to keep: 24 months for facts, 90 days for errors."""
    return df.filter(F.col(day) >= _cutoff(as_of, months, days))


def past_retention(
    df: DataFrame, day: str, as_of: dt.date, *, months: int | None = None, days: int | None = None
) -> DataFrame:
    """The complement of :func:`within_retention`, for archiving."""
    return df.filter(F.col(day) < _cutoff(as_of, months, days))


def _cutoff_day(as_of: dt.date, months: int | None, days: int | None) -> dt.date:
    if (months is None) == (days is None):
        raise ValueError("give either months or days")
    if days is not None:
        return as_of - dt.timedelta(days=days)
    year, month = divmod(as_of.year * 12 + as_of.month - 1 - months, 12)
    last = calendar.monthrange(year, month + 1)[1]
    return dt.date(year, month + 1, min(as_of.day, last))


def _cutoff(as_of: dt.date, months: int | None, days: int | None) -> Column:
    return F.lit(_cutoff_day(as_of, months, days))


# -- files ------------------------------------------------------------------------


def laid_out(df: DataFrame, partition: str | None, sort: Sequence[str]) -> DataFrame:
    """Rows of one partition together and sorted by the leading keys.

    rebalance() lets adaptive execution split a partition that is too large and
    merge small ones, so one hot day does not become one task.
    """
    if partition is None:
        return df.sortWithinPartitions(*sort) if sort else df
    return df.hint("rebalance", partition).sortWithinPartitions(partition, *sort)


def append(df: DataFrame, path: str, partition: str | None = None, sort: Sequence[str] = ()) -> None:
    writer = laid_out(df, partition, sort).write.mode("append").option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
    (writer.partitionBy(partition) if partition else writer).parquet(path)


def overwrite(df: DataFrame, path: str, partition: str | None = None, sort: Sequence[str] = ()) -> None:
    """Replace the whole table (static lookups, roll-ups).  ``path`` must not be an input of ``df``."""
    writer = (
        laid_out(df, partition, sort)
        .write.mode("overwrite")
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .option("partitionOverwriteMode", "static")
    )
    (writer.partitionBy(partition) if partition else writer).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition: str, sort: Sequence[str] = ()) -> None:
    """Replace exactly the partitions present in ``df``; loading a day twice is harmless."""
    (
        laid_out(df, partition, sort)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .partitionBy(partition)
        .parquet(path)
    )


#: Folder levels of the error log; they repeat columns of the records.
ERROR_PARTITIONS = ("batch", "source", "month")


def error_folders(errors: DataFrame) -> DataFrame:
    return errors.withColumns(
        {
            "batch": F.concat(F.lit("id_"), F.col("ProcessingBatchID")),
            "source": F.col("SourceTable"),
            "month": F.date_format("ErrorDate", "yyyyMM").cast("int"),
        }
    )


def append_errors(errors: DataFrame, path: str, batch_id: str, source: str) -> None:
    """Log the errors of one table in one batch.

    They have a folder of their own, which a repeated batch replaces, also
    when it has no errors any more.
    """
    (
        error_folders(errors)
        .drop("batch", "source")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy("month")
        .parquet(f"{path}/batch=id_{batch_id}/source={source}")
    )


def rewrite_errors(errors: DataFrame, path: str) -> None:
    """Replace whole log partitions; ``errors`` has all rows of each partition it touches."""
    (
        error_folders(errors)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*ERROR_PARTITIONS)
        .parquet(path)
    )


# -- versioned tables: a new version beside the old one, then one small pointer ----


def current_version(spark: SparkSession, path: str) -> str | None:
    """Folder name of the live version of a versioned table; None when there is none."""
    version = files.read_text(spark, f"{path}/_CURRENT")
    if version == "":
        raise ValueError(f"{path}/_CURRENT names no version")
    return version


def publish(df: DataFrame, path: str, version: str, partition: str | None = None, sort: Sequence[str] = ()) -> None:
    """Write ``df`` as a new version of the table and make it the live one.

    A failed job leaves the old version live; ``df`` may read the old version.
    """
    spark = df.sparkSession
    overwrite(df, f"{path}/{version}", partition, sort)
    files.write_text(spark, f"{path}/_CURRENT", version)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The live version of a versioned table, or a plain table without the days that its retention has dropped."""
    version = current_version(spark, path)
    if version:
        return spark.read.parquet(f"{path}/{version}")
    table, cutoff = spark.read.parquet(path), retention_cutoff(spark, path)
    return table if cutoff is None else table.filter(F.col(cutoff[0]) >= F.lit(cutoff[1]))


def table_exists(spark: SparkSession, path: str) -> bool:
    return files.exists(spark, path)


# -- tables of partition folders: changed folder by folder, in place ---------------


def write_staged(df: DataFrame, path: str, partition: str, sort: Sequence[str] = ()) -> DataFrame:
    """Fix rows on disk beside the table, in the table's layout, before they become part of it."""
    overwrite(df, path, partition, sort)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def recover(spark: SparkSession, path: str) -> None:
    """Finish a replacement of folders that was interrupted."""
    text = files.read_text(spark, f"{path}/_REPLACING")
    if text:
        _finish_replacement(spark, path, json.loads(text))


def _finish_replacement(spark: SparkSession, path: str, plan: dict) -> None:
    partition, staged = plan["partition"], plan["staged"]
    present = files.partitions(spark, path, partition)
    for day, folder in files.partitions(spark, staged, partition).items():  # those moved before are gone from here
        if day in present:
            files.delete(spark, f"{path}/{present[day]}")
        files.move(spark, f"{staged}/{folder}", f"{path}/{folder}")
    for day, folder in present.items():
        if day not in plan["days"] and any(first <= day <= last for first, last in plan["ranges"]):
            files.delete(spark, f"{path}/{folder}")
    files.write_text(spark, f"{staged}/_MOVED", json.dumps(plan["changed"]))
    files.delete(spark, f"{path}/_REPLACING")


def replace_staged(
    spark: SparkSession, staging: str, path: str, partition: str, ranges: Sequence[tuple[dt.date, dt.date]]
) -> list[dt.date]:
    """Make the staged rows the whole content of the table within ``ranges`` of days (both ends included).

    Whole folders are moved, no data are read or written again.  Days of the ranges that have no staged rows lose their
    folder, days outside are not touched, rows outside are an error.  The plan is fixed in a marker first: a run that
    dies between two folders is finished by the next one, or by :func:`recover`; doing it twice changes nothing.
    Returns the days that were written or removed.
    """
    recover(spark, path)
    moved = files.read_text(spark, f"{staging}/_MOVED")
    if moved is not None:
        return list(map(dt.date.fromisoformat, json.loads(moved)))
    days = sorted(files.partitions(spark, staging, partition))
    within = [(first.isoformat(), last.isoformat()) for first, last in ranges]
    outside = [day for day in days if not any(first <= day <= last for first, last in within)]
    if outside:
        raise ValueError(f"rows of {outside[0]} are outside of the range to replace")
    before = [day for day in files.partitions(spark, path, partition) if any(first <= day <= last for first, last in within)]
    plan = {"staged": staging, "partition": partition, "ranges": within, "days": days, "changed": sorted({*days, *before})}
    files.write_text(spark, f"{path}/_REPLACING", json.dumps(plan))
    _finish_replacement(spark, path, plan)
    return list(map(dt.date.fromisoformat, plan["changed"]))


def replace_ranges(
    df: DataFrame, path: str, partition: str, ranges: Sequence[tuple[dt.date, dt.date]], staging: str, sort: Sequence[str] = ()
) -> list[dt.date]:
    """:func:`replace_staged` for rows that are not on disk yet; they may be read from the table itself."""
    write_staged(df, staging, partition, sort)
    return replace_staged(df.sparkSession, staging, path, partition, ranges)


def retention_cutoff(spark: SparkSession, path: str) -> tuple[str, dt.date] | None:
    """Partition column and first day that readers still see; None without retention."""
    text = files.read_text(spark, f"{path}/_RETENTION")
    if not text:
        return None
    column, day = text.split()
    return column, dt.date.fromisoformat(day)


def drop_expired(
    spark: SparkSession, path: str, partition: str, as_of: dt.date, archive: str | None = None, *,
    months: int | None = None, days: int | None = None,
) -> list[str]:
    """Drop the day folders past their retention, or move them to ``archive``, through the file system.

    No data are read or written.  The first day to keep is recorded before anything is dropped and never goes back, so
    readers lose the expired days in one step and a run that dies is finished by the next one.  Loads go on writing into
    the same table.
    """
    recover(spark, path)
    first = _cutoff_day(as_of, months, days)
    known = retention_cutoff(spark, path)
    first = max(first, known[1]) if known else first
    files.write_text(spark, f"{path}/_RETENTION", f"{partition} {first.isoformat()}")
    gone = {day: folder for day, folder in files.partitions(spark, path, partition).items() if day < first.isoformat()}
    for folder in gone.values():
        if archive:
            files.move_into(spark, f"{path}/{folder}", f"{archive}/{folder}")
        else:
            files.delete(spark, f"{path}/{folder}")
    return sorted(gone)


def drop_duplicates_in_place(spark: SparkSession, path: str, partition: str, staging: str, sort: Sequence[str] = ()) -> list[str]:
    """Remove repeated rows, rewriting only the day folders that hold any.

    Fingerprints of 64 bits are counted first; a folder whose fingerprints repeat is read again and reduced on whole
    rows, so two different rows of one fingerprint cost a rewrite and no row.
    """
    recover(spark, path)
    table = read_table(spark, path)
    prints = table.select(F.col(partition).cast("string").alias("day"), F.xxhash64(*table.columns).alias("print"))
    repeated = prints.groupBy("day", "print").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("day").distinct()
    days = sorted(r.day for r in repeated.collect())  # folders of the table at most
    if days:
        ranges = [(dt.date.fromisoformat(day),) * 2 for day in days]
        wanted = table.filter(F.col(partition).isin([first for first, _ in ranges]))
        replace_ranges(wanted.dropDuplicates(), path, partition, ranges, staging, sort)
    return days


# -- maintenance of either form ------------------------------------------------------


def apply_retention(
    spark: SparkSession, path: str, day: str, as_of: dt.date, version: str, archive: str | None = None,
    partition: str | None = None, **age,
) -> None:
    """Drop (or first archive) the rows past their retention: folders of a partitioned table, rows of a versioned one."""
    if current_version(spark, path) is None and files.partitions(spark, path, day):
        drop_expired(spark, path, day, as_of, archive, **age)
        return
    table = read_table(spark, path)
    if archive:  # a repeated run replaces what it archived, and leaves it where nothing is past any more
        gone = past_retention(table, day, as_of, **age).withColumn("archived_by", F.lit(version))
        overwrite_partitions(gone, archive, "archived_by")
    publish(within_retention(table, day, as_of, **age), path, version, partition)


def rebuild_distinct(spark: SparkSession, path: str, version: str, partition: str | None = None) -> None:
    """Remove duplicate rows: in the folders that have any, or from a versioned table as a new version."""
    if partition and current_version(spark, path) is None and files.partitions(spark, path, partition):
        drop_duplicates_in_place(spark, path, partition, f"{path}/_distinct/{version}")
        return
    publish(read_table(spark, path).dropDuplicates(), path, version, partition)


def checked(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """The columns in table order; fails before writing when one is missing."""
    columns = list(columns)
    return assert_schema(df, columns).select(*columns)
