"""One batch: dimensions, then facts, then the retry of earlier misses, then the roll-ups of the periods touched.

Every step commits to a ledger (see ``operators.ledger``), and a batch that was interrupted goes on after the last
committed step.  A step that ran without committing runs again and gives the same tables: dimensions are versions beside
the live one, facts and roll-ups replace exactly the days they cover from rows fixed on disk, and a batch's errors
replace themselves.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.keys import WIDE_KEYS, KeyPolicy
from starloom.operators import files, scd, sinks, validation
from starloom.operators.dimensions import DIMENSIONS, DimSpec
from starloom.operators.facts import FACTS, FactSpec
from starloom.operators.fk import resolve_checked
from starloom.operators.identities import register_numbers, with_registered_numbers
from starloom.operators.ledger import BEGIN, FOREVER, Ledger, contiguous
from starloom.operators.quarantine import apply_error_updates, retry_candidates, retry_errors
from starloom.operators.rollups import ROLLUP_FACTS, ROLLUPS, regional_sales_refresh
from starloom.plans.warehouse import Warehouse
from starloom.schemas import conform
from starloom.sources import calendar
from starloom.sources.literals import LITERAL_TABLES, literal_table

ERRORS = "error_records"
Ranges = Sequence[tuple[dt.date, dt.date]]


def next_dimension(
    spark: SparkSession, spec: DimSpec, src: Mapping[str, DataFrame], root: str, as_of: dt.date, batch_id: str,
    keys: KeyPolicy = WIDE_KEYS,
) -> DataFrame:
    """The dimension after this batch: its first load, or the merge into the live version."""
    rows = spec.build(src, as_of, keys)
    if spec.registry:
        known = register_numbers(rows, f"{root}/_registry/{spec.name}", spec.registry, spec.natural_key, [spec.natural_key], batch_id)
        rows = with_registered_numbers(rows, known, spec.registry, spec.natural_key)
    order = [F.desc("ValidFromDate")] if spec.scd2 else []
    rows = scd.dedup_latest(rows, spec.natural_key, [*order, F.desc(spec.key)])
    path = f"{root}/{spec.name}"
    if sinks.current_version(spark, path) is None:
        return scd.initial_versions(rows) if spec.scd2 else rows
    live = sinks.read_table(spark, path)
    rows = conform(rows, spec.name)
    if spec.scd2:
        return scd.scd2_merge(rows, live, spec.natural_key, spec.key, as_of)
    return scd.scd1_sync(rows, live, spec.natural_key, spec.key)


def load_dimension(
    spark: SparkSession, spec: DimSpec, src: Mapping[str, DataFrame], root: str, as_of: dt.date, batch_id: str,
    keys: KeyPolicy = WIDE_KEYS,
) -> None:
    # Re-running a batch must not merge into its own result.
    if sinks.current_version(spark, f"{root}/{spec.name}") != batch_id:
        rows = next_dimension(spark, spec, src, root, as_of, batch_id, keys)
        sinks.publish(conform(rows, spec.name), f"{root}/{spec.name}", batch_id)


def load_lookups(
    spark: SparkSession, root: str, as_of: dt.date, batch_id: str, calendar_start: dt.date = calendar.CALENDAR_START
) -> None:
    for name in LITERAL_TABLES:
        sinks.publish(literal_table(spark, name).coalesce(1), f"{root}/{name}", batch_id)
    sinks.publish(calendar.build_calendar(spark, as_of, calendar_start).coalesce(1), f"{root}/DimDate", batch_id)


def load_dimensions(
    spark: SparkSession, src: Mapping[str, DataFrame], root: str, as_of: dt.date, batch_id: str,
    names: Iterable[str] | None = None, keys: KeyPolicy = WIDE_KEYS, calendar_start: dt.date = calendar.CALENDAR_START,
) -> None:
    for name in names or DIMENSIONS:
        load_dimension(spark, DIMENSIONS[name], src, root, as_of, batch_id, keys)
    load_lookups(spark, root, as_of, batch_id, calendar_start)


def load_fact(
    spark: SparkSession, spec: FactSpec, src: Mapping[str, DataFrame], root: str, as_of: dt.date, batch_id: str,
    since: dt.date | None = None, loaded_at: dt.datetime | None = None, keys: KeyPolicy = WIDE_KEYS,
    until: dt.date | None = None,
) -> dict:
    """Extract, check, resolve, and split into the fact's partitions and the error log.

    The load covers the days after ``since`` up to ``until`` (without them everything), and replaces exactly these: a day
    that has lost all of its rows at the source loses them here.  The tagged rows are written once, partitioned by
    outcome, and all parts are read from there: the joins run once, and a lost executor costs a task.
    """
    stored = Warehouse.from_storage(spark, root)
    rows = sinks.newer_than(
        spec.build(src, as_of, batch_id=batch_id, loaded_at=loaded_at, keys=keys), spec.date_key, since
    )
    if until is not None:
        rows = rows.filter(F.col(spec.date_key) <= F.lit(until))
    resolved = resolve_checked(rows, spec, stored.key_map)
    staging = f"{root}/_staging/{spec.name}/{batch_id}"
    invalid = F.size(validation.VIOLATIONS) > 0
    outcome = F.when(invalid, "invalid").when(F.size("_fk_misses") == 0, "valid").otherwise("rejected")
    (
        resolved.tagged.withColumn("_outcome", outcome)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy("_outcome")
        .parquet(f"{staging}/tagged")
    )
    kinds = T.StructType([*resolved.tagged.schema.fields, T.StructField("_outcome", T.StringType())])
    tagged = spark.read.schema(kinds).parquet(f"{staging}/tagged")
    by_outcome = F.col("_outcome")
    resolved.tagged = tagged.filter(by_outcome != "invalid")
    passed = tagged.filter(by_outcome == "valid").select(*resolved.valid.columns)
    covered = (since + dt.timedelta(days=1) if since else BEGIN, until or FOREVER)
    days = sinks.replace_ranges(
        conform(passed, spec.name), f"{root}/{spec.name}", spec.date_key, [covered], f"{staging}/days", spec.sort
    )
    failed = resolved.errors(batch_id, loaded_at, payload_columns=None)
    broken = tagged.filter(by_outcome == "invalid").select(*resolved.extract_columns, validation.VIOLATIONS)
    failed = failed.unionByName(validation.validation_errors(broken, spec, batch_id, loaded_at))
    sinks.append_errors(failed, f"{root}/{ERRORS}", batch_id, spec.name)
    counts = {r["_outcome"]: r["count"] for r in tagged.groupBy("_outcome").count().collect()}
    loaded = counts.get("valid", 0)
    return {
        "FirstDay": covered[0], "LastDay": until or as_of, "RowsIn": sum(counts.values()), "RowsLoaded": loaded,
        "RowsRejected": sum(counts.values()) - loaded, "Days": days,
    }


def load_facts(spark, src, root, as_of, batch_id, names: Iterable[str] | None = None, **options) -> None:
    for name in names or FACTS:
        load_fact(spark, FACTS[name], src, root, as_of, batch_id, **options)


# -- roll-ups --------------------------------------------------------------------------

_UNITS = {"WeekStartDateKey": "week", "MonthStartDateKey": "month"}


def period_ranges(period: str, days: Iterable[dt.date]) -> list[tuple[dt.date, dt.date]]:
    """The whole periods that the days lie in, as ranges with both ends included."""
    unit = _UNITS.get(period)

    def start(day: dt.date) -> dt.date:
        if unit == "week":
            return day - dt.timedelta(days=day.weekday())
        return day.replace(day=1) if unit == "month" else day

    def end(day: dt.date) -> dt.date:
        if unit == "month":
            return (day.replace(day=28) + dt.timedelta(days=4)).replace(day=1)
        return day + dt.timedelta(days=7 if unit == "week" else 1)

    return [(first, last - dt.timedelta(days=1)) for first, last in contiguous(map(start, days), end)]


def within(day: str, ranges: Ranges) -> Column:
    """Whether a day lies in one of the ranges; on a partition column it chooses folders."""
    return reduce(Column.__or__, [F.col(day).between(F.lit(first), F.lit(last)) for first, last in ranges], F.lit(False))


def refresh_rollup(
    spark: SparkSession, root: str, name: str, since: dt.date | None = None, *, days: Iterable[dt.date] | None = None,
    version: str = "full",
) -> None:
    """Rebuild a roll-up as a new version, or only the periods that hold ``days`` (or all since a day).

    A refresh reads the facts of these periods and replaces them in the live version, also where nothing is left.
    """
    build, period = ROLLUPS[name]
    wh, path = Warehouse.from_storage(spark, root), f"{root}/{name}"
    live = sinks.current_version(spark, path)
    if live is None or (since is None and days is None):
        # a version that is live already is never overwritten, readers may be on it
        sinks.publish(conform(build(wh), name), path, f"{version}-2" if live == version else version, period)
        return
    if days is None:
        (first, _), = period_ranges(period, [since])
        ranges: Ranges = [(first, FOREVER)]
    else:
        ranges = period_ranges(period, days)
    if not ranges:
        return
    recent = {
        spec.name: wh.table(spec.name).filter(within(spec.date_key, ranges))
        for spec in FACTS.values()
        if spec.name in ROLLUP_FACTS.get(name, tuple(FACTS)) and files.exists(spark, f"{root}/{spec.name}")
    }
    touched = wh.replaced(**recent)
    if name == "agg_regional_sales":  # a month's growth depends on the one before
        first = min(first for first, _ in ranges)
        rows = regional_sales_refresh(touched, sinks.read_table(spark, path), first, within("MonthStartDateKey", ranges))
        ranges = [(first, FOREVER)]
    else:
        rows = build(touched)
    sinks.replace_ranges(conform(rows, name), f"{path}/{live}", period, ranges, f"{root}/_staging/{name}/{version}")


# -- retry -----------------------------------------------------------------------------


def record_schema(src, spec: FactSpec, as_of: dt.date) -> T.StructType:
    return spec.build(src, as_of).schema


def retry_fact(
    spark: SparkSession, spec: FactSpec, schema: T.StructType, root: str, batch_id: str, now: dt.datetime,
    limit: int | None = None,
) -> dict:
    """Check and resolve the open errors of one fact again, against the dimensions as they are now.

    The new content of the days and log folders concerned is computed from the tables as they are and fixed on disk,
    which the ledger records; only then are they replaced.  So a retry that dies is finished with the same rows, equal
    order lines stay separate rows, and doing it twice adds nothing.
    """
    path, ledger = f"{root}/{spec.name}", Ledger(spark, root, batch_id)
    chosen = f"{root}/_staging/retry_{spec.name}/{batch_id}"
    stored = Warehouse.from_storage(spark, root)
    facts, errors = stored.table(spec.name), stored.table(ERRORS)

    def stage() -> dict:
        due = retry_candidates(errors.filter(F.col("SourceTable") == spec.name), now, limit)
        sinks.overwrite(due, f"{chosen}/due")
        fixed = spark.read.schema(errors.schema).parquet(f"{chosen}/due")
        outcome = retry_errors(fixed, schema, lambda rows: resolve_checked(rows, spec, stored.key_map), now)
        fresh = sinks.write_staged(outcome.facts.select(*facts.columns), f"{chosen}/fresh", spec.date_key)
        days = sorted(map(dt.date.fromisoformat, files.partitions(spark, f"{chosen}/fresh", spec.date_key)))
        before = facts.filter(F.col(spec.date_key).isin(days)) if days else facts.limit(0)
        sinks.write_staged(before.unionByName(fresh), f"{chosen}/facts", spec.date_key, spec.sort)
        places = list(sinks.ERROR_PARTITIONS)
        concerned = sinks.error_folders(fixed).select(*places).distinct()
        log = sinks.error_folders(errors).join(concerned, places, "left_semi").drop(*places)
        sinks.overwrite(apply_error_updates(log, outcome.errors), f"{chosen}/log")
        return {"Days": days, "RowsIn": fixed.count(), "RowsLoaded": fresh.count()}

    figures = ledger.run("retry_staged", spec.name, stage)
    if figures["RowsIn"]:
        days = [dt.date.fromisoformat(day) for day in figures["Days"]]
        if days:
            sinks.replace_staged(spark, f"{chosen}/facts", path, spec.date_key, [(day, day) for day in days])
        sinks.rewrite_errors(spark.read.schema(errors.schema).parquet(f"{chosen}/log"), f"{root}/{ERRORS}")
    return {k: figures[k] for k in ("Days", "RowsIn", "RowsLoaded")} | {"RowsRejected": figures["RowsIn"] - figures["RowsLoaded"]}


# -- the whole batch -------------------------------------------------------------------


def run_batch(
    spark: SparkSession, src: Mapping[str, DataFrame], root: str, as_of: dt.date, batch_id: str, *,
    since: dt.date | None = None, until: dt.date | None = None, loaded_at: dt.datetime | None = None,
    facts: Iterable[str] | None = None, rollups: Iterable[str] | None = None, keys: KeyPolicy = WIDE_KEYS,
    calendar_start: dt.date = calendar.CALENDAR_START, retry: bool = True, members: Mapping[str, DataFrame] | None = None,
    after_step: Callable[[str, str], None] | None = None,
) -> Warehouse:
    """Load everything once and return the stored warehouse; after an interruption, call it again with the same id.

    ``members`` is the source of the dimensions where it was extracted at another moment than that of the facts;
    ``after_step`` is told of every step when it has committed.
    """
    ledger = Ledger(spark, root, batch_id)
    names = list(facts) if facts is not None else list(FACTS)
    now = loaded_at or dt.datetime.combine(as_of, dt.time())

    def step(kind: str, table: str, work: Callable[[], dict | None]) -> dict:
        done = ledger.run(kind, table, work)
        if after_step:
            after_step(kind, table)
        return done

    for name in DIMENSIONS:
        step("dimension", name, lambda: load_dimension(spark, DIMENSIONS[name], members or src, root, as_of, batch_id, keys))
    step("dimension", "lookups", lambda: load_lookups(spark, root, as_of, batch_id, calendar_start))
    changed: dict[str, set[dt.date]] = {}
    for name in names:
        options = {"since": since, "until": until, "loaded_at": loaded_at, "keys": keys}
        done = step("fact", name, lambda: load_fact(spark, FACTS[name], src, root, as_of, batch_id, **options))
        changed[name] = set(map(dt.date.fromisoformat, done["Days"]))
    for name in names if retry else ():
        schema = record_schema(src, FACTS[name], as_of)
        done = step("retry", name, lambda: retry_fact(spark, FACTS[name], schema, root, batch_id, now))
        changed[name] |= set(map(dt.date.fromisoformat, done["Days"]))
    for name in rollups if rollups is not None else ROLLUPS:
        days = None if since is None and until is None else set().union(*[changed.get(f, set()) for f in ROLLUP_FACTS.get(name, names)])
        step("rollup", name, lambda: refresh_rollup(spark, root, name, days=days, version=batch_id))
    return Warehouse.from_storage(spark, root)
