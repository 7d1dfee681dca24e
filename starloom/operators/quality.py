"""Data-quality rules, profiles and reconciliation."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.lookups import current
from starloom.functions.measures import exact_avg
from starloom.operators.scd import dedup_latest
from starloom.schemas import SchemaMismatch


@dataclass(frozen=True)
class Rule:
    """A row breaks the rule when ``breaks`` is true (NULL does not break it)."""

    message: str
    breaks: Column | str


@dataclass(frozen=True)
class RuleSet:
    name: str
    rules: tuple[Rule, ...]

    def violations(self) -> Column:
        """Array of the messages of all broken rules, in rule order."""
        tests = [F.expr(r.breaks) if isinstance(r.breaks, str) else r.breaks for r in self.rules]
        return F.array_compact(F.array(*[F.when(t, F.lit(r.message)) for t, r in zip(tests, self.rules)]))

    def check(self, df: DataFrame, column: str = "Violations") -> DataFrame:
        return df.withColumn(column, self.violations())

    def failures(self, df: DataFrame, column: str = "Violations") -> DataFrame:
        return self.check(df, column).filter(F.size(column) > 0)


# The two standard rule sets.
MEASURE_RULES = RuleSet(
    "measures",
    (
        Rule("Negative revenue not allowed", "SalesRevenue < 0"),
        Rule("Quantity must be positive", "QuantitySold <= 0"),
        Rule("Unit price suspiciously low", "SalesRevenue < QuantitySold * 0.01"),
    ),
)
RANGE_RULES = RuleSet(
    "ranges",
    (
        Rule("Age out of range", "Age < 0 OR Age > 120"),
        Rule("Negative quantity", "Quantity < 0"),
        Rule("Negative price", "Price < 0"),
        Rule("Price below cost", "Price < Cost"),
    ),
)
# Default by column.
NULL_DEFAULTS = {"CustomerName": "UNKNOWN", "Email": "", "Age": -1, "Amount": 0, "Flag": 0}


def assert_schema(df: DataFrame, expected: T.StructType | Sequence[str]) -> DataFrame:
    """Fails before any data is read when columns are missing (or, given types, differ)."""
    if isinstance(expected, T.StructType):
        actual = {f.name: f.dataType for f in df.schema.fields}
        wrong = [f.name for f in expected.fields if actual.get(f.name) != f.dataType]
    else:
        wrong = [c for c in expected if c not in df.columns]
    if wrong:
        raise SchemaMismatch(f"SCHEMA_MISMATCH: {', '.join(wrong)}")
    return df


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def keys_occurring_once(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is unique; every row of a repeated key is left out.

    Aggregates (any other column is its single value), so no self-join and no
    window over a hot key.
    """
    others = [c for c in df.columns if c not in keys]
    once = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), F.min(F.struct(*others)).alias("_row"))
    return once.filter("_rows = 1").select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def duplicate_grain(df: DataFrame, grain: Sequence[str]) -> DataFrame:
    counts = df.groupBy(*grain).agg(F.count(F.lit(1)).alias("DuplicateCount"))
    return counts.filter("DuplicateCount > 1")


def multiple_current(dimension: DataFrame, natural_key: str) -> DataFrame:
    """Members with more than one current version."""
    counts = current(dimension).groupBy(natural_key).agg(F.count(F.lit(1)).alias("VersionCount"))
    return counts.filter("VersionCount > 1")


def load_anomalies(facts: DataFrame, day: str, factor: float = 1.5) -> DataFrame:
    """Days with more than ``factor`` times the average number of rows per day."""
    counts = facts.groupBy(day).agg(F.count(F.lit(1)).alias("LoadCount"))
    average = counts.agg(exact_avg("LoadCount").alias("a")).scalar()
    return counts.filter(F.col("LoadCount") > average * factor)


def null_profile(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """One row per column with total, non-null and null counts, from a single pass."""
    columns = list(columns or df.columns)
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(c) for c in columns])
    pairs = F.explode(F.create_map(*[x for c in columns for x in (F.lit(c), F.col(c))]))
    return counts.select("_rows", pairs.alias("ColumnName", "NonNullCount")).select(
        "ColumnName",
        F.col("_rows").alias("TotalRows"),
        "NonNullCount",
        (F.col("_rows") - F.col("NonNullCount")).alias("NullCount"),
    )


def negative_amounts(df: DataFrame, amount: str, order: Sequence[str], limit: int | None = None) -> DataFrame:
    """The first negative amounts under a total order, as a report."""
    rows = df.filter(F.col(amount) < 0)
    return rows.orderBy(*order).limit(limit) if limit else rows


def rowcount_drift(facts: DataFrame, day: str, low: int, high: int, tolerance: float = 0.10) -> DataFrame:
    """Rows per day against fixed bounds and against the calendar day before.

    The previous day is found by an equi-join of the daily counts with
    themselves, one row per day on each side.
    """
    counts = facts.groupBy(F.col(day).alias("Day")).agg(F.count(F.lit(1)).alias("DayRows"))
    before = counts.select(F.date_add("Day", 1).alias("Day"), F.col("DayRows").alias("PreviousRows"))
    change = F.try_divide(
        (F.col("DayRows") - F.col("PreviousRows")).cast("double"), F.col("PreviousRows").cast("double")
    )
    return counts.join(before, "Day", "left").select(
        "Day",
        "DayRows",
        "PreviousRows",
        F.round(change * 100.0, 2).alias("ChangePercent"),
        F.when(F.col("DayRows") < low, "TOO_FEW").when(F.col("DayRows") > high, "TOO_MANY").otherwise("OK").alias("Bounds"),
        F.coalesce((F.abs(change) > tolerance).cast("int"), F.lit(0)).alias("Drift"),
    )


def orphan_keys(facts: DataFrame, key: str, dimension: DataFrame, member_key: str) -> DataFrame:
    """Fact rows per key without a member: the default key 0, or a dangling one.

    Counted per key first: the join sees each key once, however hot it is.
    """
    members = dimension.select(F.col(member_key).alias("_member"))
    counts = facts.groupBy(F.col(key).alias("OrphanKey")).agg(F.count(F.lit(1)).alias("FactRows"))
    orphans = counts.join(members, F.col("OrphanKey") == F.col("_member"), "left_anti")
    kind = F.when(F.col("OrphanKey") == 0, "DEFAULT").otherwise("DANGLING")
    return orphans.select("OrphanKey", kind.alias("Kind"), "FactRows")


def reconcile(source: DataFrame, target: DataFrame, day: str, amount: str) -> DataFrame:
    """Rows and sums per day on both sides and their differences."""

    def per_day(df, prefix):
        return df.groupBy(F.col(day).alias("Day")).agg(
            F.count(F.lit(1)).alias(f"{prefix}Rows"), F.sum(amount).cast("decimal(18,2)").alias(f"{prefix}Amount")
        )

    both = per_day(source, "Source").join(per_day(target, "Target"), "Day", "full_outer")
    zero = F.lit(0).cast("decimal(18,2)")
    sides = {f"{p}{n}": F.coalesce(F.col(f"{p}{n}"), F.lit(0).cast("bigint") if n == "Rows" else zero)
             for p in ("Source", "Target") for n in ("Rows", "Amount")}
    return both.withColumns(sides).select(
        "Day", *sides,
        (F.col("SourceRows") - F.col("TargetRows")).alias("RowDifference"),
        (F.col("SourceAmount") - F.col("TargetAmount")).alias("AmountDifference"),
    )


def primary_key_checks(df: DataFrame, key: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """Tags each row OK, NULL_PK or DUPLICATE_PK (every row of a repeated key).

    Repeated keys come from an aggregate and are joined back, so that a key
    holding a large share of the rows is no single window partition.
    """
    missing = F.lit(False)
    for c in key:
        missing = missing | F.col(c).isNull()
    repeated = duplicate_grain(df.filter(~missing), key).select(*key, F.lit(True).alias("_repeated"))
    return df.join(repeated, list(key), "left").select(
        *df.columns,
        F.when(missing, "NULL_PK").when(F.col("_repeated"), "DUPLICATE_PK").otherwise("OK").alias("KeyCheck"),
    )


def keep_first(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first under ``order``."""
    return dedup_latest(df, key, order)


def key_collisions(members: DataFrame, surrogate_key: str, natural_key: str) -> DataFrame:
    """Surrogate keys shared by several members."""
    counts = members.groupBy(surrogate_key).agg(F.countDistinct(natural_key).alias("Members"))
    return counts.filter("Members > 1")


# -- monitoring of the error log and the loads --------------------------------


def _since(column: str, as_of: dt.date, days: int) -> Column:
    return F.col(column) >= F.lit(as_of - dt.timedelta(days=days)).cast("timestamp")


def error_summary(errors: DataFrame, as_of: dt.date, days: int = 7) -> DataFrame:
    """Errors by type over the last days with their resolved share."""
    return (
        errors.filter(_since("ErrorDate", as_of, days))
        .groupBy("ErrorType")
        .agg(
            F.count(F.lit(1)).alias("ErrorCount"),
            F.sum("IsRecoverable").alias("Recoverable"),
            F.sum(1 - F.col("IsRecoverable")).alias("NonRecoverable"),
            exact_avg("IsResolved").alias("ResolvedPercent"),
        )
        .orderBy(F.desc("ErrorCount"), "ErrorType")
    )


def unresolved_critical(errors: DataFrame, as_of: dt.date, days: int = 30) -> DataFrame:
    columns = ["ErrorID", "ErrorDate", "SourceTable", "ErrorType", "ErrorMessage", "FailedData", "RetryCount"]
    return (
        errors.filter((F.col("IsResolved") == 0) & (F.col("IsRecoverable") == 0) & _since("ErrorDate", as_of, days))
        .select(*columns)
        .orderBy(F.desc("ErrorDate"), "ErrorID")
    )


def recovery_rate(errors: DataFrame, as_of: dt.date, days: int = 30) -> DataFrame:
    share = F.try_divide(F.col("ResolvedErrors").cast("double") * 100.0, F.col("TotalErrors").cast("double"))
    return (
        errors.filter(_since("ErrorDate", as_of, days))
        .groupBy(F.to_date("ErrorDate").alias("Day"))
        .agg(F.count(F.lit(1)).alias("TotalErrors"), F.sum("IsResolved").alias("ResolvedErrors"))
        .withColumn("RecoveryPercent", F.round(share, 2))
        .orderBy(F.desc("Day"))
    )


def error_trend(errors: DataFrame, as_of: dt.date, days: int = 30) -> DataFrame:
    return (
        errors.filter(_since("ErrorDate", as_of, days))
        .groupBy(F.to_date("ErrorDate").alias("Day"), "ErrorType")
        .agg(F.count(F.lit(1)).alias("ErrorCount"))
        .orderBy(F.desc("Day"), F.desc("ErrorCount"), "ErrorType")
    )


def errors_by_table(errors: DataFrame, as_of: dt.date, days: int = 7) -> DataFrame:
    return (
        errors.filter(_since("ErrorDate", as_of, days))
        .groupBy("SourceTable", "ErrorType", "ErrorSeverity")
        .agg(F.count(F.lit(1)).alias("ErrorCount"), F.max("ErrorDate").alias("LastError"))
        .orderBy(F.desc("ErrorCount"), "SourceTable", "ErrorType", "ErrorSeverity")
    )


def daily_trend(facts: DataFrame, day: str, as_of: dt.date, days: int = 30) -> DataFrame:
    """Rows and revenue of the last days; the day filter prunes partitions of a stored fact."""
    return (
        facts.filter(F.col(day) >= F.lit(as_of - dt.timedelta(days=days)))
        .groupBy(day)
        .agg(F.count(F.lit(1)).alias("RowCount"), F.sum("SalesRevenue").cast("decimal(18,2)").alias("TotalRevenue"))
        .orderBy(F.desc(day))
    )


def stuck_errors(errors: DataFrame, max_retries: int = 3) -> DataFrame:
    """Key misses that used up their retries."""
    return (
        errors.filter(
            (F.col("ErrorType") == "FK_MISS") & (F.col("IsResolved") == 0) & (F.col("RetryCount") >= max_retries)
        )
        .select("RecordNaturalKey", "ErrorMessage", "RetryCount", "LastAttemptDate", "ErrorDate")
        .orderBy(F.desc("ErrorDate"), "RecordNaturalKey")
    )


def error_volume_alerts(errors: DataFrame, limit: int = 1000) -> DataFrame:
    """Errors per day with a flag above ``limit``."""
    counts = errors.groupBy(F.to_date("ErrorDate").alias("Day")).agg(F.count(F.lit(1)).alias("ErrorCount"))
    return counts.withColumn("Alert", (F.col("ErrorCount") > limit).cast("int"))


def freshness(facts: DataFrame, load_time: str, event_time: str, sla_hours: float = 4.0) -> DataFrame:
    """Hours between the latest event and the latest load, against the SLA."""
    latest = facts.agg(F.max(load_time).alias("LastLoad"), F.max(event_time).alias("LastEvent"))
    lag = (F.unix_timestamp("LastLoad") - F.unix_timestamp(F.col("LastEvent").cast("timestamp"))) / F.lit(3600.0)
    return latest.withColumn("LagHours", F.round(lag, 2)).withColumn(
        "WithinSla", (F.col("LagHours") <= sla_hours).cast("int")
    )
