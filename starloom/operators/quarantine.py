"""The error log: building, classifying and retrying quarantined records."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.keys import surrogate_key
from starloom.schemas import column_names
from starloom.sources.literals import error_taxonomy

ERROR_COLUMNS = tuple(column_names("error_records"))

#: Columns of the failed record in a short log entry.
PAYLOAD_COLUMNS = 8
# The retry policy.
MAX_RETRIES = 3
RESOLVED_COMMENT = "Auto-resolved on retry"


def payload_json(names: Sequence[str]) -> Column:
    """The failed record as ``{"sample": {...}}``; NULLs are kept."""
    record = F.struct(*[F.col(c) for c in names])
    return F.to_json(F.struct(record.alias("sample")), {"ignoreNullFields": "false"})


def build_error_records(
    df: DataFrame,
    *,
    source_table: str,
    natural_key: Column,
    message: Column,
    payload: Column,
    error_type: str | Column = "FK_MISS",
    severity: str = "WARNING",
    recoverable: int = 1,
    task_name: str = "",
    batch_id: str = "manual",
    error_time: dt.datetime | None = None,
) -> DataFrame:
    """One error record per row of ``df``.

    The id is a hash of what went wrong in which batch, so that re-running a
    batch overwrites its errors instead of adding new ones.
    """
    kind = error_type if isinstance(error_type, Column) else F.lit(error_type)
    when = F.lit(error_time) if error_time else F.current_timestamp()
    rows = df.select(
        natural_key.alias("RecordNaturalKey"), kind.alias("ErrorType"), message.alias("ErrorMessage"), payload.alias("FailedData")
    )
    return rows.select(
        surrogate_key(F.lit(batch_id), F.lit(source_table), "RecordNaturalKey", "ErrorMessage", "FailedData").alias(
            "ErrorID"
        ),
        when.cast("timestamp").alias("ErrorDate"),
        F.lit(source_table).alias("SourceTable"),
        "RecordNaturalKey",
        "ErrorType",
        F.lit(severity).alias("ErrorSeverity"),
        "ErrorMessage",
        "FailedData",
        F.lit(batch_id).alias("ProcessingBatchID"),
        F.lit(task_name).alias("TaskName"),
        F.lit(int(recoverable)).alias("IsRecoverable"),
        F.lit(0).alias("RetryCount"),
        F.lit(None).cast("timestamp").alias("LastAttemptDate"),
        F.lit(0).alias("IsResolved"),
        F.lit(None).cast("string").alias("ResolutionComment"),
    )


def classify_errors(errors: DataFrame) -> DataFrame:
    """Adds type recoverability, type severity and handling from the taxonomy."""
    taxonomy = F.broadcast(error_taxonomy(errors.sparkSession))  # ten fixed rows
    return errors.join(taxonomy, "ErrorType", "left")


def retry_candidates(
    errors: DataFrame,
    processing_time: dt.datetime,
    limit: int | None = None,
    max_retries: int = MAX_RETRIES,
    window_days: int | None = None,
) -> DataFrame:
    """Open recoverable errors under ``max_retries`` attempts; all of them unless the caller asks for less.

    ``window_days`` leaves out errors older than that, ``limit`` takes the longest-waiting ones.
    """
    due = errors.filter((F.col("IsResolved") == 0) & (F.col("IsRecoverable") == 1) & (F.col("RetryCount") < max_retries))
    if window_days is not None:
        due = due.filter(F.col("ErrorDate") >= F.lit(processing_time - dt.timedelta(days=window_days)))
    if limit is None:
        return due
    return due.orderBy(F.col("LastAttemptDate").asc_nulls_first(), "ErrorID").limit(limit)


@dataclass
class RetryOutcome:
    """``facts`` can be appended to the fact table; ``errors`` replaces the retried error rows."""

    facts: DataFrame
    errors: DataFrame


def retry_errors(
    candidates: DataFrame,
    record_schema: T.StructType,
    resolve: Callable[[DataFrame], "object"],
    processing_time: dt.datetime,
) -> RetryOutcome:
    """Resolve the recorded rows again.

    ``resolve`` is the foreign-key step of the fact (see ``operators.fk``) and
    must pass the ErrorID column through.
    """
    wrapper = T.StructType([T.StructField("sample", record_schema)])
    parsed = candidates.select("ErrorID", F.from_json("FailedData", wrapper).getField("sample").alias("_record"))
    records = parsed.filter(F.col("_record").isNotNull()).select("_record.*", "ErrorID")
    outcome = resolve(records)
    solved = outcome.valid.select("ErrorID", F.lit(1).alias("_solved"))
    stamp = F.lit(processing_time).cast("timestamp")
    fixed = F.col("_solved").isNotNull()
    updated = candidates.join(solved, "ErrorID", "left").select(
        *[
            {
                "IsResolved": F.when(fixed, 1).otherwise(F.col("IsResolved")),
                "ResolutionComment": F.when(fixed, F.lit(RESOLVED_COMMENT)).otherwise(F.col("ResolutionComment")),
                "RetryCount": F.when(fixed, F.col("RetryCount")).otherwise(F.col("RetryCount") + 1),
                "LastAttemptDate": F.when(fixed, F.col("LastAttemptDate")).otherwise(stamp),
            }
            .get(c, F.col(c))
            .alias(c)
            for c in candidates.columns
        ]
    )
    return RetryOutcome(outcome.valid.drop("ErrorID"), updated)


def apply_error_updates(errors: DataFrame, updated: DataFrame) -> DataFrame:
    """The error log with the retried rows replaced; no row is lost."""
    untouched = errors.join(updated.select("ErrorID"), "ErrorID", "left_anti")
    return untouched.unionByName(updated)
