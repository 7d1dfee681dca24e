"""Facts and dimension changes loaded as they arrive."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from starloom.operators import scd, sinks
from starloom.operators.facts import FactSpec
from starloom.operators.fk import KeyMaps, resolve_fks


def load_fact_stream(
    extracted: DataFrame, spec: FactSpec, key_maps: KeyMaps, root: str, checkpoint: str,
    error_time: dt.datetime | None = None, trigger: dict | None = None,
) -> StreamingQuery:
    """Resolve each micro-batch against the dimensions as they are at that moment.

    Valid rows and errors go to folders of the batch, which a replay replaces.
    The error records hold whole rows, so ``operators.quarantine.retry_errors``
    can load them when their member has arrived.
    """

    def block(df: DataFrame, batch_id: int) -> None:
        resolved = resolve_fks(df, spec, key_maps)
        batch = f"stream_{batch_id}"
        resolved.valid.write.mode("overwrite").parquet(f"{root}/{spec.name}/batch_id={batch_id}")
        errors = resolved.errors(batch, error_time, payload_columns=None)
        errors.write.mode("overwrite").parquet(f"{root}/error_records/batch_id={batch_id}")

    return (
        extracted.writeStream.foreachBatch(block)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def merge_dimension_stream(
    changes: DataFrame, path: str, natural_key: str, surrogate_key: str, checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Merge a feed of changed members into a versioned dimension.

    Each micro-batch holds some members only, so members missing from it are
    left alone.  The merge reads the live version and publishes a new one; a
    replayed batch finds its own version live and does nothing.
    """

    def block(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        version = f"v{batch_id:010d}"
        if sinks.current_version(spark, path) == version:
            return
        rows = scd.dedup_latest(df, natural_key, [F.desc("ValidFromDate"), F.desc(surrogate_key)])
        if sinks.current_version(spark, path) is None:
            sinks.publish(scd.initial_versions(rows), path, version)
            return
        live = sinks.read_table(spark, path)
        touched = live.join(rows.select(natural_key), natural_key, "left_semi")
        others = live.join(rows.select(natural_key), natural_key, "left_anti")
        # No member of ``touched`` is missing from the batch, so none is closed.
        merged = scd.scd2_merge(rows, touched, natural_key, surrogate_key, dt.date.max)
        sinks.publish(others.unionByName(merged.select(*others.columns)), path, version)

    return (
        changes.writeStream.foreachBatch(block)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
