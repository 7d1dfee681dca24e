"""Streamed facts that wait for their members.

Each block is checked and resolved once and written in one pass, by outcome: valid rows are facts from then on, rows
whose member is missing wait, broken rows are errors.  Waiting rows are released when their members are known: a release
resolves all rows that still wait against the members of that moment and writes those that are valid now, by row id, so
none is lost between a member's arrival and its own, and none is added twice.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from starloom.operators import files, validation
from starloom.operators.facts import FactSpec
from starloom.operators.fk import KeyMaps, Resolved, resolve_checked

VALID, WAITING, INVALID = "valid", "waiting", "invalid"


def _with_outcome(resolved: Resolved) -> DataFrame:
    broken = F.size(validation.VIOLATIONS) > 0
    outcome = F.when(broken, INVALID).when(F.size("_fk_misses") == 0, VALID).otherwise(WAITING)
    return resolved.tagged.withColumn("_outcome", outcome)


class WaitingLoad:
    """A fact under ``root`` that is loaded as it arrives; ``schema`` is that of the extracted rows."""

    def __init__(self, spark: SparkSession, spec: FactSpec, schema: T.StructType, key_maps: KeyMaps, root: str):
        self.spark, self.spec, self.schema, self.key_maps, self.root = spark, spec, schema, key_maps, root
        empty = resolve_checked(spark.createDataFrame([], schema), spec, key_maps)
        self._columns = empty.valid.columns
        self._tagged = T.StructType([*empty.tagged.schema.fields, T.StructField("_row", T.StringType())])

    def _blocks(self, place: str, outcome: str | None = None) -> DataFrame:
        fields = [*self._tagged.fields, T.StructField("block", T.LongType()), T.StructField("_outcome", T.StringType())]
        path = f"{self.root}/{place}"
        if not files.exists(self.spark, path):
            return self.spark.createDataFrame([], T.StructType(fields))
        rows = self.spark.read.schema(T.StructType(fields)).parquet(path)
        return rows.filter(F.col("_outcome") == outcome) if outcome else rows

    def take(self, df: DataFrame, block: int) -> None:
        """Load one block; a replayed block replaces itself."""
        resolved = resolve_checked(df, self.spec, self.key_maps)
        row = F.concat_ws("-", F.lit(block), F.monotonically_increasing_id())
        rows = _with_outcome(resolved).withColumn("_row", row)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("_outcome").parquet(
            f"{self.root}/blocks/block={block}"
        )

    def start(self, extracted: DataFrame, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
        return (
            extracted.writeStream.foreachBatch(self.take)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )

    def waiting(self) -> DataFrame:
        """Rows that still wait: (_row and the extracted columns)."""
        released = self._blocks("released").select("_row")
        return self._blocks("blocks", WAITING).select("_row", *self.schema.names).join(released, "_row", "left_anti")

    def release(self, release: int) -> None:
        """Add the waiting rows whose members are known by now; the same number again changes nothing."""
        path = f"{self.root}/released/block={release}"
        if files.exists(self.spark, f"{path}/_SUCCESS"):
            return
        resolved = resolve_checked(self.waiting(), self.spec, self.key_maps)
        rows = _with_outcome(resolved).filter(F.col("_outcome") == VALID)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("_outcome").parquet(path)

    def facts(self) -> DataFrame:
        """All loaded facts, with their surrogate keys."""
        return self._blocks("blocks", VALID).unionByName(self._blocks("released", VALID)).select(*self._columns)

    def errors(self, batch_id: str, error_time: dt.datetime | None = None) -> DataFrame:
        """Error records of the broken rows and of those that wait."""
        waiting = resolve_checked(self.waiting(), self.spec, self.key_maps)
        waiting.extract_columns.remove("_row")
        broken = self._blocks("blocks", INVALID).select(*self.schema.names, validation.VIOLATIONS)
        return waiting.errors(batch_id, error_time).unionByName(
            validation.validation_errors(broken, self.spec, batch_id, error_time)
        )
