"""A versioned dimension kept as an ordered log of changes.

Each block of a change feed adds its rows to the buckets of their members, nothing else is read or written.  Versions
come out of the log when it is read: a member's changes in the order of their dates, also where several came in one
block or a later block brought an earlier date.  Of changes with one date the first to arrive counts; a change that
repeats the attributes before it makes no version.  Folding rewrites only buckets that have grown.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.window import Window

from starloom.functions.dates import FAR_FUTURE
from starloom.operators import files
from starloom.operators.scd import VERSION_COLUMNS

BUCKETS = 64


class ChangeLog:
    """The log of one dimension under ``path``.

    Rows of the feed have the natural key, ``ValidFromDate``, and their attributes; ``sequence`` is the column that orders
    the changes of one block with equal dates.  ``tracked`` are the attributes that make a version, by default all but
    the keys and the version columns.
    """

    def __init__(self, spark: SparkSession, path: str, natural_key: str, surrogate_key: str | None = None, *,
                 sequence: str | None = None, tracked: Sequence[str] | None = None, buckets: int = BUCKETS):
        self.spark, self.path, self.natural_key, self.surrogate_key = spark, path, natural_key, surrogate_key
        self.sequence, self.tracked, self.buckets = sequence, tracked, buckets

    def add(self, changes: DataFrame, block: int) -> None:
        """Write a block's changes to their buckets; a replayed block replaces itself."""
        rows = changes.drop(*[c for c in VERSION_COLUMNS if c != "ValidFromDate"]).withColumns(
            {
                "_bucket": F.pmod(F.xxhash64(self.natural_key), F.lit(self.buckets)).cast("int"),
                "_block": F.lit(block).cast("bigint"),
                "_order": F.col(self.sequence).cast("bigint") if self.sequence else F.lit(0).cast("bigint"),
            }
        )
        for bucket in self._folders():  # what an earlier try of this block has left
            files.delete(self.spark, f"{self.path}/_bucket={bucket}/_from={block}")
        rows.withColumn("_from", F.lit(block)).write.mode("append").partitionBy("_bucket", "_from").parquet(self.path)

    def start(self, feed: DataFrame, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
        return (
            feed.writeStream.foreachBatch(self.add)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )

    def _folders(self) -> list[str]:
        return sorted(files.partitions(self.spark, self.path, "_bucket"))

    def versions(self) -> DataFrame:
        """All versions of all members."""
        log = self.spark.read.parquet(self.path)
        names = [c for c in log.columns if not c.startswith("_")]
        tracked = self.tracked or [c for c in names if c not in (self.natural_key, self.surrogate_key, "ValidFromDate")]
        first = Window.partitionBy(self.natural_key, "ValidFromDate").orderBy("_block", "_order", *tracked)
        by_date = Window.partitionBy(self.natural_key).orderBy("ValidFromDate")
        kept = log.withColumn("_place", F.row_number().over(first)).filter("_place = 1")
        state = F.struct(*tracked)
        before = F.lag(state).over(by_date)
        kept = kept.withColumn("_new", before.isNull() | ~state.eqNullSafe(before)).filter("_new")
        return kept.select(
            *names,
            F.coalesce(F.lead("ValidFromDate").over(by_date), F.lit(FAR_FUTURE)).alias("ValidToDate"),
            F.lead("ValidFromDate").over(by_date).isNull().cast("int").alias("IsCurrent"),
            F.row_number().over(by_date).cast("bigint").alias("Version"),
        )

    def fold(self, at_least: int = 8) -> list[str]:
        """Merge the files of buckets that hold ``at_least`` blocks; the others are not touched.

        The merged rows are moved in before the folders they come from are deleted.  Rows that are there twice meanwhile,
        or because a run died in between, are one change to a reader.
        """
        grown = []
        for bucket in self._folders():
            place = f"{self.path}/_bucket={bucket}"
            blocks = sorted(map(int, files.partitions(self.spark, place, "_from")), key=abs)
            if len(blocks) < max(2, at_least):
                continue
            grown.append(bucket)
            rows = self.spark.read.parquet(*[f"{place}/_from={b}" for b in blocks])
            first = Window.partitionBy(self.natural_key, "ValidFromDate").orderBy("_block", "_order")
            merged = rows.withColumn("_place", F.rank().over(first)).filter("_place = 1").drop("_place").dropDuplicates()
            folded = f"_from={-(max(map(abs, blocks)) + 1)}"
            merged.write.mode("overwrite").parquet(f"{self.path}/_folded/{bucket}")
            files.move(self.spark, f"{self.path}/_folded/{bucket}", f"{place}/{folded}")
            for b in blocks:
                files.delete(self.spark, f"{place}/_from={b}")
        return grown
