"""Roll-ups maintained while facts arrive.

Each micro-batch is reduced to mergeable partial states and written to its own
partition, named by the batch id.  A replayed batch replaces its own partition,
so every fact counts once; readers combine the partials.  Nothing is read back
and rewritten while streaming.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from starloom.operators import files


@dataclass(frozen=True)
class RollupState:
    """Keys, additive measures, and the column counted distinct (if any).

    Sums, counts, minima and maxima merge; an average is kept as sum and count.
    A distinct count is kept as a sketch (approximate), or exactly by keeping
    the states per key and member.
    """

    keys: tuple[str, ...]
    measure: str
    distinct: str | None = None
    sketch: bool = False

    @property
    def grain(self) -> tuple[str, ...]:
        """Columns of a stored state."""
        return (*self.keys, self.distinct) if self.distinct and not self.sketch else self.keys

    def partial(self, block: DataFrame) -> DataFrame:
        value = F.col(self.measure)
        states = [
            F.sum(value).alias("_sum"),
            F.count(value).alias("_count"),
            F.min(value).alias("_min"),
            F.max(value).alias("_max"),
        ]
        if self.distinct and self.sketch:
            states.append(F.hll_sketch_agg(self.distinct).alias("_sketch"))
        return block.groupBy(*self.grain).agg(*states)

    def merged(self, partials: DataFrame) -> DataFrame:
        """One state per key (and member)."""
        states = [F.sum("_sum").alias("_sum"), F.sum("_count").alias("_count"), F.min("_min").alias("_min"), F.max("_max").alias("_max")]
        if self.distinct and self.sketch:
            states.append(F.hll_union_agg("_sketch").alias("_sketch"))
        return partials.groupBy(*self.grain).agg(*states)

    def final(self, partials: DataFrame) -> DataFrame:
        """The roll-up over all partials."""
        states = [
            F.sum("_sum").cast("decimal(18,2)").alias("RevenueSum"),
            F.sum("_count").alias("_n"),
            F.min("_min").alias("RevenueMin"),
            F.max("_max").alias("RevenueMax"),
        ]
        if self.distinct and self.sketch:
            states.append(F.hll_sketch_estimate(F.hll_union_agg("_sketch")).alias("DistinctMembers"))
        elif self.distinct:  # each member has one row by now
            states.append(F.count(self.distinct).alias("DistinctMembers"))
            partials = self.merged(partials)
        merged = partials.groupBy(*self.keys).agg(*states)
        average = F.try_divide(F.col("RevenueSum").cast("double"), F.col("_n").cast("double"))
        return merged.withColumn("RevenueAvg", F.round(average, 2)).withColumnRenamed("_n", "RowCount")


def _write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    # The batch's own folder is replaced as a whole: also right for an empty result.
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def maintain_rollup(
    facts: DataFrame, state: RollupState, path: str, checkpoint: str, trigger: dict | None = None,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Start maintaining a roll-up of a streaming fact frame.

    ``prepare`` joins dimensions to each block.  By default the query takes what
    is there and stops; give ``trigger={"processingTime": "1 minute"}`` to go on.
    """

    def block(df: DataFrame, batch_id: int) -> None:
        rows = prepare(df) if prepare else df
        _write_batch(state.partial(rows), f"{path}/partials", batch_id)

    return (
        facts.writeStream.foreachBatch(block)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_rollup(spark, state: RollupState, path: str) -> DataFrame:
    return state.final(spark.read.parquet(f"{path}/partials"))


def compact_partials(spark, state: RollupState, path: str, target: str) -> None:
    """Fold the partials so far into one set per key, in a new place."""
    merged = state.merged(spark.read.parquet(f"{path}/partials"))
    merged.write.mode("overwrite").parquet(f"{target}/partials/batch_id=0")


def hourly_sums(
    events: DataFrame, time: str, keys: Sequence[str], amount: Column, late: str = "1 hour"
) -> DataFrame:
    """Tumbling hours per key with bounded state: events later than ``late`` are dropped once their hour is closed.

    :func:`maintain_hours` keeps them.
    """
    return (
        events.withWatermark(time, late)
        .groupBy(F.window(time, "1 hour").alias("_hour"), *keys)
        .agg(F.sum(amount).alias("Revenue"), F.count(F.lit(1)).alias("TransactionCount"))
        .select(F.col("_hour.start").alias("SalesHour"), *keys, "Revenue", "TransactionCount")
    )


def write_updates(windows: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Write changed windows per micro-batch; the highest batch_id of a window is its value."""
    return (
        windows.writeStream.outputMode("update")
        .foreachBatch(lambda df, batch_id: _write_batch(df, path, batch_id))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


# -- hours that late rows still reach ---------------------------------------------------


def maintain_hours(
    events: DataFrame, time: str, keys: Sequence[str], amount: Column, path: str, checkpoint: str,
    late_after: dt.timedelta = dt.timedelta(hours=1), trigger: dict | None = None,
) -> StreamingQuery:
    """Tumbling hours per key that lose no row, however late it comes.

    An hour is closed when an event has been seen that is ``late_after`` later than its end.  A block is reduced once, to
    one partial per hour, key and lateness: rows of hours that the blocks before had closed are kept apart as late, and
    :func:`read_hours` adds them to their hours.  A block's clock (the latest time seen up to it) is a marker of its own
    beside its partials, so a replayed block comes to the same partials and replaces them.
    """

    def block(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        clock = files.read_text(spark, f"{path}/clock/{batch_id - 1}") if batch_id else None
        seen = dt.datetime.fromisoformat(clock) if clock else None
        hour = F.date_trunc("hour", F.col(time))
        late = F.lit(False) if seen is None else hour + F.expr("INTERVAL 1 HOUR") <= F.lit(seen - late_after)
        partial = df.groupBy(hour.alias("SalesHour"), *keys, late.alias("Late")).agg(
            F.sum(amount).alias("_sum"), F.count(F.lit(1)).alias("_count"), F.max(time).alias("_latest")
        )
        _write_batch(partial, f"{path}/hours", batch_id)
        latest = spark.read.parquet(f"{path}/hours/batch_id={batch_id}").agg(F.max("_latest")).first()[0]
        times = [t for t in (seen, latest) if t is not None]
        if times:
            files.write_text(spark, f"{path}/clock/{batch_id}", max(times).isoformat())

    return (
        events.writeStream.foreachBatch(block)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_hours(spark, path: str, keys: Sequence[str]) -> DataFrame:
    """Hours with everything that has arrived for them, and how many of their rows came after they were closed."""
    partials = spark.read.parquet(f"{path}/hours")
    return partials.groupBy("SalesHour", *keys).agg(
        F.sum("_sum").alias("Revenue"),
        F.sum("_count").alias("TransactionCount"),
        F.sum(F.when(F.col("Late"), F.col("_count")).otherwise(F.lit(0))).alias("LateCount"),
    )
