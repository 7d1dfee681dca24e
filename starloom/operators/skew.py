"""Left joins whose hot keys are dealt over many partitions.

A shuffled join sends all rows of a key to one task.  Here the rows of NULL and of the hot keys get a sub-key from a
hash of the row, and the members of the hot keys are repeated once per sub-key, so each row still meets its member
exactly once.  Nothing is dropped or sampled, and a retried task deals its rows as before.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The surrogate key of facts without a member, hot in every fact table.
NO_MEMBER = 0
#: Sub-keys per shuffle partition, so that an uneven spread of the sub-keys evens out.
SLOTS_PER_PARTITION = 4


def heavy_keys(rows: DataFrame, key: str, least_share: float = 0.02) -> list:
    """The non-NULL values of ``key`` that hold at least ``least_share`` of all rows, most frequent first.

    Counted over all rows; the shares bound the answer to 1 / ``least_share`` values.
    """
    if not 0 < least_share <= 1:
        raise ValueError("least_share is in (0, 1]")
    counts = rows.groupBy(F.col(key).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    total = F.broadcast(counts.agg(F.sum("n").alias("total")))  # one row
    found = counts.crossJoin(total).where(F.col("value").isNotNull() & (F.col("n") >= F.col("total") * least_share))
    return [r[0] for r in found.orderBy(F.desc("n"), "value").select("value").collect()]


def _is_hot(key: str, hot: Sequence) -> Column:
    return F.col(key).isin(*hot) if hot else F.lit(False)


def split_left_join(
    rows: DataFrame, side: DataFrame, key: str, hot: Iterable, row_key: Sequence[str], slots: int | None = None,
    also: Sequence[str] = (),
) -> DataFrame:
    """``rows`` left joined to ``side`` on ``key`` (and the columns ``also``), the rows of NULL and of the ``hot`` keys dealt by ``row_key``.

    ``side`` may hold several rows of a key; those of a hot key are repeated ``slots`` times, which is bounded by the
    number of hot keys.  Rows that agree in all of ``row_key`` stay together, so it should tell rows apart.
    """
    hot = [v for v in dict.fromkeys(hot) if v is not None]
    if slots is None:
        slots = SLOTS_PER_PARTITION * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    first = F.lit(0).cast("bigint")
    dealt = F.pmod(F.xxhash64(*row_key), F.lit(slots).cast("bigint"))
    rows = rows.withColumn("_slot", F.when(F.col(key).isNull() | _is_hot(key, hot), dealt).otherwise(first))
    everywhere = F.sequence(first, F.lit(slots - 1).cast("bigint"))
    side = side.withColumn("_slot", F.explode(F.when(_is_hot(key, hot), everywhere).otherwise(F.array(first))))
    return rows.join(side, [key, *also, "_slot"], "left").drop("_slot")
