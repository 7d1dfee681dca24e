"""Size-checked broadcasting and current-version helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: In-memory rows are assumed to take up to this many times their Parquet bytes.
EXPANSION = 8


_UNITS = {"k": 1024, "m": 1024**2, "g": 1024**3}


def _bytes(setting: str) -> int:
    """Bytes of a Spark size setting such as 10485760, 10m or 10MB."""
    text = setting.strip().lower().removesuffix("b")
    return int(text[:-1]) * _UNITS[text[-1]] if text[-1] in _UNITS else int(text)


def broadcast_limit(spark) -> int:
    """The session's own broadcast threshold in bytes; -1 switches hints off."""
    return _bytes(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760"))


def planned_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate; for a plain scan this is the size of its files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def small_enough(df: DataFrame, derived: bool = False) -> bool:
    """Whether a table of the size of ``df`` may be broadcast; ``derived`` allows for rows that are built from it."""
    return 0 <= planned_bytes(df) * (EXPANSION if derived else 1) <= broadcast_limit(df.sparkSession)


def small_side(df: DataFrame, driver: DataFrame | None = None) -> DataFrame:
    """Hint ``df`` as broadcast only where its size is known to be small.

    The estimate of a derived table is a product over its joins and says little,
    so the check is made on ``driver``: the input whose rows bound those of
    ``df``.  Beyond the limit ``df`` comes back unhinted and Spark shuffles (and
    splits skewed partitions) as usual.
    """
    small = small_enough(df) if driver is None else small_enough(driver, derived=True)
    return F.broadcast(df) if small else df


def spread(scan: DataFrame, *keys: str) -> DataFrame:
    """Deal the rows of a small scan over all cores.

    A file of a few megabytes is read by fewer tasks than there are cores, and
    with broadcast joins everything up to the first aggregation would stay in
    those tasks.  Larger scans have splits enough and are returned as they are.
    """
    spark = scan.sparkSession
    cores = spark.sparkContext.defaultParallelism
    split = _bytes(spark.conf.get("spark.sql.files.openCostInBytes", "4194304"))
    if planned_bytes(scan) > split * cores / 2:
        return scan
    return scan.repartition(cores, *keys)


def nullable_left_join(df: DataFrame, side: DataFrame, key: str, row_key: Sequence[str]) -> DataFrame:
    """Left join on a ``key`` that may be NULL in a large share of the rows.

    NULL matches nothing, so those rows must not meet in one shuffle partition:
    they get the hash of ``row_key`` as sub-key, all others sub-key 0.  Joins on
    the same key one after the other share one shuffle.
    """
    slot = f"_slot_{key}"
    if slot not in df.columns:
        df = df.withColumn(slot, F.when(F.col(key).isNull(), F.xxhash64(*row_key)).otherwise(F.lit(0).cast("bigint")))
    side = side.withColumn(slot, F.lit(0).cast("bigint"))
    return df.join(side, [key, slot], "left")


def current(dimension: DataFrame) -> DataFrame:
    """Latest version of each member; the flag itself is dropped by column pruning."""
    return dimension.filter(F.col("IsCurrent") == 1)
