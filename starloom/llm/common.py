"""What several operators of this subpackage need: staged tables, batches of bounded size, null-safe row filters."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.session import scratch_dir

#: Characters that separate words; the rest of a text is words.
SPACE_CLASS = r"\x20\x09-\x0D"


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` under the folder that all executors share and read it back.

    Cuts the lineage: a lost executor costs the tasks it ran, not the work that led to the table.
    """
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def arrow_batches(spark: SparkSession, rows: int = 500) -> None:
    """Bound the rows of an Arrow batch, as whole texts can be long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def texts(docs: DataFrame, *keys: str, column: str = "text") -> DataFrame:
    """The key columns and the text, null taken as empty.  Other columns, whatever their names, stay behind."""
    return docs.select(*keys, F.coalesce(F.col(column).cast("string"), F.lit("")).alias("text"))


def content_key(column: str = "text") -> Column:
    """Tells rows apart that share an id: 64 bits of the text (null is the empty text)."""
    return F.xxhash64(F.coalesce(F.col(column).cast("string"), F.lit("")))


def filter_rows(docs: DataFrame, marked: DataFrame, keep: bool, column: str = "text") -> DataFrame:
    """Rows of ``docs`` whose (doc_id, text) is in ``marked`` (doc_id, content), or with ``keep`` false the others.

    ``marked`` is (doc_id, content) with content as :func:`content_key` gives it.  Null ids match each other.
    Columns and their order stay as they are.
    """
    right = marked.select(F.col("doc_id").alias("__id"), F.col("content").alias("__content"))
    names = docs.columns
    left = docs.withColumn("__key", content_key(column))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__key") == F.col("__content"))
    return left.join(right, same, "left_semi" if keep else "left_anti").select(*[F.col(f"`{n}`") for n in names])


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def gathered(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...], rows: int = 4000, size: int = 32 << 20) -> Iterator[pa.Table]:
    """Batches put together up to about ``rows`` rows or ``size`` bytes in ``columns``, for work that gains from many rows at once."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= rows or sum(b.column(c).nbytes for b in held for c in columns) >= size:
            yield pa.Table.from_batches(held)
            held = []
    if held:
        yield pa.Table.from_batches(held)


def bounded_batches(spark: SparkSession, rows: int = 500, size: str = "16m") -> None:
    """Bound the rows and the bytes of an Arrow batch; a single text of more bytes still makes a batch of its own."""
    arrow_batches(spark, rows)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)
