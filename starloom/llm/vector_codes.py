"""Vector code compression: vectors as one codebook index for each of their parts, nearest entries by bitmasks.

Components become integers floor(``SCALE`` * x), vectors are cut into ``PARTS`` parts, and each part position has a
codebook of up to 64 entries, so a set of entries is one uint64.  Per dimension of a part the entries' coordinates are
sorted and carry prefix masks: mask r has the bits of the first r entries, and two of them give by one XOR the entries
within a range.  For a point, the distance to the entries nearest in single coordinates bounds the distance to the
nearest one; the entries within that radius in every dimension, found by ANDing one mask a dimension, are the exact
candidates, and only these are measured.  Ties go to the lower index.

Codebooks are fitted as in k-means: a round assigns all parts, sums them up per entry in the tasks, and moves each entry
to the floor of its mean.  What a round brings to the driver and back to the tasks is one row per entry (``PARTS`` * 64),
whatever the number of vectors, so no vector moves and no code or label can be hot.  Label totals are summed in the tasks
too; labels that hold more than one row in ``HEAVY`` are at most ``HEAVY`` many and are broadcast, all other rows meet
their total in a shuffle join in which no key can be large.

Defined cases: vectors that are null or hold null or non-finite components are left out, and so are those with a
component of ``LIMIT`` or more in size, whose squares would not fit into 64 bits; vectors of another length than the
first kept one (by vec_id) are left out as well; a length that ``PARTS`` does not divide is filled up with zeros.  Null
ids come after all others and equal ids are ordered by their vectors; fewer vectors than entries make a smaller
codebook; null labels are one label; a label total beyond 64 bits is null; an empty table gives an empty result; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from starloom.llm.common import bounded_batches, staged

SCALE, PARTS, ENTRIES, ROUNDS = 256, 16, 64, 2
LIMIT = 2.0**18
HEAVY = 4096
_ONE, _ALL = np.uint64(1), np.uint64(2**64 - 1)


class Slices:
    """The entries of one codebook, sorted by each coordinate, with prefix masks."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.order = np.argsort(entries, axis=0, kind="stable").T
        self.sorted = np.take_along_axis(entries.T, self.order, axis=1)
        bits = _ONE << self.order.astype(np.uint64)
        self.prefix = np.concatenate([np.zeros((len(bits), 1), np.uint64), np.bitwise_or.accumulate(bits, axis=1)], axis=1)

    def _within(self, points: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """For each point the mask of the entries that no coordinate puts further away than ``radius``."""
        mask = np.full(len(points), _ALL)
        for d, (column, prefix) in enumerate(zip(self.sorted, self.prefix)):
            low = np.searchsorted(column, points[:, d] - radius, side="left")
            high = np.searchsorted(column, points[:, d] + radius, side="right")
            mask &= prefix[high] ^ prefix[low]
        return mask

    def _bound(self, points: np.ndarray) -> np.ndarray:
        """Squared distance to the best of the entries that are nearest in one coordinate."""
        best = None
        for d, column in enumerate(self.sorted):
            at = np.searchsorted(column, points[:, d]).clip(1, max(1, len(column) - 1))
            left, right = column[at - 1], column[at.clip(max=len(column) - 1)]
            near = np.where(points[:, d] - left <= right - points[:, d], at - 1, at.clip(max=len(column) - 1))
            distance = np.square(points - self.entries[self.order[d][near]]).sum(axis=1)
            best = distance if best is None else np.minimum(best, distance)
        return best

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry and the squared distance to it."""
        radius = np.sqrt(self._bound(points).astype(np.float64)).astype(np.int64) + 1  # never below the true root
        mask = self._within(points, radius)
        set_bits = np.unpackbits(mask.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        row, entry = np.nonzero(set_bits)  # by row, then entry; each row has the entry of its bound at least
        distance = np.square(points[row] - self.entries[entry]).sum(axis=1)
        starts = np.searchsorted(row, np.arange(len(points)))
        least = np.minimum.reduceat(distance, starts)
        index = np.minimum.reduceat(np.where(distance == least[row], entry, ENTRIES), starts)
        return index, least


def assign(vectors: np.ndarray, slices: list[Slices]) -> tuple[np.ndarray, np.ndarray]:
    """Codes and squared distances of whole vectors, a column for each part."""
    pairs = [s.nearest(p) for s, p in zip(slices, np.split(vectors, len(slices), axis=1))]
    return np.stack([i for i, _ in pairs], axis=1), np.stack([d for _, d in pairs], axis=1)


def _integers(batch: pa.RecordBatch, width: int) -> np.ndarray:
    column = batch.column("vector")
    flat = column.flatten().to_numpy(zero_copy_only=False)
    size = len(flat) // max(1, len(column))
    whole = np.floor(SCALE * flat.astype(np.float64)).astype(np.int64).reshape(len(column), size)
    return np.pad(whole, ((0, 0), (0, width - size)))


def kept_vectors(vectors: DataFrame, *keys: str) -> DataFrame:
    """(keys, vector) of the rows whose vector is whole."""
    rows = vectors.select(*keys, F.col("embedding").cast("array<double>").alias("vector"))
    return rows.filter(F.col("vector").isNotNull() & F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < LIMIT)))


def _totals(rows: DataFrame, books: list[np.ndarray], width: int) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """For each part and entry the number and the sum of the parts it is nearest to."""
    schema = StructType([StructField(n, IntegerType()) for n in ("part", "entry", "dim")] + [StructField(n, LongType()) for n in ("total", "n")])
    step = width // PARTS

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = [Slices(b) for b in books]
        counts, sums = np.zeros((PARTS, ENTRIES), np.int64), np.zeros((PARTS, ENTRIES, step), np.int64)
        for batch in batches:
            whole = _integers(batch, width)
            codes, _ = assign(whole, slices)
            for p in range(PARTS):
                counts[p] += np.bincount(codes[:, p], minlength=ENTRIES)
                for d in range(step):  # sums of a batch are exact in a double
                    sums[p, :, d] += np.bincount(codes[:, p], whole[:, p * step + d], ENTRIES).astype(np.int64)
        part, entry, dim = np.nonzero(np.broadcast_to(counts[:, :, None] > 0, sums.shape))
        columns = [part.astype(np.int32), entry.astype(np.int32), dim.astype(np.int32), sums[part, entry, dim], counts[part, entry]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=schema.names)

    partial = rows.select("vector").mapInArrow(summed, schema)
    added = partial.groupBy("part", "entry", "dim").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
    found: dict[tuple[int, int], tuple[int, list[int]]] = {}
    for r in added.collect():  # parts * entries * dimensions of a part: as large as the codebooks
        found.setdefault((r.part, r.entry), (r.n, [0] * step))[1][r.dim] = int(r.total)
    return found


def fit_codebooks(vectors: DataFrame, size: int, rounds: int = ROUNDS) -> list[np.ndarray]:
    """The codebook of each part position, first the parts of the first vectors by vec_id."""
    width = -(-max(size, 1) // PARTS) * PARTS
    rows = kept_vectors(vectors, "vec_id").filter(F.size("vector") == size)
    start = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(ENTRIES).collect()
    bounded_batches(vectors.sparkSession, rows=4096)
    whole = np.pad(np.floor(SCALE * np.array([r.vector for r in start], np.float64).reshape(len(start), size)).astype(np.int64), ((0, 0), (0, width - size)))
    books = np.split(whole, PARTS, axis=1)
    for _ in range(rounds):
        books = [b.copy() for b in books]
        for (part, entry), (n, sums) in _totals(rows, books, width).items():
            books[part][entry] = [s // n for s in sums]
    return books


def with_label_totals(rows: DataFrame) -> DataFrame:
    """``rows`` with label_error, the sum of error over all rows of the same label (null is a label)."""
    totals = rows.groupBy("label").agg(F.try_sum("error").alias("label_error"), F.count(F.lit(1)).alias("n"))
    totals = totals.crossJoin(F.broadcast(rows.agg(F.count(F.lit(1)).alias("all_rows"))))  # one row
    is_heavy = F.col("n") * HEAVY > F.col("all_rows")
    known = F.col("__label").eqNullSafe(F.col("label"))

    def sums(of: DataFrame) -> DataFrame:
        return of.select(F.col("label").alias("__label"), "label_error")

    heavy, light = F.broadcast(sums(totals.filter(is_heavy))), sums(totals.filter(~is_heavy))
    common = rows.join(heavy, known).drop("__label")
    rare = rows.join(heavy.select("__label"), known, "left_anti").join(light, known).drop("__label")
    return common.unionByName(rare)


def compress(vectors: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Per kept vector: vec_id, code (two hex digits a part), error, label_error, codebooks_sha256."""
    spark = vectors.sparkSession
    first = kept_vectors(vectors, "vec_id").orderBy(F.col("vec_id").asc_nulls_last(), "vector").select(F.size("vector").alias("size")).first()
    books = fit_codebooks(vectors, first.size, rounds) if first else []
    id_type, label_type = vectors.schema["vec_id"].dataType, vectors.schema["label"].dataType
    schema = StructType([StructField("vec_id", id_type), StructField("label", label_type), StructField("code", StringType()), StructField("error", LongType())])
    digest = hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()
    if not books:
        none = spark.createDataFrame([], schema).withColumn("label_error", F.lit(0).cast("long"))
        return none.drop("label").withColumn("codebooks_sha256", F.lit(digest))
    width = PARTS * books[0].shape[1]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = [Slices(b) for b in books]
        for batch in batches:
            codes, distances = assign(_integers(batch, width), slices)
            text = [row.tobytes().hex() for row in codes.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(text, pa.string()), pa.array(distances.sum(axis=1))], names=schema.names)

    rows = kept_vectors(vectors, "vec_id", "label").filter(F.size("vector") == first.size)
    coded = staged(rows.mapInArrow(encode, schema), "codes")
    return with_label_totals(coded).drop("label").withColumn("codebooks_sha256", F.lit(digest))
