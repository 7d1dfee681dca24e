"""Benchmark decontamination: which documents hold an item of a benchmark, however long the document.

Size-partitioned MinHash containment search.  The items are partitioned by their number of distinct word shingles,
powers of two.  An item of a partition is sketched by the least of its shingles in hash order (its bottom-k MinHash);
how many, the partition's upper size decides: a document with at least the share ``threshold`` of an item's shingles
misses fewer than k of them, so it holds one of every k, those of the sketch too.  The search therefore loses no
document.  Documents look up all their shingles among the sketches; what is found is verified by exact containment on
the words themselves.

Documents are neither shuffled nor windowed.  The items go to the tasks in blocks of bounded size, one pass over the
documents for each block.

Items of fewer than five words are one shingle of all their words.  Defined cases: null or wordless items match
nothing, null or wordless documents are clean; equal items and equal documents are each reported; empty tables give an
empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from starloom.llm.common import arrow_batches, content_key, filter_rows, union_all
from starloom.llm.words import SHINGLE, WordHashes, shingles, words_of

THRESHOLD = 0.8
#: Bytes of benchmark text in one block.
BLOCK_BYTES = 8 << 20


class Item:
    def __init__(self, words: list[str], threshold: float):
        self.width = min(SHINGLE, len(words))
        self.texts = {tuple(words[i : i + self.width]) for i in range(len(words) - self.width + 1)}
        self.hashes = np.unique(shingles(WordHashes().of(words), self.width))
        self.needed = math.ceil(threshold * len(self.texts) - 1e-9)
        upper = 1 << max(0, len(self.hashes) - 1).bit_length()  # of its size partition
        self.sketch = self.hashes[: upper - math.ceil(threshold * upper - 1e-9) + 1]


class Index:
    """Sketches of a block of items, by shingle width."""

    def __init__(self, texts: list[str], threshold: float):
        self.items = [Item(words_of(t or ""), threshold) for t in texts]
        owners: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
        for i, item in enumerate(self.items):
            for h in item.sketch.tolist() if item.width else ():
                owners[item.width][h].append(i)
        self.owners = {w: dict(x) for w, x in owners.items()}
        self.sorted = {w: np.array(sorted(x), dtype=np.uint64) for w, x in owners.items()}
        self.seen = {}
        for width, keys in self.sorted.items():
            self.seen[width] = np.zeros(1 << 22, bool)
            self.seen[width][keys >> np.uint64(42)] = True

    def candidates(self, hashes: np.ndarray, width: int) -> set[int]:
        maybe = hashes[self.seen[width][hashes >> np.uint64(42)]]
        if not len(maybe):
            return set()
        keys = self.sorted[width]
        maybe = np.unique(maybe)
        at = np.minimum(np.searchsorted(keys, maybe), len(keys) - 1)
        return {i for h in maybe[keys[at] == maybe].tolist() for i in self.owners[width][h]}

    def search(self, words: list[str], hashes: np.ndarray) -> list[tuple[int, int]]:
        """(item, shared shingles) for the items that the document contains."""
        found = []
        for width in self.owners:
            own = shingles(hashes, width)
            picked = self.candidates(own, width) if len(own) else set()
            if not picked:
                continue
            texts = {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}
            for i in sorted(picked):
                shared = len(self.items[i].texts & texts)
                if shared >= self.items[i].needed:
                    found.append((i, shared))
        return found


def contained_items(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, content, item_id, n_shingles, n_shared, containment) for every item that a document contains."""
    spark = docs.sparkSession
    arrow_batches(spark)
    items = benchmark.select("item_id", F.col("text").cast("string").alias("text")).where(F.col("text").isNotNull())
    size = items.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    blocks = max(1, math.ceil(size / block_bytes))
    rows = docs.select("doc_id", content_key().alias("content"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    fields = [
        StructField("doc_id", docs.schema["doc_id"].dataType), StructField("content", LongType()), StructField("item_id", benchmark.schema["item_id"].dataType),
        StructField("n_shingles", LongType()), StructField("n_shared", LongType()), StructField("containment", DoubleType()),
    ]
    schema, id_type = StructType(fields), to_arrow_type(benchmark.schema["item_id"].dataType)

    def one_block(number: int) -> DataFrame:
        block = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == number).collect()
        shared = spark.sparkContext.broadcast(([r.item_id for r in block], [r.text for r in block]))

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ids, texts = shared.value
            index, hashes = Index(texts, threshold), WordHashes()
            for batch in batches:
                at, hits = [], []
                for row, text in enumerate(batch.column("text").to_pylist()):
                    words = words_of(text)
                    for hit in index.search(words, hashes.of(words)):
                        at.append(row)
                        hits.append(hit)
                sizes = [len(index.items[i].texts) for i, _ in hits]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(pa.array(at, pa.int64())), batch.column("content").take(pa.array(at, pa.int64())),
                        pa.array([ids[i] for i, _ in hits], id_type), pa.array(sizes, pa.int64()), pa.array([n for _, n in hits], pa.int64()),
                        pa.array([n / q for (_, n), q in zip(hits, sizes)], pa.float64()),
                    ],
                    names=schema.names,
                )

        return rows.mapInArrow(search, schema)

    return union_all([one_block(k) for k in range(blocks)])


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that contain no item, with the columns they came with."""
    return filter_rows(docs, contained_items(docs, benchmark), keep=False)
