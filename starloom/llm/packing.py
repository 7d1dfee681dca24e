"""Packing along a space-filling curve: neighbouring documents of similar content share training sequences.

A document's words are hashed into a vector of ``BUCKETS`` counts, which fixed random signs project to ``DIMENSIONS``
numbers; the mean sign per word is squashed to ``BITS`` bits, and the place of that point on a Hilbert curve is the key by
which documents are range-sorted.  Each range then packs its documents in that order: their token ids, followed by an end
id, fill sequences of ``LENGTH`` ids without gaps, cut where a sequence is full.  What remains at the end of a range is
cut into sequences whose lengths are powers of two, so that nothing is padded at all.

The text moves once, in the range sort; ids are made after it, in the task that packs them, by a library for byte-level
BPE that is several times faster than the one the vocabulary file is written for and gives the same ids (tests compare
them).  A task holds a batch and the open sequence.  Ranges are cut by (key, doc_id, place in the input), so a third of
all rows with one text, or without id, are many ranges like any others.

Defined cases: a null or empty text is its end id alone; equal texts lie next to each other, ties of key and id in
the order of the input; repeated rows are packed each; a text longer than a sequence is cut; an empty table gives an empty
result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from starloom.llm.common import bounded_batches, texts
from starloom.llm.words import mixed

LENGTH, END = 2048, 1
BUCKETS, DIMENSIONS, BITS = 1 << 16, 4, 15
#: How fast the squash saturates; mean signs of texts lie within a few tenths.
STEEP = 8.0
#: Bytes that are projected at once, a longer text in slices of that size.
SLICE = 1 << 22
#: The pre-tokenizer's pattern of this kind of vocabulary (a fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


# -- ids -----------------------------------------------------------------------------


@lru_cache(maxsize=2)
def coder(vocabulary: str):
    """An encoder with the vocabulary of a byte-level BPE file (.json), whose ids rise in the order of the merges."""
    import tiktoken

    with open(vocabulary, encoding="utf-8") as file:
        given = json.load(file)
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]  # bytes that stand for themselves
    signs = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    special = {t["content"]: t["id"] for t in given["added_tokens"]}
    ranks = {bytes(signs[c] for c in piece): i for piece, i in given["model"]["vocab"].items() if piece not in special}
    return tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)


# -- the curve -----------------------------------------------------------------------

_CASE = np.arange(256, dtype=np.uint8)
_CASE[65:91] += 32
_CASE[[32, *range(9, 14)]] = 0
_HEAD = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [2**64 - 1], np.uint64)


@lru_cache(maxsize=1)
def _signs() -> np.ndarray:
    return np.random.Generator(np.random.PCG64(7)).choice(np.array([-1, 1], np.int8), (BUCKETS, DIMENSIONS))


def word_sums(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum of the words' signs and number of words for each stretch of ``raw`` between two ``bounds``.

    Words are what white space separates, in lower case, told apart by their first eight bytes and their length.
    """
    folded = np.concatenate([_CASE[raw], np.zeros(8, np.uint8)])
    inside = folded[: len(raw)] != 0
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = bounds[(bounds > 0) & (bounds < len(raw))]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    size = ends - starts
    heads = np.lib.stride_tricks.sliding_window_view(folded, 8)[starts].view("<u8").ravel() & _HEAD[size.clip(max=8)]
    buckets = mixed(heads + mixed(size.astype(np.uint64))) % np.uint64(BUCKETS)
    total = np.concatenate([np.zeros((1, DIMENSIONS), np.int64), np.cumsum(_signs()[buckets], axis=0, dtype=np.int64)])
    at = np.searchsorted(starts, bounds)
    return np.diff(total[at], axis=0), np.diff(at)


def points(raws: list[bytes]) -> np.ndarray:
    """Each text as ``DIMENSIONS`` coordinates of ``BITS`` bits."""
    sums, counts = np.zeros((len(raws), DIMENSIONS), np.int64), np.zeros(len(raws), np.int64)
    i = 0
    while i < len(raws):
        size, j = 0, i
        while j < len(raws) and (j == i or size + len(raws[j]) <= SLICE):
            size, j = size + len(raws[j]), j + 1
        joined = np.frombuffer(b"".join(raws[i:j]), np.uint8)
        if j == i + 1:  # one text, in slices of its own
            for at in range(0, size, SLICE):
                part = joined[at : at + SLICE]
                s, n = word_sums(part, np.array([0, len(part)]))
                sums[i] += s[0]
                counts[i] += n[0]
        else:
            sums[i:j], counts[i:j] = word_sums(joined, np.concatenate([[0], np.cumsum([len(r) for r in raws[i:j]])]))
        i = j
    mean = sums / np.maximum(counts, 1)[:, None]
    return ((1 << BITS) / (1 + np.exp(-STEEP * mean))).astype(np.int64).clip(0, (1 << BITS) - 1)


def hilbert_key(coordinates: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place of each point (a row of coordinates of ``bits`` bits) on the Hilbert curve that fills the cube."""
    x = [c.copy() for c in coordinates.T]
    for level in range(bits - 1, 0, -1):  # undo the turns and reflections of the cells, from the largest down
        low = (1 << level) - 1
        for d in range(len(x)):
            upper = (x[d] >> level) & 1 == 1
            swap = np.where(upper, 0, (x[0] ^ x[d]) & low)
            x[0] ^= np.where(upper, low, swap)
            x[d] ^= swap
    for d in range(1, len(x)):
        x[d] ^= x[d - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] >> level) & 1 == 1, (1 << level) - 1, 0)
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for c in x:
            key = (key << 1) | (((c ^ flip) >> level) & 1)
    return key


# -- sequences -----------------------------------------------------------------------


class Packer:
    """Cuts the ids that come in into sequences; ``taken`` gives the pieces of those that are complete."""

    def __init__(self, length: int = LENGTH):
        self.length, self.fill, self.made = length, 0, 0
        self.open: list[tuple] = []  # (document, start, ids, ids of the document)
        self.done: list[tuple] = []

    def _close(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc, start, ids, whole in pieces:
            self.done.append((doc, start, len(ids), whole, self.made, offset, ids.tobytes()))
            offset += len(ids)
        self.made += 1

    def add(self, doc, ids: np.ndarray) -> None:
        at = 0
        while at < len(ids):
            n = min(len(ids) - at, self.length - self.fill)
            self.open.append((doc, at, ids[at : at + n], len(ids)))
            self.fill, at = self.fill + n, at + n
            if self.fill == self.length:
                self._close(self.open)
                self.open, self.fill = [], 0

    def finish(self) -> None:
        """Cut the open sequence into lengths that are powers of two."""
        rest = list(reversed(self.open))
        for bit in range(self.fill.bit_length() - 1, -1, -1):
            room, pieces = self.fill & (1 << bit), []
            while room:
                doc, start, ids, whole = rest.pop()
                n = min(room, len(ids))
                pieces.append((doc, start, ids[:n], whole))
                if n < len(ids):
                    rest.append((doc, start + n, ids[n:], whole))
                room -= n
            if pieces:
                self._close(pieces)
        self.open, self.fill = [], 0

    def taken(self) -> list[tuple]:
        done, self.done = self.done, []
        return done


def pack(docs: DataFrame, vocabulary: str, length: int = LENGTH, end: int = END) -> DataFrame:
    """Per piece: doc_id, start, length, doc_tokens, sequence_id, offset, ids (unsigned 32-bit, little-endian).

    ``vocabulary`` is the path of a byte-level BPE tokenizer (.json).
    """
    bounded_batches(docs.sparkSession)
    rows = texts(docs, "doc_id")
    id_field = rows.schema["doc_id"]
    keyed_schema = StructType([*rows.schema.fields, StructField("curve", LongType())])

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = hilbert_key(points([t.as_buffer().to_pybytes() for t in batch.column("text")]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(key)], names=keyed_schema.names)

    names = ("start", "length", "doc_tokens", "sequence_id", "offset")
    schema = StructType([id_field, *[StructField(n, LongType()) for n in names], StructField("ids", BinaryType())])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer, first, kind = coder(vocabulary).encode_to_numpy, Packer(length), 0, None

        def batch_of(pieces: list[tuple]) -> pa.RecordBatch:
            doc, *numbers, ids = zip(*pieces)
            arrays = [pa.array(n, pa.int64()) for n in numbers]
            arrays[3] = pa.array([first + n for n in numbers[3]], pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(doc, kind), *arrays, pa.array(ids, pa.binary())], names=schema.names)

        for batch in batches:
            kind = batch.schema.field("doc_id").type
            if batch.num_rows:
                first = batch.column("part")[0].as_py() << 36  # numbers of its own for each range
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                packer.add(doc, np.append(encode(text, allowed_special="all"), np.uint32(end)).astype("<u4"))
            if packer.done:
                yield batch_of(packer.taken())
        packer.finish()
        if packer.done:
            yield batch_of(packer.taken())

    order = ("curve", "doc_id", "place")
    placed = rows.mapInArrow(keyed, keyed_schema).withColumn("place", F.monotonically_increasing_id())
    ranges = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    return ranges.select("doc_id", "text", F.spark_partition_id().alias("part")).mapInArrow(packed, schema)
