"""Periodic runs: stretches of words that repeat with a period, found by seeds that are extended along diagonals.

Words are what ASCII white space separates.  A run is a stretch of words with smallest period q, at least ``EXPONENT``
periods and ``LENGTH`` words long, that neither neighbour extends.  Two places of a text that are q words apart lie on
diagonal (lag) q; a run of period q is a stretch of equal words on it, of :func:`overlap` words at least.

Lags are taken in scales of a factor of three.  ``k``, the least overlap that a scale guarantees, is at the same time
its largest lag, so of the k-grams of a text only each occurrence and its next one in the same text need to be paired:
a nearer third occurrence would give the stretch a smaller period (Fine and Wilf), and that belongs to a smaller lag.
The pairs of a text are therefore no more than its words, however often a phrase stands in it.  Seeds are extended word
by word, exactly; a table of how far each lag of a text is covered stops a stretch from being extended again.

Hashes of k-grams grow by doubling and only where the shorter ones occur twice, so a text without repetition costs one
sort.  Texts of an Arrow batch go through side by side; no text is shuffled and no group is formed across texts.

Defined cases: a null or empty text, or one of white space, has no words and no runs; of ties nothing is dropped, all
runs are returned by start and period; repeated rows each get a row; texts of any length are taken whole, in batches
bounded by bytes; an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from starloom.llm.common import SPACE_CLASS, bounded_batches, let, texts
from starloom.llm.words import mixed

EXPONENT, LENGTH = 4, 6
_STEP = np.uint64(0x9E3779B97F4A7C15)
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def overlap(lag: int) -> int:
    """Equal words that a run of period ``lag`` has on its diagonal at least."""
    return max(LENGTH - lag, (EXPONENT - 1) * lag)


def scales(longest: int) -> Iterator[tuple[int, int, int]]:
    """(first lag, last lag, k) up to the largest period that fits into ``longest`` words."""
    low = 1
    while EXPONENT * low <= longest:
        k = min(overlap(q) for q in range(low, low + LENGTH))
        yield low, k, k
        low = k + 1


class Codes(dict):
    """A number for each distinct word of a batch."""

    def __missing__(self, word: bytes) -> int:
        self[word] = len(self)
        return self[word]


def next_occurrences(values: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each place with the next one of the same value; ``places`` ascends."""
    order = np.argsort(values, kind="stable")
    same = np.flatnonzero(values[order[1:]] == values[order[:-1]])
    return places[order[same]], places[order[same + 1]]


def agreeing(codes: np.ndarray, a: int, b: int, most: int, step: int) -> int:
    """Equal words from places ``a`` and ``b`` onwards in direction ``step``, up to ``most``."""
    done, width = 0, 64
    while done < most:
        n = min(width, most - done)
        x, y = a + step * done, b + step * done
        unequal = codes[x : x + n] != codes[y : y + n] if step > 0 else (codes[x - n + 1 : x + 1] != codes[y - n + 1 : y + 1])[::-1]
        if unequal.any():
            return done + int(unequal.argmax())
        done, width = done + n, width * 2
    return done


def find_runs(codes: np.ndarray, sizes: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """Runs (start, length, period) of each text; ``codes`` has the words of all texts, ``sizes`` their numbers."""
    ends = np.cumsum(sizes)
    text_of = np.repeat(np.arange(len(sizes)), sizes)
    begin, end = (ends - sizes)[text_of], ends[text_of]
    found: list[list[tuple[int, int, int]]] = [[] for _ in sizes]
    total = len(codes)
    hashes = mixed(mixed(codes.astype(np.uint64) * _STEP) + text_of.astype(np.uint64) * _STEP)
    width, alive = 1, np.ones(total, bool)  # hashes of ``width`` words are known at the places alive

    def joined(places: np.ndarray, shift: int) -> np.ndarray:
        return mixed(hashes[places] * _STEP + hashes[places + shift])

    def grown(k: int, shift: int) -> np.ndarray:
        """Places where ``k`` words fit and both halves are known."""
        places = np.flatnonzero(alive)
        places = places[places + k <= end[places]]
        return places[alive[places + shift]]

    for low, high, k in scales(int(sizes.max(initial=0))):
        while 2 * width <= k:
            places = grown(2 * width, width)
            values = joined(places, width)
            if width >= 4:  # shorter k-grams repeat anyway
                kept = np.isin(places, np.concatenate(next_occurrences(values, places)))
                places, values = places[kept], values[kept]
            hashes, alive = np.zeros_like(hashes), np.zeros_like(alive)
            hashes[places], alive[places] = values, True
            width *= 2
        places = grown(k, k - width)
        first, second = next_occurrences(joined(places, k - width), places)
        if not len(first):
            break  # no longer k-gram repeats
        lag = second - first
        inside = (lag >= low) & (lag <= high)
        first, lag = first[inside], lag[inside]
        order = np.lexsort((first, lag))
        first, lag = first[order], lag[order]
        fresh = np.ones(len(first), bool)  # of seeds side by side on a diagonal the first one is enough
        fresh[1:] = (lag[1:] != lag[:-1]) | (first[1:] != first[:-1] + 1)
        covered: dict[int, int] = {}
        for at, q in zip(first[fresh].tolist(), lag[fresh].tolist()):
            if at < covered.get(q, 0):
                continue
            top, bottom = int(end[at]), int(begin[at])
            right = agreeing(codes, at, at + q, top - at - q, 1)
            left = agreeing(codes, at - 1, at + q - 1, at - bottom, -1)
            covered[q] = at + right
            if left + right >= overlap(q):
                found[text_of[at]].append((at - left - bottom, left + right + q, q))
    return [sorted(x, key=lambda r: (r[0], r[2])) for x in found]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words outside of repetitions: of each run only the first period stays."""
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()])


def periodic_runs(docs: DataFrame, key: str = "doc_id", column: str = "text") -> DataFrame:
    """Per row: key, n_words, runs (array of start, length, period) and collapsed (the kept words, joined by a space)."""
    bounded_batches(docs.sparkSession)
    rows = texts(docs, key, column=column)
    run = StructType([StructField(n, LongType()) for n in ("start", "length", "period")])
    schema = StructType([rows.schema[key], StructField("n_words", LongType()), StructField("runs", ArrayType(run)), StructField("collapsed", StringType())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [t.encode().split() for t in batch.column("text").to_pylist()]
            sizes = np.fromiter(map(len, words), np.int64, count=len(words))
            codes = Codes()
            flat = np.fromiter(map(codes.__getitem__, chain.from_iterable(words)), np.int64, count=int(sizes.sum()))
            runs = find_runs(flat, sizes)
            kept = pa.array([collapsed(w, r) for w, r in zip(words, runs)], pa.binary()).cast(pa.string())
            offsets = np.concatenate([[0], np.cumsum([len(r) for r in runs])]).astype(np.int32)
            table = np.array([r for own in runs for r in own], np.int64).reshape(-1, 3)
            items = pa.StructArray.from_arrays([pa.array(table[:, i]) for i in range(3)], fields=list(_RUN))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes), pa.ListArray.from_arrays(pa.array(offsets), items), kept], names=schema.names)

    return rows.mapInArrow(scan, schema)


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period, compared exactly; ties go to the smallest start, then period."""

    def before(x, y):
        gain = y["length"] * x["period"] - x["length"] * y["period"]
        order = [F.signum(v.cast("double")).cast("int") for v in (gain, x["start"] - y["start"], x["period"] - y["period"])]
        return F.when(order[0] != 0, order[0]).when(order[1] != 0, order[1]).otherwise(order[2])

    return F.get(F.array_sort(runs, before), F.lit(0))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text) in which every tenth document, by the CRC of its id, ends in a repetition of known period.

    With h that CRC, g = floor(h / 10) and n words, words from a = g % n on repeat the first p = 1 + floor((n - a) / (3 + g % 8)) of them.
    Documents without id are left as they are.
    """
    rows = texts(docs, "doc_id").withColumn("h", F.crc32(F.col("doc_id").cast("string").cast("binary")))
    words = F.filter(F.split("text", f"[{SPACE_CLASS}]+"), lambda w: w != "")
    g = F.floor(F.col("h") / 10)

    def planted(w):
        def repeated(a):
            p = 1 + F.floor((F.size(w) - a) / (3 + g % 8))
            return let(p, lambda p: F.transform(w, lambda x, i: F.when(i < a, x).otherwise(F.get(w, (a + (i - a) % p).cast("int")))))

        return F.when(F.size(w) > 0, F.array_join(let(g % F.size(w), repeated), " ")).otherwise(F.lit(""))

    return rows.select("doc_id", F.when(F.col("h") % 10 == 0, let(words, planted)).otherwise(F.col("text")).alias("text"))
