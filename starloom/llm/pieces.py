"""SentencePiece encoding and decoding: Unigram Viterbi over a double-array trie.

The pieces and their scores come from a model file; the segmentation with the largest sum of scores is found in a
lattice whose edges are the pieces that a double-array trie finds at each byte.  A character that no piece covers
scores as the library's unknown (the least score minus 10) and is written as byte pieces.  Decoding joins the pieces,
turns markers into spaces, bytes into characters, and takes off the marker that encoding puts before a text.

A text is cut into pre-tokens first (see :mod:`starloom.llm.pretokens`): the best path of a text is that of its
pre-tokens, so each distinct one is segmented once per batch, all of them side by side with numpy, and a bounded cache
keeps them for the next batch.

Defined cases: a null text has no pieces and decodes to the empty text; the marker character itself decodes to a
space; repeated rows each get a row; an empty table gives an empty result; an input column named as one of the new
ones is replaced, others stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StructField, StructType

from starloom.llm.common import arrow_batches
from starloom.llm.pretokens import LONGEST_CACHED, MARKER, pretokens, processor

UNKNOWN_PENALTY = 10.0
CACHED = 500_000
#: Longer pre-tokens (in bytes) are segmented one by one.
SIDE_BY_SIDE = 64


class DoubleArray:
    """Trie over bytes: the child of node s by byte c is base[s] + c + 1 if check there is s; value is the piece or -1."""

    def __init__(self, keys: dict[bytes, int]):
        ordered = sorted(keys.items())
        size = 1 << 16
        self.base, self.check, self.value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        self.longest = max(map(len, keys), default=0)
        taken, first, top = np.zeros(size, bool), 300, 300  # no base is below 0
        taken[0] = True
        stack = [(0, 0, 0, len(ordered))]
        while stack:
            node, depth, low, high = stack.pop()
            if low < high and len(ordered[low][0]) == depth:
                self.value[node] = ordered[low][1]
                low += 1
            if low >= high:
                continue
            bounds, codes = [low], [ordered[low][0][depth]]
            for i in range(low + 1, high):
                if ordered[i][0][depth] != codes[-1]:
                    bounds.append(i)
                    codes.append(ordered[i][0][depth])
            bounds.append(high)
            offsets = np.array(codes) + 1
            while taken[first]:
                first += 1
            near = first if len(offsets) == 1 else max(first, top - 512)  # only children fill the holes of the others
            start = near - int(offsets[0])
            while True:
                if start + 300 >= len(taken):
                    grow = len(taken)
                    self.base, taken = np.pad(self.base, (0, grow)), np.pad(taken, (0, grow))
                    self.check, self.value = (np.pad(x, (0, grow), constant_values=-1) for x in (self.check, self.value))
                if not taken[start + offsets].any():
                    break
                start += 1
            top = max(top, start + int(offsets[-1]))
            self.base[node] = start
            taken[start + offsets] = True
            self.check[start + offsets] = node
            stack.extend((start + int(o), depth + 1, a, b) for o, a, b in zip(offsets, bounds, bounds[1:]))
        end = int(np.flatnonzero(taken)[-1]) + 300  # a lookup never leaves the arrays
        self.base, self.check, self.value = (np.ascontiguousarray(x[:end]) if len(x) >= end else np.pad(x, (0, end - len(x)), constant_values=-1 if x is not self.base else 0) for x in (self.base, self.check, self.value))


#: Length of a UTF-8 character by its first byte.
_LENGTHS = np.array([1 if b < 0xC0 else 2 if b < 0xE0 else 3 if b < 0xF0 else 4 for b in range(256)])


class Unigram:
    """Segmentation with the pieces of a model file.

    ``scores`` is "model" for a Unigram model, whose scores are logarithms of probabilities.  A BPE model's are merge
    ranks; "zipf" takes the probability of a piece as inverse to its rank, normalised, and scores by its logarithm.
    """

    def __init__(self, model: str, scores: str = "model", cached: int = CACHED):
        own = processor(model)
        n = len(own)
        special = [own.is_control(i) or own.is_unknown(i) or own.is_byte(i) for i in range(n)]
        self.text = [own.id_to_piece(i) for i in range(n)]
        self.score = np.array([own.get_score(i) for i in range(n)], dtype=np.float64)
        if scores == "zipf":
            ranked = sorted((i for i in range(n) if not special[i]), key=lambda i: (-self.score[i], i))
            total = np.log(np.sum(1 / np.arange(1, len(ranked) + 1)))
            self.score[ranked] = -np.log(np.arange(1, len(ranked) + 1)) - total
        self.trie = DoubleArray({self.text[i].encode(): i for i in range(n) if not special[i]})
        self.unknown = min((self.score[i] for i in range(n) if not special[i]), default=0.0) - UNKNOWN_PENALTY
        self.byte = {int(self.text[i][3:5], 16): i for i in range(n) if own.is_byte(i)}
        self.unk = own.unk_id()
        self.raw = [bytes([int(t[3:5], 16)]) if own.is_byte(i) else b"" if own.is_control(i) else t.replace(MARKER, " ").encode() for i, t in enumerate(self.text)]
        self.raw_all = np.frombuffer(b"".join(self.raw), np.uint8)
        self.raw_ends = np.concatenate([[0], np.cumsum([len(r) for r in self.raw])])
        self.cached = cached
        self._forget()

    def _ids(self, raw: bytes, back: list[int], piece: list[int]) -> list[int]:
        """Follow the best edges back from the end."""
        found, at = [], len(raw)
        while at > 0:
            if piece[at] >= 0:
                found.append(piece[at])
            else:
                unknown = raw[back[at] : at]
                found.extend([self.byte[b] for b in reversed(unknown)] if self.byte else [self.unk])
            at = back[at]
        return found[::-1]

    def one(self, raw: bytes) -> list[int]:
        """Viterbi for one pre-token of any length."""
        base, check, value, score = self.trie.base, self.trie.check, self.trie.value, self.score
        size = len(raw)
        best, back, piece = [-np.inf] * (size + 1), [0] * (size + 1), [-1] * (size + 1)
        best[0] = 0.0
        for start in range(size):
            if best[start] == -np.inf:
                continue
            width, covered, node = int(_LENGTHS[raw[start]]), False, 0
            for end in range(start + 1, min(size, start + self.trie.longest) + 1):
                child = base[node] + raw[end - 1] + 1
                if check[child] != node:
                    break
                node = child
                if value[node] >= 0:
                    covered |= end - start == width
                    total = best[start] + score[value[node]]
                    if total > best[end]:
                        best[end], back[end], piece[end] = total, start, int(value[node])
            if not covered and best[start] + self.unknown > best[start + width]:
                best[start + width], back[start + width], piece[start + width] = best[start] + self.unknown, start, -1
        return self._ids(raw, back, piece)

    def many(self, raws: list[bytes]) -> list[list[int]]:
        """Viterbi for pre-tokens of similar length, a position at a time for all of them."""
        base, check, value, score = self.trie.base, self.trie.check, self.trie.value, self.score
        sizes = np.array([len(r) for r in raws])
        length = int(sizes.max())
        codes = np.zeros((len(raws), length), np.int32)
        codes[np.arange(length) < sizes[:, None]] = np.frombuffer(b"".join(raws), np.uint8)
        best = np.full((len(raws), length + 5), -np.inf)
        back, piece = np.zeros(best.shape, np.int32), np.full(best.shape, -1, np.int32)
        best[:, 0] = 0.0
        for start in range(length):
            all_rows = np.flatnonzero((best[:, start] > -np.inf) & (sizes > start))
            if not len(all_rows):
                continue
            width = _LENGTHS[codes[all_rows, start]]
            covered = np.zeros(len(raws), bool)
            rows, node, widths = all_rows, np.zeros(len(all_rows), np.int32), width
            for end in range(start + 1, min(length, start + self.trie.longest) + 1):
                child = base[node] + codes[rows, end - 1] + 1
                ok = (check[child] == node) & (sizes[rows] >= end)
                rows, node, widths = rows[ok], child[ok], widths[ok]
                if not len(rows):
                    break
                ids = value[node]
                full = ids >= 0
                r, ids = rows[full], ids[full]
                covered[r[widths[full] == end - start]] = True
                total = best[r, start] + score[ids]
                better = total > best[r, end]
                r = r[better]
                best[r, end], back[r, end], piece[r, end] = total[better], start, ids[better]
            bare = ~covered[all_rows]
            r, end = all_rows[bare], start + width[bare]
            total = best[r, start] + self.unknown
            better = total > best[r, end]
            r, end = r[better], end[better]
            best[r, end], back[r, end], piece[r, end] = total[better], start, -1
        return [self._ids(raw, b, p) for raw, b, p in zip(raws, back.tolist(), piece.tolist())]

    def segment(self, words: list[str]) -> dict[str, list[int]]:
        """Ids of distinct pre-tokens, given without their first marker."""
        raw = {w: (MARKER + w.replace(" ", MARKER)).encode() for w in words}
        short = sorted((w for w in words if len(raw[w]) <= SIDE_BY_SIDE), key=lambda w: len(raw[w]))
        found = {w: self.one(raw[w]) for w in words if len(raw[w]) > SIDE_BY_SIDE}
        for i in range(0, len(short), 4096):
            part = short[i : i + 4096]
            found.update(zip(part, self.many([raw[w] for w in part])))
        return found

    # -- memory of pre-tokens: a number each, their pieces side by side in one array, what these decode to, last use --

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.spoken: list[str] = []
        self.ends, self.ids, self.used, self.batches = np.zeros(1, np.int64), np.empty(0, np.int32), np.empty(0, np.int64), 0

    def _remember(self, found: dict[str, list[int]]) -> None:
        start = len(self.number)
        self.number.update(zip(found, range(start, start + len(found))))
        sizes = np.fromiter(map(len, found.values()), np.int64, count=len(found))
        flat = np.fromiter(chain.from_iterable(found.values()), np.int32, count=int(sizes.sum()))
        self.spoken.extend(self._speak_all(flat, sizes))
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])
        self.ids = np.concatenate([self.ids, flat])
        self.used = np.concatenate([self.used, np.full(len(found), self.batches)])

    def _keep(self, kept: np.ndarray) -> None:
        """Forget all pre-tokens but those with the given numbers (ascending)."""
        words = list(self.number)
        lengths = np.diff(self.ends)[kept]
        until = np.concatenate([[0], np.cumsum(lengths)])
        self.ids = self.ids[np.repeat(self.ends[kept] - until[:-1], lengths) + np.arange(until[-1])]
        self.ends, self.used = until, self.used[kept]
        numbers = kept.tolist()
        self.number = {words[n]: i for i, n in enumerate(numbers)}
        self.spoken = [self.spoken[n] for n in numbers]

    def _speak_all(self, flat: np.ndarray, sizes: np.ndarray) -> list[str]:
        """What the pieces of each pre-token stand for; the bytes of a character never lie in two pre-tokens."""
        lengths = self.raw_ends[flat + 1] - self.raw_ends[flat]
        until = np.concatenate([[0], np.cumsum(lengths)])
        joined = self.raw_all[np.repeat(self.raw_ends[flat] - until[:-1], lengths) + np.arange(until[-1])].tobytes()
        bounds = until[np.concatenate([[0], np.cumsum(sizes)])].tolist()
        return [joined[a:b].decode("utf-8", "replace") for a, b in zip(bounds, bounds[1:])]

    def coded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """The pieces of all texts side by side, where each text begins (and the last one ends), and the decoded texts."""
        split = [pretokens(t) for t in texts]
        self.batches += 1
        fresh = set(chain.from_iterable(split)) - self.number.keys()
        long = [w for w in fresh if len(w) > LONGEST_CACHED]
        self._remember(self.segment([w for w in fresh if len(w) <= LONGEST_CACHED]))
        short = len(self.number)
        self._remember(self.segment(long))
        sizes = np.fromiter(map(len, split), np.int64, count=len(split))
        numbers = np.fromiter(map(self.number.__getitem__, chain.from_iterable(split)), np.int64, count=int(sizes.sum()))
        lengths = np.diff(self.ends)[numbers]
        until = np.concatenate([[0], np.cumsum(lengths)])
        flat = self.ids[np.repeat(self.ends[numbers] - until[:-1], lengths) + np.arange(until[-1])]
        places = np.concatenate([[0], np.cumsum(sizes)])
        spoken, listed, at = self.spoken.__getitem__, numbers.tolist(), places.tolist()
        decoded = ["".join(map(spoken, listed[a:b])).removeprefix(" ") for a, b in zip(at, at[1:])]
        self.used[numbers] = self.batches
        if long or short > self.cached:  # long ones stay for this batch only; those unused for longest make room
            recent = self.used[:short]
            if short > self.cached:
                recent = np.flatnonzero(recent >= np.partition(recent, short - self.cached // 2)[short - self.cached // 2])
                self._keep(recent[-self.cached :])
            else:
                self._keep(np.arange(short))
        return flat, until[places], decoded

    def encode(self, texts: list[str]) -> list[list[int]]:
        flat, bounds, _ = self.coded(texts)
        return [flat[a:b].tolist() for a, b in zip(bounds, bounds[1:])]

    def decode(self, ids: list[int]) -> str:
        return "".join(self._speak_all(np.array(ids, np.int32), np.array([len(ids)]))).removeprefix(" ")


@lru_cache(maxsize=2)
def unigram(model: str, scores: str) -> Unigram:
    return Unigram(model, scores)


NEW = ("piece_ids", "n_pieces", "n_byte_pieces", "round_trip")


def encode_documents(docs: DataFrame, model: str, scores: str = "model", column: str = "text") -> DataFrame:
    """``docs`` with ``column`` replaced by what its pieces decode to, and :data:`NEW`.

    ``round_trip`` says whether that equals the text (with markers as spaces).
    """
    arrow_batches(docs.sparkSession)
    old = [n for n in docs.columns if n.lower() not in NEW]
    rows = docs.select(*[F.col(f"`{n}`") for n in old if n != column], F.col(column).cast("string").alias(column))
    new = [StructField("piece_ids", ArrayType(IntegerType(), False)), StructField("n_pieces", LongType()), StructField("n_byte_pieces", LongType()), StructField("round_trip", BooleanType())]
    schema = StructType([*rows.schema.fields, *new])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = unigram(model, scores)
        is_byte = np.zeros(len(own.text), bool)
        is_byte[list(own.byte.values())] = True
        for batch in batches:
            texts = [t or "" for t in batch.column(column).to_pylist()]
            flat, bounds, decoded = own.coded(texts)
            same = [d == (t.replace(MARKER, " ") if MARKER in t else t) for d, t in zip(decoded, texts)]
            arrays = [batch.column(i) for i in range(batch.num_columns - 1)]
            kept = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(flat))
            bytes_until = np.concatenate([[0], np.cumsum(is_byte[flat])])
            arrays += [pa.array(decoded, pa.string()), kept, pa.array(np.diff(bounds)), pa.array(np.diff(bytes_until[bounds])), pa.array(same, pa.bool_())]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return rows.mapInArrow(encode, schema)
