"""Pairs of rows that stand next to each other under an entry, however many rows the entry has.

Rows are sorted into ranges, so the rows of a frequent entry lie in many tasks; each row is paired with the few before
it, across the borders of the ranges too.  The number of pairs is linear in the rows.  Rows of one entry and node that stand
next to each other count once.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import staged, union_all

_SCHEMA = "place int, at int, entry long, value int, node long, a long, b long, value_a int, value_b int"
_NAMES = [x.split()[0] for x in _SCHEMA.split(", ")]
_TYPES = [pa.int32() if x.endswith("int") else pa.int64() for x in _SCHEMA.split(", ")]


def _batch(n: int, **columns) -> pa.RecordBatch:
    given = {k: np.asarray(v) for k, v in columns.items()}
    arrays = [pa.array(given[k] if k in given else np.zeros(n, np.int64)).cast(t) for k, t in zip(_NAMES, _TYPES)]
    return pa.RecordBatch.from_arrays(arrays, names=_NAMES)


def _pairs(entry: np.ndarray, value: np.ndarray, node: np.ndarray, back: int, ratio: float) -> tuple[np.ndarray, ...]:
    """Rows ``back`` apart with the same entry, different nodes, and values whose ratio is large enough."""
    ok = (entry[back:] == entry[:-back]) & (node[back:] != node[:-back])
    if ratio:
        ok &= np.minimum(value[:-back], value[back:]) >= ratio * np.maximum(value[:-back], value[back:])
    x, y, vx, vy = node[:-back][ok], node[back:][ok], value[:-back][ok], value[back:][ok]
    less = x < y
    return np.where(less, x, y), np.where(less, y, x), np.where(less, vx, vy), np.where(less, vy, vx)


def _not_repeated(held: list[np.ndarray], fresh: list[np.ndarray]) -> np.ndarray:
    """Rows that don't repeat the entry and node of the row before: copies would take the places of other texts."""
    entry, node = (np.concatenate([held[i][-1:], fresh[i]]) for i in (0, 2))
    differs = (entry[1:] != entry[:-1]) | (node[1:] != node[:-1])
    return np.concatenate([np.ones(len(fresh[0]) - len(differs), bool), differs])


def _in_range(batches: Iterator[pa.RecordBatch], many: int, ratio: float) -> Iterator[pa.RecordBatch]:
    """Pairs (place -1), and the first and last rows of the range (place: its number), by which ranges are joined."""
    place, seen = TaskContext.get().partitionId(), 0
    held = [np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, np.int64)]
    for batch in batches:
        fresh = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
        fresh = [c[_not_repeated(held, fresh)] for c in fresh]
        if seen < many:
            first = [c[: many - seen] for c in fresh]
            n = len(first[0])
            yield _batch(n, place=np.full(n, place), at=seen + np.arange(n), entry=first[0], value=first[1], node=first[2])
        columns = [np.concatenate([h, c]) for h, c in zip(held, fresh)]
        old = len(held[0])
        for back in range(1, many + 1):
            low = max(0, old - back)  # pairs of two held rows were found before
            part = [c[low:] for c in columns]
            if len(part[0]) > back:
                a, b, va, vb = _pairs(*part, back, ratio)
                if len(a):
                    yield _batch(len(a), place=np.full(len(a), -1), a=a, b=b, value_a=va, value_b=vb)
        seen += len(fresh[0])
        held = [c[-many:] for c in columns]
    if seen > many:
        last = [c[-(seen - many) :] for c in held]  # those that aren't among the first
        n = len(last[0])
        yield _batch(n, place=np.full(n, place), at=seen - n + np.arange(n), entry=last[0], value=last[1], node=last[2])


def neighbours(rows: DataFrame, order: tuple[str, ...], many: int, ratio: float = 0.0) -> DataFrame:
    """(a, b, value_a, value_b), a < b, for rows (entry long, value int, node long) at most ``many`` apart in ``order``.

    ``order`` starts with entry.  A pair across a border may come twice.
    """
    ordered = rows.select("entry", "value", "node").repartitionByRange(*order).sortWithinPartitions(*order)
    near = staged(ordered.mapInArrow(partial(_in_range, many=many, ratio=ratio), _SCHEMA), "neighbours")
    edges = near.where(F.col("place") >= 0)  # a few rows of each task
    window, across = Window.orderBy("place", "at"), []
    for back in range(1, many + 1):
        named = edges.select("entry", "value", "node", *[F.lag(c, back).over(window).alias(f"p_{c}") for c in ("entry", "value", "node")])
        same = (F.col("entry") == F.col("p_entry")) & (F.col("node") != F.col("p_node"))
        if ratio:
            same &= F.least("value", "p_value") >= ratio * F.greatest("value", "p_value")
        less = F.col("node") < F.col("p_node")
        across.append(
            named.where(same).select(
                F.least("node", "p_node").alias("a"), F.greatest("node", "p_node").alias("b"),
                F.when(less, F.col("value")).otherwise(F.col("p_value")).alias("value_a"), F.when(less, F.col("p_value")).otherwise(F.col("value")).alias("value_b"),
            )
        )
    return union_all([near.where(F.col("place") < 0).select("a", "b", "value_a", "value_b"), *across])
