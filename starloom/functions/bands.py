"""Banding ladders: a list of (operator, bound, label) tested top-down."""

from __future__ import annotations

import operator
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_OPERATORS = {
    "<": operator.lt,
    "<=": operator.le,
    ">": operator.gt,
    ">=": operator.ge,
    "=": operator.eq,
    "like": lambda column, pattern: column.like(pattern),
}


def band(column: Column | str, rungs: Sequence[tuple[str, object, object]], otherwise) -> Column:
    """First rung whose test holds wins; a NULL input falls to ``otherwise``."""
    value = F.col(column) if isinstance(column, str) else column
    ladder = F
    for op, bound, label in rungs:
        ladder = ladder.when(_OPERATORS[op](value, bound), F.lit(label))
    return ladder.otherwise(F.lit(otherwise))


def first_match(rungs: Sequence[tuple[Column, object]], otherwise) -> Column:
    """As :func:`band`, for rungs with their own full conditions."""
    ladder = F
    for condition, label in rungs:
        ladder = ladder.when(condition, label if isinstance(label, Column) else F.lit(label))
    return ladder.otherwise(otherwise if isinstance(otherwise, Column) else F.lit(otherwise))
