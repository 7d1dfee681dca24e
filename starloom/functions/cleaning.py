"""Column cleaning driven by the schema: one projection, no row code."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.dates import MAX_TIMESTAMP


def _is_date_name(name: str) -> bool:
    return "date" in name.lower()


def _clean_timestamp(value: Column) -> Column:
    return F.least(value.cast("timestamp"), F.lit(MAX_TIMESTAMP).cast("timestamp"))


def _clean_column(field: T.StructField, null_as_zero: bool) -> Column:
    column, kind = F.col(field.name), field.dataType
    if _is_date_name(field.name):
        if isinstance(kind, T.StringType):
            parsed = F.try_to_timestamp(column, F.lit("yyyy-MM-dd"))
            clamped = F.date_format(_clean_timestamp(parsed), "yyyy-MM-dd HH:mm:ss")
            # Text that is no date stays as it is, as text.
            return F.when(parsed.isNotNull(), clamped).otherwise(column)
        if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            # least() would turn a NULL date into the clamp value.
            return F.when(column.isNotNull(), _clean_timestamp(column))
    if isinstance(kind, T.DecimalType):
        column = column.cast("double")
        kind = T.DoubleType()
    if null_as_zero and isinstance(kind, T.NumericType):
        return F.coalesce(column, F.lit(0).cast(kind))
    if null_as_zero and isinstance(kind, T.StringType):
        return F.coalesce(column, F.lit("0"))
    return column


def clean_values(
    df: DataFrame, columns: Iterable[str] | None = None, *, null_as_zero: bool = True, keep: Iterable[str] = ()
) -> DataFrame:
    """Normalise values before a load.

    DECIMAL becomes DOUBLE, dates in columns named ``*date*`` become timestamps
    no later than 2100-12-31 (strings of the form yyyy-MM-dd are parsed), and
    NULL numbers and strings become 0.  Name the foreign keys in ``keep``: a
    NULL key must stay NULL, or it would be looked up as member 0.
    """
    wanted = set(columns if columns is not None else df.columns) - set(keep)
    return df.select(
        *[
            _clean_column(f, null_as_zero).alias(f.name) if f.name in wanted else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def null_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Replace NULLs column by column."""
    return df.select(
        *[F.coalesce(F.col(c), F.lit(defaults[c])).alias(c) if c in defaults else F.col(c) for c in df.columns]
    )


def convert_types(df: DataFrame, targets: Mapping[str, str], error_column: str = "ConversionErrors") -> DataFrame:
    """Cast text columns, collecting a message per value that does not fit.

    ``targets`` maps a column to int, bigint, float or date.
    """
    converted, messages = {}, []
    for name, target in targets.items():
        source = F.col(name)
        if target == "date":
            value = F.try_to_date(source, "yyyy-MM-dd")
        else:
            value = source.try_cast("double" if target == "float" else target)
        converted[name] = value
        messages.append(
            F.when(source.isNotNull() & value.isNull(), F.lit(f"TYPE_MISMATCH: cannot convert {name} to {target}"))
        )
    kept = [converted[c].alias(c) if c in converted else F.col(c) for c in df.columns]
    return df.select(*kept, F.array_compact(F.array(*messages)).alias(error_column))


def as_date_literal(day: dt.date) -> Column:
    return F.lit(day).cast("date")
