"""Hash keys: surrogate keys and reproducible uniform draws."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class KeyPolicy:
    """How surrogate keys are derived from their text.

    ``bits`` leading bits of the MD5 digest become the key.  32 bits without a
    separator reproduces the compact keys of existing warehouses, but such keys
    start to collide near 10^5 rows.  The default keeps 60 bits (a positive
    BIGINT) and separates the parts, so ``(1, 23)`` and ``(12, 3)`` differ.
    """

    bits: int = 60
    separator: str = "|"

    def __post_init__(self):
        if self.bits % 4 or not 4 <= self.bits <= 60:
            raise ValueError("bits must be a multiple of 4 between 4 and 60")


WIDE_KEYS = KeyPolicy()
COMPACT_KEYS = KeyPolicy(bits=32, separator="")


def _text(part) -> Column:
    column = part if isinstance(part, Column) else F.col(part)
    return F.coalesce(column.cast("string"), F.lit(""))


def surrogate_key(*parts, policy: KeyPolicy = WIDE_KEYS) -> Column:
    """Deterministic BIGINT key of the given columns; NULL counts as ''."""
    text = F.concat_ws(policy.separator, *[_text(p) for p in parts])
    digest = F.substring(F.md5(text), 1, policy.bits // 4)
    return F.conv(digest, 16, 10).cast("bigint")


def wide_decimal_key(*parts, separator: str = "|") -> Column:
    """The unsigned 64-bit variant, which needs DECIMAL(20,0)."""
    text = F.concat_ws(separator, *[_text(p) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 16), 16, 10).cast("decimal(20,0)")


def hash_uniform(salt: str, *parts) -> Column:
    """A draw from [0, 1) fixed by the row's key and ``salt``.

    Replaces random(): re-running a job, retrying a lost task or asking a second
    engine gives the same sample.
    """
    text = F.concat_ws("|", *[_text(p) for p in parts], F.lit(salt))
    number = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return F.pmod(number, F.lit(1_000_000)).cast("double") / F.lit(1_000_000.0)
