"""Text clean-up and tolerant casts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: characters that cannot stand in a column name.
UNSAFE = r"[ ,;{}()\n\t=]"


def sanitize(value: Column) -> Column:
    return F.regexp_replace(value, UNSAFE, "_")


def to_number(value: Column, kind: str) -> Column:
    """Null instead of an ANSI error for text that is no number."""
    if kind not in ("bigint", "double", "int"):
        raise ValueError(f"unsupported number type {kind!r}")
    return value.try_cast(kind)
