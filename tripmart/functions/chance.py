"""Reproducible random values: a hash of the row's key, so a rerun or a lost executor changes nothing.

The hash is MD5, which other engines have too, so what is drawn here can be checked there.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import gcd

from pyspark.sql import Column
from pyspark.sql import functions as F

_STEPS = 1 << 40


def draw(key: Column, salt: str, n: int | Column) -> Column:
    """A whole number in [0, n): the first 15 hex digits of the MD5 of "salt|key", modulo n."""
    n = F.lit(n) if isinstance(n, int) else n
    digest = F.md5(F.concat(F.lit(f"{salt}|"), key.cast("string")).cast("binary"))
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint"), n.cast("bigint"))


def uniform(key: Column, salt: str, low: float | Column = 0.0, high: float | Column = 1.0) -> Column:
    """A double in [low, high)."""
    unit = draw(key, salt, _STEPS) / F.lit(float(_STEPS))
    low = F.lit(low) if isinstance(low, (int, float)) else low
    high = F.lit(high) if isinstance(high, (int, float)) else high
    return low + unit * (high - low)


def happens(key: Column, salt: str, probability: float) -> Column:
    return uniform(key, salt) < probability


def weighted_choice(key: Column, salt: str, choices: dict[str, int] | Sequence) -> Column:
    """Pick a label. Each stands in a literal array as often as it weighs, so a pick is one array read."""
    if not isinstance(choices, dict):
        choices = {c: 1 for c in choices} if len(set(choices)) == len(choices) else _count(choices)
    if not choices or any(w < 0 or w != int(w) for w in choices.values()):
        raise ValueError("choices need whole, non-negative weights")
    common = reduce(gcd, (int(w) for w in choices.values()))
    if common == 0:
        raise ValueError("one weight must be above zero")
    slots = [label for label, w in choices.items() for _ in range(int(w) // common)]
    return F.element_at(F.array(*[F.lit(s) for s in slots]), (draw(key, salt, len(slots)) + 1).cast("int"))


def _count(labels: Sequence) -> dict:
    weights: dict = {}
    for label in labels:
        weights[label] = weights.get(label, 0) + 1
    return weights
