"""Sketches of sets: bitmaps of their members' hashes, in native expressions.

A bit that only one of two sketches has is a member at least that the other set lacks. So the
members that two sets share are bounded from above, however the hashes fall.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORDS = 16  # of 64 bits
NAMES = tuple(f"w{k}" for k in range(WORDS))


def bit(hashed: str) -> Column:
    """The bit of a hash within its word, by the lowest six bits."""
    return F.expr(f"shiftleft(1L, int({hashed} & 63))")


def bitmap(hashed: str) -> list[Column]:
    """w0, w1, ...: the aggregates of a column of hashes, of which the lowest bits count."""
    word = F.shiftright(hashed, 6).bitwiseAND(F.lit(WORDS - 1))
    return [F.bit_or(F.when(word == k, bit(hashed)).otherwise(F.lit(0).cast("long"))).alias(name) for k, name in enumerate(NAMES)]


def _sum(counts: list[Column]) -> Column:
    return sum(counts[1:], counts[0])


def bits(suffix: str = "") -> Column:
    """How many bits the bitmap in w0, w1, ... has; `suffix` ends the columns' names."""
    return _sum([F.bit_count(f"{name}{suffix}") for name in NAMES])


def common(x: str, y: str) -> Column:
    """How many bits two bitmaps share, in columns named w0_x, w0_y, ...

    Compare by this alone, once in a condition: a generated method that is too long for the
    compiler of the virtual machine runs many times slower.
    """
    return _sum([F.bit_count(F.col(f"{name}_{x}").bitwiseAND(F.col(f"{name}_{y}"))) for name in NAMES])
