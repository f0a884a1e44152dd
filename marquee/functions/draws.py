"""Repeatable random draws.

A draw is a function of the row's key and a salt, never of the partition it sits in: a retried
task, another partition count or a second evaluation of the frame gives the same value. One
SHA-256 digest carries eight independent 32-bit draws, so a row that needs several pays one hash.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_32 = 1 << 32
SLOTS = 8


def digest(salt: str, *keys: Column | str) -> Column:
    columns = [F.col(k) if isinstance(k, str) else k for k in keys]
    return F.sha2(F.concat_ws(":", F.lit(salt), *[c.cast("string") for c in columns]), 256)


def word(digest_column: Column, slot: int = 0) -> Column:
    """The ``slot``-th 32-bit word of a digest, as bigint."""
    if not 0 <= slot < SLOTS:
        raise ValueError(f"a digest has slots 0..{SLOTS - 1}, not {slot}")
    return F.conv(F.substring(digest_column, 8 * slot + 1, 8), 16, 10).cast("bigint")


def uniform(digest_column: Column, slot: int = 0) -> Column:
    """Uniform in [0, 1)."""
    return word(digest_column, slot) / F.lit(float(TWO_POW_32))


def normal(digest_column: Column, slot: int = 0) -> Column:
    """Standard normal by Box-Muller from the draws ``slot`` and ``slot + 1``."""
    radius = F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - uniform(digest_column, slot)))
    return radius * F.cos(F.lit(2.0 * math.pi) * uniform(digest_column, slot + 1))


def clamped_normal(
    digest_column: Column, mean: float, deviation: float, low: int, high: int, slot: int = 0
) -> Column:
    """Normal draw cut to an integer in [low, high]."""
    value = (F.lit(float(mean)) + F.lit(float(deviation)) * normal(digest_column, slot)).cast("int")
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


def thresholds(weights: Sequence[float]) -> list[float]:
    """Running shares of the weights; the last one is exactly 1.0."""
    if not weights or min(weights) < 0 or sum(weights) <= 0:
        raise ValueError("weights must be non-negative with a positive sum")
    running = list(accumulate(weights))
    return [value / running[-1] for value in running]


def weighted_index(weights: Sequence[float], draw: Column) -> Column:
    """Index 0..n-1 chosen by ``weights``: the number of inner thresholds at or below the draw."""
    steps = [(draw >= F.lit(t)).cast("int") for t in thresholds(weights)[:-1]]
    index = F.lit(0)
    for step in steps:
        index = index + step
    return index


def label_at(labels: Sequence[str], index: Column) -> Column:
    """Zero-based index to label."""
    return F.elt(index + F.lit(1), *[F.lit(text) for text in labels])


def weighted_label(labels: Sequence[str], weights: Sequence[float], draw: Column) -> Column:
    if len(labels) != len(weights):
        raise ValueError("one weight per label")
    return label_at(labels, weighted_index(weights, draw))


def pick_below(bound: Column | int, draw: Column, skew: float = 1.0) -> Column:
    """Integer in [0, bound); ``skew`` > 1 crowds the picks near 0."""
    limit = F.lit(bound) if isinstance(bound, int) else bound
    position = draw if skew == 1.0 else F.pow(draw, F.lit(float(skew)))
    return F.floor(position * limit)


def day_between(start: Column, days: Column | int, draw: Column, skew: float = 1.0) -> Column:
    """A date in the ``days`` days from ``start`` on; a negative span runs backwards."""
    span = F.lit(days) if isinstance(days, int) else days
    position = draw if skew == 1.0 else F.pow(draw, F.lit(float(skew)))
    return F.date_add(start, (position * span).cast("int"))


def popularity(key: Column | str) -> Column:
    """Power-law weight in [0, 1] of an id: its hashed uniform to the fourth power."""
    column = F.col(key) if isinstance(key, str) else key
    return F.pow(word(F.sha2(column, 256)) / F.lit(float(TWO_POW_32 - 1)), F.lit(4.0))
