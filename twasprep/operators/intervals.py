"""Overlap joins of positions with intervals, by bins of the intervals' scale.

An interval goes to the finest level whose bins are at least as wide as it is,
so it lies in at most two neighbouring bins whatever its length; a position has
one bin on each level that intervals of its key use. The join is an equi-join on
(key, level, bin) with the range condition on top: rows grow with the number of
records, never with their length, and a hot bin can be split like any join key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits by which positions are shifted to their bin, level by level (widths 1,
#: 16, 256, ...): records of one base meet positions by equality alone.
LEVELS = tuple(range(0, 61, 4))


def level_of(length: Column) -> Column:
    """The finest level whose bins are at least ``length`` wide."""
    out = F.lit(LEVELS[-1])
    for bits in reversed(LEVELS[:-1]):
        out = F.when(length <= F.lit(2 ** bits), F.lit(bits)).otherwise(out)
    return out


def _bin(position: Column | str, level: str = "_level") -> Column:
    return F.call_function("shiftright", F.col(position) if isinstance(position, str) else position, F.col(level))


def binned_intervals(intervals: DataFrame, start: str, end: str) -> DataFrame:
    """``intervals`` with ``_level`` and ``_bin``: one or two rows for each."""
    leveled = intervals.withColumn("_level", level_of(F.col(end) - F.col(start) + 1))
    return leveled.withColumn("_bin", F.explode(F.array_distinct(F.array(_bin(start), _bin(end)))))


def overlaps(points: DataFrame, intervals: DataFrame, keys: Sequence[str], at: str, start: str,
             end: str) -> DataFrame:
    """Every (point, interval) of equal ``keys`` with start <= at <= end.

    ``at``, ``start`` and ``end`` are longs (both ends belong to the interval);
    null keys and positions match nothing, an interval that ends before it
    starts holds nothing. The columns of both sides apart from ``keys`` differ.
    """
    keys = list(keys)
    binned = binned_intervals(intervals.where(F.col(start) <= F.col(end)), start, end)
    # a few rows per key: points take only the levels that their key's intervals use
    levels = binned.select(*keys, "_level").distinct()
    placed = points.join(levels, keys).withColumn("_bin", _bin(at))
    return (placed.join(binned, [*keys, "_level", "_bin"])
            .where((F.col(start) <= F.col(at)) & (F.col(at) <= F.col(end))).drop("_level", "_bin"))
