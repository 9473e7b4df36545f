"""Array (vector) expressions evaluated row-locally in the JVM (array lambdas are interpreted)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def place_by_position(entries: Column, width: int) -> Column:
    """``array<struct<ord, value>>`` (0-based, one entry per ``ord``) -> array of
    ``width`` values, NULL where no entry stands. One pass over the sorted
    entries: the gap before each is filled from its distance to the one before."""

    def fill(z: Column) -> Column:
        def step(e: Column, i: Column) -> Column:
            before = F.coalesce(F.get(z, i - 1)["ord"], F.lit(-1))
            gap = F.array_repeat(F.nullif(e["value"], e["value"]), e["ord"] - before - 1)
            return F.concat(gap, F.array(e["value"]))

        last = F.coalesce(F.get(z, F.size(z) - 1)["ord"], F.lit(-1))
        return F.struct(F.flatten(F.transform(z, step)).alias("head"),
                        (F.lit(width - 1) - last).alias("rest"))

    def close(s: Column) -> Column:
        return F.concat(s["head"], F.array_repeat(F.get(s["head"], F.lit(-1)), s["rest"]))

    # each array is bound once by a one-element transform
    filled = F.get(F.transform(F.array(F.array_sort(entries)), fill), F.lit(0))
    return F.get(F.transform(F.array(filled), close), F.lit(0))


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def elementwise_mean_of_rows(matrix) -> Column:
    """Mean over the outer axis of ``array<array<num>>`` -> ``array<double>``.

    Element ``i`` of the result is the mean of element ``i`` of every inner
    array (summed with ``zip_with``, one pass per inner array). Inner arrays
    of unequal length, or an empty matrix, give NULL (the row is rejected by
    the caller). NaN propagates, as a float mean does.
    """
    m = _c(matrix)
    width = F.size(F.element_at(m, 1))
    ok = (F.size(m) > 0) & F.forall(m, lambda row: F.size(row) == width)
    first = F.element_at(m, 1).cast("array<double>")
    rest = F.slice(m, 2, F.greatest(F.size(m) - 1, F.lit(0)))
    sums = F.aggregate(rest, first,
                       lambda acc, row: F.zip_with(acc, row, lambda a, b: a + b.cast("double")))
    return F.when(ok, F.transform(sums, lambda v: v / F.size(m)))


def zscore_array(x, mean, std, epsilon: float) -> Column:
    """``(x - mean) / (std + epsilon)`` element-wise over three arrays."""
    return F.zip_with(
        F.zip_with(_c(x), _c(mean), lambda a, m: a.cast("double") - m),
        _c(std),
        lambda d, s: d / (s + F.lit(epsilon)),
    )


def array_dot(x, w) -> Column:
    """Dot product of two equally long numeric arrays."""
    return F.aggregate(F.zip_with(_c(x), _c(w), lambda a, b: a * b), F.lit(0.0).cast("double"),
                       lambda acc, v: acc + v)
