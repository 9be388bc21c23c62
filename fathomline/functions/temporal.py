"""Step functions of time as arrays of (t, v), and circular differences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def circular_delta(values: Column, bound: float = 360.0, ordered: bool = False) -> Column:
    """The sum of least turns between neighbours. By default over the sorted distinct values (the set of values that
    occur); ``ordered`` keeps the array's order. Null or fewer than two values give 0."""
    v = F.filter(values, lambda x: x.isNotNull())
    if not ordered:
        v = F.array_sort(F.array_distinct(v))
    n = F.greatest(F.size(v) - 1, F.lit(0))
    mod = lambda x: x - F.floor(x / bound) * bound
    turns = F.zip_with(F.slice(v, 1, n), F.slice(v, 2, n), lambda a, b: F.least(mod(a - b), mod(b - a)))
    return F.coalesce(F.aggregate(turns, F.lit(0.0), lambda s, x: s + x), F.lit(0.0))


def delta(values: Column, absolute: bool = True) -> Column:
    """The sum of (absolute) differences between neighbours."""
    n = F.greatest(F.size(values) - 1, F.lit(0))
    steps = F.zip_with(F.slice(values, 1, n), F.slice(values, 2, n), lambda a, b: F.abs(b - a) if absolute else b - a)
    return F.coalesce(F.aggregate(steps, F.lit(0.0), lambda s, x: s + x), F.lit(0.0))


def compress_steps(points: Column) -> Column:
    """An array of (t, v) in time order without null values and without instants that repeat the value before; the last instant stays."""
    p = F.filter(points, lambda x: x["v"].isNotNull())
    return F.filter(p, lambda x, i: (i == 0) | (i == F.size(p) - 1) | (x["v"] != F.get(p, i - 1)["v"]))


def steps_within(steps: Column, start: Column, end: Column) -> Column:
    """The values in force during [start, end]: those that begin there and the one in force at the start."""
    begin = F.array_max(F.transform(F.filter(steps, lambda s: s["t"] <= start), lambda s: s["t"]))
    return F.transform(F.filter(steps, lambda s: (s["t"] <= end) & (s["t"] >= F.coalesce(begin, start))), lambda s: s["v"])


def least_step(steps: Column, start: Column, end: Column) -> Column:
    return F.array_min(steps_within(steps, start, end))
