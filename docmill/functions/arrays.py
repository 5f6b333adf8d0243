"""Array helpers that take time in proportion to the array, or to n log n, where a fold that appends would be quadratic."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def scan(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """Running results of an associative ``combine(before, own)``, by doubling: after the step of d, each element covers the 2d up to itself."""
    steps = F.array(*[F.lit(1 << k) for k in range(30)])

    def step(acc: Column, d: Column) -> Column:
        # a null struct is padding; values themselves may be null
        shifted = F.slice(F.concat(F.array_repeat(F.get(F.slice(acc, 1, 0), F.lit(0)), d), acc), 1, F.size(acc))
        return F.zip_with(acc, shifted, lambda own, before: F.when(before.isNull(), own).otherwise(F.struct(combine(before["v"], own["v"]).alias("v"))))

    boxed = F.transform(values, lambda x: F.struct(x.alias("v")))
    return let(boxed, lambda b: F.transform(F.aggregate(F.filter(steps, lambda d: d < F.size(b)), b, step), lambda x: x["v"]))


def slices(values: Column, bounds: Column) -> Column:
    """array<array>: the parts of ``values`` at array<struct<at, n>>, ``at`` from 0."""
    return let(F.transform(values, lambda v: v), lambda vs: F.transform(bounds, lambda b: F.slice(vs, b["at"] + 1, b["n"])))
