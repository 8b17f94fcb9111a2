"""Idioms of Column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it any number of times in ``body``, lambdas included."""
    return F.element_at(F.transform(F.array(value), body), 1)


def total(values: Column) -> Column:
    """Sum of an array of doubles."""
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def middle(values: Column) -> Column:
    """Median of an array, the mean of the two in the middle; null of none."""
    halves = lambda v: (F.get(v, F.floor((F.size(v) - 1) / 2).cast("int")) + F.get(v, F.floor(F.size(v) / 2).cast("int"))) / 2
    return let(F.array_sort(values), halves)
