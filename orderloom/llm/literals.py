"""Arrays of numbers as constants in a plan, of models whose size is a parameter."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, functions as F


def doubles(values: Iterable[float]) -> Column:
    """One constant, folded once by the optimizer; not one expression per number."""
    text = ",".join(f"{v:.6g}" for v in values)
    return F.split(F.lit(text), ",").cast("array<double>")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), 0)
