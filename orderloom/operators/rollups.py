"""Grouped sums. All of them combine on the map side before the shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.values import amount_parts, parts_total, rough_cents

_KIND = "::kind"


def _named(amount: str, part: str) -> str:
    return f"{amount}::{part}"


def with_parts(df: DataFrame, amounts: Sequence[str]) -> DataFrame:
    """Amounts split into parts, once per row, in place of the amounts."""
    numbers = df.withColumns({a: F.col(a).try_cast("double") for a in amounts})
    numbers = numbers.withColumns({_named(a, "rough"): rough_cents(F.col(a)) for a in amounts})
    split = {_named(a, part): column for a in amounts for part, column in amount_parts(
        F.col(a), F.col(f"`{_named(a, 'rough')}`")).items()}
    return numbers.withColumns(split).drop(*amounts, *[_named(a, "rough") for a in amounts])


def part_sums(amount: str, where: Column | None = None) -> dict[str, Column]:
    """Sums of an amount's parts; rows for which ``where`` does not hold count as 0."""
    cells = {part: F.col(f"`{_named(amount, part)}`") for part in ("cents", "parts")}
    return {part: F.sum(cell if where is None else F.when(where, cell).otherwise(0.0))
            for part, cell in cells.items()}


def sum_amounts(df: DataFrame, key: str, amounts: Mapping[str, str], *others: Column) -> DataFrame:
    """Per key the sum of each amount, named as its value says, after any other aggregates."""
    return with_parts(df, list(amounts)).groupBy(key).agg(
        *others, *[parts_total(**part_sums(a)).alias(name) for a, name in amounts.items()])


def pivot_sum(df: DataFrame, key: str, kind: str, amount: str,
              kinds: dict[str, str], total: str) -> DataFrame:
    """One amount column per kind (0 where absent) and a total over every kind."""
    # Texts are compared once per row, not once per sum.
    number = reduce(lambda found, i: found.when(F.col(kind) == list(kinds)[i], i),
                    range(1, len(kinds)), F.when(F.col(kind) == next(iter(kinds)), 0))
    parts = with_parts(df.select(key, number.otherwise(-1).alias(_KIND), amount), [amount])
    return parts.groupBy(key).agg(
        *[parts_total(**part_sums(amount, F.col(f"`{_KIND}`") == i)).alias(name)
          for i, name in enumerate(kinds.values())],
        parts_total(**part_sums(amount)).alias(total),
    )
