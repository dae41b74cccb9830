"""What the cells of a column say about its type, as counts that add up.

The counts of files, or of any parts of a table, are summed; the sum decides as a pass over all
of them would. So what a file says is kept, and its text is not read again to decide anew.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Row

from ..functions.values import TYPE_ORDER

DATE_TEXT = "date_text"


@dataclass(frozen=True)
class Evidence:
    """How many values there are, and how many of them fit each type that was tested."""

    n_values: int = 0
    fits: Mapping[str, int] = field(default_factory=dict)

    @classmethod
    def of(cls, counts: Row, column: str) -> "Evidence":
        """From one row of `type_counts` or `date_counts`; a row without the column says nothing."""
        if f"{column}::n_values" not in counts:
            return cls()
        return cls(counts[f"{column}::n_values"], {
            t: counts[f"{column}::{t}"] for t in (*TYPE_ORDER, DATE_TEXT)
            if f"{column}::{t}" in counts})

    def __add__(self, other: "Evidence") -> "Evidence":
        return Evidence(self.n_values + other.n_values, {
            t: self.fits.get(t, 0) + other.fits.get(t, 0) for t in {*self.fits, *other.fits}})

    def fitting(self) -> list[str]:
        """Types that every value fits, narrowest first; none without values. A type that some
        values were not tested for falls short of their number."""
        return [t for t in (*TYPE_ORDER, DATE_TEXT)
                if self.n_values and self.fits.get(t) == self.n_values]

    def narrowest(self, empty: str) -> str:
        """The narrowest type that every value fits, text if none, ``empty`` without values."""
        return (self.fitting() or ["string"])[0] if self.n_values else empty
