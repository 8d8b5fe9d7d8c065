"""Ordered value bands: label and sort position come from the same spec."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelsight.functions.scalars import col


@dataclass(frozen=True)
class Bands:
    """Upper bounds with labels, lowest first; ``rest`` takes everything above."""

    uppers: tuple[tuple[float, str], ...]
    rest: str
    inclusive: bool = False

    def _pick(self, value: str | Column, results: list) -> Column:
        value = col(value)
        picked = F.when(value.isNull(), F.lit(None))
        for (upper, _), result in zip(self.uppers, results):
            inside = value <= upper if self.inclusive else value < upper
            picked = picked.when(inside, F.lit(result))
        return picked.otherwise(F.lit(results[-1]))

    def label(self, value: str | Column) -> Column:
        """Band name; unknown for an unknown value."""
        return self._pick(value, [name for _, name in self.uppers] + [self.rest])

    def position(self, value: str | Column) -> Column:
        """1 for the lowest band; unknown for an unknown value."""
        return self._pick(value, list(range(1, len(self.uppers) + 2)))


# Band limits and labels.
DISTANCE_BANDS = Bands(
    (
        (100, "under 100 km"),
        (300, "100-300 km"),
        (700, "300-700 km"),
        (1500, "700-1500 km"),
    ),
    "over 1500 km",
)
DELAY_BANDS = Bands(
    (
        (0, "on time or early"),
        (3, "1-3 days late"),
        (7, "4-7 days late"),
        (14, "8-14 days late"),
    ),
    "15+ days late",
    inclusive=True,
)
