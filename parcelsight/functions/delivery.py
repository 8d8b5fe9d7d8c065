"""Derived delivery facts. Unknown inputs always give an unknown result."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelsight.functions.scalars import col, elapsed_hours

# Fixed value: mean earth radius in kilometres.
EARTH_RADIUS_KM = 6371


def delay_days(delivered: str | Column, promised: str | Column) -> Column:
    """Whole days from the promised date to the delivery date (dates, not times)."""
    return F.date_diff(F.to_date(col(delivered)), F.to_date(col(promised)))


def is_late(delay: str | Column) -> Column:
    return col(delay) > 0


def stage_hours(start: str | Column, end: str | Column) -> Column:
    """Length of a stage in hours; a reversed pair is unknown, zero stays zero."""
    hours = elapsed_hours(start, end)
    return F.when(hours >= 0, hours)


def out_of_order(earlier: str | Column, later: str | Column) -> Column:
    """True when the later event carries the smaller timestamp."""
    return col(later) < col(earlier)


def missed_deadline(limit: str | Column, handed_over: str | Column) -> Column:
    return col(handed_over) > col(limit)


def great_circle_km(
    lat1: str | Column, lng1: str | Column, lat2: str | Column, lng2: str | Column
) -> Column:
    """Great-circle distance between two points given in degrees."""
    phi1, phi2 = F.radians(col(lat1)), F.radians(col(lat2))
    half_dlat = (phi2 - phi1) / 2
    half_dlng = (F.radians(col(lng2)) - F.radians(col(lng1))) / 2
    chord = F.pow(F.sin(half_dlat), 2) + F.cos(phi1) * F.cos(phi2) * F.pow(F.sin(half_dlng), 2)
    # Rounding can lift the chord of opposite points just above 1. The clamp sits
    # behind a NULL test because least() would skip an unknown chord.
    safe = F.when(chord.isNotNull(), F.least(chord, F.lit(1.0)))
    return F.lit(2.0 * EARTH_RADIUS_KM) * F.asin(F.sqrt(safe))
