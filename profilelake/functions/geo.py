"""Longitudes on -180..180, with ranges that may cross the date line."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalize_longitude(longitude: Column | str) -> Column:
    """Bring 0..360 longitudes to -180..180."""
    longitude = F.col(longitude) if isinstance(longitude, str) else longitude
    return F.when(longitude > 180, longitude - 360).otherwise(longitude)


def longitude_bounds(lon_range: tuple[float, float] | list[float] | None) -> tuple[float, float]:
    """Bounds on -180..180; lower > upper means the range crosses the date line.

    A range of a full turn or more selects every longitude.
    """
    if lon_range is None:
        return (-180.0, 180.0)
    lower, upper = lon_range
    if upper - lower >= 360:
        return (-180.0, 180.0)
    lower, upper = (b - 360 if b > 180 else b for b in (lower, upper))
    return (float(lower), float(upper))


def between_longitudes(
    longitude: Column | str, lon_range: tuple[float, float] | list[float] | None
) -> Column:
    """Inclusive range test; both forms reach the Parquet scan."""
    longitude = F.col(longitude) if isinstance(longitude, str) else longitude
    lower, upper = longitude_bounds(lon_range)
    if lower <= upper:
        return longitude.between(lower, upper)
    return (longitude >= lower) | (longitude <= upper)
