"""Subsets of a profile index, and the floats they leave."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from profilelake import functions as PF
from profilelake.flavour import Flavour, flavour

EARLIEST = datetime(1900, 1, 1)
LATEST = datetime(2200, 1, 1)


def subset_area(
    index: DataFrame,
    lat_range: Sequence[float] | None = None,
    lon_range: Sequence[float] | None = None,
) -> DataFrame:
    """Profiles in an inclusive box, which may cross the date line.

    Profiles without position are dropped, with the default ranges too.
    """
    south, north = (-90.0, 90.0) if lat_range is None else lat_range
    return index.where(
        F.col("latitude").between(south, north) & PF.between_longitudes("longitude", lon_range)
    )


def subset_dates(
    index: DataFrame, start: datetime | None = None, end: datetime | None = None
) -> DataFrame:
    """Profiles in an inclusive date range; undated ones are dropped."""
    return index.where(F.col("date").between(F.lit(start or EARLIEST).cast("timestamp_ntz"),
                                             F.lit(end or LATEST).cast("timestamp_ntz")))


def subset_floats(
    index: DataFrame, floats: int | str | Iterable[int | str] | DataFrame
) -> DataFrame:
    """Profiles of the given floats: one id, a list, or a table with a ``wmoid`` column.

    Ids may be numbers of any kind or their text. A list of any length becomes part
    of the query; a table is joined, and broadcast by its size.
    """
    if not isinstance(floats, DataFrame):
        single = isinstance(floats, str) or not isinstance(floats, Iterable)
        ids = {int(i) for i in ([floats] if single else floats)}
        return index.where(F.col("wmoid").isin(sorted(ids)))
    return index.join(floats.select("wmoid"), "wmoid", "left_semi").select(*index.columns)


def subset_sensors(
    index: DataFrame, sensors: str | Sequence[str], exact: bool = False
) -> DataFrame:
    """Profiles that carry every given sensor.

    A sensor is a pattern found anywhere in the list, so ``CHLA`` also finds
    ``CHLA_FLUORESCENCE``; ``exact`` asks for whole names.
    """
    for sensor in [sensors] if isinstance(sensors, str) else sensors:
        carried = F.col("parameters")
        if exact:
            index = index.where(F.array_contains(F.split(carried, r"\s+"), sensor))
        else:
            index = index.where(carried.rlike(sensor))
    return index


def subset_index(
    index: DataFrame,
    db: str | Flavour,
    lat_range: Sequence[float] | None = None,
    lon_range: Sequence[float] | None = None,
    start: datetime | None = None,
    end: datetime | None = None,
    floats: int | Sequence[int] | DataFrame | None = None,
    sensors: str | Sequence[str] | None = None,
    exact_sensors: bool = False,
) -> DataFrame:
    """All index subsets together; area and dates always apply."""
    if sensors is not None and not flavour(db).has_sensor_list:
        raise ValueError("sensors can only be asked of the biogeochemical index")
    kept = subset_dates(subset_area(index, lat_range, lon_range), start, end)
    if floats is not None:
        kept = subset_floats(kept, floats)
    if sensors is not None:
        kept = subset_sensors(kept, sensors, exact_sensors)
    return kept


def float_list(index: DataFrame, order_by: str | None = None) -> DataFrame:
    """Distinct float directories in path order, each with its float id.

    A float that changes data centre has two directories and so appears twice.
    ``order_by`` names the column whose smallest row gives the id; without it
    the smallest id of the directory is taken.
    """
    first = F.min("wmoid") if order_by is None else F.min_by("wmoid", order_by)
    return (
        index.where(F.col("filepath_main").isNotNull())
        .groupBy("filepath_main")
        .agg(first.alias("wmoid"))
        .orderBy("filepath_main")
    )
