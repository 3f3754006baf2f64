"""The data behind a map of one variable: means by position and colour limits."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cached_property
from typing import Any

from pyspark.sql import DataFrame

from profilelake.operators.aggregate import group_mean, quantile_limits
from profilelake.operators.filters import box, time_and_pressure, valid_values


@dataclass(frozen=True)
class MapData:
    """Selected rows, means by position, and quantile limits, worked out when asked for."""

    rows: DataFrame
    means: DataFrame
    find_limits: Callable[[], DataFrame]

    @cached_property
    def limits(self) -> DataFrame:
        return self.find_limits()


def map_data(
    levels: DataFrame,
    variable: str,
    lat_range: tuple[float, float],
    lon_range: tuple[float, float],
    time_range: tuple[Any, Any],
    pressure_range: tuple[float, float],
    q: Sequence[float] = (0.01, 0.99),
    approximate: bool = False,
) -> MapData:
    """Select by box, time, pressure and presence of a value; then average and rank.

    Five columns are read, whatever the width of the dataset.
    """
    narrow = levels.select(variable, "LATITUDE", "LONGITUDE", "PRES_ADJUSTED", "JULD")
    rows = valid_values(
        time_and_pressure(box(narrow, lat_range, lon_range), time_range, pressure_range), variable
    )
    return MapData(
        rows,
        group_mean(rows, variable),
        lambda: quantile_limits(rows, variable, q, approximate=approximate),
    )
