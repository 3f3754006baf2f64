"""Column expressions used by the operators; all stay inside Spark SQL."""

from profilelake.functions.geo import between_longitudes, longitude_bounds, normalize_longitude
from profilelake.functions.paths import (
    PROFILE_PATH_PATTERN,
    cycle,
    filename,
    filepath,
    filepath_main,
    float_filename,
    path_tail,
    profile_path,
    wmoid,
)
from profilelake.functions.times import compact_timestamp, nanoseconds_to_ntz, utc_ntz, year_month
from profilelake.functions.values import is_valid, nan_to_null, strip

__all__ = [
    "PROFILE_PATH_PATTERN",
    "between_longitudes",
    "compact_timestamp",
    "cycle",
    "filename",
    "filepath",
    "filepath_main",
    "float_filename",
    "is_valid",
    "longitude_bounds",
    "nan_to_null",
    "nanoseconds_to_ntz",
    "normalize_longitude",
    "path_tail",
    "profile_path",
    "strip",
    "utc_ntz",
    "wmoid",
    "year_month",
]
