"""Whole runs: refresh planning, conversion, map data."""

from profilelake.plans.arriving import convert_arriving
from profilelake.plans.convert import Conversion, convert_files, convert_profiles
from profilelake.plans.mapdata import MapData, map_data
from profilelake.plans.mirror import MirrorPlan, plan_refresh
from profilelake.plans.run import DatabaseRun, convert_mirror

__all__ = [
    "Conversion",
    "DatabaseRun",
    "MapData",
    "MirrorPlan",
    "convert_arriving",
    "convert_files",
    "convert_mirror",
    "convert_profiles",
    "map_data",
    "plan_refresh",
]
