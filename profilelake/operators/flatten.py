"""From one row per profile to one row per level."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PROFILE_ARRAYS = {"PARAMETER", "PARAMETER_DATA_MODE"}


def measurement_arrays(staged: DataFrame) -> list[T.StructField]:
    return [
        f
        for f in staged.schema
        if isinstance(f.dataType, T.ArrayType) and f.name not in _PROFILE_ARRAYS
    ]


def longest_array(arrays: Iterable[T.StructField]) -> Column:
    """Length of a profile's longest array; 0 without one."""
    sizes = [F.coalesce(F.array_size(F.col(f.name)), F.lit(0)) for f in arrays]
    return F.greatest(F.lit(0), F.lit(0), *sizes)


def _has_value(field: T.StructField) -> Column:
    present = F.col(field.name).isNotNull()
    if isinstance(field.dataType.elementType, (T.FloatType, T.DoubleType)):
        return present & ~F.isnan(field.name)
    return present


def flatten_levels(
    staged: DataFrame, wanted: Iterable[str] | None = None, drop_padding: bool = False
) -> DataFrame:
    """One row per (file, profile, level), profile values repeated on every level.

    A file's levels are rectangular: each profile gives ``level_count`` rows,
    those past its own data holding nulls. No value is lost: a profile whose
    arrays are longer than ``level_count``, or that has none, gives as many rows
    as its longest kept array (``failed_checks`` names such files). ``drop_padding`` leaves out rows
    without any measurement. ``wanted`` names the columns to keep; absent ones
    are not an error.

    The arrays of a profile are zipped once and exploded, so that no array is
    copied to the rows of its levels and nothing is shuffled.
    """
    keep = None if wanted is None else {"source_file", "N_PROF", *wanted}
    arrays = [f for f in measurement_arrays(staged) if keep is None or f.name in keep]
    dropped = {f.name for f in measurement_arrays(staged)} | _PROFILE_ARRAYS | {"level_count"}
    scalars = [
        c for c in staged.columns if c not in dropped and (keep is None or c in keep)
    ]
    declared = F.coalesce(F.col("level_count").cast("long"), F.lit(0).cast("long"))
    rows = F.greatest(declared, longest_array(arrays).cast("long"))
    positions = F.sequence(F.lit(0).cast("long"), rows - 1)
    filled = [
        F.coalesce(F.col(f.name), F.array().cast(f.dataType)).alias(f.name) for f in arrays
    ]
    levels = (
        # sequence(0, -1) counts down, so files without levels go first.
        staged.where(rows > 0)
        .select(*scalars, positions.alias("N_LEVELS"), *filled)
        .select(*scalars, F.explode(F.arrays_zip("N_LEVELS", *(f.name for f in arrays))).alias("l"))
        .select(*scalars, F.col("l.N_LEVELS"), *(F.col(f"l.{f.name}") for f in arrays))
        .where(F.col("N_LEVELS").isNotNull())
    )
    if drop_padding and arrays:
        levels = levels.where(reduce(or_, (_has_value(f) for f in arrays)))
    return levels
