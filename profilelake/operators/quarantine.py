"""Files that fail their checks give no rows; they are listed instead."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from profilelake.operators.datamode import (
    CALIBRATION_ERROR,
    DATA_MODE_ERROR,
    calibration_varies,
    data_mode_too_long,
    with_mode_columns,
)
from profilelake.operators.flatten import longest_array, measurement_arrays
from profilelake.sources.stored import stored

LEVELS_ERROR = "level_count is missing or smaller than an array"


def failed_checks(staged: DataFrame, parameters: Sequence[str]) -> DataFrame:
    """Failing files with the reason, one row each.

    Names, modes and array lengths are looked at, and only failing profiles are
    shuffled. A file without number of levels, or with more values than levels,
    fails where ``staged`` has a ``level_count``.
    """
    failure = F.when(calibration_varies(), 1).when(data_mode_too_long(parameters), 2)
    if "level_count" in staged.columns:
        declared = F.col("level_count")
        failure = failure.when(declared.isNull() | (longest_array(measurement_arrays(staged)) > declared), 3)
    return (
        with_mode_columns(staged)
        .select("source_file", failure.alias("failure"))
        .where(F.col("failure").isNotNull())
        .groupBy("source_file")
        .agg(F.min("failure").alias("failure"))
        .select(
            "source_file",
            F.when(F.col("failure") == 1, CALIBRATION_ERROR)
            .when(F.col("failure") == 2, DATA_MODE_ERROR)
            .otherwise(LEVELS_ERROR)
            .alias("error"),
        )
    )


def without_files(staged: DataFrame, failed: DataFrame) -> DataFrame:
    """Rows of the files that are not listed.

    Give a stored list: Spark then broadcasts a short one, and joins a long
    one so that a file holding much of the data is split.
    """
    return staged.join(failed.select("source_file"), "source_file", "left_anti").select(
        *staged.columns
    )


def quarantine(staged: DataFrame, parameters: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows of sound files, and the list of failed files with reasons.

    The list is worked out and stored when this is called.
    """
    failed = stored(failed_checks(staged, parameters))
    return without_files(staged, failed), failed


def failure_rate(files: DataFrame) -> DataFrame:
    """Files, failed files and the percentage that failed.

    ``files`` has a ``source_file`` and an ``error``, null where all went
    well; a file may have any number of rows.
    """
    per_file = files.groupBy("source_file").agg(
        F.bool_or(F.col("error").isNotNull()).alias("failed")
    )
    failed = F.count_if("failed")
    rate = F.when(F.count("*") > 0, failed * 100 / F.count("*"))
    return per_file.agg(
        F.count("*").alias("files"),
        failed.alias("failed"),
        rate.alias("failed_percent"),
    )
