"""Parquet tables: staged profiles, level datasets, metadata.

A root folder holds one level dataset per flavour and the metadata beside
them: ``<root>/phy``, ``<root>/bgc``, ``<root>/metadata/{phy,bgc}``. Replacing
one leaves the others alone.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from profilelake import functions as PF
from profilelake.flavour import Flavour, flavour
from profilelake.operators.filters import Filters, filter_rows
from profilelake.schema import level_schema, metadata_schema, staged_schema
from profilelake.sources.stored import replace_folder

DEFAULT_FILE_BYTES = 300 * 1024 * 1024
LEAST_RANGE_BYTES = 256 * 1024
# Packed columns of a few numbers may become rows of forty times their size, which a task sorts.
SORTED_BYTES = 8 * 1024 * 1024
LEVELS_TOGETHER = 1024  # levels of a profile that stay in one file

# Appended to a clustering key, so that one hot key can still be split.
_ROW_IDENTITY = ("PLATFORM_NUMBER", "CYCLE_NUMBER", "N_PROF", "N_LEVELS")


def levels_path(root: str, db: str | Flavour) -> str:
    return f"{root.rstrip('/')}/{flavour(db).name}"


def metadata_path(root: str, db: str | Flavour) -> str:
    return f"{root.rstrip('/')}/metadata/{flavour(db).name}"


def read_staged(
    spark: SparkSession,
    path: str | list[str],
    db: str | Flavour,
    schema: T.StructType | None = None,
    format: str = "parquet",
) -> DataFrame:
    """Staged profiles already in Parquet or JSON."""
    paths = [path] if isinstance(path, str) else path
    return spark.read.schema(schema or staged_schema(db)).format(format).load(paths)


def read_levels(
    spark: SparkSession,
    path: str | list[str],
    db: str | Flavour,
    columns: Sequence[str] | None = None,
    filters: Filters | None = None,
    schema: T.StructType | None = None,
    nanosecond_time: bool = False,
) -> DataFrame:
    """Scan a level dataset with its declared schema.

    Only the named columns are decoded and the filters reach the Parquet
    scan; columns absent from a file are null. ``nanosecond_time`` is for
    datasets written elsewhere with nanosecond ``JULD``; Spark reads those only
    with ``spark.sql.legacy.parquet.nanosAsLong`` set to true.
    """
    schema = schema or level_schema(db)
    paths = [path] if isinstance(path, str) else path
    if nanosecond_time:
        if spark.conf.get("spark.sql.legacy.parquet.nanosAsLong") != "true":
            raise ValueError("nanosecond files need spark.sql.legacy.parquet.nanosAsLong=true")
        stored = T.StructType(
            [T.StructField(f.name, T.LongType()) if f.name == "JULD" else f for f in schema]
        )
        levels = spark.read.schema(stored).parquet(*paths)
        levels = levels.select(
            *(PF.nanoseconds_to_ntz(c).alias(c) if c == "JULD" else c for c in levels.columns)
        )
    else:
        levels = spark.read.schema(schema).parquet(*paths)
    if filters is not None:
        levels = filter_rows(levels, filters)
    return levels if columns is None else levels.select(*columns)


def read_metadata(
    spark: SparkSession,
    path: str | list[str],
    filters: Filters | None = None,
    db: str | Flavour | None = None,
) -> DataFrame:
    """Scan a metadata table, filtered at the read.

    With ``db`` the declared schema is used and no file is opened to plan the scan;
    without, the columns are those of the files.
    """
    paths = [path] if isinstance(path, str) else path
    reader = spark.read if db is None else spark.read.schema(metadata_schema(db))
    metadata = reader.parquet(*paths)
    return metadata if filters is None else filter_rows(metadata, filters)


def _input_bytes(rows: DataFrame) -> int | None:
    """Bytes of what the rows are made from, as the planner knows them; None if it does not."""
    leaves = rows._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(sizes) if sum(sizes) < 1 << 60 else None


def range_count(rows: DataFrame, file_bytes: int | None) -> int:
    """Ranges that give files near a size, from the bytes of the files that rows come from.

    Without a wanted size, a range holds ``SORTED_BYTES``, so that what a task sorts does
    not grow with the input; small inputs are cut into as many ranges as there are threads,
    of ``LEAST_RANGE_BYTES`` at least, so that no single task sorts and writes them all.
    Rows whose origin has no known size are counted, at eight bytes a value.
    """
    total = _input_bytes(rows)
    if total is None:
        total = 8 * len(rows.columns) * rows.count()
    wanted = max(1, math.ceil(total / (file_bytes or SORTED_BYTES)))
    if file_bytes is not None:
        return wanted
    threads = rows.sparkSession.sparkContext.defaultParallelism
    return max(wanted, min(threads, total // LEAST_RANGE_BYTES))


def _profile_parts(levels: DataFrame) -> list[Column]:
    """What tells profiles and long stretches of their levels apart; nothing if columns lack."""
    if not set(_ROW_IDENTITY) <= set(levels.columns):
        return []
    *profile, level = _ROW_IDENTITY
    return [*map(F.col, profile), F.floor(F.col(level) / LEVELS_TOGETHER)]


def write_levels(
    levels: DataFrame,
    root: str,
    db: str | Flavour,
    mode: str = "overwrite",
    target_file_bytes: int | None = None,
    max_records_per_file: int | None = None,
    cluster_by: Sequence[str] | None = None,
    ranges: int | None = None,
    clustered: bool = False,
) -> str:
    """Write a flavour's level dataset and return its path.

    A run replaces the dataset, and a failed run leaves the old one: rows are
    written beside it and take its place at the end. ``append`` adds a batch. By
    default each task writes its own file and nothing is shuffled, since Spark
    already packs and splits its input evenly. ``target_file_bytes`` (such as
    ``DEFAULT_FILE_BYTES``) deals rows evenly to as many files as the input's bytes
    ask for, by a hash of their profile: dealt in turn, they would be sorted first, and
    neighbours that pack well would part. ``cluster_by`` sorts the dataset by ranges of those columns, which
    lets later reads skip row groups; the number of ranges is ``ranges``, or
    follows from the input's bytes. ``clustered`` rows are in ranges already and
    are only sorted.
    """
    path = levels_path(root, db)
    if cluster_by:
        keys = [*cluster_by, *(c for c in _ROW_IDENTITY if c in levels.columns)]
        keys = list(dict.fromkeys(keys))
        if not clustered:
            number = ranges or range_count(levels, target_file_bytes)
            levels = levels.repartitionByRange(number, *keys)
        levels = levels.sortWithinPartitions(*keys)
    elif target_file_bytes is not None:
        number = ranges or range_count(levels, target_file_bytes)
        levels = levels.repartition(number, *_profile_parts(levels))
    replaced = mode == "overwrite"
    target = f"{path}-{uuid.uuid4().hex}" if replaced else path
    writer = levels.write.mode(mode)
    if max_records_per_file is not None:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.parquet(target)
    if replaced:
        replace_folder(levels.sparkSession, target, path)
    return path


def write_metadata(
    metadata: DataFrame, root: str, db: str | Flavour, mode: str = "overwrite"
) -> str | None:
    """Write the index subset beside the level data; an empty one is skipped."""
    if metadata.isEmpty():
        return None
    path = metadata_path(root, db)
    metadata.write.mode(mode).parquet(path)
    return path
