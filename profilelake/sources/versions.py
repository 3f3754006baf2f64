"""Level datasets that are read through a list of their files.

``<root>/<db>-versions/`` holds ``data/<batch>/``, the files of each batch, and
``lists/<number>/``, one small Parquet table per version: the files that belong to it,
the batch of each, the schema it was written with, its rows and bytes, and the least and
largest value of some columns.
A version is there once Spark has written the list's ``_SUCCESS``; until then readers
use the one before, so they never see half a batch, and nothing that a reader may be
using is moved or deleted. A batch has an id: adding one that is there changes nothing,
so a run may simply be repeated.

Rows of a batch are clustered along a space-filling curve over position and time, so a
file covers a small part of each, and a read with filters on these columns opens only
the files whose ranges fit. Files are judged by a query over the list; only the names
of those that fit come to the driver, which Spark needs for any scan.

Batches may differ in schema as far as no value changes: columns may be added, numbers
may become wider. Files are read with the schema of their own batch and brought to the
version's; a batch that does not fit is refused before anything is written.

Cases: a batch without rows is noted in the list and adds no file; columns without a
value in a file have null ranges, and a comparison with them keeps no row, so the file
is skipped; columns without ranges, and filters that ranges say nothing about, skip
nothing; equal rows in two batches are both kept. Two writers at once: the one that
finds the next number taken fails and may be repeated.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from profilelake.flavour import Flavour, flavour
from profilelake.functions.curve import cell, interleaved
from profilelake.operators.filters import Filters, filter_rows
from profilelake.schema import widened
from profilelake.sources.tables import range_count

CURVE = ("LATITUDE", "LONGITUDE", "JULD")
RANGED = ("LATITUDE", "LONGITUDE", "JULD", "PRES", "PRES_ADJUSTED", "PLATFORM_NUMBER")
_NUMBER = re.compile(r"\d{10}$")


class VersionConflict(RuntimeError):
    """Another writer has taken the next version."""


def versions_path(root: str, db: str | Flavour) -> str:
    return f"{root.rstrip('/')}/{flavour(db).name}-versions"


def _system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _numbers(spark: SparkSession, root: str, db: str | Flavour) -> tuple[list[int], int]:
    """(complete versions, the largest number that was ever begun)."""
    system, where = _system(spark, f"{versions_path(root, db)}/lists")
    if not system.exists(where):
        return [], 0
    begun = [s.getPath() for s in system.listStatus(where) if _NUMBER.match(s.getPath().getName())]
    done = [p for p in begun if system.exists(_system(spark, f"{p}/_SUCCESS")[1])]
    return sorted(int(p.getName()) for p in done), max((int(p.getName()) for p in begun), default=0)


def versions(spark: SparkSession, root: str, db: str | Flavour) -> list[int]:
    """The numbers of the complete versions, oldest first."""
    return _numbers(spark, root, db)[0]


def _list_path(root: str, db: str | Flavour, number: int) -> str:
    return f"{versions_path(root, db)}/lists/{number:010d}"


def file_list(spark: SparkSession, root: str, db: str | Flavour, version: int | None = None) -> DataFrame:
    """The files of a version, the newest one by default."""
    known = versions(spark, root, db)
    number = version if version is not None else (known[-1] if known else None)
    if number not in known:
        raise FileNotFoundError(f"no version {number} under {versions_path(root, db)}")
    return spark.read.parquet(_list_path(root, db, number))


def along_curve(levels: DataFrame, by: Sequence[str], ranges: int) -> DataFrame:
    """The rows dealt into ranges of a curve over columns, and sorted along it.

    The curve spans the columns' values in these rows. Rows of one place are told apart
    by a hash of the row, so a hot place is still split.
    """
    seconds = {f.name for f in levels.schema if isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType))}

    def number(name: str) -> Column:
        column = F.col(name)
        return column.cast("timestamp").cast("double") if name in seconds else column.cast("double")

    spans = levels.agg(*(f(F.nanvl(number(c), F.lit(None))).alias(f"{f.__name__}{i}") for i, c in enumerate(by) for f in (F.min, F.max))).first()
    cells = [cell(number(c), spans[f"min{i}"] or 0.0, spans[f"max{i}"] or 0.0) for i, c in enumerate(by)]
    keyed = levels.withColumn("_curve", interleaved(cells)).withColumn("_row", F.xxhash64(*levels.columns))
    dealt = keyed.repartitionByRange(ranges, "_curve", "_row").sortWithinPartitions("_curve")
    return dealt.drop("_curve", "_row")


def _described(spark: SparkSession, folder: str, schema: T.StructType, batch: str) -> DataFrame:
    """One row per file of a batch: its rows, bytes and ranges."""
    ranged = [c for c in RANGED if c in schema.names]
    figures = [f(c).alias(f"{n}_{c}") for c in ranged for n, f in (("min", F.min), ("max", F.max))]
    files = (
        spark.read.schema(schema)
        .parquet(folder)
        .groupBy(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes"))
        .agg(F.count(F.lit(1)).alias("rows"), *figures)
    )
    return files.select(F.lit(batch).alias("batch"), F.lit(schema.json()).alias("schema"), "*")


def schemas(files: DataFrame) -> list[T.StructType]:
    """The schemas that a list's batches were written with, a few whatever their number."""
    first = files.groupBy("schema").agg(F.min("batch").alias("batch")).orderBy("batch", "schema")
    return [T.StructType.fromJson(json.loads(r["schema"])) for r in first.collect()]


def version_schema(files: DataFrame) -> T.StructType:
    """The schema that holds the rows of all batches of a list."""
    return reduce(widened, schemas(files))


def _commit(listed: DataFrame, root: str, db: str | Flavour, number: int) -> int:
    path = _list_path(root, db, number)
    try:
        listed.coalesce(1).write.mode("errorifexists").parquet(path)
    except Exception as e:
        if "PATH_ALREADY_EXISTS" in str(e):
            raise VersionConflict(f"version {number} has been taken by another writer") from e
        raise
    return number


def add_batch(
    levels: DataFrame,
    root: str,
    db: str | Flavour,
    batch: str,
    replace: bool = False,
    curve: Sequence[str] = CURVE,
    target_file_bytes: int | None = None,
    ranges: int | None = None,
) -> int:
    """Add a batch of level rows and return the version that holds it.

    A batch that the newest version holds is not written again. ``replace`` makes a
    version of this batch alone; older versions stay readable.
    """
    spark = levels.sparkSession
    known, largest = _numbers(spark, root, db)
    before = spark.read.parquet(_list_path(root, db, known[-1])) if known else None
    if before is not None and not before.filter(F.col("batch") == batch).isEmpty():
        if not replace or before.filter(F.col("batch") != batch).isEmpty():
            return known[-1]
    # Columns may all be null, whatever the rows at hand.
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in levels.schema])
    if before is not None and not replace:
        widened(version_schema(before), schema)
    folder = f"{versions_path(root, db)}/data/{uuid.uuid4().hex}"
    by = [c for c in curve if c in levels.columns]
    if by:
        levels = along_curve(levels, by, ranges or range_count(levels, target_file_bytes))
    levels.write.parquet(folder)
    described = _described(spark, folder, schema, batch)
    # An empty batch has no file, but it has been added.
    mark = spark.createDataFrame([(batch, schema.json())], "batch string, schema string")
    listed = described.unionByName(mark, allowMissingColumns=True)
    if before is not None and not replace:
        listed = before.unionByName(listed, allowMissingColumns=True)
    return _commit(listed, root, db, max([largest, *known]) + 1)


def _may_hold(fields: set[str], name: str, op: str, value) -> Column | None:
    """Whether a file can hold a row that meets a predicate; None if ranges say nothing."""
    if f"min_{name}" not in fields:
        return None
    low, high = F.col(f"min_{name}"), F.col(f"max_{name}")
    if op == "in":
        values = [value] if isinstance(value, str) else list(value)
        plain = [v for v in values if v is not None and v == v]
        if len(plain) < len(values) or not plain:
            return None
        return (low <= F.lit(max(plain))) & (high >= F.lit(min(plain)))
    if op not in {"=", "==", "<", "<=", ">", ">="} or value is None or value != value:
        return None
    literal = F.lit(value)
    if op in {"<", "<="}:
        return low < literal if op == "<" else low <= literal
    if op in {">", ">="}:
        return high > literal if op == ">" else high >= literal
    return (low <= literal) & (high >= literal)


def fitting_files(files: DataFrame, filters: Filters | None) -> DataFrame:
    """The files of a list that can hold rows which meet the filters."""
    held = files.filter("path IS NOT NULL")
    if not filters:
        return held
    fields = set(files.columns)
    groups = [filters] if isinstance(filters[0], tuple) else filters
    kept = []
    for group in groups:
        parts = [p for p in (_may_hold(fields, *predicate) for predicate in group) if p is not None]
        kept.append(reduce(and_, parts) if parts else F.lit(True))
    return held.filter(reduce(or_, kept))


def read_version(
    spark: SparkSession,
    root: str,
    db: str | Flavour,
    columns: Sequence[str] | None = None,
    filters: Filters | None = None,
    version: int | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """The rows of a version, from the files that can hold rows the filters keep.

    ``schema`` asks for other columns or types than the version's own.
    """
    files = file_list(spark, root, db, version)
    schema = schema or version_schema(files)
    paths: dict[str, list[str]] = {}
    for r in fitting_files(files, filters).select("schema", "path").toLocalIterator():
        paths.setdefault(r.schema, []).append(r.path)
    levels = spark.createDataFrame([], schema)
    for text, group in paths.items():
        stored = spark.read.schema(T.StructType.fromJson(json.loads(text))).parquet(*group)
        present = set(stored.columns)
        columns_ = [(F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]
        levels = stored.select(*columns_) if len(paths) == 1 else levels.unionAll(stored.select(*columns_))
    if filters:
        levels = filter_rows(levels, filters)
    return levels if columns is None else levels.select(*columns)


def remove_unlisted(spark: SparkSession, root: str, db: str | Flavour, keep: int = 2) -> int:
    """Delete lists older than the last ``keep`` versions, and batches in none of those kept.

    Call it when no writer is at work. Returns the number of batch folders deleted.
    """
    known = versions(spark, root, db)
    base = versions_path(root, db)
    if not known:
        return 0
    lists = [spark.read.parquet(_list_path(root, db, n)).select("path") for n in known[-keep:]]
    listed = reduce(DataFrame.unionAll, lists).filter("path IS NOT NULL")
    folders = listed.select(F.element_at(F.split("path", "/"), -2).alias("f")).distinct()
    used = {r.f for r in folders.toLocalIterator()}
    for number in known[:-keep]:
        system, where = _system(spark, _list_path(root, db, number))
        system.delete(where, True)
    system, where = _system(spark, f"{base}/data")
    gone = [s.getPath() for s in system.listStatus(where) if s.getPath().getName() not in used]
    for path in gone:
        system.delete(path, True)
    return len(gone)
