"""Declared schemas: level tables by name rules, index and staged tables, persistence."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from profilelake.flavour import DATA_MODE_SUFFIX, Flavour, flavour

_LONGS = {"PLATFORM_NUMBER", "N_PROF", "N_LEVELS", "CYCLE_NUMBER"}
_POSITIONS = {"LATITUDE", "LONGITUDE"}


def column_type(name: str) -> T.DataType:
    """Type of a level-table column; the first rule that fits its name wins.

    Quality flags are unsigned bytes in files written elsewhere. Spark has no
    unsigned byte, so they are shorts here.
    """
    if name in _LONGS:
        return T.LongType()
    if "_QC" in name:
        return T.ShortType()
    if name in _POSITIONS:
        return T.DoubleType()
    if name == "JULD":
        return T.TimestampNTZType()
    if name == "DIRECTION" or "DATA_MODE" in name:
        return T.StringType()
    return T.FloatType()


def schema_of(columns: Iterable[str]) -> T.StructType:
    return T.StructType([T.StructField(c, column_type(c), True) for c in columns])


def level_schema(db: str | Flavour) -> T.StructType:
    """Declared schema of a flavour's level table."""
    return schema_of(flavour(db).columns)


def is_level_column(name: str) -> bool:
    """Whether a column varies along a profile, rather than once per profile."""
    fixed = name in _LONGS | _POSITIONS or name in {
        "JULD", "JULD_QC", "POSITION_QC", "DIRECTION", "DATA_MODE",
    }
    return not fixed and not name.endswith(DATA_MODE_SUFFIX)


def staged_schema(db: str | Flavour, parameters: Iterable[str] | None = None) -> T.StructType:
    """Schema of the staged table: one row per (file, profile), one array per measurement.

    ``parameters`` keeps only the measurements of those base parameters.
    ``level_count`` is the file-wide number of levels.
    """
    kinds = ("", "_QC", "_dPRES", "_ADJUSTED", "_ADJUSTED_QC", "_ADJUSTED_ERROR")
    wanted = None if parameters is None else {p + k for p in parameters for k in kinds}
    fields = [
        T.StructField("source_file", T.StringType()),
        T.StructField("N_PROF", T.LongType()),
        T.StructField("level_count", T.IntegerType()),
    ]
    for c in flavour(db).columns:
        if c in {"N_PROF", "N_LEVELS"} or c.endswith(DATA_MODE_SUFFIX):
            continue
        if not is_level_column(c):
            fields.append(T.StructField(c, column_type(c)))
        elif wanted is None or c in wanted:
            fields.append(T.StructField(c, T.ArrayType(column_type(c))))
    fields += [
        T.StructField("PARAMETER", T.ArrayType(T.ArrayType(T.StringType()))),
        T.StructField("PARAMETER_DATA_MODE", T.ArrayType(T.StringType())),
    ]
    return T.StructType(fields)


def index_schema(db: str | Flavour) -> T.StructType:
    """Declared columns of a profile index file, dates still as text."""
    sensors = ("parameters", "parameter_data_mode") if flavour(db).has_sensor_list else ()
    names = (
        "file", "date", "latitude", "longitude",
        "ocean", "profiler_type", "institution", *sensors, "date_update",
    )
    doubles = {"latitude", "longitude"}
    return T.StructType(
        [T.StructField(n, T.DoubleType() if n in doubles else T.StringType()) for n in names]
    )


def metadata_schema(db: str | Flavour) -> T.StructType:
    """Schema of the metadata table: the index with dates, and the parts of the path."""
    dates = {"date", "date_update"}
    fields = [
        T.StructField(f.name, T.TimestampNTZType() if f.name in dates else f.dataType)
        for f in index_schema(db)
    ]
    parts = {"wmoid": T.IntegerType(), "filepath_main": T.StringType(), "filepath": T.StringType(),
             "filename": T.StringType(), "cycle": T.IntegerType()}
    return T.StructType([*fields, *(T.StructField(n, t) for n, t in parts.items())])


# Types that hold every value of another, the narrowest first.
_WIDER = {
    "tinyint": ("smallint", "int", "bigint", "float", "double"),
    "smallint": ("int", "bigint", "float", "double"),
    "int": ("bigint", "double"),
    "float": ("double",),
}
_TYPES = {
    "smallint": T.ShortType(), "int": T.IntegerType(), "bigint": T.LongType(),
    "float": T.FloatType(), "double": T.DoubleType(),
}


class SchemaConflict(ValueError):
    """Two schemas that no schema can hold without changing values."""


def wider_type(name: str, one: T.DataType, other: T.DataType) -> T.DataType:
    """The narrowest type that holds the values of both without loss."""
    a, b = one.simpleString(), other.simpleString()
    if a == b:
        return one
    fits_a, fits_b = (a, *_WIDER.get(a, ())), (b, *_WIDER.get(b, ()))
    both = [t for t in fits_a if t in fits_b]
    if not both:
        raise SchemaConflict(f"{name} is {a} in one schema and {b} in the other")
    return {a: one, b: other}.get(both[0]) or _TYPES[both[0]]


def widened(old: T.StructType, new: T.StructType) -> T.StructType:
    """A schema for rows of both: types widened, columns of the new one added at the end.

    Numbers may become wider (short to int, float to double); a column may be missing on
    either side. Anything else raises ``SchemaConflict``.
    """
    known = {f.name: f for f in new}
    fields = []
    for f in old:
        other = known.pop(f.name, None)
        kind = f.dataType if other is None else wider_type(f.name, f.dataType, other.dataType)
        fields.append(T.StructField(f.name, kind))
    return T.StructType([*fields, *(T.StructField(f.name, f.dataType) for f in known.values())])


def column_names(table: DataFrame | T.StructType) -> list[str]:
    """Column names in code-point order."""
    names = table.columns if isinstance(table, DataFrame) else table.fieldNames()
    return sorted(names)


def save_schema(spark: SparkSession, schema: T.StructType | None, path: str) -> None:
    """Keep a schema outside the data, as its JSON text."""
    if schema is None:
        raise ValueError("no schema to save: generate it first")
    spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.mode(
        "overwrite"
    ).text(path)


def load_schema(spark: SparkSession, path: str) -> T.StructType:
    text = spark.read.text(path, wholetext=True).first().value
    return T.StructType.fromJson(json.loads(text))
