"""Bring rows to a declared schema."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from profilelake import functions as PF

_FLOATING = (T.FloatType, T.DoubleType)


def available_columns(df: DataFrame, wanted: Iterable[str]) -> list[str]:
    """Wanted columns the rows have, in wanted order."""
    present = set(df.columns)
    return [c for c in wanted if c in present]


def _without_nan(name: str, source: T.DataType) -> Column:
    return PF.nan_to_null(name) if isinstance(source, _FLOATING) else F.col(name)


def conform(df: DataFrame, schema: T.StructType, on_error: str = "raise") -> DataFrame:
    """Every declared column, in order and type; absent ones null, extra ones dropped.

    NaN becomes null. A value that does not fit its type fails the run, or
    becomes null with ``on_error="null"``.
    """
    if on_error not in {"raise", "null"}:
        raise ValueError(f"on_error must be 'raise' or 'null', not {on_error!r}")
    present = {f.name: f.dataType for f in df.schema}

    def column(field: T.StructField) -> Column:
        source = present.get(field.name)
        if source is None:
            return F.lit(None).cast(field.dataType)
        value = _without_nan(field.name, source)
        if source == field.dataType:
            return value
        if on_error == "null":
            cast = value.try_cast(field.dataType)
        else:
            cast = value.cast(field.dataType)
        # Text may spell a NaN, which appears only once it is a number.
        text_to_float = isinstance(source, T.StringType) and isinstance(field.dataType, _FLOATING)
        return PF.nan_to_null(cast) if text_to_float else cast

    return df.select(*(column(f).alias(f.name) for f in schema))


def uncastable_files(
    df: DataFrame, schema: T.StructType, file_column: str = "source_file"
) -> DataFrame:
    """Files holding a value that does not fit its declared type, with the reason."""
    present = {f.name: f.dataType for f in df.schema}
    checks = []
    for field in schema:
        source = present.get(field.name)
        if source is not None and source != field.dataType:
            value = _without_nan(field.name, source)
            checks.append(
                F.when(
                    value.isNotNull() & value.try_cast(field.dataType).isNull(), F.lit(field.name)
                )
            )
    if not checks:
        return df.where(F.lit(False)).select(
            F.col(file_column), F.lit(None).cast("string").alias("error")
        )
    bad = F.coalesce(*checks)
    return (
        df.select(file_column, bad.alias("column"))
        .where(F.col("column").isNotNull())
        .groupBy(file_column)
        .agg(F.concat(F.lit("value does not fit column "), F.min("column")).alias("error"))
    )


def union_outer(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames, with the columns of any; absent values are null."""
    if not frames:
        raise ValueError("no frames to unite")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
