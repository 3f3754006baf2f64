"""Row filters, and the list notation for them."""

from __future__ import annotations

import math
import numbers
from collections.abc import Iterable, Sequence
from datetime import datetime
from functools import reduce
from operator import and_, or_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from profilelake import functions as PF

_FLOATING = (T.FloatType, T.DoubleType)

Predicate = tuple[str, str, Any]
Filters = Sequence[Predicate] | Sequence[Sequence[Predicate]]


def _is_nan(value: Any) -> bool:
    return isinstance(value, float) and math.isnan(value)


_INTEGER_BITS = {"tinyint": 8, "smallint": 16, "int": 32, "bigint": 64}


def _fits(value: Any, kind: T.DataType) -> bool:
    """Whether a column of this type can hold the value at all."""
    bits = _INTEGER_BITS.get(kind.simpleString())
    if bits is None or isinstance(value, (bool, str)):
        return True
    if not isinstance(value, numbers.Number) or not math.isfinite(value):
        return False
    return value == int(value) and -(2 ** (bits - 1)) <= value < 2 ** (bits - 1)


def _typed(value: Any, kind: T.DataType) -> Column:
    """A listed value in the column's own type: 0.1 is then found in a float column."""
    if isinstance(kind, T.TimestampNTZType) and isinstance(value, datetime):
        value = value.isoformat(sep=" ")
    return F.lit(value).cast(kind)


def _membership(column: Column, values: Iterable[Any], kind: T.DataType, inside: bool) -> Column:
    """``in`` or ``not in``, as comparisons that a Parquet scan can apply.

    Null and NaN belong to the list only when they are listed.
    """
    listed = [values] if isinstance(values, str) else list(values)
    listed = [v.item() if hasattr(v, "item") else v for v in listed]
    plain = [v for v in listed if v is not None and not _is_nan(v) and _fits(v, kind)]
    null = any(v is None for v in listed)
    nan = isinstance(kind, _FLOATING) and any(_is_nan(v) for v in listed)
    found = column.isin([_typed(v, kind) for v in plain]) if plain else None
    if inside:
        parts = [] if found is None else [found]
        parts += [column.isNull()] * null + [F.isnan(column)] * nan
        return reduce(or_, parts) if parts else F.lit(False)
    if found is None:
        kept = column.isNotNull() if null else F.lit(True)
    else:
        kept = column.isNotNull() & ~found if null else column.isNull() | ~found
    return kept & ~F.isnan(column) if nan else kept


def _predicate(schema: T.StructType, name: str, op: str, value: Any) -> Column:
    column = F.col(name)
    kind = schema[name].dataType
    floating = isinstance(kind, _FLOATING)
    if op in {"in", "not in"}:
        return _membership(column, value, kind, op == "in")
    if op == "!=":
        return column.isNotNull() if _is_nan(value) else column != F.lit(value)
    if op not in {"=", "==", "<", "<=", ">", ">="}:
        raise ValueError(f"unknown operator {op!r} in filter on {name!r}")
    if _is_nan(value):
        return F.lit(False)
    literal = F.lit(value)
    if op in {"=", "=="}:
        return column == literal
    if op == "<":
        return column < literal
    if op == "<=":
        return column <= literal
    above = column > literal if op == ">" else column >= literal
    # Spark ranks NaN above every number; here it is never in range. A comparison says so
    # in a form that reaches the scan, which isnan does not.
    return above & (column <= F.lit(math.inf).cast(kind)) if floating else above


def filter_condition(schema: T.StructType, filters: Filters) -> Column:
    """One condition from ``[(column, op, value), …]`` or ``[[…], …]``.

    A flat list holds when all its predicates do, a list of lists when any of
    its inner lists does. Operators: ``= == != < <= > >= in`` and ``not in``.
    A null operand drops the row, except that ``not in`` keeps nulls unless
    null is listed and ``in`` keeps them if it is.
    """
    if not filters:
        raise ValueError("empty filter list")
    groups = [filters] if isinstance(filters[0], tuple) else filters
    if not all(groups):
        raise ValueError("empty group in filter list")
    return reduce(or_, (reduce(and_, (_predicate(schema, *p) for p in g)) for g in groups))


def filter_rows(df: DataFrame, filters: Filters) -> DataFrame:
    return df.where(filter_condition(df.schema, filters))


def box(
    df: DataFrame, lat_range: tuple[float, float], lon_range: tuple[float, float]
) -> DataFrame:
    """Rows strictly inside a geographic box."""
    return filter_rows(
        df,
        [
            ("LATITUDE", ">", lat_range[0]), ("LATITUDE", "<", lat_range[1]),
            ("LONGITUDE", ">", lon_range[0]), ("LONGITUDE", "<", lon_range[1]),
        ],
    )


def time_and_pressure(
    df: DataFrame,
    time_range: tuple[Any, Any],
    pressure_range: tuple[float, float],
    pressure: str = "PRES_ADJUSTED",
) -> DataFrame:
    """Rows in a closed time range and a closed pressure band."""
    return filter_rows(
        df,
        [
            ("JULD", ">=", time_range[0]), ("JULD", "<=", time_range[1]),
            (pressure, ">=", pressure_range[0]), (pressure, "<=", pressure_range[1]),
        ],
    )


def valid_values(df: DataFrame, *columns: str) -> DataFrame:
    """Rows where every named column has a finite value."""
    return df.where(reduce(and_, (PF.is_valid(c) for c in columns)))


def quality(df: DataFrame, variable: str, flags: Sequence[int] = (1,)) -> DataFrame:
    """Rows whose quality flag for the variable is one of the given ones."""
    return df.where(F.col(f"{variable}_QC").isin(list(flags)))
