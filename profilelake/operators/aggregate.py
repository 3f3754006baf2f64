"""Means by group, quantile limits, first rows."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from profilelake import functions as PF

_FLOATING = (T.FloatType, T.DoubleType)


def _number(df: DataFrame, name: str) -> Column:
    return PF.nan_to_null(name) if isinstance(df.schema[name].dataType, _FLOATING) else F.col(name)


def group_mean(
    df: DataFrame, values: str | Sequence[str], by: Sequence[str] = ("LATITUDE", "LONGITUDE")
) -> DataFrame:
    """Mean of each value per exact key; absent keys are dropped, absent values skipped."""
    names = [values] if isinstance(values, str) else list(values)
    keyed = df.select(*(_number(df, c).alias(c) for c in dict.fromkeys([*by, *names])))
    return (
        keyed.dropna(subset=list(by))
        .groupBy(*by)
        .agg(*(F.avg(c).alias(c) for c in names))
    )


def first_rows(df: DataFrame, n: int = 5, order_by: Sequence[str] = ()) -> DataFrame:
    """The first rows, in any order unless one is given."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def quantile_limits(
    df: DataFrame,
    column: str,
    q: Sequence[float] = (0.01, 0.99),
    names: Sequence[str] = ("lower", "upper"),
    approximate: bool = False,
    accuracy: int = 10000,
    rows_per_range: int = 1_000_000,
) -> DataFrame:
    """One row of quantiles, interpolated between neighbours, over all rows.

    ``approximate`` takes one pass and returns values near the quantiles that
    occur in the data, with a rank error of ``1/accuracy``. The exact form
    counts rows per bin of values and goes on with only the bins that hold a
    wanted rank: a bin of more than ``rows_per_range`` rows is split and
    counted again, the others have their distinct values counted. No task
    holds more than the bins of one pass or ``rows_per_range`` values, and the
    driver sees at most two bins per quantile. The passes that find the bins
    run when this is called.
    """
    if len(q) != len(names):
        raise ValueError("one name is needed per quantile")
    if not all(0 <= x <= 1 for x in q):
        raise ValueError(f"quantiles must lie between 0 and 1: {list(q)}")
    kind = df.schema[column].dataType
    value = F.col(column) if isinstance(kind, _FLOATING) else F.col(column).cast("double")
    present = df.where(value.isNotNull() & ~F.isnan(value)).select(value.alias("v"))
    v = F.col("v")
    if approximate:
        found = F.percentile_approx(v.cast("double"), [float(x) for x in q], accuracy)
        return present.agg(found.alias("_f")).select(
            *(F.get("_f", F.lit(i)).alias(n) for i, n in enumerate(names))
        )

    counted = _count(present.withColumn("_bin", _coarse_bin(v)), "_bin")
    placed = counted.select(
        "_n", "_lo", "_hi",
        (F.sum("_n").over(Window.orderBy("_bin")) - F.col("_n")).alias("_base"),
        F.sum("_n").over(Window.partitionBy()).alias("_total"),
    )
    ranks = [(F.col("_total") - 1) * F.lit(float(x)) for x in q]
    wanted = reduce(or_, (_holds(edge(r)) for r in ranks for edge in (F.floor, F.ceil)))
    ranges = placed.where(wanted).collect()
    if not ranges:
        absent = T.StructType([T.StructField(n, T.DoubleType()) for n in names])
        return df.sparkSession.createDataFrame([(None,) * len(names)], absent)

    total = ranges[0]["_total"]
    targets = [(total - 1) * float(x) for x in q]
    edges = sorted({edge(t) for t in targets for edge in (math.floor, math.ceil)})
    while any(r["_n"] > rows_per_range and r["_lo"] < r["_hi"] for r in ranges):
        counted = _count(
            _inside(present, ranges, kind).withColumn("_part", _split(ranges)), "_range", "_part"
        )
        within = Window.partitionBy("_range").orderBy("_part")
        base = _pick(ranges, "_base") + F.sum("_n").over(within) - F.col("_n")
        placed = counted.select("_n", "_lo", "_hi", base.alias("_base"))
        ranges = placed.where(reduce(or_, (_holds(F.lit(e)) for e in edges))).collect()

    within = Window.partitionBy("_range").orderBy("v")
    first = _pick(ranges, "_base") + F.sum("_n").over(within) - F.col("_n")
    counts = (
        _inside(present, ranges, kind)
        .groupBy("_range", "v")
        .agg(F.count("*").alias("_n"))
        .select(v.cast("double").alias("v"), "_n", first.alias("_base"))
    )

    def at(rank: int) -> Column:
        return F.max(F.when(_holds(F.lit(rank)), v))

    def quantile(target: float) -> Column:
        low, high = at(math.floor(target)), at(math.ceil(target))
        part = F.lit(target - math.floor(target))
        return F.when(low == high, low).otherwise(low + (high - low) * part)

    return counts.agg(*(quantile(t).alias(n) for t, n in zip(targets, names)))


# Bins per factor of two. Exponents of finite doubles lie within -1074..1024.
_BINS_PER_OCTAVE = 64
_SPLITS = 65536


def _coarse_bin(v: Column) -> Column:
    """Bin number that never falls as the value rises; under 300,000 of them."""
    exponent = F.least(F.greatest(F.log2(F.abs(v)), F.lit(-1100.0)), F.lit(1100.0))
    size = F.floor(exponent * _BINS_PER_OCTAVE).cast("int") + F.lit(1200 * _BINS_PER_OCTAVE)
    return F.when(v > 0, size).when(v < 0, -size).otherwise(0)


def _count(values: DataFrame, *bins: str) -> DataFrame:
    return values.groupBy(*bins).agg(
        F.count("*").alias("_n"), F.min("v").alias("_lo"), F.max("v").alias("_hi")
    )


def _holds(rank: Column) -> Column:
    return rank.between(F.col("_base"), F.col("_base") + F.col("_n") - 1)


def _pick(ranges: list[Row], field: str) -> Column:
    """A field of the range that a row belongs to."""
    return F.get(F.array(*(F.lit(r[field]) for r in ranges)), F.col("_range"))


def _inside(present: DataFrame, ranges: list[Row], kind: T.DataType) -> DataFrame:
    """Values within the ranges, which do not overlap, with the number of their range."""
    exact = kind if isinstance(kind, _FLOATING) else T.DoubleType()

    def within(r: Row) -> Column:
        return F.col("v").between(F.lit(r["_lo"]).cast(exact), F.lit(r["_hi"]).cast(exact))

    number = F.coalesce(*(F.when(within(r), F.lit(i)) for i, r in enumerate(ranges)))
    return present.where(reduce(or_, map(within, ranges))).select("v", number.alias("_range"))


def _split(ranges: list[Row]) -> Column:
    """Position of a value among equal parts of its range."""
    v, lo, hi = F.col("v").cast("double"), _pick(ranges, "_lo"), _pick(ranges, "_hi")
    part = F.floor((v - lo) / (hi - lo) * _SPLITS).cast("int")
    return F.when(hi > lo, F.least(part, F.lit(_SPLITS - 1))).otherwise(0)
