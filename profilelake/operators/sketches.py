"""Quantiles from sketches that are kept and merged, batch by batch.

A KLL sketch of a few kilobytes stands for any number of values. One is made per batch
(or per any group), kept as a binary column, and merged when quantiles are wanted, so a
new batch costs one pass over itself and none over what is there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIZE = 4096


def rank_error(size: int = SIZE) -> float:
    """How far the rank of a sketch's quantile may be off, as a share of the values.

    The bound that the sketch's authors give for one quantile with 99 % confidence;
    merging does not widen it.
    """
    return 2.296 / size**0.9723


def value_sketches(
    df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), size: int = SIZE
) -> DataFrame:
    """One row per group: for each column a sketch of its values; nulls and NaN do not count.

    A group without any value has a null sketch.
    """
    kept = [
        F.kll_sketch_agg_double(F.when(~F.isnan(c), F.col(c)).cast("double"), size).alias(c) for c in columns
    ]
    counts = [F.count(F.when(~F.isnan(c), F.col(c))).alias(f"_{c}") for c in columns]
    cast = df.select(*by, *(F.col(c).cast("double").alias(c) for c in columns))
    grouped = cast.groupBy(*by).agg(*kept, *counts)
    return grouped.select(*by, *(F.when(F.col(f"_{c}") > 0, F.col(c)).alias(c) for c in columns))


def merged(sketches: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One row per group of what its sketches stand for together."""
    counts = [F.count(c).alias(f"_{c}") for c in columns]
    found = sketches.groupBy(*by).agg(*(F.kll_merge_agg_double(c).alias(c) for c in columns), *counts)
    return found.select(*by, *(F.when(F.col(f"_{c}") > 0, F.col(c)).alias(c) for c in columns))


def sketched_quantile(sketch: Column, q: float) -> Column:
    """The value at a share of the sketched values; null without any."""
    return F.when(sketch.isNotNull(), F.kll_sketch_get_quantile_double(sketch, F.lit(float(q))))


def sketched_limits(
    sketches: DataFrame,
    column: str,
    q: Sequence[float] = (0.01, 0.99),
    names: Sequence[str] = ("lower", "upper"),
) -> DataFrame:
    """One row of quantiles over all sketches, each within ``rank_error`` of its rank."""
    if len(q) != len(names):
        raise ValueError("one name is needed per quantile")
    if not all(0 <= x <= 1 for x in q):
        raise ValueError(f"quantiles must lie between 0 and 1: {list(q)}")
    one = merged(sketches, [column])
    return one.select(*(sketched_quantile(F.col(column), x).alias(n) for x, n in zip(q, names)))
