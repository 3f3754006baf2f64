"""Check a converted table against its source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from profilelake.flavour import DATA_MODE_SUFFIX
from profilelake.operators.datamode import source_modes


def verify_data_modes(
    levels: DataFrame,
    staged: DataFrame,
    parameters: Sequence[str],
    keys: Sequence[str] = ("source_file", "N_PROF"),
) -> DataFrame:
    """Per profile and parameter, whether every level carries the mode of the source.

    Levels are reduced to the distinct sets of modes of their profile, one in
    sound data, before anything is joined; the last grouping then needs no
    further shuffle. They are as many as the profiles, but come from a few narrow
    columns of a wide dataset, which the planner takes for a small table: the
    join is told not to broadcast them.
    """
    present = [p for p in parameters if p + DATA_MODE_SUFFIX in levels.columns]
    carried = F.array(*(F.col(p + DATA_MODE_SUFFIX) for p in present))
    found = levels.select(*keys, carried.alias("_carried")).distinct()
    place = F.array_position(F.array(*map(F.lit, present)), F.col("_source.parameter"))
    same = F.get("_carried", place.cast("int") - 1).eqNullSafe(F.col("_source.mode"))
    # A profile without levels has none that differs.
    matches = F.when(F.col("_carried").isNull(), True).otherwise(same)
    return (
        source_modes(staged, present, keys)
        .join(found.hint("merge"), list(keys), "left")
        .select(*keys, "_carried", F.explode("modes").alias("_source"))
        .select(*keys, "_source.parameter", matches.alias("_same"))
        .groupBy(*keys, "parameter")
        .agg(F.bool_and("_same").alias("matches"))
    )
