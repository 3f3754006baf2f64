"""Per-parameter data modes, and the checks a file must pass before conversion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from profilelake import functions as PF
from profilelake.flavour import DATA_MODE_SUFFIX

CALIBRATION_ERROR = "PARAMETER differs between calibrations"
DATA_MODE_ERROR = "data mode of a known parameter is longer than one character"


def with_mode_columns(staged: DataFrame) -> DataFrame:
    """Staged rows with names and modes; files that came without them have null ones."""
    kinds = {"PARAMETER": "array<array<string>>", "PARAMETER_DATA_MODE": "array<string>"}
    absent = {c: F.lit(None).cast(k) for c, k in kinds.items() if c not in staged.columns}
    return staged.withColumns(absent) if absent else staged


def declared_modes() -> Column:
    """Array of (name, mode) of a profile, in file order and without white space.

    Null only where the profile has no modes.
    """
    return F.zip_with(
        F.coalesce(F.get("PARAMETER", F.lit(0)), F.array().cast("array<string>")),
        "PARAMETER_DATA_MODE",
        lambda name, mode: F.struct(
            F.coalesce(PF.strip(name), F.lit("")).alias("name"),
            F.coalesce(PF.strip(mode), F.lit("")).alias("mode"),
        ),
    )


def _last_mode(declared: Column, name: Column) -> Column:
    same = F.filter(declared, lambda d: d["name"] == name)
    return F.try_element_at(same, F.lit(-1))["mode"]


def spread_data_modes(staged: DataFrame, parameters: Sequence[str]) -> DataFrame:
    """Add a ``<PARAM>_DATA_MODE`` column for every given parameter.

    Null where the file has no modes, empty where the profile does not name
    the parameter; of repeated names the last counts. Works on profiles, ahead
    of ``flatten_levels``, which repeats the value on every level.
    """
    if not parameters:
        return staged
    # The last of repeated names is the first from the end. Names and modes are
    # common to all columns, so a profile's arrays are taken apart once.
    names = F.transform("_reversed", lambda d: d["name"])
    modes = F.transform("_reversed", lambda d: d["mode"])
    unnamed = F.when(F.col("PARAMETER_DATA_MODE").isNotNull(), "")

    def mode_of(parameter: str) -> Column:
        place = F.array_position(names, parameter).cast("int") - 1
        return F.coalesce(F.get(modes, place), unnamed)

    return (
        with_mode_columns(staged)
        .select("*", F.reverse(declared_modes()).alias("_reversed"))
        .select(
            *staged.columns,
            *(mode_of(p).alias(p + DATA_MODE_SUFFIX) for p in parameters),
        )
    )


def source_modes(
    staged: DataFrame, parameters: Sequence[str], keys: Sequence[str]
) -> DataFrame:
    """Per profile, an array ``modes`` of (parameter, mode) for the known ones it names."""
    names = F.array_distinct(F.transform("_declared", lambda d: d["name"]))
    modes = F.transform(
        F.filter(names, lambda n: n.isin(list(parameters))),
        lambda n: F.struct(
            n.alias("parameter"), _last_mode(F.col("_declared"), n).alias("mode")
        ),
    )
    return (
        with_mode_columns(staged)
        .where(F.col("PARAMETER_DATA_MODE").isNotNull())
        .select(*keys, declared_modes().alias("_declared"))
        .select(*keys, modes.alias("modes"))
    )


def unknown_parameters(staged: DataFrame, parameters: Sequence[str]) -> DataFrame:
    """Data-mode column names a file asks for that the schema lacks; reported, not fatal."""
    unknown = F.filter(
        F.transform(F.get("PARAMETER", F.lit(0)), PF.strip),
        lambda n: (n != "") & ~n.isin(list(parameters)),
    )
    return (
        with_mode_columns(staged)
        .where(F.col("PARAMETER_DATA_MODE").isNotNull())
        .select("source_file", F.explode(F.array_distinct(unknown)).alias("name"))
        .select("source_file", F.concat("name", F.lit(DATA_MODE_SUFFIX)).alias("column"))
        .distinct()
    )


def calibration_varies() -> Column:
    """Whether a profile's parameter names differ between calibrations."""
    same = F.forall(
        "PARAMETER", lambda c: c.eqNullSafe(F.get(F.col("PARAMETER"), F.lit(0)))
    )
    return F.col("PARAMETER_DATA_MODE").isNotNull() & ~F.coalesce(same, F.lit(True))


def data_mode_too_long(parameters: Sequence[str]) -> Column:
    """Whether a known parameter has a data mode of more than one character."""
    bad = F.exists(
        declared_modes(),
        lambda d: d["name"].isin(list(parameters)) & (F.length(d["mode"]) > 1),
    )
    return F.coalesce(F.col("PARAMETER_DATA_MODE").isNotNull() & bad, F.lit(False))


def calibration_invariant(staged: DataFrame) -> DataFrame:
    """Per file, whether parameter names are the same in every calibration."""
    return with_mode_columns(staged).groupBy("source_file").agg(
        F.bool_and(~calibration_varies()).alias("invariant")
    )


def data_modes_valid(staged: DataFrame, parameters: Sequence[str]) -> DataFrame:
    """Per file, whether every known parameter's data mode is one character at most."""
    return with_mode_columns(staged).groupBy("source_file").agg(
        F.bool_and(~data_mode_too_long(parameters)).alias("valid")
    )
