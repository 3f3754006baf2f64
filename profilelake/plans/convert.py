"""Staged profiles, or files and a decoder, to a level dataset with its metadata."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from profilelake.flavour import Flavour, flavour
from profilelake.operators.conform import conform, uncastable_files, union_outer
from profilelake.operators.datamode import spread_data_modes
from profilelake.operators.flatten import flatten_levels
from profilelake.operators.quarantine import failed_checks, without_files
from profilelake.schema import level_schema, staged_schema
from profilelake.sources.files import Decoder, decode_files, staged_and_failed
from profilelake.sources.stored import stored
from profilelake.sources.tables import range_count, write_levels, write_metadata


@dataclass(frozen=True)
class Conversion:
    """Where a run has put its tables; ``metadata`` is None if there was none to write."""

    levels: str
    quarantine: str
    metadata: str | None


def level_rows(
    staged: DataFrame, db: str | Flavour, drop_padding: bool = False
) -> DataFrame:
    """Level rows of sound files, with data modes, not yet conformed."""
    kind = flavour(db)
    spread = spread_data_modes(staged, kind.data_mode_parameters)
    return flatten_levels(spread, kind.columns, drop_padding)


def _profile_keys(staged: DataFrame, cluster_by: Sequence[str] | None) -> list[str]:
    """Clustering keys if all of them are values of a profile, completed by its identity."""
    arrays = {f.name for f in staged.schema if isinstance(f.dataType, T.ArrayType)}
    if not cluster_by or not set(cluster_by) <= set(staged.columns) - arrays:
        return []
    return [*dict.fromkeys([*cluster_by, "source_file", "N_PROF"])]


def convert_profiles(
    staged: DataFrame,
    root: str,
    db: str | Flavour,
    failed: DataFrame | None = None,
    metadata: DataFrame | None = None,
    on_error: str = "raise",
    drop_padding: bool = False,
    mode: str = "overwrite",
    target_file_bytes: int | None = None,
    cluster_by: Sequence[str] | None = None,
) -> Conversion:
    """Convert staged profiles and replace the flavour's dataset under ``root``.

    ``failed`` lists files that could not be decoded. ``on_error`` says what a
    value that does not fit its type does: fail the run, become null, or send
    its file to ``quarantine``.

    The list of failed files is stored first. Its size then tells Spark
    whether it can be broadcast, so that staged rows are not shuffled unless
    very many files failed. ``staged`` is read more than once and should be a
    stored table.
    """
    if on_error not in {"raise", "null", "quarantine"}:
        raise ValueError(f"unknown on_error {on_error!r}")
    kind = flavour(db)
    schema = level_schema(kind)

    # The run's own list; the dataset's list is only added to by an append.
    folder = f"{root.rstrip('/')}/runs"
    bad = [stored(failed_checks(staged, kind.data_mode_parameters), folder)]
    if failed is not None:
        bad.append(failed.select("source_file", "error"))
    if on_error == "quarantine":
        checked = without_files(staged, bad[0])
        bad.append(uncastable_files(level_rows(checked, kind), schema))
    listed = stored(union_outer(bad), folder)
    quarantine = f"{root.rstrip('/')}/quarantine/{kind.name}"
    sound = without_files(staged, listed)
    keys = _profile_keys(staged, cluster_by)
    if keys:
        # Profiles are dealt into ranges before they become levels: their rows are fewer.
        sound = sound.repartitionByRange(range_count(staged, target_file_bytes), *keys)
    levels = conform(
        level_rows(sound, kind, drop_padding),
        schema,
        on_error="null" if on_error == "null" else "raise",
    )
    written = write_levels(
        levels,
        root,
        kind,
        mode,
        target_file_bytes=target_file_bytes,
        cluster_by=cluster_by,
        clustered=bool(keys),
    )
    listed.write.mode(mode).parquet(quarantine)
    described = None if metadata is None else write_metadata(metadata, root, kind, mode)
    return Conversion(written, quarantine, described)


def convert_files(
    spark: SparkSession,
    path: str | list[str],
    decoder: Decoder,
    root: str,
    db: str | Flavour,
    staged_path: str,
    schema: T.StructType | None = None,
    glob: str | None = None,
    files: DataFrame | None = None,
    **options,
) -> Conversion:
    """Decode files, keep the staged rows at ``staged_path``, convert them.

    Each file is decoded once. ``files`` (with a ``local_path``, such as the
    actions of a refresh plan) restricts the run to those; missing ones are listed
    in the quarantine. ``options`` are those of ``convert_profiles``.
    """
    kind = flavour(db)
    decoded = decode_files(
        spark, path, decoder, schema or staged_schema(kind), glob or f"*{kind.file_suffix}", files
    )
    decoded.write.mode("overwrite").parquet(staged_path)
    staged, failed = staged_and_failed(spark.read.schema(decoded.schema).parquet(staged_path))
    return convert_profiles(staged, root, kind, failed=failed, **options)
