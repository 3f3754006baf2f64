"""One run over one or both databases: index, subset, plan, conversion, metadata."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from profilelake.flavour import Flavour, flavours
from profilelake.plans.convert import Conversion, convert_files
from profilelake.plans.mirror import MirrorPlan, plan_refresh
from profilelake.sources.files import Decoder, file_inventory
from profilelake.sources.index import read_index
from profilelake.sources.stored import stored


@dataclass(frozen=True)
class DatabaseRun:
    """What was planned for a database, and where its tables are."""

    plan: MirrorPlan
    conversion: Conversion


def convert_mirror(
    spark: SparkSession,
    index_path: str,
    local_root: str,
    remote_root: str,
    remote: DataFrame,
    decoder: Decoder | Mapping[str, Decoder],
    root: str,
    staged_root: str,
    db: str | Flavour | None = None,
    subset: Mapping | None = None,
    **options,
) -> dict[str, DatabaseRun]:
    """Convert the files of the index subset; both databases when none is named.

    Only files that the plan names are opened; those it names and the mirror lacks
    are listed in the quarantine. ``decoder`` may hold one decoder per database;
    ``options`` are those of ``convert_files``. Nothing is fetched: the plans say
    what a refresh would do.
    """
    runs = {}
    for kind in flavours(db):
        index = read_index(spark, index_path, kind)
        files = file_inventory(spark, local_root, f"*{kind.file_suffix}")
        plan = plan_refresh(
            index, files, remote, kind, local_root, remote_root, **dict(subset or {})
        )
        chosen = stored(plan.actions.select("local_path"), f"{root.rstrip('/')}/runs")
        conversion = convert_files(
            spark,
            local_root,
            decoder[kind.name] if isinstance(decoder, Mapping) else decoder,
            root,
            kind,
            f"{staged_root.rstrip('/')}/{kind.name}",
            files=chosen,
            metadata=plan.metadata,
            **options,
        )
        runs[kind.name] = DatabaseRun(plan, conversion)
    return runs
