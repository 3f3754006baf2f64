"""From a profile index to the refresh plan of a local mirror."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from profilelake.flavour import Flavour, flavour
from profilelake.operators.refresh import candidates_per_float, planned_actions
from profilelake.operators.subset import float_list, subset_index
from profilelake.sources.index import enrich_index, split_rejects


@dataclass(frozen=True)
class MirrorPlan:
    """Index subset (the metadata table), its floats, planned actions, unusable index rows."""

    metadata: DataFrame
    floats: DataFrame
    actions: DataFrame
    rejects: DataFrame


def plan_refresh(
    index: DataFrame,
    files: DataFrame,
    remote: DataFrame,
    db: str | Flavour,
    local_root: str,
    remote_root: str,
    checktime: bool = True,
    overwrite: bool = False,
    **subset,
) -> MirrorPlan:
    """What a refresh would do; nothing is fetched.

    ``subset`` takes the arguments of ``subset_index``.
    """
    kind = flavour(db)
    usable, rejects = split_rejects(enrich_index(index))
    metadata = subset_index(usable, kind, **subset)
    floats = float_list(metadata)
    candidates = candidates_per_float(floats, kind, local_root, remote_root)
    actions = planned_actions(candidates, metadata, files, remote, checktime, overwrite)
    return MirrorPlan(metadata, floats, actions, rejects)
