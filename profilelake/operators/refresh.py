"""Which files of a local mirror are missing, stale or current, and what to do about each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from profilelake import functions as PF
from profilelake.flavour import Flavour, flavour


def _under(root: str) -> str:
    return root if root.endswith("/") else root + "/"


def candidates_per_float(
    floats: DataFrame, db: str | Flavour, local_root: str, remote_root: str
) -> DataFrame:
    """Local path and address of the one file each float directory holds.

    ``local_root`` is written the way the file inventory shows paths, such as
    ``file:/data/dac`` or ``s3a://bucket/dac``.
    """
    name = PF.float_filename("wmoid", flavour(db).file_suffix)
    return floats.select(
        "filepath_main",
        "wmoid",
        name.alias("filename"),
        F.concat(F.lit(_under(local_root)), "filepath_main", name).alias("local_path"),
        F.concat(F.lit(_under(remote_root)), "filepath_main", name).alias("url"),
    )


def candidates_per_profile(index: DataFrame, local_root: str, remote_root: str) -> DataFrame:
    """Local path and address of every single profile file."""
    relative = F.concat(F.lit("dac/"), "filepath", "filename")
    return index.select(
        "filepath",
        "filename",
        "wmoid",
        F.concat(F.lit(_under(local_root)), relative).alias("local_path"),
        F.concat(F.lit(_under(remote_root)), relative).alias("url"),
    )


def latest_updates(index: DataFrame) -> DataFrame:
    """Per float, over all its directories: the last update and the undated profiles."""
    return index.groupBy("wmoid").agg(
        F.max("date_update").alias("last_update"),
        F.count_if(F.col("date_update").isNull()).alias("undated"),
    )


def _with_mtime(candidates: DataFrame, files: DataFrame) -> DataFrame:
    """Add the local file's time, null without a file; a path listed twice counts once."""
    local = files.groupBy(F.col("path").alias("local_path")).agg(F.max("mtime").alias("_mtime"))
    return candidates.join(local, "local_path", "left")


def _with_state(timed: DataFrame, index: DataFrame) -> DataFrame:
    newer = (F.col("undated") == 0) & (F.col("last_update") < F.col("_mtime"))
    # No profile at all: nothing the file could be older than.
    newer = F.when(F.col("undated").isNull(), True).otherwise(F.coalesce(newer, F.lit(False)))
    state = (
        F.when(F.col("_mtime").isNull(), "missing").when(newer, "current").otherwise("stale")
    )
    return timed.join(latest_updates(index), "wmoid", "left").select(
        *timed.columns, state.alias("state")
    )


def _with_action(
    timed: DataFrame, remote: DataFrame, checktime: bool, overwrite: bool
) -> DataFrame:
    listing = remote.groupBy("url").agg(
        F.max("remote_mtime").alias("remote_mtime"), F.min("status").alias("status")
    )
    exists = F.col("_mtime").isNotNull()
    found = F.coalesce(F.col("status"), F.lit(404)) != 404
    action = F
    if checktime:
        if "state" in timed.columns:
            action = action.when(F.col("state") == "current", "keep")
        action = action.when(exists & F.col("remote_mtime").isNull(), "error").when(
            exists & (F.col("remote_mtime") <= F.col("_mtime")), "keep"
        )
    elif not overwrite:
        action = action.when(exists, "keep")
    action = action.when(~found, "missing_remote").otherwise("fetch")
    return timed.join(listing, "url", "left").select(*timed.columns, action.alias("action"))


def freshness(candidates: DataFrame, index: DataFrame, files: DataFrame) -> DataFrame:
    """Add ``state``: ``missing``, ``current`` or ``stale``.

    A file is current when it is newer than every update of its float; a
    profile without update time cannot be ruled out and makes it stale.
    """
    return _with_state(_with_mtime(candidates, files), index).select(
        *candidates.columns, "state"
    )


def refresh_actions(
    candidates: DataFrame,
    files: DataFrame,
    remote: DataFrame,
    checktime: bool = True,
    overwrite: bool = False,
) -> DataFrame:
    """Add ``action``: ``keep``, ``fetch``, ``error`` or ``missing_remote``.

    ``remote`` lists ``url, remote_mtime, status``; an address it lacks counts
    as not found, one listed twice counts once (latest time, least status).
    With ``checktime`` a present file is kept unless the remote one is newer,
    and ``overwrite`` plays no part. Candidates that carry a ``state`` are kept
    when it says ``current``. The result is the dry run.
    """
    timed = _with_mtime(candidates, files)
    return _with_action(timed, remote, checktime, overwrite).select(
        *candidates.columns, "action"
    )


def planned_actions(
    candidates: DataFrame,
    index: DataFrame,
    files: DataFrame,
    remote: DataFrame,
    checktime: bool = True,
    overwrite: bool = False,
) -> DataFrame:
    """``state`` and ``action`` together: the inventory is joined once for both."""
    stated = _with_state(_with_mtime(candidates, files), index)
    return _with_action(stated, remote, checktime, overwrite).select(
        *candidates.columns, "state", "action"
    )


def inventory_totals(files: DataFrame) -> DataFrame:
    """Number of files and their size in MB."""
    return files.agg(
        F.count("*").alias("files"), (F.sum("length") / (1024 * 1024)).alias("total_mb")
    )
