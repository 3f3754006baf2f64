"""Small intermediate tables kept where every executor can read them."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for intermediate data.

    A folder of this machine serves only where executors are threads of it
    (``local[...]``); elsewhere they could not see each other's files.
    """
    folder = spark.conf.get(_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError(f"{_SETTING} must name a folder that all executors share")
    return tempfile.mkdtemp(prefix="profilelake-")


def stored(df: DataFrame, folder: str | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Cuts lineage, and gives the planner the true size: a small table is
    broadcast, a large one is joined by shuffles that can be split where one
    key is hot.
    """
    path = f"{folder or shared_folder(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def replace_folder(spark: SparkSession, new: str, old: str) -> None:
    """Put a finished folder in the place of another.

    The old folder is first set aside under a name of its own and deleted only once the
    new one has its name, so a run that ends in between has lost nothing.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path
    source, target, aside = path(new), path(old), path(f"{old}-{uuid.uuid4().hex}-old")
    system = source.getFileSystem(spark._jsc.hadoopConfiguration())
    there = system.exists(target)
    if there and not system.rename(target, aside):
        raise OSError(f"{old} could not be set aside")
    if not system.rename(source, target):
        if there:
            system.rename(aside, target)
        raise OSError(f"{new} could not be renamed to {old}")
    if there:
        system.delete(aside, True)
