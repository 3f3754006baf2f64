"""What the corpus operators share: inputs, staged tables, file systems."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_SETTING = "spark.checkpoint.dir"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; every executor reaches it.

    Only a session without executors of its own (``local[...]``) may leave it
    unset: then a folder of this machine serves.
    """
    folder = spark.conf.get(_SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError(f"{_SETTING} must name a folder that all executors share")
    return tempfile.mkdtemp(prefix="corpus-")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared one."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str = "staged") -> DataFrame:
    """Write a table to the shared folder and read it back.

    Cuts lineage in a form that survives lost executors, and gives the planner
    the true size.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only (doc_id, text), whatever else the table has; a null text is empty."""
    return df.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )


FILTER_WORDS = 1 << 17  # 64-bit words of an id filter


def may_hold(rows: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows whose id may be one of ``ids``: all that are, and few others.

    One bit stands for each hashed id, in ``FILTER_WORDS`` words: a megabyte, whatever the
    number of ids, which is why it may be broadcast. It goes in front of a join, so that
    rows which cannot match are not shuffled; with very many ids it lets all through.
    """
    word = F.shiftrightunsigned(F.xxhash64(id_col), 6).bitwiseAND(F.lit(FILTER_WORDS - 1))
    bit = F.xxhash64(id_col).bitwiseAND(F.lit(63)).cast("int")
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)
    bits = ids.groupBy(word.alias("_word")).agg(F.bit_or(one).alias("_bits"))
    met = rows.withColumn("_word", word).withColumn("_bit", bit).join(F.broadcast(bits), "_word")
    return met.filter(F.getbit("_bits", "_bit") == 1).select(rows.columns)


def sha256_hex(value: Column) -> Column:
    return F.sha2(value.cast("binary"), 256)
