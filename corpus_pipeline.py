"""From raw documents to encoded training texts, stage by stage.

Every stage takes ``(spark, docs, sf_dir)``, works on all that its predecessor
kept, and returns a table that is written as Parquet and read again as the next
one's documents. All but the last return the columns of the documents:

* documents that the quality classifier rejects go;
* of each group of near-duplicates one document stays;
* documents that hold a benchmark item go;
* secrets are masked in the text, and ``n_chars`` counts the text anew;
* the texts are encoded and decoded: id, number of ids, digests.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from profilelake.llm import (
    decontaminate,
    near_duplicates,
    pieces,
    queries,
    rule_ensemble,
    secrets,
)
from profilelake.llm.common import scratch, table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    return rule_ensemble.keep_good(docs, table(spark, sf_dir, "labels"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id."""
    return near_duplicates.keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in the place of every secret."""
    return secrets.mask(docs, queries.RANKS, queries.RANKS_PATTERN)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids and decoded texts as digests."""
    return pieces.digests(docs, queries.PIECE_MODEL)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", keep_quality),
    ("near duplicates", keep_one_of_each),
    ("benchmark decontamination", drop_benchmark),
    ("secret scan", mask_secrets),
    ("piece encoding", encode),
]

#: Neither the fitted classifier nor the ids of the encoder are SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stage's table written and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = scratch(spark, "pipeline")
    for number, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{folder}/{number}")
        docs = spark.read.schema(out.schema).parquet(f"{folder}/{number}")
    return docs
