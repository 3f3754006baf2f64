"""Profile index: one text row per profile."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from profilelake import functions as PF
from profilelake.flavour import Flavour, flavour
from profilelake.schema import index_schema

_DATES = ("date", "date_update")


def _read_lines(
    spark: SparkSession, path: str, db: str | Flavour, schema: T.StructType | None
) -> DataFrame:
    """All lines; one that does not fit the schema has its text in ``_line``."""
    kind = flavour(db)
    if not path.endswith((".txt", ".csv", ".gz")):
        path = f"{path.rstrip('/')}/{kind.index_file}"
    fields = T.StructType([*(schema or index_schema(kind)), T.StructField("_line", T.StringType())])
    lines = (
        spark.read.schema(fields)
        .option("comment", "#")
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_line")
        .option("columnPruning", False)
        .csv(path)
    )
    # Always true, and made of every column: a line is judged by all of them, whichever
    # of them a query wants in the end.
    return lines.filter(F.hash(*(f.name for f in fields if f.name != "_line")) >= -(2**31))


def read_index(
    spark: SparkSession,
    path: str,
    db: str | Flavour,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Scan an index directory or file of the given flavour.

    ``path`` may be the folder that holds the flavour's index file. Preamble
    lines start with ``#``; the header that follows is checked against the
    schema. Empty or malformed dates become null. Lines with too few or too many
    fields, or with text where a number belongs, are left out: ``index_rejects``
    lists them.
    """
    text = _read_lines(spark, path, db, schema)
    return parse_dates(text.filter("_line IS NULL").drop("_line"))


def index_rejects(
    spark: SparkSession,
    path: str,
    db: str | Flavour,
    schema: T.StructType | None = None,
) -> DataFrame:
    """(file, line) of the lines that ``read_index`` leaves out, as they stand in the index."""
    bad = _read_lines(spark, path, db, schema).filter("_line IS NOT NULL")
    return bad.select("file", F.col("_line").alias("line"))


def parse_dates(index: DataFrame) -> DataFrame:
    """Replace the compact text dates of an index by timestamps."""
    return index.select(
        *(PF.compact_timestamp(c).alias(c) if c in _DATES else F.col(c) for c in index.columns)
    )


def enrich_index(index: DataFrame) -> DataFrame:
    """Add float id, cycle and path parts, all taken from the profile path."""
    return index.select("*", PF.profile_path("file").alias("_path")).select(
        *index.columns,
        PF.wmoid("_path").alias("wmoid"),
        PF.filepath_main("_path").alias("filepath_main"),
        PF.filepath("_path").alias("filepath"),
        PF.filename("_path").alias("filename"),
        PF.cycle("_path").alias("cycle"),
    )


def split_rejects(enriched: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with a usable path, and rows whose path gives no float id or cycle."""
    usable = F.col("wmoid").isNotNull() & F.col("cycle").isNotNull()
    return enriched.where(usable), enriched.where(~usable)
