"""Staged profiles converted as they arrive, batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from profilelake.flavour import Flavour, flavour
from profilelake.operators.conform import conform
from profilelake.operators.quarantine import failed_checks, without_files
from profilelake.plans.convert import level_rows
from profilelake.schema import level_schema, staged_schema
from profilelake.sources.stored import stored
from profilelake.sources.versions import add_batch


def convert_arriving(
    spark: SparkSession,
    staged_path: str,
    root: str,
    db: str | Flavour,
    checkpoint: str,
    schema: T.StructType | None = None,
    files_per_batch: int | None = None,
    drop_padding: bool = False,
    continuous: str | None = None,
    name: str = "arriving",
) -> StreamingQuery:
    """Add the profiles of new files under ``staged_path`` to the versioned dataset.

    Each micro-batch runs the checks, the data-mode spread, the flatten and the cast of
    a whole conversion and becomes one batch of the dataset, named by the stream and its
    number: a batch that Spark runs again after a failure adds nothing twice. Files that
    fail their checks are listed under ``<root>/quarantine/<db>-<name>/``. All profiles
    of a source file must arrive in one staged file, as the checks are per source file.

    By default the stream ends when it has read what is there; ``continuous`` is the
    interval of a stream that goes on.
    """
    kind = flavour(db)
    wanted = level_schema(kind)
    reader = spark.readStream.schema(schema or staged_schema(kind))
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def add(batch: DataFrame, number: int) -> None:
        held = stored(batch, f"{root.rstrip('/')}/runs")
        bad = stored(failed_checks(held, kind.data_mode_parameters), f"{root.rstrip('/')}/runs")
        rows = conform(level_rows(without_files(held, bad), kind, drop_padding), wanted)
        add_batch(rows, root, kind, f"{name}-{number:012d}")
        listed = f"{root.rstrip('/')}/quarantine/{kind.name}-{name}/batch={number}"
        bad.write.mode("overwrite").parquet(listed)

    writer = reader.parquet(staged_path).writeStream.foreachBatch(add)
    writer = writer.option("checkpointLocation", checkpoint)
    if continuous is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=continuous).start()
