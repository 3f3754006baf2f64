"""Files on disk: their inventory, and decoding them into staged profiles."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from profilelake.sources.listing import (
    PACK_BYTES,
    measure_files,
    opened,
    packed,
    reachable,
    roots,
    scan_files,
)
from profilelake.sources.stored import stored

BATCH_ROWS, BATCH_BYTES = 4096, 32 << 20  # of decoded rows that are handed on at once

Decoder = Callable[[str, bytes], Iterable[pd.DataFrame] | pd.DataFrame]


def file_inventory(
    spark: SparkSession,
    path: str | list[str],
    glob: str | None = None,
    on_error: str = "raise",
) -> DataFrame:
    """Path, modification time (UTC) and size of every file; contents are not read.

    Executors list the folders, level by level. A folder that cannot be listed fails
    the call, or with ``on_error="rows"`` is a row with its reason in ``error``.
    """
    if on_error not in {"raise", "rows"}:
        raise ValueError(f"unknown on_error {on_error!r}")
    found = scan_files(spark, path, glob)
    if on_error == "rows":
        return found
    bad = found.filter("error IS NOT NULL").select("path", "error").first()
    if bad is not None:
        raise OSError(f"{bad.path} cannot be listed: {bad.error}")
    return found.drop("error")


class _Batch:
    """Decoded frames of several files, until they are worth a batch."""

    def __init__(self, schema: pa.Schema):
        self.schema = schema
        self.parts: list[tuple[int, dict[str, pa.Array]]] = []
        self.rows = self.size = 0

    def add(self, parts: list[tuple[int, dict[str, pa.Array]]]) -> None:
        self.parts += parts
        self.rows += sum(n for n, _ in parts)
        self.size += sum(a.nbytes for _, columns in parts for a in columns.values())

    @property
    def full(self) -> bool:
        return self.rows >= BATCH_ROWS or self.size >= BATCH_BYTES

    def take(self) -> pa.RecordBatch:
        def column(field: pa.Field) -> pa.Array:
            if not any(field.name in columns for _, columns in self.parts):
                return pa.nulls(self.rows, field.type)
            arrays = [
                columns[field.name] if field.name in columns else pa.nulls(n, field.type)
                for n, columns in self.parts
            ]
            return pa.concat_arrays(arrays)

        batch = pa.RecordBatch.from_arrays([column(f) for f in self.schema], schema=self.schema)
        self.parts, self.rows, self.size = [], 0, 0
        return batch


def decode_files(
    spark: SparkSession,
    path: str | list[str],
    decoder: Decoder,
    schema: T.StructType,
    glob: str | None = None,
    files: DataFrame | None = None,
    pack_bytes: int = PACK_BYTES,
) -> DataFrame:
    """Run a user decoder over many files, one call per file.

    Executors list the files, which are packed into tasks of even size
    (``listing.packed``), opened there through PyArrow's file systems, and handed on
    in batches across files. ``files`` names the wanted ones in ``local_path``
    instead: then nothing is listed, and a wanted file that is not there gives a row
    with an ``error``. A path that only Spark can open is read by its ``binaryFile``
    source.

    ``decoder(path, content)`` returns one pandas frame of staged rows or an
    iterable of them; absent columns become null, ``source_file`` is filled
    in. The result has the staged columns and ``error``: a file that fails at
    any point, or holds values that do not fit the schema, yields no staged
    row but one row with its path and the reason.

    Two uses of the result decode twice, so write it to a table first
    (``convert_files`` does).
    """
    out = T.StructType([*schema.fields, T.StructField("error", T.StringType())])
    arrow = to_arrow_schema(out)
    types = {f.name: f.type for f in arrow}
    times = {f.name for f in schema if isinstance(f.dataType, T.TimestampNTZType)}

    def columns(frame: pd.DataFrame, file: str) -> tuple[int, dict[str, pa.Array]]:
        found = {"source_file": pa.repeat(pa.scalar(file, types["source_file"]), len(frame))}
        for name in frame.columns:
            if name in types and name not in {"source_file", "error"}:
                values = frame[name]
                if name in times:
                    values = pd.to_datetime(values).dt.floor("us")
                found[name] = pa.Array.from_pandas(values, type=types[name])
        return len(frame), found

    def failure(file: str, reason: str) -> tuple[int, dict[str, pa.Array]]:
        return 1, {c: pa.array([v], types[c]) for c, v in (("source_file", file), ("error", reason))}

    def decoded(file: str, content: bytes) -> list[tuple[int, dict[str, pa.Array]]]:
        try:
            frames = decoder(file, content)
            frames = [frames] if isinstance(frames, pd.DataFrame) else frames
            # Kept until the file is through: a late failure drops them all.
            return [columns(f, file) for f in frames]
        except Exception as e:
            return [failure(file, f"{type(e).__name__}: {e}")]

    def contents(batch: pa.RecordBatch) -> Iterator[tuple[str, bytes | None, str | None]]:
        for file, error in zip(batch["path"].to_pylist(), batch["error"].to_pylist()):
            if error is not None:
                yield file, None, error
                continue
            try:
                system, inside = opened(file)
                with system.open_input_file(inside) as source:
                    content = source.read()
            except Exception as e:
                yield file, None, f"{type(e).__name__}: {e}"
                continue
            yield file, content, None

    def batched(parts: Iterator[list]) -> Iterator[pa.RecordBatch]:
        waiting = _Batch(arrow)
        for part in parts:
            waiting.add(part)
            if waiting.full:
                yield waiting.take()
        if waiting.parts:
            yield waiting.take()

    def decode_packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (x for batch in batches for x in contents(batch))
        return batched([failure(f, e)] if e is not None else decoded(f, c) for f, c, e in found)

    def decode_read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = (pair for batch in batches for pair in zip(batch["path"], batch["content"]))
        return batched(decoded(f.as_py(), c.as_py()) for f, c in pairs)

    if files is not None:
        wanted = files.select(F.col("local_path").alias("path"))
        found = measure_files(wanted)
    else:
        starts = roots(spark, path)
        if not reachable(starts):
            reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
            if glob is not None:
                reader = reader.option("pathGlobFilter", glob)
            return reader.load(starts).select("path", "content").mapInArrow(decode_read, out)
        found = scan_files(spark, path, glob)
    dealt = packed(stored(found), pack_bytes)
    return dealt.select("path", "error").mapInArrow(decode_packed, out)


def staged_and_failed(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split decoder output into staged rows and (source_file, error) rows."""
    return (
        decoded.where(F.col("error").isNull()).drop("error"),
        decoded.where(F.col("error").isNotNull()).select("source_file", "error"),
    )
