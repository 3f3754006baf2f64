"""Folders listed by executors, and files packed into tasks of even size."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from profilelake import functions as PF
from profilelake.sources.stored import stored

OPEN_BYTES = 1 << 17  # what opening a file counts beside its bytes: a thousand small files are a pack
PACK_BYTES = 128 << 20
BATCH_ENTRIES = 10_000  # entries of folders that are handed on at once
GROUP_PACKS = 64  # packs that are filled from one sorted group of files

ENTRIES = "path string, folder boolean, mtime timestamp_ntz, length bigint, error string"
_FIELDS = pa.schema(
    [("path", pa.string()), ("folder", pa.bool_()), ("mtime", pa.timestamp("us")),
     ("length", pa.int64()), ("error", pa.string())]
)
_NATIVE = {"s3a": "s3", "s3n": "s3", "abfs": "abfss"}


@lru_cache(maxsize=64)
def _system(base: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(base)


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """(file system, name in it) of a path as Spark shows it (``file:/data``, ``s3a://b/k``).

    The file system of a scheme and host is made once in each Python process.
    """
    parts = urlsplit(path)
    if parts.scheme in ("", "file"):
        plain = path.removeprefix("file:")
        return _system("file:///")[0], "/" + plain.lstrip("/")
    scheme = _NATIVE.get(parts.scheme, parts.scheme)
    base = f"{scheme}://{parts.netloc}/"
    system, inside = _system(base)
    return system, f"{inside.rstrip('/')}/{path.split('//', 1)[1].partition('/')[2]}".lstrip("/")


def roots(spark: SparkSession, path: str | list[str]) -> list[str]:
    """The given paths with scheme and host, patterns in them filled in."""
    found = []
    for one in [path] if isinstance(path, str) else path:
        where = spark._jvm.org.apache.hadoop.fs.Path(one)
        system = where.getFileSystem(spark._jsc.hadoopConfiguration())
        met = system.globStatus(where)
        if not met:
            raise FileNotFoundError(one)
        found += [m.getPath().toString() for m in met]
    return found


def reachable(paths: list[str]) -> bool:
    """Whether executors can list these without Hadoop's file systems."""
    try:
        for path in paths:
            opened(path)
    except Exception:
        return False
    return True


def _entry(path: str, info: fs.FileInfo | None, error: str | None = None) -> tuple:
    if info is None:
        return path, True, None, None, error
    micros = None if info.mtime_ns is None else info.mtime_ns // 1_000_000 * 1000
    return path, info.type == fs.FileType.Directory, micros, info.size, None


def _rows(entries: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*entries)) if entries else [()] * len(_FIELDS)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.int64()).cast(f.type) if f.name == "mtime" else pa.array(c, f.type)
         for c, f in zip(columns, _FIELDS)], schema=_FIELDS
    )


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What lies in each folder; a path that is a file gives itself.

    Entries are handed on in batches across folders, since most folders hold few.
    """
    waiting: list[tuple] = []
    for batch in batches:
        for folder in batch["path"].to_pylist():
            try:
                system, inside = opened(folder)
                info = system.get_file_info(inside)
                if info.type == fs.FileType.File:
                    waiting.append(_entry(folder, info))
                else:
                    base, inner = folder.rstrip("/"), system.get_file_info(fs.FileSelector(inside))
                    waiting += [_entry(f"{base}/{i.base_name}", i) for i in inner if i.base_name[:1] not in "._"]
            except Exception as e:
                waiting.append(_entry(folder, None, f"{type(e).__name__}: {e}"))
            if len(waiting) >= BATCH_ENTRIES:
                for start in range(0, len(waiting), BATCH_ENTRIES):
                    yield _rows(waiting[start : start + BATCH_ENTRIES])
                waiting = []
    if waiting:
        yield _rows(waiting)


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The files at given paths; a path without one gives an error."""
    for batch in batches:
        entries = []
        for path in batch["path"].to_pylist():
            try:
                system, inside = opened(path)
                info = system.get_file_info(inside)
                if info.type != fs.FileType.File:
                    raise FileNotFoundError(path)
                entries.append(_entry(path, info))
            except Exception as e:
                entries.append((path, False, None, None, f"{type(e).__name__}: {e}"))
        yield _rows(entries)


def _spread(spark: SparkSession) -> int:
    return 4 * spark.sparkContext.defaultParallelism


def list_folders(spark: SparkSession, folders: DataFrame, glob: str | None = None) -> DataFrame:
    """(path, mtime, length, error) of all files below the folders in ``path``.

    Level by level: the folders of a level are dealt to tasks, and what they hold is
    stored, so no process holds more than one folder's entries. A folder that cannot
    be listed is a row with an ``error``.
    """
    files = []
    while True:
        found = stored(folders.repartition(_spread(spark), "path").mapInArrow(_listed, ENTRIES))
        files.append(found.filter("NOT folder OR error IS NOT NULL"))
        folders = found.filter("folder AND error IS NULL").select("path")
        if folders.isEmpty():
            break
    every = files[0]
    for level in files[1:]:
        every = every.unionAll(level)
    if glob is not None:
        pattern = spark._jvm.org.apache.hadoop.fs.GlobPattern(glob).compiled().pattern()
        named = F.element_at(F.split("path", "/"), -1).rlike(f"^(?:{pattern})$")
        every = every.filter(F.col("error").isNotNull() | named)
    return every.select("path", "mtime", "length", "error")


def scan_files(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """Path, modification time (UTC), size and error of all files below ``path``.

    Executors list the folders. Only file systems that PyArrow cannot open are listed
    on the driver, by Spark's ``binaryFile`` source.
    """
    starts = roots(spark, path)
    if reachable(starts):
        return list_folders(spark, spark.createDataFrame([(p,) for p in starts], "path string"), glob)
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(starts).select(
        "path", PF.utc_ntz("modificationTime").alias("mtime"), "length", F.lit(None).cast("string").alias("error")
    )


def measure_files(paths: DataFrame) -> DataFrame:
    """Path, modification time, size and error of the files named in ``path``, without a listing."""
    wanted = paths.select("path").distinct().repartition(_spread(paths.sparkSession), "path")
    return wanted.mapInArrow(_measured, ENTRIES).select("path", "mtime", "length", "error")


def packed(
    files: DataFrame, pack_bytes: int = PACK_BYTES, open_bytes: int = OPEN_BYTES
) -> DataFrame:
    """The files dealt into tasks that hold about ``pack_bytes`` each, opening included.

    ``files`` is a stored table with ``path`` and ``length``. Files are cut into groups
    by a hash; in a group the largest come first, so a file of more than a pack fills
    one by itself and small ones fill the others up evenly. All this happens to paths
    and sizes; neither a path nor a count per file comes to the driver.
    """
    spark = files.sparkSession
    cost = F.coalesce("length", F.lit(0)) + open_bytes
    total = files.agg(F.sum(cost)).first()[0] or 0
    size = max(1, min(pack_bytes, -(-total // (2 * spark.sparkContext.defaultParallelism))))
    groups = max(1, total // (size * GROUP_PACKS))
    group = F.pmod(F.xxhash64("path"), F.lit(groups)).alias("_group")
    costed = files.select("*", group, cost.alias("_cost"))
    most = costed.groupBy("_group").agg(F.sum("_cost").alias("n")).agg(F.max("n")).first()[0] or 0
    each = -(-most // size) + 1
    before = F.expr(
        "sum(_cost) OVER (PARTITION BY _group ORDER BY _cost DESC, path "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - _cost"
    )
    numbered = costed.withColumn("_pack", F.col("_group") * each + F.floor(before / size))
    return numbered.repartitionById(int(groups * each), F.col("_pack").cast("int")).drop("_group", "_cost", "_pack")
