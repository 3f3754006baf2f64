import json
import os
from datetime import datetime, timezone

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from profilelake.operators.filters import filter_rows
from profilelake.plans import convert_files
from profilelake.schema import level_schema, staged_schema
from profilelake.sources import (
    listing,
    decode_files,
    file_inventory,
    read_levels,
    read_metadata,
    read_staged,
    staged_and_failed,
    write_levels,
    write_metadata,
)

CORE_LEVELS = "PLATFORM_NUMBER bigint, N_PROF bigint, N_LEVELS bigint, LATITUDE double, TEMP float"


@pytest.fixture
def decode_json():
    # Defined inside, so that workers need not import this file.
    def decode_json(path, content):
        """Two profiles per blob; a blob may ask to fail late."""
        blob = json.loads(content)
        for i, p in enumerate(blob["profiles"]):
            yield pd.DataFrame(
                {
                    "N_PROF": [i],
                    "level_count": [blob["levels"]],
                    "PLATFORM_NUMBER": [blob["float"]],
                    "JULD": [pd.Timestamp(blob["day"])],
                    "PRES": [p["PRES"]],
                    "PRES_QC": [p["QC"]],
                    "PARAMETER": [[["PRES"]]],
                    "PARAMETER_DATA_MODE": [["R"]],
                }
            )
        if blob.get("fail"):
            raise RuntimeError("late")

    return decode_json


@pytest.fixture
def blobs(tmp_path):
    folder = tmp_path / "nc"
    for i in range(6):
        where = folder / "dac" / str(i)
        os.makedirs(where)
        blob = {
            "float": i, "levels": 2, "day": "2020-01-02T03:04:05", "fail": i == 4,
            "profiles": [{"PRES": [1.5, None], "QC": [1, None]}, {"PRES": [2.5], "QC": [4, 9]}],
        }
        text = "{ broken" if i == 3 else json.dumps(blob)
        (where / f"{i}_Sprof.nc").write_text(text)
    (folder / "notes.txt").write_text("not a float")
    return str(folder)


def test_inventory(spark, blobs):
    mtime = datetime(2021, 7, 1, 12, tzinfo=timezone.utc)
    path = f"{blobs}/dac/0/0_Sprof.nc"
    os.utime(path, (mtime.timestamp(), mtime.timestamp()))
    rows = file_inventory(spark, blobs, "*_Sprof.nc").collect()
    assert len(rows) == 6
    row = next(r for r in rows if r.path.endswith("/0_Sprof.nc"))
    assert row.mtime == datetime(2021, 7, 1, 12) and row.length == os.path.getsize(path)
    assert file_inventory(spark, blobs).count() == 7


def test_decode(spark, blobs, decode_json):
    schema = staged_schema("bgc", ["PRES"])
    staged, failed = staged_and_failed(decode_files(spark, blobs, decode_json, schema, "*_Sprof.nc"))
    assert staged.schema == schema
    rows = staged.collect()
    assert sorted(r.PLATFORM_NUMBER for r in rows) == [0, 0, 1, 1, 2, 2, 5, 5]
    row = next(r for r in rows if r.N_PROF == 0)
    assert row.PRES == [1.5, None] and row.PRES_QC == [1, None] and row.PRES_ADJUSTED is None
    assert row.JULD == datetime(2020, 1, 2, 3, 4, 5) and row.PARAMETER == [["PRES"]]
    reasons = {os.path.basename(r.source_file): r.error for r in failed.collect()}
    assert set(reasons) == {"3_Sprof.nc", "4_Sprof.nc"}
    assert reasons["4_Sprof.nc"] == "RuntimeError: late"


def test_a_value_of_the_wrong_type_fails_its_file_only(spark, blobs):
    def decode(path, content):
        return pd.DataFrame({"N_PROF": [0], "PRES": [["deep"] if "/1/" in path else [1.0]]})

    schema = staged_schema("bgc", ["PRES"])
    staged, failed = staged_and_failed(decode_files(spark, blobs, decode, schema, "*_Sprof.nc"))
    assert staged.count() == 5 and failed.count() == 1


def test_convert_files(spark, blobs, decode_json, tmp_path):
    done = convert_files(
        spark, blobs, decode_json, str(tmp_path / "out"), "bgc", str(tmp_path / "staged"),
        schema=staged_schema("bgc", ["PRES"]),
    )
    levels = read_levels(spark, done.levels, "bgc")
    assert levels.schema == level_schema("bgc") and levels.count() == 4 * 2 * 2
    assert {r.PRES_DATA_MODE for r in levels.collect()} == {"R"}
    assert spark.read.parquet(done.quarantine).count() == 2
    assert done.metadata is None


def test_read_staged_json(spark, tmp_path):
    (tmp_path / "s.json").write_text(
        json.dumps({"source_file": "f", "N_PROF": 0, "level_count": 2, "PRES": [1, 2.5]}) + "\n"
    )
    row = read_staged(spark, str(tmp_path / "s.json"), "phy", format="json").first()
    assert row.PRES == [1.0, 2.5] and row.TEMP is None and row.level_count == 2


def levels_df(spark, n=100, start=0):
    return spark.range(start, start + n).selectExpr(
        "id div 10 as PLATFORM_NUMBER", "id div 5 as N_PROF", "id % 5 as N_LEVELS",
        "cast((id * 37) % 90 as double) as LATITUDE", "cast(id as float) as TEMP",
    )


def test_replace_append_and_neighbours(spark, tmp_path):
    root = str(tmp_path)
    meta = spark.createDataFrame([(5, "x")], "wmoid int, file string")
    assert write_metadata(meta, root, "phy").endswith("metadata/phy")
    core, bgc = write_levels(levels_df(spark), root, "phy"), write_levels(levels_df(spark, 7), root, "bgc")
    assert core != bgc
    write_levels(levels_df(spark, 40), root, "phy")
    assert read_levels(spark, core, "phy").count() == 40
    write_levels(levels_df(spark, 40, 40), root, "phy", mode="append")
    assert read_levels(spark, core, "phy").count() == 80
    assert read_levels(spark, bgc, "bgc").count() == 7
    assert read_metadata(spark, f"{root}/metadata/phy", [("wmoid", "==", 5)]).count() == 1
    assert read_metadata(spark, f"{root}/metadata/phy", [("wmoid", "==", 6)]).count() == 0
    assert write_metadata(meta.where("false"), root, "bgc") is None


def test_columns_and_filters(spark, tmp_path):
    path = write_levels(levels_df(spark), str(tmp_path), "phy")
    got = read_levels(spark, path, "phy", ["TEMP", "PSAL"], [("LATITUDE", "<", 10)])
    assert got.columns == ["TEMP", "PSAL"]
    expected = levels_df(spark).where("LATITUDE < 10").count()
    assert got.count() == expected and got.where("PSAL is not null").count() == 0


def test_clustered_write_splits_a_hot_key(spark, tmp_path):
    hot = levels_df(spark, 4000).selectExpr(
        "PLATFORM_NUMBER", "N_PROF", "N_LEVELS", "TEMP",
        "if(TEMP % 3 < 2, 50D, LATITUDE) as LATITUDE",
    )
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path = write_levels(hot, str(tmp_path), "phy", cluster_by=["LATITUDE"], ranges=8)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    sizes, ranges = [], []
    for f in sorted(os.listdir(path)):
        if f.endswith(".parquet"):
            column = pq.read_table(f"{path}/{f}")["LATITUDE"].to_pylist()
            assert column == sorted(column)
            sizes.append(len(column))
            ranges.append((column[0], column[-1]))
    assert sum(sizes) == 4000 and max(sizes) < 1200
    ranges.sort()
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))


def test_file_size_target(spark, tmp_path):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)

    def files(target):
        path = write_levels(
            levels_df(spark, 200_000).repartition(16), str(tmp_path / str(target)), "phy",
            target_file_bytes=target,
        )
        assert read_levels(spark, path, "phy").count() == 200_000
        return sum(f.endswith(".parquet") for f in os.listdir(path))

    assert files(1 << 30) < files(1 << 18)
    assert spark.conf.get(key) == before
    path = write_levels(levels_df(spark, 100).coalesce(1), str(tmp_path), "bgc", max_records_per_file=30)
    assert sum(f.endswith(".parquet") for f in os.listdir(path)) == 4


def test_files_written_elsewhere(spark, tmp_path):
    path = str(tmp_path / "foreign.parquet")
    table = pa.table(
        {
            "TEMP_QC": pa.array([200, None], pa.uint8()),
            "JULD": pa.array([1_700_000_000_000_001_999, None], pa.timestamp("ns")),
            "TEMP": pa.array([1.5, float("nan")], pa.float32()),
        }
    )
    pq.write_table(table, path, version="2.6")
    columns = ["TEMP_QC", "JULD", "TEMP", "PSAL"]
    with pytest.raises(ValueError):
        read_levels(spark, path, "phy", columns, nanosecond_time=True)
    spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    try:
        rows = read_levels(spark, path, "phy", columns, nanosecond_time=True).collect()
        late = read_levels(
            spark, path, "phy", ["TEMP"], [("JULD", ">=", datetime(2023, 1, 1))],
            nanosecond_time=True,
        )
        assert late.count() == 1
    finally:
        spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "false")
    assert [(r.TEMP_QC, r.JULD, r.PSAL) for r in rows] == [
        (200, datetime(2023, 11, 14, 22, 13, 20, 1), None), (None, None, None)
    ]


def test_missing_folder_and_empty_filter(spark, tmp_path):
    with pytest.raises(Exception):
        read_levels(spark, str(tmp_path / "nowhere"), "phy").count()
    with pytest.raises(ValueError):
        filter_rows(levels_df(spark), [])


def tree(root, folders=12, files=5):
    for i in range(folders):
        where = root / f"c{i % 3}" / str(i) / "profiles"
        os.makedirs(where)
        for k in range(files):
            (where / f"{k}_{'Sprof' if k % 2 else 'prof'}.nc").write_bytes(b"x" * (i * 10 + k + 1))
    (root / "_hidden").mkdir()
    (root / "_hidden" / "9_Sprof.nc").write_text("no")
    (root / ".crc").write_text("no")
    return str(root)


def test_listing_equals_binary_files(spark, tmp_path):
    root = tree(tmp_path)
    for glob in (None, "*_Sprof.nc", "[0-2]_*", "{1,3}_Sprof.nc", "none"):
        reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
        if glob is not None:
            reader = reader.option("pathGlobFilter", glob)
        want = reader.load(root).select("path", "length").collect()
        got = file_inventory(spark, root, glob).select("path", "length").collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    assert file_inventory(spark, [f"{root}/c0", f"{root}/c[12]"]).count() == 60
    (tmp_path / "empty.nc").touch()  # which the other source leaves out
    assert file_inventory(spark, root).count() == 61
    assert file_inventory(spark, f"{root}/c0/0/profiles/1_Sprof.nc").count() == 1
    with pytest.raises(FileNotFoundError):
        file_inventory(spark, f"{root}/nowhere")


def test_unreadable_folders_are_rows(spark, tmp_path):
    root = tree(tmp_path, 3, 1)
    folders = spark.createDataFrame([(root,), (f"{root}/gone",), ("nosuch://x/y",)], "path string")
    rows = listing.list_folders(spark, folders).collect()
    assert sorted(bool(r.error) for r in rows) == [False] * 3 + [True] * 2
    assert {r.path for r in rows if r.error} == {f"{root}/gone", "nosuch://x/y"}
    assert all(r.length is None for r in rows if r.error)


def test_packs_are_even(spark):
    """One huge file, some large ones, very many small ones."""
    sizes = [(f"/{i}", 5_000_000 if i == 0 else 400_000 if i < 20 else 100 * (i % 9)) for i in range(6000)]
    files = spark.createDataFrame(sizes, "path string, length bigint")
    dealt = listing.packed(files, pack_bytes=1_000_000, open_bytes=1000)
    assert sorted(map(tuple, dealt.collect())) == sorted(sizes)
    packs = dealt.groupBy(F.spark_partition_id().alias("p")).agg(
        F.sum(F.col("length") + 1000).alias("n"), F.count("*").alias("files"), F.max("length").alias("most")
    ).collect()
    assert [r.files for r in packs if r.most == 5_000_000] == [1]
    rest = sorted(r.n for r in packs if r.most != 5_000_000)
    assert rest[-1] <= 1_400_000 and sum(n > 600_000 for n in rest) >= 0.8 * len(rest)
    assert len(packs) >= sum(s + 1000 for _, s in sizes) // 1_400_000


def test_many_small_files_share_batches_and_packs(spark, tmp_path):
    """Neither a batch for each folder listed, nor a task for each hundred files."""
    root = tree(tmp_path, 40, 1)
    folders = [f"{root}/c{i % 3}/{i}/profiles" for i in range(40)]
    batches = list(listing._listed(iter([pa.RecordBatch.from_pydict({"path": folders})])))
    assert [b.num_rows for b in batches] == [40]
    files = spark.range(20_000).selectExpr("concat('/', id) AS path", "10L AS length")
    packs = listing.packed(files).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in packs) == 20_000 and 16 <= len(packs) <= 40


def test_wanted_files_are_not_listed(spark, blobs, decode_json):
    schema = staged_schema("bgc", ["PRES"])
    names = [(f"file:{blobs}/dac/{i}/{i}_Sprof.nc",) for i in (0, 1, 3, 77)] + [(f"{blobs}/dac",)]
    wanted = spark.createDataFrame(names * 2, "local_path string")
    decoded = decode_files(spark, "/nowhere/at/all", decode_json, schema, files=wanted)
    staged, failed = staged_and_failed(decoded)
    assert sorted(r.PLATFORM_NUMBER for r in staged.collect()) == [0, 0, 1, 1]
    assert {os.path.basename(r.source_file) for r in failed.collect()} == {"3_Sprof.nc", "77_Sprof.nc", "dac"}


def test_batches_go_across_files(spark, tmp_path):
    """Frames of many files, with different columns, arrive whole."""
    for i in range(300):
        (tmp_path / f"{i}_Sprof.nc").write_text(str(i))

    def decode(path, content):
        i = int(content)
        frame = {"N_PROF": list(range(i % 4)), "PLATFORM_NUMBER": [i] * (i % 4)}
        if i % 2:
            frame["PRES"] = [[float(i)]] * (i % 4)
        return pd.DataFrame(frame)

    schema = staged_schema("bgc", ["PRES"])
    staged, failed = staged_and_failed(decode_files(spark, str(tmp_path), decode, schema, "*.nc"))
    want = sorted((i, k, [float(i)] if i % 2 else None) for i in range(300) for k in range(i % 4))
    assert sorted((r.PLATFORM_NUMBER, r.N_PROF, r.PRES) for r in staged.collect()) == want
    assert failed.count() == 0
    assert decode_files(spark, str(tmp_path), decode, schema, "*.txt").count() == 0
