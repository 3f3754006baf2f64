"""Versioned datasets: batches once, no half version, files skipped by their ranges."""

import os
import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import views
from conftest import SF_DIR
from profilelake import schema
from profilelake.functions import curve
from profilelake.operators.filters import filter_rows
from profilelake.schema import SchemaConflict
from profilelake.sources import versions as vs

ROWS = "PLATFORM_NUMBER bigint, LATITUDE double, LONGITUDE double, JULD timestamp_ntz, PRES float, TEMP float"


def levels(spark, n=2000, start=0):
    return spark.range(start, start + n).selectExpr(
        "id AS PLATFORM_NUMBER",
        "if(id % 50 = 0, null, cast(id * 7919 % 1801 AS double) / 10 - 90) AS LATITUDE",
        "cast(id * 104729 % 3601 AS double) / 10 - 180 AS LONGITUDE",
        "timestamp_ntz'2020-01-01' + make_interval(0, 0, 0, cast(id * 31 % 700 AS int)) AS JULD",
        "cast(id % 200 AS float) AS PRES", "cast(id AS float) AS TEMP",
    )


def read(spark, root, **kw):
    return vs.read_version(spark, root, "phy", schema=levels(spark, 1).schema, **kw)


def test_interleaved_bits(spark):
    cells = [(random.Random(i).randrange(65536), i * 13 % 65536, i * 7 % 65536) for i in range(50)]
    df = spark.createDataFrame(cells, "a bigint, b bigint, c bigint")

    def woven(*xs):
        return sum((x >> k & 1) << (len(xs) * k + j) for k in range(16) for j, x in enumerate(xs))

    for names in (["a"], ["a", "b"], ["a", "b", "c"]):
        got = df.select(*names, curve.interleaved([F.col(c) for c in names]).alias("k")).collect()
        assert all(r.k == woven(*(r[c] for c in names)) for r in got)
    with pytest.raises(ValueError):
        curve.interleaved([F.col("a")] * 4)


def test_cells(spark):
    values = [(None,), (float("nan"),), (-5.0,), (0.0,), (5.0,), (10.0,), (99.0,)]
    got = [r.c for r in spark.createDataFrame(values, "v double").select(curve.cell(F.col("v"), 0, 10).alias("c")).collect()]
    assert got == [0, 0, 0, 0, 32767, 65535, 65535]


def test_a_batch_is_added_once(spark, tmp_path):
    root = str(tmp_path)
    assert vs.versions(spark, root, "phy") == []
    assert vs.add_batch(levels(spark), root, "phy", "a") == 1
    assert vs.add_batch(levels(spark, 500, 2000), root, "phy", "b") == 2
    assert vs.add_batch(levels(spark, 500, 2000), root, "phy", "b") == 2
    assert vs.add_batch(levels(spark, 2000), root, "phy", "a") == 2
    assert vs.versions(spark, root, "phy") == [1, 2]
    got = read(spark, root)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, levels(spark, 2500).collect()), key=str)
    assert read(spark, root, version=1).count() == 2000
    # Other flavours are their own datasets.
    assert vs.versions(spark, root, "bgc") == []
    with pytest.raises(FileNotFoundError):
        vs.file_list(spark, root, "bgc")


def test_replace_and_empty_batches(spark, tmp_path):
    root = str(tmp_path)
    vs.add_batch(levels(spark, 0), root, "phy", "none")
    assert read(spark, root).count() == 0 and read(spark, root, filters=[("LATITUDE", ">", 0)]).count() == 0
    assert vs.add_batch(levels(spark, 0), root, "phy", "none") == 1
    vs.add_batch(levels(spark, 100), root, "phy", "a")
    assert vs.add_batch(levels(spark, 50), root, "phy", "c", replace=True) == 3
    assert read(spark, root).count() == 50 and read(spark, root, version=2).count() == 100
    assert vs.add_batch(levels(spark, 50), root, "phy", "c", replace=True) == 3
    assert vs.remove_unlisted(spark, root, "phy", keep=1) == 2
    assert vs.versions(spark, root, "phy") == [3] and read(spark, root).count() == 50


def test_a_run_that_ends_between_data_and_list(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    vs.add_batch(levels(spark, 100), root, "phy", "a")

    def end(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(vs, "_commit", end)
        with pytest.raises(KeyboardInterrupt):
            vs.add_batch(levels(spark, 50, 100), root, "phy", "b")
    assert read(spark, root).count() == 100
    # A list that was begun and not finished is no version, and its number is not used again.
    os.makedirs(tmp_path / "phy-versions" / "lists" / "0000000002")
    assert vs.versions(spark, root, "phy") == [1] and read(spark, root).count() == 100
    assert vs.add_batch(levels(spark, 50, 100), root, "phy", "b") == 3
    assert read(spark, root).count() == 150
    assert vs.remove_unlisted(spark, root, "phy") == 1  # the data of the run that ended


def test_two_writers(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    vs.add_batch(levels(spark, 10), root, "phy", "a")
    seen = vs._numbers(spark, root, "phy")
    vs.add_batch(levels(spark, 10, 10), root, "phy", "b")
    monkeypatch.setattr(vs, "_numbers", lambda *_: seen)
    with pytest.raises(vs.VersionConflict):
        vs.add_batch(levels(spark, 10, 20), root, "phy", "c")


def test_files_are_skipped(spark, tmp_path):
    root = str(tmp_path)
    rows = levels(spark, 20_000)
    vs.add_batch(rows, root, "phy", "a", ranges=64)
    files = vs.file_list(spark, root, "phy")
    assert files.count() >= 50 and files.agg({"rows": "sum"}).first()[0] == 20_000
    box = [("LATITUDE", ">", 30.0), ("LATITUDE", "<=", 45.0), ("LONGITUDE", ">=", -60.0), ("LONGITUDE", "<", -30.0)]
    fitting = vs.fitting_files(files, box).count()
    assert 0 < fitting <= files.count() / 4  # four cuts in each of three columns
    first = rows.agg(F.min("JULD")).first()[0]
    week = [*box, ("JULD", ">=", first), ("JULD", "<", first + timedelta(days=60))]
    assert 0 < vs.fitting_files(files, week).count() <= files.count() / 8
    cases = [
        box,
        week,
        [box, [("JULD", "==", rows.first().JULD)]],
        [("LATITUDE", "in", [12.5, 12.6])], [("LATITUDE", "not in", [12.5])], [("LATITUDE", "in", [None, 3.0])],
        [("TEMP", "<", 5)], [("PRES", ">", 500)], [("PLATFORM_NUMBER", "!=", 3)], [("PRES", "==", 7)],
    ]
    for wanted in cases:
        got = read(spark, root, filters=wanted, columns=["PLATFORM_NUMBER"])
        assert sorted(got.collect()) == sorted(filter_rows(rows, wanted).select("PLATFORM_NUMBER").collect())
    plan = read(spark, root, filters=box)
    assert len(plan.inputFiles()) == fitting
    assert vs.fitting_files(files, [("PRES", ">", 500)]).count() == 0


def test_a_hot_place_is_split(spark):
    rows = levels(spark, 3000).withColumns({"LATITUDE": F.lit(1.0), "LONGITUDE": F.lit(2.0), "JULD": F.lit(None).cast("timestamp_ntz")})
    sizes = vs.along_curve(rows, vs.CURVE, 8).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) >= 6 and max(r["count"] for r in sizes) < 1000


def test_skipping_on_the_given_tables(spark, tmp_path):
    rows = views.observations(spark, SF_DIR)
    vs.add_batch(rows, str(tmp_path), "bgc", "all", ranges=32)
    files = vs.file_list(spark, str(tmp_path), "bgc")
    corner = [("LATITUDE", ">", 65.0), ("LONGITUDE", "<", -60.0)]
    assert vs.fitting_files(files, corner).count() <= files.count() / 2
    got = vs.read_version(spark, str(tmp_path), "bgc", filters=corner, schema=rows.schema)
    assert got.count() == filter_rows(rows, corner).count() > 0


def test_schemas_widen_and_clash(spark, tmp_path):
    root = str(tmp_path)
    one = spark.range(5).selectExpr("id AS PLATFORM_NUMBER", "cast(id AS smallint) AS N", "cast(id AS float) / 4 AS TEMP")
    two = spark.range(5, 9).selectExpr("id AS PLATFORM_NUMBER", "cast(id * 100000 AS int) AS N", "'x' AS NEW")
    vs.add_batch(one, root, "phy", "one")
    vs.add_batch(two, root, "phy", "two")
    got = vs.read_version(spark, root, "phy")
    assert got.dtypes == [("PLATFORM_NUMBER", "bigint"), ("N", "int"), ("TEMP", "double"), ("NEW", "string")]
    rows = {r.PLATFORM_NUMBER: (r.N, r.TEMP, r.NEW) for r in got.collect()}
    assert rows == {i: (i, i / 4, None) for i in range(5)} | {i: (i * 100000, None, "x") for i in range(5, 9)}
    # The version before still has its own schema; a narrower batch later on changes nothing.
    assert vs.read_version(spark, root, "phy", version=1).columns == ["PLATFORM_NUMBER", "N", "TEMP"]
    vs.add_batch(one.selectExpr("PLATFORM_NUMBER + 20 AS PLATFORM_NUMBER", "N"), root, "phy", "three")
    assert vs.read_version(spark, root, "phy").dtypes == got.dtypes
    assert vs.read_version(spark, root, "phy", filters=[("N", ">=", 500000)]).count() == 4
    for bad in ("'a' AS N", "timestamp_ntz'2020-01-01' AS N", "1 AS NEW"):
        with pytest.raises(SchemaConflict):
            vs.add_batch(spark.range(1).selectExpr("id AS PLATFORM_NUMBER", bad), root, "phy", "four")
    assert vs.versions(spark, root, "phy") == [1, 2, 3]
    assert len(os.listdir(tmp_path / "phy-versions" / "data")) == 3


def test_wider_types():
    def wide(a, b):
        return schema.wider_type("c", T._parse_datatype_string(a), T._parse_datatype_string(b)).simpleString()

    pairs = [("short", "int", "int"), ("int", "float", "double"), ("float", "double", "double"), ("byte", "long", "bigint"),
             ("short", "float", "float"), ("string", "string", "string")]
    for a, b, want in pairs:
        assert wide(a, b) == wide(b, a) == want
    for a, b in (("string", "int"), ("long", "float"), ("long", "double"), ("timestamp_ntz", "long")):
        with pytest.raises(SchemaConflict):
            wide(a, b)
