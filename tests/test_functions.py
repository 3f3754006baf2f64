import random
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from profilelake import functions as PF


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kathmandu"])
@pytest.mark.parametrize(
    "text, expected",
    [
        ("20200229010203", datetime(2020, 2, 29, 1, 2, 3)),
        ("20210314023000", datetime(2021, 3, 14, 2, 30)),  # does not exist in New York
        ("20210229010203", None),
        ("20201301000000", None),
        ("2020", None),
        ("", None),
        ("n/a", None),
        (None, None),
    ],
)
def test_compact_timestamp(spark, session_zone, zone, text, expected):
    session_zone(zone)
    assert one(spark, PF.compact_timestamp(F.lit(text).cast("string"))) == expected


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_utc_and_nanoseconds(spark, session_zone, zone):
    session_zone(zone)
    instant = F.timestamp_micros(F.lit(1_700_000_000_000_001))
    assert one(spark, PF.utc_ntz(instant)) == datetime(2023, 11, 14, 22, 13, 20, 1)
    nanos = PF.nanoseconds_to_ntz(F.lit(1_700_000_000_000_001_999))
    assert one(spark, nanos) == datetime(2023, 11, 14, 22, 13, 20, 1)
    before = PF.nanoseconds_to_ntz(F.lit(-1).cast("bigint"))
    assert one(spark, before) == datetime(1969, 12, 31, 23, 59, 59, 999999)


def test_path_parts(spark):
    rows = [
        ("aoml/1900722/profiles/SR1900722_007D.nc",),
        ("x/bodc/12/profiles/12_100.nc.gz",),
        ("aoml/1900722/1900722_prof.nc",),
        ("aoml/1900722/profiles/R_001.nc",),
        (None,),
    ]
    got = (
        spark.createDataFrame(rows, "file string")
        .select("file", PF.profile_path("file").alias("path"))
        .select(
            PF.wmoid("path"), PF.cycle("path"), PF.filepath_main("path"), PF.filepath("path"),
            PF.filename("path"), PF.path_tail("file"),
        )
    )
    assert [tuple(r) for r in got.collect()] == [
        (1900722, 7, "aoml/1900722/", "aoml/1900722/profiles/", "SR1900722_007D.nc",
         "1900722/profiles/SR1900722_007D.nc"),
        (12, 100, "bodc/12/", "bodc/12/profiles/", "12_100.nc", "12/profiles/12_100.nc.gz"),
        (None, None, None, None, None, "aoml/1900722/1900722_prof.nc"),
        (None, 1, "aoml/1900722/", "aoml/1900722/profiles/", "R_001.nc",
         "1900722/profiles/R_001.nc"),
        (None, None, None, None, None, None),
    ]


def test_path_parts_like_one_pattern_per_part(spark):
    """Random paths, against the groups of a single pattern."""
    grouped = re.compile(r"(([a-z]*/[0-9]*/)profiles/)([A-Z]*([0-9]*)_([0-9]*)[A-Z]*.nc)")
    rng = random.Random(1)
    pieces = ["a", "/", "12", "/profiles/", "profiles", "R", "SD", "_", "007", "D", ".nc", "nc", "x"]
    usual = ["ab", "/", "12", "/profiles/", "R", "12", "_", "007", "D", ".nc"]
    paths = ["".join(rng.choices(pieces, k=rng.randint(3, 14))) for _ in range(1000)]
    for _ in range(2000):
        path = list(usual)
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(path))
            path[at : at + rng.randint(0, 1)] = [rng.choice(pieces)]
        paths.append("".join(path))

    def parts(path):
        m = grouped.search(path)
        if m is None:
            return (path, None, None, None, None, None)
        number = [int(m[i]) if m[i] else None for i in (4, 5)]
        return (path, *number, m[2], m[1], m[3])

    got = (
        spark.createDataFrame([(p,) for p in paths], "file string")
        .select("file", PF.profile_path("file").alias("path"))
        .select(
            "file", PF.wmoid("path"), PF.cycle("path"), PF.filepath_main("path"),
            PF.filepath("path"), PF.filename("path"),
        )
    )
    assert [tuple(r) for r in got.collect()] == [parts(p) for p in paths]


def test_strip(spark):
    assert one(spark, PF.strip(F.lit(" \t\nTEMP x \r\n"))) == "TEMP x"


def test_valid_and_nan(spark):
    nan, inf = float("nan"), float("inf")
    values = [None, nan, inf, -inf, 0.0, 1e30, 1.1e30]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r.v for r in df.where(PF.is_valid("v")).collect()] == [0.0, 1e30]
    assert [r.x for r in df.select(PF.nan_to_null("v").alias("x")).collect()] == [
        None, None, inf, -inf, 0.0, 1e30, 1.1e30
    ]


def test_longitudes(spark):
    assert PF.longitude_bounds(None) == (-180, 180)
    assert PF.longitude_bounds([0, 360]) == (-180, 180)
    assert PF.longitude_bounds([-180, 180]) == (-180, 180)
    assert PF.longitude_bounds([190, 200]) == (-170, -160)
    assert PF.longitude_bounds([170, 190]) == (170, -170)
    given = [170, 190]
    PF.longitude_bounds(given)
    assert given == [170, 190]
    assert one(spark, PF.normalize_longitude(F.lit(350.0))) == -10
    assert one(spark, PF.normalize_longitude(F.lit(180.0))) == 180
