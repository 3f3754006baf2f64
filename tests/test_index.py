from datetime import datetime

import pytest

from profilelake.operators import subset
from profilelake.schema import index_schema, metadata_schema
from profilelake.sources import enrich_index, index_rejects, read_index, split_rejects
from profilelake.sources.index import parse_dates

PREAMBLE = "".join(f"# line {i}\n" for i in range(8))
CORE_HEADER = "file,date,latitude,longitude,ocean,profiler_type,institution,date_update\n"
ROWS = [
    "aoml/13857/profiles/R13857_001.nc,20200101120000,10.5,175.25,P,845,AO,20200201000000",
    "aoml/13857/profiles/R13857_002D.nc,,10.5,-175.25,P,845,AO,20200202000000",
    "bodc/13857/profiles/D13857_003.nc,20200103000000,,20.0,A,845,BO,",
    "bodc/77/profiles/D77_003.nc,20210103000000,-90,180,A,845,BO,20210203000000",
    "somewhere/else.nc,20200103000000,1.0,20.0,A,845,BO,20200203000000",
]


@pytest.fixture
def index(spark, tmp_path):
    (tmp_path / "ar_index_global_prof.txt").write_text(
        PREAMBLE + CORE_HEADER + "\n".join(ROWS) + "\n"
    )
    return read_index(spark, str(tmp_path), "phy")


def files(df):
    return sorted(r.file.split("/")[-1] for r in df.select("file").collect())


def test_scan(index):
    rows = index.collect()
    assert len(rows) == 5
    assert rows[0].date == datetime(2020, 1, 1, 12) and rows[0].institution == "AO"
    assert rows[1].date is None and rows[2].latitude is None and rows[2].date_update is None


def test_header_is_checked(spark, tmp_path):
    (tmp_path / "ar_index_global_prof.txt").write_text(PREAMBLE + CORE_HEADER.replace(
        "latitude,longitude", "longitude,latitude") + ROWS[0] + "\n")
    with pytest.raises(Exception):
        read_index(spark, str(tmp_path), "phy").collect()


def test_unknown_flavour_raises_before_any_job(spark, tmp_path):
    with pytest.raises(ValueError):
        read_index(spark, str(tmp_path), "xyz")


def test_enrich_and_rejects(index):
    usable, rejects = split_rejects(enrich_index(index))
    assert files(rejects) == ["else.nc"]
    assert [(r.wmoid, r.cycle, r.filepath_main) for r in usable.orderBy("cycle", "wmoid").collect()] == [
        (13857, 1, "aoml/13857/"), (13857, 2, "aoml/13857/"),
        (77, 3, "bodc/77/"), (13857, 3, "bodc/13857/"),
    ]


def test_subsets(index):
    usable, _ = split_rejects(enrich_index(index))
    assert files(subset.subset_index(usable, "phy")) == ["D77_003.nc", "R13857_001.nc"]
    assert files(subset.subset_area(usable, lon_range=[170, 190])) == [
        "D77_003.nc", "R13857_001.nc", "R13857_002D.nc"
    ]
    assert files(subset.subset_area(usable, lat_range=[-90, -90])) == ["D77_003.nc"]
    assert files(subset.subset_floats(usable, 77)) == ["D77_003.nc"]
    many = list(range(100, 3000)) + [77]
    assert files(subset.subset_floats(usable, many)) == ["D77_003.nc"]
    assert files(subset.subset_dates(usable, end=datetime(2020, 12, 31))) == [
        "D13857_003.nc", "R13857_001.nc"
    ]
    with pytest.raises(ValueError):
        subset.subset_index(usable, "phy", sensors="DOXY")


def test_wrap_and_complement_cover_every_positioned_row(spark):
    df = spark.range(-1800, 1801).selectExpr("id / 10 as longitude", "0.0D as latitude")
    inside = subset.subset_area(df, lon_range=[170, -170])
    outside = df.where("longitude > -170 and longitude < 170")
    assert inside.count() + outside.count() == df.count()
    assert inside.intersect(outside).count() == 0


def test_sensors(spark):
    rows = [("PRES CHLA",), ("PRES CHLA_FLUORESCENCE",), ("PRES",), (None,)]
    df = spark.createDataFrame(rows, "parameters string")
    assert subset.subset_sensors(df, "CHLA").count() == 2
    assert subset.subset_sensors(df, "CHLA", exact=True).count() == 1
    assert subset.subset_sensors(df, ["PRES", "CHLA_F"]).count() == 1


def test_float_list_keeps_moved_floats_and_first_row(spark):
    rows = [("b/1/", 1, 5), ("a/1/", 1, 3), ("a/1/", 2, 4), (None, None, 0)]
    df = spark.createDataFrame(rows, "filepath_main string, wmoid int, ord int")
    expected = [("a/1/", 1), ("b/1/", 1)]
    assert [tuple(r) for r in subset.float_list(df, "ord").collect()] == expected
    assert [tuple(r) for r in subset.float_list(df).collect()] == expected
    reverse = df.selectExpr("filepath_main", "wmoid", "-ord as ord")
    assert [tuple(r) for r in subset.float_list(reverse, "ord").collect()][0] == ("a/1/", 2)


def test_metadata_schema_is_that_of_an_enriched_index(spark):
    for db in ("phy", "bgc"):
        text = spark.createDataFrame([], index_schema(db))
        assert enrich_index(parse_dates(text)).dtypes == [(f.name, f.dataType.simpleString()) for f in metadata_schema(db)]


def test_rejects_do_not_depend_on_the_columns_read(spark, tmp_path):
    names = index_schema("phy").names
    good = ["a/1/profiles/R1_1.nc", "20200101000000", "1.5", "2.5", "A", "846", "AO", "20200102000000"]
    lines = ["# preamble", ",".join(names), ",".join(good), ",".join(good[:3]), ",".join([*good, "more"]),
             ",".join([*good[:2], "deep", *good[3:]]), '"' + good[0] + '",' + ",".join(good[1:]),
             ",".join([*good[:1], "", "", "", "", "", "", ""])]
    path = tmp_path / "index.txt"
    path.write_text("\n".join(lines) + "\n")
    index = read_index(spark, str(path), "phy")
    assert index.count() == 3 and index.select("file").count() == 3
    assert index.where("latitude = 1.5").select("date").count() == 2
    rejects = index_rejects(spark, str(path), "phy").collect()
    assert sorted(r.line for r in rejects) == sorted(lines[3:6])
    assert {r.file for r in rejects} == {good[0]}
