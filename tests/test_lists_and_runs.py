"""Typed and pushed list filters, float lists, one-pass plans, runs over both databases."""

import random
from datetime import datetime

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from checks import catalogue
from checks import views as V
from conftest import SF_DIR
from profilelake.flavour import BIOGEOCHEMICAL, CORE
from profilelake.operators import aggregate, subset
from profilelake.operators.filters import filter_rows
from profilelake.plans import convert_mirror, convert_profiles
from profilelake.schema import staged_schema
from profilelake.sources import read_levels, read_metadata, write_levels
from profilelake.sources import tables
from profilelake.sources.tables import range_count

NAN = float("nan")


@pytest.fixture(scope="module")
def narrow(tmp_path_factory):
    """A table of narrow types, with nulls and NaN."""
    rng = random.Random(2)
    n = 400

    def some(values):
        return [rng.choice(values) for _ in range(n)]

    days = [datetime(2024, 1, d) for d in (1, 2, 3)]
    table = pa.table({
        "f": pa.array(some([0.1, 0.2, 1.5, NAN, None]), pa.float32()),
        "d": pa.array(some([0.1, 0.2, 1.5, NAN, None]), pa.float64()),
        "s": pa.array(some([1, 2, -3, None]), pa.int16()),
        "i": pa.array(some([1, 2, 70000, None]), pa.int32()),
        "t": pa.array(some([*days, None]), pa.timestamp("us")),
        "k": pa.array(range(n), pa.int64()),
    })
    path = str(tmp_path_factory.mktemp("narrow") / "t.parquet")
    pq.write_table(table, path)
    return path


VALUES = {
    "f": [0.1, 0.2, 1.5, 7.0], "d": [0.1, 0.2, 1.5], "s": [1, 2, -3], "i": [1, 2, 70000],
    "t": [pd.Timestamp("2024-01-01"), pd.Timestamp("2024-01-02"), pd.Timestamp("2024-01-09")],
}


def test_random_lists_agree_with_pyarrow(spark, narrow):
    rng = random.Random(7)
    df = spark.read.parquet(narrow)

    def predicate():
        name = rng.choice(list(VALUES))
        op = rng.choice(["in", "in", "==", "<", "<=", ">", ">="])
        listed = rng.sample(VALUES[name], rng.randint(1, 2))
        own = [v.to_pydatetime() if name == "t" else v for v in listed]
        return (name, op, own if op == "in" else own[0])

    for _ in range(60):
        filters = [[predicate() for _ in range(rng.randint(1, 2))] for _ in range(rng.randint(1, 3))]
        table = pq.read_table(narrow)
        kept = pa.array([False] * table.num_rows)
        for group in filters:
            mask = pa.array([True] * table.num_rows)
            for name, op, value in group:
                column = table[name].combine_chunks()
                values = value if op == "in" else [value]
                values = pa.array(values, column.type)
                if op == "in":
                    found = pa.compute.is_in(column, values)
                else:
                    call = {"==": "equal", "<": "less", "<=": "less_equal", ">": "greater",
                            ">=": "greater_equal"}[op]
                    found = getattr(pa.compute, call)(column, values[0]).fill_null(False)
                mask = pa.compute.and_(mask, found)
            kept = pa.compute.or_(kept, mask)
        want = table.filter(kept)["k"].to_pylist()
        # A float column is compared with a double literal: only lists take its type.
        if any(n == "f" and op != "in" for g in filters for n, op, _ in g):
            continue
        assert sorted(r.k for r in filter_rows(df, filters).select("k").collect()) == want, filters


def test_not_in_keeps_nulls_unless_listed(spark, narrow):
    df = spark.read.parquet(narrow)
    total, null = df.count(), df.where("s is null").count()
    ones = df.where("s = 1").count()
    assert filter_rows(df, [("s", "not in", [1])]).count() == total - ones
    assert filter_rows(df, [("s", "not in", [1, None])]).count() == total - ones - null
    assert filter_rows(df, [("s", "in", [1.5, 10**9])]).count() == 0
    nan = df.where("isnan(f)").count()
    assert filter_rows(df, [("f", "in", [NAN])]).count() == nan
    assert filter_rows(df, [("f", "not in", [NAN])]).count() == total - nan
    assert filter_rows(df, [("f", "in", [np.float32(0.1)])]).count() == df.where("f = float(0.1)").count()


def pushed(df, capsys):
    df.explain()
    line = next(x for x in capsys.readouterr().out.splitlines() if "PushedFilters" in x)
    return line.split("PushedFilters: ")[1].split(", ReadSchema")[0]


def test_lists_reach_the_scan(spark, narrow, capsys):
    df = spark.read.parquet(narrow)
    assert "In(i, [1,2])" in pushed(filter_rows(df, [("i", "in", [1, 2])]), capsys)
    text = pushed(filter_rows(df, [("i", "not in", [1, 2])]), capsys)
    assert "IsNull(i)" in text and "Not(In(i, [1,2]))" in text
    text = pushed(filter_rows(df, [[("d", ">", 1.0)], [("i", "in", [1, 2])]]), capsys)
    assert "Or(And(GreaterThan(d,1.0),LessThanOrEqual(d,Infinity)),In(i, [1,2]))" in text
    text = pushed(filter_rows(df, [[("f", ">=", 1.0)], [("f", "<", 0.5)]]), capsys)
    assert "Or(And(GreaterThanOrEqual(f,1.0),LessThanOrEqual(f,Infinity)),LessThan(f,0.5))" in text


def test_float_lists_of_any_kind(spark):
    index = spark.range(3000).selectExpr("id + 1900000 as wmoid", "id")
    ids = np.arange(1900000, 1901500)
    assert subset.subset_floats(index, ids).count() == 1500
    assert subset.subset_floats(index, [str(i) for i in ids]).count() == 1500
    assert subset.subset_floats(index, np.int64(1900007)).count() == 1
    assert subset.subset_floats(index, "1900007").count() == 1
    assert subset.subset_floats(index, []).count() == 0


def test_refresh_plan_joins_the_inventory_once(spark, capsys):
    catalogue.refresh_plan(spark, SF_DIR).explain()
    text = capsys.readouterr().out
    assert text.count("FileScan") + text.count("BatchScan") <= 4
    assert text.count("HashJoin") + text.count("SortMergeJoin") <= 3


def staged_frame(spark, platform):
    rows = [("f%d" % k, k, 1, platform + k, [float(k)]) for k in range(6)]
    return spark.createDataFrame(
        rows, "source_file string, N_PROF bigint, level_count int, PLATFORM_NUMBER bigint, PRES array<float>"
    )


def test_appends_keep_both_batches_metadata(spark, tmp_path):
    root = str(tmp_path / "d")
    for platform, mode in ((100, "overwrite"), (200, "append")):
        facts = spark.createDataFrame([(platform,)], "wmoid bigint")
        done = convert_profiles(staged_frame(spark, platform), root, "phy", metadata=facts, mode=mode)
    assert sorted(r.wmoid for r in read_metadata(spark, done.metadata).collect()) == [100, 200]
    assert read_levels(spark, done.levels, "phy").count() == 12


def test_a_failed_run_leaves_the_old_dataset(spark, tmp_path):
    root = str(tmp_path / "d")
    done = convert_profiles(staged_frame(spark, 100), root, "phy")
    bad = staged_frame(spark, 7).withColumn("PLATFORM_NUMBER", F.lit("not a number"))
    with pytest.raises(Exception):
        convert_profiles(bad, root, "phy")
    assert read_levels(spark, done.levels, "phy").count() == 6


def test_ranges_follow_the_size(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.range(200_000).selectExpr(
        "id as PLATFORM_NUMBER", "id as N_PROF", "0L as N_LEVELS", "rand(3) * 90 as LATITUDE"
    ).write.parquet(path)
    rows = spark.read.parquet(path)
    few, many = range_count(rows, 1 << 30), range_count(rows, 1 << 18)
    assert few == 1 and many > 5
    out = write_levels(rows, str(tmp_path / "out"), "phy", target_file_bytes=1 << 18, cluster_by=["LATITUDE"])
    assert len(list((tmp_path / "out" / "phy").glob("part-*"))) == many
    assert spark.read.parquet(out).count() == 200_000
    # Profiles are dealt into ranges before they become levels.
    done = convert_profiles(staged_frame(spark, 1), str(tmp_path / "c"), "phy", cluster_by=["PLATFORM_NUMBER"])
    assert read_levels(spark, done.levels, "phy").count() == 6


@pytest.mark.parametrize("approximate", [False, True])
def test_quantiles_must_be_shares(spark, approximate):
    with pytest.raises(ValueError):
        aggregate.quantile_limits(spark.range(5).toDF("v"), "v", (0.5, 1.5), approximate=approximate)


def test_only_chosen_files_are_decoded_for_both_databases(spark, tmp_path):
    local, opened = tmp_path / "dac", tmp_path / "opened"
    opened.mkdir()
    for suffix in ("_prof.nc", "_Sprof.nc"):
        for wmoid in (1900001, 1900002, 1900003):
            folder = local / "aoml" / str(wmoid)
            folder.mkdir(parents=True, exist_ok=True)
            (folder / f"{wmoid}{suffix}").write_text(f"{wmoid},1")
    index = tmp_path / "index"
    index.mkdir()
    head = "file,date,latitude,longitude,ocean,profiler_type,institution,"
    for name, extra in ((CORE.index_file, ""), (BIOGEOCHEMICAL.index_file, "parameters,parameter_data_mode,")):
        lines = ["# one", "# two", head + extra + "date_update"]
        for wmoid, lat in ((1900001, 10.0), (1900002, 50.0), (1900009, 11.0)):
            cells = [f"aoml/{wmoid}/profiles/R{wmoid}_001.nc", "20200101000000", lat, 5.0, "A", 846, "AO"]
            cells += ["PRES TEMP", "RR"] if extra else []
            lines.append(",".join(map(str, [*cells, "20200102000000"])))
        (index / name).write_text("\n".join(lines) + "\n")

    def decode(path, content):
        (opened / path.rsplit("/", 1)[1]).touch()
        wmoid, value = content.decode().split(",")
        return pd.DataFrame({"N_PROF": [0], "level_count": 1, "PLATFORM_NUMBER": int(wmoid), "PRES": [[float(value)]]})

    remote = spark.createDataFrame([], "url string, remote_mtime timestamp_ntz, status int")
    runs = convert_mirror(
        spark, str(index), f"file:{local}", "https://host/dac", remote, decode, str(tmp_path / "out"),
        str(tmp_path / "staged"), subset={"lat_range": [0, 20]}, schema=staged_schema("phy", ["PRES"]),
    )
    assert set(runs) == {"phy", "bgc"}
    assert {p.name for p in opened.iterdir()} == {"1900001_prof.nc", "1900001_Sprof.nc"}
    for name, run in runs.items():
        levels = read_levels(spark, run.conversion.levels, name)
        assert [r.PLATFORM_NUMBER for r in levels.collect()] == [1900001]
        (failed,) = spark.read.parquet(run.conversion.quarantine).collect()
        assert "1900009" in failed.source_file and "not in the inventory" in failed.error
        assert read_metadata(spark, run.conversion.metadata).count() == 2


def test_shared_folder(spark):
    from types import SimpleNamespace

    from profilelake.sources.stored import shared_folder

    def session(setting, master, checkpoint=None):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: checkpoint)
        return SimpleNamespace(conf={"spark.checkpoint.dir": setting}, sparkContext=context)

    assert shared_folder(spark)
    assert shared_folder(session("s3a://b/x/", "spark://h")) == "s3a://b/x"
    assert shared_folder(session(None, "spark://h", "hdfs:/c")) == "hdfs:/c"
    with pytest.raises(ValueError):
        shared_folder(session(None, "spark://h"))


def test_views_cover_whole_tables(spark):
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    held = V.parameters(spark, SF_DIR).selectExpr("sum(size(TEMP))").first()[0]
    assert held == events.count()


def test_written_rows_are_dealt_by_profile(spark, tmp_path):
    """Dealt by a hash, not in turn: nothing is sorted and the levels of a profile stay together."""
    rows = spark.range(40_000).selectExpr(
        "id % 400 AS N_PROF", "id DIV 400 AS N_LEVELS", "1 AS PLATFORM_NUMBER", "2 AS CYCLE_NUMBER", "rand() AS TEMP"
    )
    out = tables.write_levels(rows, str(tmp_path), "phy", target_file_bytes=1 << 20, ranges=5)
    found = spark.read.parquet(out).selectExpr("N_PROF", "_metadata.file_path AS file")
    assert found.count() == 40_000 and found.select("file").distinct().count() == 5
    assert found.distinct().count() == 400


def test_sorted_ranges_do_not_grow_with_the_input(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "SORTED_BYTES", 4096)
    spark.range(300_000).selectExpr("rand() AS LATITUDE").write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    total = tables._input_bytes(rows)
    assert range_count(rows, None) == -(-total // 4096) > 8
