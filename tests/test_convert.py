from datetime import datetime

import pytest

from profilelake.operators.verify import verify_data_modes
from profilelake.plans import convert_profiles, map_data
from profilelake.schema import level_schema
from profilelake.sources import read_levels, read_metadata

SCHEMA = (
    "source_file string, N_PROF bigint, level_count int, PLATFORM_NUMBER bigint, "
    "LATITUDE double, LONGITUDE double, JULD timestamp_ntz, PRES_ADJUSTED array<float>, "
    "CHLA_ADJUSTED array<double>, CHLA_ADJUSTED_QC array<string>, "
    "PARAMETER array<array<string>>, PARAMETER_DATA_MODE array<string>"
)
NAN = float("nan")


def row(file, prof, lat, chla, qc=("1", "2", None), mode="A", second="CHLA"):
    return (
        file, prof, 3, int(file[1:]), lat, -60.0, datetime(2023, 5, prof + 1), [50.0, 150.0, 250.0],
        chla, list(qc), [["CHLA", "PRES"], [second, "PRES"]], [mode, "R"],
    )


@pytest.fixture
def staged(spark):
    return spark.createDataFrame(
        [
            row("f1", 0, 40.0, [1.0, 2.0, 4.0]),
            row("f1", 1, 40.0, [1.0, NAN, None]),
            row("f2", 0, 50.0, [0.5, 0.25, 0.75], mode="AD"),
            row("f3", 0, 50.0, [0.5, 0.25, 0.75], second="X"),
            row("f4", 0, 60.0, [0.0, 8.0]),
        ],
        SCHEMA,
    )


def test_run_and_map(spark, staged, tmp_path):
    metadata = spark.createDataFrame([(1, "f"), (4, "g")], "wmoid int, file string")
    failed = spark.createDataFrame([("f9", "unreadable")], "source_file string, error string")
    done = convert_profiles(staged, str(tmp_path), "bgc", failed=failed, metadata=metadata)
    levels = read_levels(spark, done.levels, "bgc")
    assert levels.schema == level_schema("bgc") and levels.count() == 9
    assert {r.source_file for r in spark.read.parquet(done.quarantine).collect()} == {"f2", "f3", "f9"}
    assert read_metadata(spark, done.metadata, [("wmoid", "in", [4])]).count() == 1
    assert levels.where("isnan(CHLA_ADJUSTED)").count() == 0
    assert levels.where("CHLA_DATA_MODE = 'A' and DOXY_DATA_MODE = ''").count() == 9

    checks = verify_data_modes(
        levels, staged.where("source_file in ('f1', 'f4')"), ["CHLA", "PRES"],
        keys=["PLATFORM_NUMBER", "N_PROF"],
    )
    assert checks.count() == 6 and checks.where("not matches").count() == 0

    found = map_data(
        levels, "CHLA_ADJUSTED", (34, 80), (-78, -50),
        (datetime(2023, 1, 1), datetime(2023, 12, 31)), (100, 300), q=(0.0, 1.0),
    )
    assert {r.LATITUDE: r.CHLA_ADJUSTED for r in found.means.collect()} == {40.0: 3.0, 60.0: 8.0}
    assert tuple(found.limits.first()) == (2.0, 8.0)


def test_values_that_do_not_fit(spark, staged, tmp_path):
    bad = staged.union(
        spark.createDataFrame([row("f5", 0, 1.0, [1.0], qc=("1", "bad", "1"))], SCHEMA)
    )
    with pytest.raises(Exception):
        convert_profiles(bad, str(tmp_path / "a"), "bgc")
    nulled = convert_profiles(bad, str(tmp_path / "b"), "bgc", on_error="null")
    assert read_levels(spark, nulled.levels, "bgc").count() == 12
    aside = convert_profiles(bad, str(tmp_path / "c"), "bgc", on_error="quarantine")
    assert read_levels(spark, aside.levels, "bgc").count() == 9
    reasons = {r.source_file: r.error for r in spark.read.parquet(aside.quarantine).collect()}
    assert set(reasons) == {"f2", "f3", "f5"} and "CHLA_ADJUSTED_QC" in reasons["f5"]
    with pytest.raises(ValueError):
        convert_profiles(staged, str(tmp_path), "bgc", on_error="skip")


def test_append_uses_the_failures_of_its_own_batch(spark, staged, tmp_path):
    root = str(tmp_path)
    convert_profiles(staged, root, "bgc")
    repaired = spark.createDataFrame([row("f2", 0, 50.0, [1.0])], SCHEMA)
    done = convert_profiles(repaired, root, "bgc", mode="append")
    assert read_levels(spark, done.levels, "bgc").count() == 12
    replaced = convert_profiles(repaired, root, "bgc", drop_padding=True)
    assert read_levels(spark, replaced.levels, "bgc").count() == 3


def test_core_has_no_mode_columns(spark, staged, tmp_path):
    done = convert_profiles(staged, str(tmp_path), "phy")
    levels = read_levels(spark, done.levels, "phy")
    # Modes of unknown parameters are not checked, calibrations still are.
    assert levels.count() == 12 and len(levels.columns) == 26
    assert spark.read.parquet(done.quarantine).count() == 1
