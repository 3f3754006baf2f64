"""Flatten, data modes and quarantine, against plain loops over the same profiles."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from profilelake.operators import datamode, quarantine
from profilelake.operators.flatten import flatten_levels
from profilelake.operators.verify import verify_data_modes

KNOWN = ["PRES", "TEMP", "PSAL"]
SCHEMA = (
    "source_file string, N_PROF bigint, level_count int, JULD timestamp_ntz, "
    "PRES array<float>, TEMP array<float>, TEMP_QC array<smallint>, "
    "PARAMETER array<array<string>>, PARAMETER_DATA_MODE array<string>"
)
NAN = float("nan")
DAY = datetime(2020, 1, 1)


def profile(file="f", prof=0, count=3, names=None, modes=None, pres=(1.0, 2.0, 3.0), second=None):
    calibrations = None if names is None else [names, second if second is not None else names]
    return (file, prof, count, DAY, list(pres) if pres is not None else None,
            [10.0], [1, None, 3], calibrations, modes)


def stage(spark, *profiles):
    return spark.createDataFrame(list(profiles), SCHEMA)


def test_padding_levels_are_kept(spark):
    df = stage(spark, profile(prof=0), profile(prof=1, pres=[5.0]))
    rows = flatten_levels(df).orderBy("N_PROF", "N_LEVELS").collect()
    assert [(r.N_PROF, r.N_LEVELS, r.PRES, r.TEMP, r.TEMP_QC) for r in rows] == [
        (0, 0, 1.0, 10.0, 1), (0, 1, 2.0, None, None), (0, 2, 3.0, None, 3),
        (1, 0, 5.0, 10.0, 1), (1, 1, None, None, None), (1, 2, None, None, 3),
    ]
    assert {r.JULD for r in rows} == {DAY}


def test_drop_padding(spark):
    df = stage(spark, profile(pres=[1.0, NAN, NAN]), profile(prof=1, count=5, pres=None))
    full, kept = flatten_levels(df), flatten_levels(df, drop_padding=True)
    assert full.count() == 8
    assert sorted((r.N_PROF, r.N_LEVELS) for r in kept.collect()) == [(0, 0), (0, 2), (1, 0), (1, 2)]
    assert kept.exceptAll(full).count() == 0


def test_files_without_levels_and_overlong_arrays(spark):
    df = stage(spark, profile(count=0), profile(file="g", count=2), profile(file="h", count=None))
    rows = [(r.source_file, r.N_LEVELS) for r in flatten_levels(df).collect()]
    assert sorted(rows) == [(f, k) for f in "fgh" for k in range(3)]
    bad = {r.source_file: r.error for r in quarantine.failed_checks(df, KNOWN).collect()}
    assert bad == dict.fromkeys("fgh", quarantine.LEVELS_ERROR)


def test_sound_files_keep_every_value(spark):
    df = stage(spark, profile(), profile(file="g", prof=1))
    assert quarantine.failed_checks(df, KNOWN).isEmpty()
    values = df.selectExpr("sum(size(filter(PRES, p -> p is not null)))").first()[0]
    assert flatten_levels(df).where("PRES is not null").count() == values


def test_wanted_columns(spark):
    got = flatten_levels(stage(spark, profile()), wanted=["PRES", "JULD", "absent"])
    assert got.columns == ["source_file", "N_PROF", "JULD", "N_LEVELS", "PRES"]


def test_three_states_of_a_data_mode(spark):
    df = stage(
        spark,
        profile(prof=0),
        profile(prof=1, names=["  TEMP\t", "FOO", "   ", "TEMP"], modes=["R", "A", "D", " D "]),
        profile(prof=2, names=["PSAL"], modes=["A"]),
        profile(prof=3, names=[], modes=[]),
    )
    got = datamode.spread_data_modes(df, KNOWN).orderBy("N_PROF").collect()
    assert [(r.PRES_DATA_MODE, r.TEMP_DATA_MODE, r.PSAL_DATA_MODE) for r in got] == [
        (None, None, None), ("", "D", ""), ("", "", "A"), ("", "", "")
    ]
    assert [tuple(r) for r in datamode.unknown_parameters(df, KNOWN).collect()] == [
        ("f", "FOO_DATA_MODE")
    ]


def test_profiles_staged_without_names_and_modes(spark):
    df = stage(spark, profile()).drop("PARAMETER", "PARAMETER_DATA_MODE")
    spread = datamode.spread_data_modes(df, KNOWN)
    assert spread.columns == [*df.columns, *(f"{p}_DATA_MODE" for p in KNOWN)]
    assert spread.first().TEMP_DATA_MODE is None
    sound, failed = quarantine.quarantine(df, KNOWN)
    assert sound.count() == 1 and failed.count() == 0
    assert datamode.calibration_invariant(df).first().invariant
    assert datamode.unknown_parameters(df, KNOWN).count() == 0


def test_mode_is_the_same_on_every_level(spark):
    df = stage(spark, profile(names=["TEMP"], modes=["A"], count=4))
    rows = flatten_levels(datamode.spread_data_modes(df, KNOWN)).collect()
    assert [r.TEMP_DATA_MODE for r in rows] == ["A"] * 4


def test_checks_and_quarantine(spark):
    df = stage(
        spark,
        profile(file="fine", names=["TEMP"], modes=["R"]),
        profile(file="long", prof=0, names=["TEMP"], modes=["R"]),
        profile(file="long", prof=1, names=["TEMP"], modes=["RD"]),
        profile(file="unknown", names=["FOO"], modes=["RD"]),
        profile(file="varies", names=["TEMP"], modes=["RD"], second=["PSAL"]),
        profile(file="no modes", names=["TEMP"], modes=None, second=["PSAL"]),
        profile(file="nothing"),
    )
    sound, failed = quarantine.quarantine(df, KNOWN)
    assert {r.source_file: r.error for r in failed.collect()} == {
        "long": datamode.DATA_MODE_ERROR, "varies": datamode.CALIBRATION_ERROR
    }
    assert sound.columns == df.columns
    assert sorted(r.source_file for r in sound.collect()) == ["fine", "no modes", "nothing", "unknown"]
    invariant = {r.source_file: r.invariant for r in datamode.calibration_invariant(df).collect()}
    assert [k for k, v in invariant.items() if not v] == ["varies"] and len(invariant) == 6
    valid = {r.source_file: r.valid for r in datamode.data_modes_valid(df, KNOWN).collect()}
    assert sorted(k for k, v in valid.items() if not v) == ["long", "varies"]
    outcome = df.select("source_file", F.lit(None).cast("string").alias("error")).union(failed)
    rate = quarantine.failure_rate(outcome).first()
    assert (rate.files, rate.failed, round(rate.failed_percent, 3)) == (6, 2, 33.333)
    none = quarantine.failure_rate(outcome.where("false")).first()
    assert (none.files, none.failed, none.failed_percent) == (0, 0, None)


def test_random_profiles_like_a_loop(spark):
    rng = random.Random(7)
    pool = ["PRES", " TEMP ", "PSAL", "TEMP", "BAR", "", "  "]
    profiles, expected = [], {}
    for i in range(60):
        names = [rng.choice(pool) for _ in range(rng.randint(0, 6))]
        modes = [rng.choice(["R", "A ", " D", ""]) for _ in names] if i % 5 else None
        profiles.append(profile(file=f"f{i % 7}", prof=i, names=names, modes=modes))
        state = dict.fromkeys(KNOWN, None if modes is None else "")
        for name, mode in zip(names, modes or []):
            if name.strip() in state:
                state[name.strip()] = mode.strip()
        expected[i] = tuple(state.values())
    spread = datamode.spread_data_modes(stage(spark, *profiles), KNOWN)
    got = {r.N_PROF: tuple(r[f"{p}_DATA_MODE"] for p in KNOWN) for r in spread.collect()}
    assert got == expected


@pytest.fixture
def converted(spark):
    staged = stage(
        spark,
        profile(file="a", prof=0, names=["TEMP", "PSAL", "TEMP", "FOO"], modes=["R", "A", "D", "R"]),
        profile(file="a", prof=1, names=["PRES"], modes=[""]),
        profile(file="b", prof=0),
        profile(file="c", prof=0, count=0, names=["PRES"], modes=["R"]),
    )
    return staged, flatten_levels(datamode.spread_data_modes(staged, KNOWN))


def test_verify_true(converted):
    staged, levels = converted
    got = verify_data_modes(levels, staged, KNOWN).orderBy("source_file", "N_PROF", "parameter")
    assert [tuple(r) for r in got.collect()] == [
        ("a", 0, "PSAL", True), ("a", 0, "TEMP", True), ("a", 1, "PRES", True),
        ("c", 0, "PRES", True),
    ]


@pytest.mark.parametrize("wrong", ["'X'", "'DD'", "''", "cast(null as string)"])
def test_verify_false_when_one_level_differs(converted, wrong):
    staged, levels = converted
    damaged = levels.withColumn(
        "TEMP_DATA_MODE",
        F.when(F.col("N_LEVELS") == 1, F.expr(wrong)).otherwise(F.col("TEMP_DATA_MODE")),
    )
    got = {(r.source_file, r.N_PROF, r.parameter): r.matches
           for r in verify_data_modes(damaged, staged, KNOWN).collect()}
    assert got[("a", 0, "TEMP")] is False and got[("a", 0, "PSAL")] is True
