"""Streams against whole conversions, restarts, and sketches against exact ranks."""

import random

import pytest
from pyspark.sql import functions as F

from checks import views
from conftest import SF_DIR
from profilelake.operators import sketches
from profilelake.plans import convert_arriving, convert_profiles
from profilelake.sources import read_levels, read_version
from profilelake.sources import versions as vs

COLUMNS = ["PLATFORM_NUMBER", "N_PROF", "N_LEVELS", "PRES", "TEMP", "TEMP_QC"]


def rows_of(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()), key=str)


def test_two_halves_equal_one_run(spark, tmp_path):
    staged, root = views.staged_uneven(spark, SF_DIR), str(tmp_path)
    half = F.pmod(F.xxhash64("source_file"), F.lit(2))
    staged.where(half == 0).repartition(3, "source_file").write.parquet(f"{root}/in")

    def run(**kw):
        convert_arriving(spark, f"{root}/in", root, "phy", f"{root}/state", **kw).awaitTermination()

    run(files_per_batch=2)
    first = vs.versions(spark, root, "phy")
    assert len(first) == 2
    run()  # a restart with nothing new
    assert vs.versions(spark, root, "phy") == first
    staged.where(half == 1).repartition(2, "source_file").write.mode("append").parquet(f"{root}/in")
    run()
    staged.write.parquet(f"{root}/whole")
    done = convert_profiles(spark.read.parquet(f"{root}/whole"), f"{root}/out", "phy")
    assert rows_of(read_version(spark, root, "phy")) == rows_of(read_levels(spark, done.levels, "phy"))
    listed = spark.read.parquet(f"{root}/quarantine/phy-arriving").select("source_file", "error")
    want = spark.read.parquet(done.quarantine).select("source_file", "error")
    assert sorted(listed.collect()) == sorted(want.collect()) and listed.count() > 0


def test_a_batch_that_runs_again(spark, tmp_path):
    """The state of a stream is lost after its batch was added: it is not added twice."""
    root = str(tmp_path)
    views.staged(spark, SF_DIR).coalesce(1).write.parquet(f"{root}/in")
    for state in ("a", "b"):
        convert_arriving(spark, f"{root}/in", root, "phy", f"{root}/{state}").awaitTermination()
    assert vs.versions(spark, root, "phy") == [1]
    assert read_version(spark, root, "phy").count() == views.staged(spark, SF_DIR).agg(F.sum("level_count")).first()[0]


def test_sketches_merge_within_their_bound(spark):
    rng = random.Random(7)
    values = [rng.gauss(0, 1) for _ in range(60_000)]
    rows = [(i % 23, v, None if i % 3 else 2 * v) for i, v in enumerate(values)]
    rows += [(99, None, float("nan")), (98, 0.5, None)]
    df = spark.createDataFrame(rows, "batch int, a double, b double").withColumn("a", F.col("a").cast("float"))
    kept = sketches.value_sketches(df, ["a", "b"], ["batch"]).cache()
    assert {r.batch: (r.a is None, r.b is None) for r in kept.collect() if r.batch > 90} == {99: (True, True), 98: (False, True)}
    for column, present in (("a", sorted([*values, 0.5])), ("b", sorted(2 * v for v in values[::3]))):
        for merge in (kept, sketches.merged(kept.withColumn("half", F.col("batch") % 2), ["a", "b"], ["half"])):
            got = sketches.sketched_limits(merge, column, (0.01, 0.25, 0.99), ("x", "y", "z")).first()
            for q, value in zip((0.01, 0.25, 0.99), got):
                rank = sum(v <= value for v in present) / len(present)
                assert abs(rank - q) <= sketches.rank_error() + 1 / len(present)
    none = sketches.sketched_limits(kept.where("batch = 99"), "a").first()
    assert tuple(none) == (None, None)
    with pytest.raises(ValueError):
        sketches.sketched_limits(kept, "a", (0.5,), ("x", "y"))
    kept.unpersist()


def test_streamed_files_grow_with_the_input(spark, tmp_path, monkeypatch):
    """More staged files for more input, still two batches."""
    from checks import catalogue
    from conftest import SF_DIR
    from profilelake.sources.versions import file_list, versions

    monkeypatch.setattr(catalogue, "range_count", lambda rows, size: 9)
    monkeypatch.setattr(catalogue.V, "scratch", lambda spark: str(tmp_path))
    assert catalogue.stream_convert(spark, SF_DIR).count() > 0
    staged = [f for f in (tmp_path / "staged").iterdir() if f.name.endswith(".parquet")]
    assert len(staged) == 9 and len(versions(spark, str(tmp_path), "phy")) == 2
    assert file_list(spark, str(tmp_path), "phy").select("batch").distinct().count() == 2
