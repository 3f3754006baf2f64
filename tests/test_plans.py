"""What Spark makes of the operators: pushed filters, narrow scans, few shuffles, no Python."""

import io
import re
from contextlib import redirect_stdout
from datetime import datetime

import pytest

from checks import catalogue, views
from conftest import SF_DIR
from profilelake.operators import datamode, quarantine, refresh, subset
from profilelake.operators.aggregate import group_mean
from profilelake.operators.filters import box, valid_values
from profilelake.operators.flatten import flatten_levels
from profilelake.operators.verify import verify_data_modes
from profilelake.plans import convert_profiles
from profilelake.plans.convert import level_rows
from profilelake.schema import level_schema, staged_schema
from profilelake.sources import read_levels, read_staged

MODES = catalogue.MODES


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def shuffles(df):
    tree = plan(df).split("\n\n\n")[0]
    return len(re.findall(r"\bExchange\b", tree))


@pytest.fixture(scope="module")
def level_table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("levels"))
    spark.createDataFrame([], level_schema("bgc")).write.mode("overwrite").parquet(path)
    return path


@pytest.fixture(scope="module")
def staged_table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("staged"))
    spark.createDataFrame([], staged_schema("bgc")).write.mode("overwrite").parquet(path)
    return read_staged(spark, path, "bgc")


def test_map_reads_five_of_219_columns(spark, level_table):
    levels = read_levels(spark, level_table, "bgc")
    narrow = levels.select("CHLA_ADJUSTED", "LATITUDE", "LONGITUDE", "PRES_ADJUSTED", "JULD")
    rows = box(narrow, (34, 80), (-78, -50)).where(
        (narrow.JULD >= datetime(2023, 1, 1)) & (narrow.PRES_ADJUSTED >= 100)
    )
    means = group_mean(valid_values(rows, "CHLA_ADJUSTED"), "CHLA_ADJUSTED")
    text = plan(means)
    schema = re.search(r"ReadSchema: struct<(.*)>", text).group(1)
    assert set(re.findall(r"(\w+):", schema)) == {
        "CHLA_ADJUSTED", "LATITUDE", "LONGITUDE", "PRES_ADJUSTED", "JULD"
    }
    pushed = re.search(r"PushedFilters: (.*)", text).group(1)
    for part in (
        "GreaterThan(LATITUDE,34.0)", "LessThan(LONGITUDE,-50.0)",
        "GreaterThanOrEqual(JULD", "GreaterThanOrEqual(PRES_ADJUSTED,100.0)",
        "LessThan(CHLA_ADJUSTED,1.0E30)",
    ):
        assert part in pushed, (part, pushed)
    assert "Batched: true" in text
    assert shuffles(means) == 1 and "partial_avg" in text


def test_date_line_filter_is_pushed(spark, tmp_path):
    spark.range(1).selectExpr("0D as latitude", "0D as longitude").write.parquet(str(tmp_path / "i"))
    text = plan(subset.subset_area(spark.read.parquet(str(tmp_path / "i")), lon_range=[170, 190]))
    assert "Or(GreaterThanOrEqual(longitude,170.0),LessThanOrEqual(longitude,-170.0))" in text


def test_conversion_rows_are_never_shuffled(staged_table):
    rows = level_rows(staged_table, "bgc")
    text = plan(rows)
    assert shuffles(rows) == 0 and text.count("Generate") >= 1
    assert "Python" not in text and "Pandas" not in text


def test_checks_shuffle_failing_profiles_only(staged_table):
    text = plan(quarantine.failed_checks(staged_table, MODES))
    schema = re.search(r"ReadSchema: struct<(.*)>", text).group(1)
    # Lengths of all arrays are looked at; profile values are not read.
    assert schema.startswith("source_file:string,level_count:int,PRES:array<float>")
    assert not re.search("JULD|LATITUDE|LONGITUDE", schema)


def test_flatten_prunes_arrays(staged_table):
    text = plan(flatten_levels(staged_table, ["PRES", "JULD"]))
    schema = re.search(r"ReadSchema: struct<(.*)>", text).group(1)
    assert "TEMP" not in schema and "PRES:array<float>" in schema


def test_a_stored_list_is_broadcast(spark, staged_table, tmp_path):
    done = convert_profiles(staged_table, str(tmp_path), "bgc")
    listed = spark.read.parquet(done.quarantine)
    text = plan(quarantine.without_files(staged_table, listed))
    assert "BroadcastHashJoin LeftAnti" in text
    assert shuffles(quarantine.without_files(staged_table, listed)) == 0


def test_updates_are_reduced_before_the_join(spark):
    index = views.index(spark, SF_DIR)
    text = plan(refresh.latest_updates(index))
    assert "partial_max" in text
    tree = plan(refresh.freshness(
        catalogue._candidates(spark, SF_DIR), index, views.local_files(spark, SF_DIR)
    ))
    assert "CartesianProduct" not in tree and "NestedLoop" not in tree


@pytest.mark.parametrize(
    "name", [n for n in catalogue.queries() if not n.startswith(("write", "convert"))]
)
def test_no_python_and_no_cross_join(spark, name):
    text = plan(catalogue.queries()[name](spark, SF_DIR))
    for node in ("Python", "Pandas", "CartesianProduct", "NestedLoop"):
        assert node not in text, (name, node)


def test_spread_stays_one_projection_over_the_names(staged_table):
    text = plan(datamode.spread_data_modes(staged_table.select(
        "source_file", "N_PROF", "PARAMETER", "PARAMETER_DATA_MODE"), MODES))
    # Names and modes are zipped and stripped once, not once per parameter.
    assert text.count("zip_with(") <= 2


def test_modes_of_all_profiles_are_not_broadcast(level_table, staged_table, spark):
    levels = read_levels(spark, level_table, "bgc")
    levels = levels.withColumn("source_file", levels.PLATFORM_NUMBER.cast("string"))
    text = plan(verify_data_modes(levels, staged_table, MODES))
    assert "SortMergeJoin" in text and "BroadcastExchange" not in text
