"""One key holds a third of the rows or more: results stay whole and no task gets it all."""

import io
import re
from contextlib import contextmanager, redirect_stdout

import pytest
from pyspark.sql import functions as F

from profilelake.operators.aggregate import group_mean, quantile_limits
from profilelake.operators.quarantine import without_files
from profilelake.operators.subset import float_list, subset_floats
from profilelake.sources.stored import stored

ROWS = 60_000


@contextmanager
def settings(spark, **values):
    before = {k: spark.conf.get(k) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


SPLIT_SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def final_plan(df):
    df.collect()
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain()
    return out.getvalue()


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    """Half the rows belong to one file, one float, one position."""
    path = str(tmp_path_factory.mktemp("hot"))
    key = F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 997)
    spark.range(ROWS).repartition(8).select(
        F.concat(F.lit("f"), key).alias("source_file"),
        key.alias("wmoid"),
        F.concat(F.lit("a/"), key, F.lit("/")).alias("filepath_main"),
        key.cast("double").alias("LATITUDE"),
        F.lit(0.0).alias("LONGITUDE"),
        F.col("id").cast("double").alias("CHLA"),
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
    ).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def test_a_long_list_of_failed_files_splits_the_hot_file(spark, hot):
    failed = hot.where("wmoid > 500").groupBy("source_file").agg(F.first("text").alias("error"))
    with settings(spark, **SPLIT_SMALL):
        rest = without_files(hot, stored(failed.select("source_file", "error")))
        text = final_plan(rest)
        assert re.search(r"SortMergeJoin\(skew=true\).*LeftAnti", text), text
        assert rest.count() == hot.where("wmoid <= 500").count()


def test_a_long_list_of_floats_splits_the_hot_float(spark, hot):
    ids = stored(spark.range(0, 997, 2).selectExpr("id as wmoid"))
    with settings(spark, **SPLIT_SMALL):
        kept = subset_floats(hot, ids)
        assert re.search(r"SortMergeJoin\(skew=true\).*LeftSemi", final_plan(kept))
        assert kept.count() == hot.where("wmoid % 2 = 0").count()


@pytest.mark.parametrize("operator", [
    lambda df: group_mean(df, "CHLA"), lambda df: float_list(df),
])
def test_groups_are_reduced_before_the_shuffle(hot, operator):
    df = operator(hot)
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain()
    assert re.search(r"partial_(avg|min)", out.getvalue())
    assert df.count() == 997


def test_quantiles_of_one_repeated_value(spark):
    df = spark.range(ROWS).select(
        F.when(F.col("id") % 3 == 0, 0.25).otherwise(F.col("id") / ROWS).alias("v")
    )
    got = quantile_limits(df, "v", (0.1, 0.5), rows_per_range=100).first()
    expected = df.agg(F.percentile("v", F.array(F.lit(0.1), F.lit(0.5)))).first()[0]
    assert list(got) == pytest.approx(expected, rel=1e-12)
