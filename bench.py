"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` is the table folder, ``BENCH_CPUS`` the number of local
threads, ``BENCH_RUNS`` the timed runs of each query, of which the median
counts. Each query runs once before to warm up.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import catalogue  # noqa: E402

HEADLINE = (
    "index_extract",
    "subset_lon_wrap",
    "subset_sensors",
    "float_list",
    "freshness",
    "refresh_action",
    "flatten_levels",
    "flatten_drop_padding",
    "conform_schema",
    "data_mode_spread",
    "quarantine_files",
    "verify_data_mode",
    "write_roundtrip",
    "convert_pipeline",
    "decode_profiles",
    "convert_subset",
    "map_mean",
    "map_limits",
)


def conversions(spark: SparkSession, profiles: int = 400, levels: int = 400) -> dict[str, float]:
    """MB/s of whole conversions of stored staged rows with profiles of several hundred levels.

    MB are those of the written level dataset.
    """
    from pyspark.sql import functions as F
    from pyspark.sql.types import ArrayType

    from checks import views
    from profilelake.plans import convert_profiles
    from profilelake.schema import staged_schema

    rates = {}
    for db in ("phy", "bgc"):
        root = views.scratch(spark)
        values = F.transform(
            F.sequence(F.lit(1), F.lit(levels)), lambda k: F.rand(1) * 30 + k.cast("double")
        )
        flags = F.transform(F.sequence(F.lit(1), F.lit(levels)), lambda k: k % 4 + 1)
        columns = []
        for field in staged_schema(db):
            kind = field.dataType
            if isinstance(kind, ArrayType) and not field.name.startswith("PARAMETER"):
                source = values if kind.elementType.simpleString() == "float" else flags
                columns.append(source.cast(kind).alias(field.name))
        spark.range(profiles).select(
            (F.col("id") % 16).cast("string").alias("source_file"),
            F.col("id").alias("N_PROF"),
            F.lit(levels).alias("level_count"),
            (F.col("id") % 16 + 1900000).alias("PLATFORM_NUMBER"),
            *columns,
        ).write.parquet(f"{root}/staged")
        staged = spark.read.parquet(f"{root}/staged")
        start = time.perf_counter()
        done = convert_profiles(staged, f"{root}/out", db)
        seconds = time.perf_counter() - start
        files = spark.read.format("binaryFile").load(done.levels)
        written = files.agg({"length": "sum"}).first()[0]
        rates[f"{db}_mb_per_s"] = round(written / 1e6 / seconds, 2)
    return rates


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("profilelake-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        start = time.perf_counter()
        df = catalogue.queries()[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in HEADLINE:
        once(name)
        seconds[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "conversions": conversions(spark),
                "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
