"""One entry per operator: build a view, call the library, return plain columns."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import views as V
from profilelake import functions as PF
from profilelake.flavour import BIOGEOCHEMICAL
from profilelake.operators import aggregate, conform, datamode, filters, quarantine, refresh
from profilelake.operators import subset, verify
from profilelake.operators.flatten import flatten_levels
from profilelake.operators.sketches import rank_error, sketched_limits, value_sketches
from profilelake.plans import convert_arriving, convert_files, convert_profiles, map_data, plan_refresh
from profilelake.schema import level_schema, load_schema, save_schema, staged_schema
from profilelake.sources.files import decode_files, file_inventory, staged_and_failed
from profilelake.sources.index import index_rejects as read_rejects
from profilelake.sources.stored import stored
from profilelake.sources.tables import range_count, read_staged
from profilelake.sources.versions import add_batch, read_version
from profilelake.sources import (
    read_index,
    read_levels,
    read_metadata,
    split_rejects,
    write_levels,
    write_metadata,
)

Query = Callable[[SparkSession, str], DataFrame]

MODES = BIOGEOCHEMICAL.data_mode_parameters
BOX = {"lat_range": (34, 80), "lon_range": (-78, -50)}
TIMES = (datetime(2024, 1, 5), datetime(2024, 1, 25))
PRESSURES = (20, 200)
WMOID = 1900899


def _index_rows(df: DataFrame) -> DataFrame:
    return V.plain(df.select("ord", "file", "wmoid", "latitude", "longitude", "date"))


def index_extract(spark, sf_dir):
    return V.plain(
        V.index(spark, sf_dir).select(
            "ord", "wmoid", "cycle", "filepath_main", "filepath", "filename", "date", "date_update"
        )
    )


def index_rejects(spark, sf_dir):
    _, rejects = split_rejects(V.index(spark, sf_dir))
    return V.plain(rejects.select("ord", "file"))


def index_scan(spark, sf_dir):
    columns = ["file", "date", "latitude", "longitude", "parameters", "date_update"]
    path = V.write_index(spark, sf_dir, columns)
    schema = V.index_text(spark, sf_dir).select(*columns).schema
    return V.plain(read_index(spark, path, "bgc", schema).select(*columns))


_BROKEN = ["file", "date", "latitude", "longitude", "parameters", "date_update"]


def index_scan_broken(spark, sf_dir):
    path = V.write_broken_index(spark, sf_dir, _BROKEN)
    schema = V.index_text(spark, sf_dir).select(*_BROKEN).schema
    return V.plain(read_index(spark, path, "bgc", schema).select(*_BROKEN))


def index_scan_rejects(spark, sf_dir):
    path = V.write_broken_index(spark, sf_dir, _BROKEN)
    schema = V.index_text(spark, sf_dir).select(*_BROKEN).schema
    rejects = read_rejects(spark, path, "bgc", schema)
    return V.plain(rejects.select("file", F.size(F.split("line", ",")).alias("fields")))


def subset_default(spark, sf_dir):
    return _index_rows(subset.subset_index(V.index(spark, sf_dir), "bgc"))


def subset_latlon(spark, sf_dir):
    return _index_rows(
        subset.subset_area(V.index(spark, sf_dir), lat_range=[-20, 45], lon_range=[-60, 30.5])
    )


def subset_lon_wrap(spark, sf_dir):
    return _index_rows(
        subset.subset_area(V.index(spark, sf_dir), lat_range=[-10, 10], lon_range=[170, -170])
    )


def subset_lon_360(spark, sf_dir):
    found = subset.subset_area(V.index(spark, sf_dir), lon_range=[190, 200])
    east = F.when(F.col("longitude") < 0, F.col("longitude") + 360).otherwise(F.col("longitude"))
    return V.plain(
        found.select("ord", "longitude", PF.normalize_longitude(east).alias("normalized"))
    )


def subset_date(spark, sf_dir):
    return _index_rows(
        subset.subset_dates(
            V.index(spark, sf_dir), start=datetime(1996, 3, 1), end=datetime(1999, 12, 31)
        )
    )


def subset_floats(spark, sf_dir):
    return _index_rows(subset.subset_floats(V.index(spark, sf_dir), [1900005, 1900050, 1900089]))


def subset_floats_table(spark, sf_dir):
    rich = V.table(spark, sf_dir, "customer").where("c_acctbal > 0")
    ids = rich.select((F.lit(1900000) + F.col("c_custkey")).alias("wmoid"))
    return _index_rows(subset.subset_floats(V.index(spark, sf_dir), ids))


def subset_sensors(spark, sf_dir):
    return _index_rows(
        subset.subset_index(V.index(spark, sf_dir), "bgc", sensors=["CHLA", "DOXY"])
    )


def subset_sensors_exact(spark, sf_dir):
    return _index_rows(
        subset.subset_index(
            V.index(spark, sf_dir), "bgc", sensors=["CHLA", "DOXY"], exact_sensors=True
        )
    )


def float_list(spark, sf_dir):
    return V.plain(subset.float_list(V.index(spark, sf_dir), order_by="ord"))


def metadata_by_float(spark, sf_dir):
    usable, _ = split_rejects(V.index(spark, sf_dir))
    path = write_metadata(usable, V.scratch(spark), "bgc")
    found = read_metadata(spark, path, [("wmoid", "==", WMOID)])
    return V.plain(found.select("ord", "wmoid", "cycle", "filename", "latitude", "parameters"))


def month_label(spark, sf_dir):
    return V.plain(V.index(spark, sf_dir).select("ord", PF.year_month("date").alias("month")))


def _candidates(spark, sf_dir):
    floats = subset.float_list(V.index(spark, sf_dir))
    return refresh.candidates_per_float(floats, "bgc", V.LOCAL_ROOT, V.REMOTE_ROOT)


def candidates_float(spark, sf_dir):
    return V.plain(_candidates(spark, sf_dir))


def candidates_profile(spark, sf_dir):
    usable, _ = split_rejects(V.index(spark, sf_dir))
    found = refresh.candidates_per_profile(usable, "/mirror", "https://example.org")
    return V.plain(found)


def path_tail(spark, sf_dir):
    files = V.all_files(spark, sf_dir)
    return V.plain(files.select("path", PF.path_tail("path").alias("tail")))


def file_inventory_stats(spark, sf_dir):
    totals = refresh.inventory_totals(V.all_files(spark, sf_dir))
    return V.plain(totals.withColumn("total_mb", F.round("total_mb", 6)))


def freshness(spark, sf_dir):
    index = V.index(spark, sf_dir)
    found = refresh.freshness(_candidates(spark, sf_dir), index, V.local_files(spark, sf_dir))
    return V.plain(found.select("local_path", "wmoid", "state"))


def refresh_action(spark, sf_dir):
    files, remote = V.local_files(spark, sf_dir), V.remote_files(spark, sf_dir)
    checked = refresh.refresh_actions(_candidates(spark, sf_dir), files, remote)
    both = refresh.refresh_actions(
        checked.withColumnRenamed("action", "by_time"), files, remote, checktime=False
    )
    return V.plain(
        both.select("local_path", "by_time", F.col("action").alias("by_presence"))
    )


def refresh_plan(spark, sf_dir):
    plan = plan_refresh(
        V.index(spark, sf_dir).select("file", "date", "latitude", "longitude", "date_update"),
        V.local_files(spark, sf_dir),
        V.remote_files(spark, sf_dir),
        "bgc",
        V.LOCAL_ROOT,
        V.REMOTE_ROOT,
        lat_range=[-60, 60],
    )
    return V.plain(plan.actions.select("local_path", "state", "action"))


_LEVEL_COLUMNS = (
    "source_file", "N_PROF", "N_LEVELS", "PLATFORM_NUMBER", "DIRECTION", "LATITUDE", "JULD",
    "PRES", "TEMP", "TEMP_QC",
)


def flatten(spark, sf_dir):
    return V.plain(flatten_levels(V.staged(spark, sf_dir)).select(*_LEVEL_COLUMNS))


def flatten_drop_padding(spark, sf_dir):
    rows = flatten_levels(V.staged(spark, sf_dir), drop_padding=True)
    return V.plain(rows.select(*_LEVEL_COLUMNS))


def conform_schema(spark, sf_dir):
    rows = flatten_levels(V.staged(spark, sf_dir))
    return V.plain(conform.conform(rows, level_schema("phy")))


def union_outer(spark, sf_dir):
    rows = flatten_levels(V.staged(spark, sf_dir))
    keys = ["source_file", "N_PROF", "N_LEVELS"]
    frames = [rows.select(*keys, "PRES"), rows.select(*keys, "TEMP", "TEMP_QC")]
    return V.plain(conform.union_outer(frames))


def write_roundtrip(spark, sf_dir):
    rows = conform.conform(flatten_levels(V.staged(spark, sf_dir)), level_schema("phy"))
    path = write_levels(rows, V.scratch(spark), "phy", cluster_by=["LATITUDE", "LONGITUDE"])
    columns = ["PLATFORM_NUMBER", "N_PROF", "N_LEVELS", "LATITUDE", "JULD", "PRES", "TEMP"]
    return V.plain(read_levels(spark, path, "phy", columns))


def data_mode_spread(spark, sf_dir):
    rows = datamode.spread_data_modes(V.parameters(spark, sf_dir), MODES)
    shown = [f"{p}_DATA_MODE" for p in ("TEMP", "PSAL", "DOXY", "CHLA")]
    return V.plain(rows.select("source_file", "N_PROF", *shown))


def data_mode_unknown(spark, sf_dir):
    return V.plain(datamode.unknown_parameters(V.parameters(spark, sf_dir), MODES))


def data_mode_invalid(spark, sf_dir):
    return V.plain(datamode.data_modes_valid(V.parameters(spark, sf_dir), MODES))


def calib_invariant(spark, sf_dir):
    return V.plain(datamode.calibration_invariant(V.parameters(spark, sf_dir)))


def quarantine_files(spark, sf_dir):
    return V.plain(quarantine.failed_checks(V.parameters(spark, sf_dir), MODES))


def quarantine_levels(spark, sf_dir):
    return V.plain(quarantine.failed_checks(V.staged_uneven(spark, sf_dir), MODES))


def flatten_uneven(spark, sf_dir):
    return V.plain(flatten_levels(V.staged_uneven(spark, sf_dir)).select(*_LEVEL_COLUMNS))


def filter_in_float(spark, sf_dir):
    rows = flatten_levels(V.staged(spark, sf_dir)).select("source_file", "N_PROF", "N_LEVELS", "TEMP")
    single = rows.withColumn("PART", (F.col("N_PROF") % 10 / 10).cast("float"))
    found = filters.filter_rows(
        single, [[("PART", "in", [0.1, 0.7]), ("TEMP", ">", 30)], [("PART", "in", [0.3])]]
    )
    return V.plain(found.select("source_file", "N_PROF", "N_LEVELS", "TEMP"))


def quarantine_rest(spark, sf_dir):
    sound, _ = quarantine.quarantine(V.parameters(spark, sf_dir), MODES)
    return V.plain(sound.select("source_file", "N_PROF"))


def failure_rate(spark, sf_dir):
    staged = V.parameters(spark, sf_dir)
    fine = staged.select("source_file", F.lit(None).cast("string").alias("error"))
    rate = quarantine.failure_rate(fine.union(quarantine.failed_checks(staged, MODES)))
    return V.plain(rate.withColumn("failed_percent", F.round("failed_percent", 6)))


def verify_data_mode(spark, sf_dir):
    staged, _ = quarantine.quarantine(V.parameters(spark, sf_dir), MODES)
    rows = flatten_levels(datamode.spread_data_modes(staged, MODES))
    rows = rows.withColumn("PLATFORM_NUMBER", F.col("source_file").cast("bigint"))
    path = write_levels(conform.conform(rows, level_schema("bgc")), V.scratch(spark), "bgc")
    levels = read_levels(spark, path, "bgc").withColumn(
        "source_file", F.col("PLATFORM_NUMBER").cast("string")
    )
    return V.plain(verify.verify_data_modes(levels, staged, MODES))


def convert_pipeline(spark, sf_dir):
    done = convert_profiles(V.parameters(spark, sf_dir), V.scratch(spark), "bgc")
    columns = ["PLATFORM_NUMBER", "N_PROF", "N_LEVELS", "TEMP", "TEMP_DATA_MODE", "CHLA"]
    return V.plain(read_levels(spark, done.levels, "bgc", columns))


def _decoded(spark, sf_dir):
    schema = staged_schema("bgc", ["PRES"])
    rows = decode_files(spark, V.write_files(spark, sf_dir), V.decode_lines, schema, "*_Sprof.nc")
    return staged_and_failed(stored(rows))


def decode_profiles(spark, sf_dir):
    staged, _ = _decoded(spark, sf_dir)
    tail = PF.path_tail("source_file").alias("tail")
    return V.plain(staged.select(tail, "N_PROF", F.get("PRES", F.lit(0)).alias("PRES")))


def decode_failures(spark, sf_dir):
    _, failed = _decoded(spark, sf_dir)
    return V.plain(failed.select(PF.path_tail("source_file").alias("tail")))


def inventory_scan(spark, sf_dir):
    files = file_inventory(spark, V.write_files(spark, sf_dir), "*_Sprof.nc")
    return V.plain(files.select(PF.path_tail("path").alias("tail"), "length"))


def staged_scan(spark, sf_dir):
    path = f"{V.scratch(spark)}/staged"
    V.staged(spark, sf_dir).write.parquet(path)
    rows = flatten_levels(read_staged(spark, path, "phy"))
    return V.plain(rows.select(*_LEVEL_COLUMNS))


def convert_subset(spark, sf_dir):
    folder = V.write_files(spark, sf_dir)
    index = V.index(spark, sf_dir)
    floats = subset.float_list(subset.subset_index(index, "bgc", lat_range=[-60, 60]))
    shown = file_inventory(spark, folder, "*_Sprof.nc").select("path").first()
    root = shown.path.rsplit("/", 3)[0] if shown else folder
    chosen = refresh.candidates_per_float(floats, "bgc", root, V.REMOTE_ROOT)
    scratch = V.scratch(spark)
    done = convert_files(
        spark, folder, V.decode_lines, scratch, "bgc", f"{scratch}/staged",
        schema=staged_schema("bgc", ["PRES"]), files=stored(chosen.select("local_path")),
    )
    columns = ["PLATFORM_NUMBER", "N_PROF", "N_LEVELS", "PRES"]
    return V.plain(read_levels(spark, done.levels, "bgc", columns))


_WRITTEN = ("PLATFORM_NUMBER", "N_PROF", "N_LEVELS", "PRES", "TEMP")


def write_append(spark, sf_dir):
    rows = conform.conform(flatten_levels(V.staged(spark, sf_dir)), level_schema("phy"))
    root, odd = V.scratch(spark), F.col("PLATFORM_NUMBER") % 2 == 1
    write_levels(rows.where(odd), root, "phy")
    path = write_levels(rows.where(~odd), root, "phy", mode="append")
    return V.plain(read_levels(spark, path, "phy", list(_WRITTEN)))


def write_sized(spark, sf_dir):
    rows = conform.conform(flatten_levels(V.staged(spark, sf_dir)), level_schema("phy"))
    path = write_levels(rows, V.scratch(spark), "phy", target_file_bytes=1 << 20)
    return V.plain(read_levels(spark, path, "phy", list(_WRITTEN)))


def batch_twice(spark, sf_dir):
    """Two batches, the second of them added twice."""
    rows = conform.conform(flatten_levels(V.staged(spark, sf_dir)), level_schema("phy"))
    root, odd = V.scratch(spark), F.col("PLATFORM_NUMBER") % 2 == 1
    add_batch(rows.where(odd), root, "phy", "odd")
    for _ in range(2):
        add_batch(rows.where(~odd), root, "phy", "even")
    return V.plain(read_version(spark, root, "phy", list(_WRITTEN)))


def two_schemas(spark, sf_dir):
    """Two batches of one dataset: the later one has a wider number and one more column."""
    rows, root = V.observations(spark, sf_dir), V.scratch(spark)
    narrow = rows.select("event_id", F.col("CHLA_ADJUSTED_QC").cast("smallint").alias("CHLA_ADJUSTED_QC"))
    wide = rows.select("event_id", F.col("CHLA_ADJUSTED_QC").cast("int").alias("CHLA_ADJUSTED_QC"), "PRES_ADJUSTED")
    add_batch(narrow.where("event_id % 2 = 0"), root, "bgc", "old")
    add_batch(wide.where("event_id % 2 = 1"), root, "bgc", "new")
    return V.plain(read_version(spark, root, "bgc"))


def stream_convert(spark, sf_dir):
    """Staged files converted as a stream in several batches, then run again with nothing new."""
    root, rows = V.scratch(spark), V.staged(spark, sf_dir)
    # More files for more data, two thirds of them in the first batch.
    files = max(3, range_count(rows, None))
    rows.repartition(files, "source_file").write.parquet(f"{root}/staged")
    for _ in range(2):
        convert_arriving(
            spark, f"{root}/staged", root, "phy", f"{root}/checkpoint", files_per_batch=-(-2 * files // 3)
        ).awaitTermination()
    return V.plain(read_version(spark, root, "phy", list(_WRITTEN)))


def sketch_limits(spark, sf_dir):
    """Whether limits from sketches of many groups lie within their rank error."""
    rows = filters.valid_values(V.observations(spark, sf_dir), "CHLA_ADJUSTED")
    sketches = stored(value_sketches(rows.withColumn("batch", F.col("event_id") % 16), ["CHLA_ADJUSTED"], ["batch"]))
    limits = sketched_limits(sketches, "CHLA_ADJUSTED", (0.01, 0.5, 0.99), ("a", "b", "c"))
    ranks = rows.crossJoin(F.broadcast(limits)).agg(
        *(F.avg((F.col("CHLA_ADJUSTED") <= F.col(c)).cast("double")).alias(c) for c in "abc")
    )
    pairs = F.array(*(F.struct(F.lit(q).alias("q"), F.col(c).alias("rank")) for q, c in ((0.01, "a"), (0.5, "b"), (0.99, "c"))))
    found = ranks.select(F.explode(pairs).alias("p")).select("p.*")
    # One value may stand for many ranks where the data repeat it.
    return V.plain(found.select("q", (F.abs(F.col("q") - F.col("rank")) <= rank_error() + 0.005).alias("within")))


def skipping_read(spark, sf_dir):
    """The rows of ``box_time_depth`` from the files of a stored dataset that can hold them."""
    rows, root = V.observations(spark, sf_dir), V.scratch(spark)
    add_batch(rows, root, "bgc", "all", ranges=64)
    wanted = [
        ("LATITUDE", ">", BOX["lat_range"][0]), ("LATITUDE", "<", BOX["lat_range"][1]),
        ("LONGITUDE", ">", BOX["lon_range"][0]), ("LONGITUDE", "<", BOX["lon_range"][1]),
        ("JULD", ">=", TIMES[0]), ("JULD", "<=", TIMES[1]),
        ("PRES_ADJUSTED", ">=", PRESSURES[0]), ("PRES_ADJUSTED", "<=", PRESSURES[1]),
    ]
    columns = ["event_id", "JULD", "PRES_ADJUSTED"]
    return V.plain(read_version(spark, root, "bgc", columns, wanted, schema=rows.schema))


def schema_roundtrip(spark, sf_dir):
    root = V.scratch(spark)
    save_schema(spark, level_schema("phy"), f"{root}/schema")
    schema = load_schema(spark, f"{root}/schema")
    rows = conform.conform(flatten_levels(V.staged(spark, sf_dir)), schema)
    path = write_levels(rows, root, "phy")
    found = spark.read.schema(schema).parquet(path)
    return V.plain(found.select(*_WRITTEN))


def filter_dnf(spark, sf_dir):
    return V.plain(
        filters.filter_rows(
            V.observations(spark, sf_dir),
            [
                [("LATITUDE", ">", 50), ("CHLA_ADJUSTED", ">=", 0.5)],
                [("PRES_ADJUSTED", "<", 5), ("CHLA_ADJUSTED_QC", "in", [1, 2])],
            ],
        ).select("event_id", "LATITUDE", "PRES_ADJUSTED")
    )


def _latitude_bands(spark, sf_dir):
    return V.index(spark, sf_dir).select("ord", F.floor(F.col("latitude") / 30).alias("band"))


def filter_not_in(spark, sf_dir):
    bands = _latitude_bands(spark, sf_dir)
    return V.plain(filters.filter_rows(bands, [("band", "not in", [0, 1])]))


def filter_in_null(spark, sf_dir):
    bands = _latitude_bands(spark, sf_dir)
    return V.plain(filters.filter_rows(bands, [("band", "in", [2, None])]))


def box_filter(spark, sf_dir):
    found = filters.box(V.observations(spark, sf_dir), **BOX)
    return V.plain(found.select("event_id", "LATITUDE", "LONGITUDE"))


def box_time_depth(spark, sf_dir):
    found = filters.time_and_pressure(
        filters.box(V.observations(spark, sf_dir), **BOX), TIMES, PRESSURES
    )
    return V.plain(found.select("event_id", "JULD", "PRES_ADJUSTED"))


def valid_values(spark, sf_dir):
    found = filters.valid_values(V.observations(spark, sf_dir), "CHLA_ADJUSTED")
    return V.plain(found.select("event_id", "CHLA_ADJUSTED"))


def qc_filter(spark, sf_dir):
    found = filters.quality(V.observations(spark, sf_dir), "CHLA_ADJUSTED", [1, 2])
    return V.plain(found.select("event_id", "CHLA_ADJUSTED_QC"))


def _map(spark, sf_dir):
    return map_data(
        V.observations(spark, sf_dir),
        "CHLA_ADJUSTED",
        time_range=TIMES,
        pressure_range=PRESSURES,
        **BOX,
    )


def map_rows(spark, sf_dir):
    return V.plain(_map(spark, sf_dir).rows)


def map_mean(spark, sf_dir):
    means = _map(spark, sf_dir).means
    return V.plain(means.withColumn("CHLA_ADJUSTED", F.round("CHLA_ADJUSTED", 6)))


def map_limits(spark, sf_dir):
    limits = _map(spark, sf_dir).limits
    return V.plain(limits.select(*(F.round(c, 9).alias(c) for c in limits.columns)))


def head_rows(spark, sf_dir):
    rows = V.observations(spark, sf_dir).select("event_id", "JULD", "LATITUDE")
    return V.plain(aggregate.first_rows(rows, order_by=["event_id"]))


def queries() -> dict[str, Query]:
    return {
        "index_extract": index_extract,
        "index_rejects": index_rejects,
        "index_scan": index_scan,
        "index_scan_broken": index_scan_broken,
        "index_scan_rejects": index_scan_rejects,
        "subset_default": subset_default,
        "subset_latlon": subset_latlon,
        "subset_lon_wrap": subset_lon_wrap,
        "subset_lon_360": subset_lon_360,
        "subset_date": subset_date,
        "subset_floats": subset_floats,
        "subset_floats_table": subset_floats_table,
        "subset_sensors": subset_sensors,
        "subset_sensors_exact": subset_sensors_exact,
        "float_list": float_list,
        "metadata_by_float": metadata_by_float,
        "month_label": month_label,
        "candidates_float": candidates_float,
        "candidates_profile": candidates_profile,
        "path_tail": path_tail,
        "file_inventory_stats": file_inventory_stats,
        "freshness": freshness,
        "refresh_action": refresh_action,
        "refresh_plan": refresh_plan,
        "flatten_levels": flatten,
        "flatten_uneven": flatten_uneven,
        "flatten_drop_padding": flatten_drop_padding,
        "conform_schema": conform_schema,
        "union_outer": union_outer,
        "write_roundtrip": write_roundtrip,
        "data_mode_spread": data_mode_spread,
        "data_mode_unknown": data_mode_unknown,
        "data_mode_invalid": data_mode_invalid,
        "calib_invariant": calib_invariant,
        "quarantine_files": quarantine_files,
        "quarantine_levels": quarantine_levels,
        "quarantine_rest": quarantine_rest,
        "failure_rate": failure_rate,
        "verify_data_mode": verify_data_mode,
        "convert_pipeline": convert_pipeline,
        "decode_profiles": decode_profiles,
        "decode_failures": decode_failures,
        "inventory_scan": inventory_scan,
        "staged_scan": staged_scan,
        "convert_subset": convert_subset,
        "write_append": write_append,
        "write_sized": write_sized,
        "batch_twice": batch_twice,
        "skipping_read": skipping_read,
        "two_schemas": two_schemas,
        "stream_convert": stream_convert,
        "sketch_limits": sketch_limits,
        "schema_roundtrip": schema_roundtrip,
        "filter_dnf": filter_dnf,
        "filter_in_float": filter_in_float,
        "filter_not_in": filter_not_in,
        "filter_in_null": filter_in_null,
        "box_filter": box_filter,
        "box_time_depth": box_time_depth,
        "valid_values": valid_values,
        "qc_filter": qc_filter,
        "map_rows": map_rows,
        "map_mean": map_mean,
        "map_limits": map_limits,
        "head_rows": head_rows,
    }
