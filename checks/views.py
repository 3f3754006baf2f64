"""Views that give the driver's tables the shape of profile data (see FIXTURES.md).

Every view covers its whole table. Arrays are bounded by construction: a
profile has at most ``LEVELS`` levels and ``BLOCK`` parameters, whatever share
of the rows one order, customer or user holds.
"""

from __future__ import annotations

import uuid

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from profilelake.flavour import BIOGEOCHEMICAL
from profilelake.schema import staged_schema
from profilelake.sources.index import enrich_index, parse_dates
from profilelake.sources.stored import shared_folder

LEVELS = 7
BLOCK = 512
CENTRES = ("aoml", "bodc", "coriolis", "csio", "incois")
LOCAL_ROOT = "/mirror/dac/"
REMOTE_ROOT = "https://example.org/dac/"
EVENT_PARAMETERS = {
    "click": "  TEMP  ",
    "view": "PSAL",
    "purchase": "DOXY",
    "signup": "FOO",
    "error": "    ",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A fresh folder that every executor can reach."""
    return f"{shared_folder(spark)}/checks-{uuid.uuid4().hex}"


def plain(df: DataFrame) -> DataFrame:
    """Only bigint, double and string columns, so that two engines can be compared."""
    to = {"float": "double", "smallint": "bigint", "int": "bigint", "boolean": "bigint"}

    def column(name: str, kind: str):
        if kind == "timestamp_ntz":
            return F.date_format(name, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(name)
        if kind == "boolean":
            return F.col(name).cast("int").cast("bigint").alias(name)
        return F.col(name).cast(to.get(kind, kind)).alias(name)

    return df.select(*(column(n, k) for n, k in df.dtypes))


def _centre(key: Column, moved: Column) -> Column:
    names = F.array(*map(F.lit, CENTRES))
    return F.get(names, ((key + moved) % len(CENTRES)).cast("int"))


def index_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw index rows, dates as text; some paths, positions and dates unusable."""
    key, customer, day = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderdate")
    float_id = (F.lit(1900000) + customer).cast("string")
    moved = F.when(customer % 50 == 0, key % 2).otherwise(0)
    folder = F.when(key % 997 == 0, "/misplaced/").otherwise("/profiles/")
    file = F.concat(
        _centre(customer, moved), F.lit("/"), float_id, folder, F.lit("S"),
        F.when(F.col("o_orderstatus") == "O", "R").otherwise("D"),
        float_id, F.lit("_"), F.lpad((key % 300 + 1).cast("string"), 3, "0"),
        F.when(key % 10 == 0, "D").otherwise(""), F.lit(".nc"),
    )
    compact = "yyyyMMddHHmmss"
    updated = F.timestamp_add("DAY", (key % 400).cast("int"), day)
    sensors = F.concat(
        F.lit("PRES TEMP PSAL"),
        *(
            F.when(key % n == 0, " " + name).otherwise("")
            for n, name in ((2, "DOXY"), (3, "BBP700"), (5, "CHLA_FLUORESCENCE"), (7, "CHLA"))
        ),
    )
    return table(spark, sf_dir, "orders").select(
        key.alias("ord"),
        file.alias("file"),
        F.when(key % 613 == 0, "n/a")
        .when(key % 307 != 0, F.date_format(day, compact))
        .alias("date"),
        F.when(key % 97 != 0, key * 7919 % 18001 / 100 - 90).alias("latitude"),
        F.when(key % 89 != 0, key * 104729 % 36001 / 100 - 180).alias("longitude"),
        sensors.alias("parameters"),
        F.when(key % 211 != 0, F.date_format(updated, compact)).alias("date_update"),
    )


def index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich_index(parse_dates(index_text(spark, sf_dir)))


def _float_file(root: str) -> Column:
    customer = F.col("c_custkey")
    float_id = (F.lit(1900000) + customer).cast("string")
    return F.concat(
        F.lit(root), _centre(customer, F.lit(0)), F.lit("/"), float_id, F.lit("/"),
        float_id, F.lit("_Sprof.nc"),
    )


def _day(start: str, days: Column) -> Column:
    return F.timestamp_add("DAY", days.cast("int"), F.lit(start).cast("timestamp_ntz"))


def all_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The file of every customer's float."""
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        key.alias("_key"),
        _float_file(LOCAL_ROOT).alias("path"),
        _day("1998-06-01", key * 7 % 1500).alias("mtime"),
        (F.lit(100000) + key * 37 % 9000).alias("length"),
    )


def local_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mirror that lacks every third file."""
    return all_files(spark, sf_dir).where(F.col("_key") % 3 != 0).drop("_key")


def profile_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(name, text) of a small file per customer with orders; every 17th is broken."""
    line = F.concat_ws(",", "o_orderkey", F.col("o_orderkey") % 97)
    grouped = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(F.sort_array(F.collect_list(F.struct("o_orderkey", line.alias("line")))).alias("l"))
        .select(
            F.col("o_custkey").alias("c_custkey"),
            F.concat_ws("\n", F.transform("l", lambda x: x["line"])).alias("lines"),
        )
    )
    return grouped.select(
        _float_file("").alias("name"),
        F.when(F.col("c_custkey") % 17 == 0, "broken").otherwise(F.col("lines")).alias("text"),
    )


def write_files(spark: SparkSession, sf_dir: str) -> str:
    """The profile files, written by the executors into a fresh shared folder."""
    folder = scratch(spark)

    def write(batches):
        for frame in batches:
            for name, text in zip(frame["name"], frame["text"]):
                where, path = fs.FileSystem.from_uri(f"{folder}/{name}".replace("file:///", "/", 1))
                where.create_dir(path.rpartition("/")[0], recursive=True)
                with where.open_output_stream(path) as out:
                    out.write(text.encode())
            yield frame[["name"]]

    profile_texts(spark, sf_dir).mapInPandas(write, "name string").write.format("noop").mode(
        "overwrite"
    ).save()
    return folder


def decode_lines(path: str, content: bytes) -> pd.DataFrame:
    """A decoder of the profile files."""
    rows = [line.split(",") for line in content.decode().split("\n")]
    return pd.DataFrame(
        {
            "N_PROF": [int(key) for key, _ in rows],
            "level_count": 1,
            "PLATFORM_NUMBER": int(path.split("/")[-2]),
            "PRES": [[float(value)] for _, value in rows],
        }
    )


def write_index(spark: SparkSession, sf_dir: str, columns: list[str]) -> str:
    """The index as text files, each with eight preamble lines and a header."""
    folder = f"{scratch(spark)}/{BIOGEOCHEMICAL.index_file}"
    text = index_text(spark, sf_dir).select(*(F.col(c).cast("string") for c in columns))

    def lines(batches):
        started = False
        for frame in batches:
            rows = frame.fillna("").agg(",".join, axis=1).tolist() if len(frame) else []
            if rows and not started:
                rows = [f"# preamble line {k}" for k in range(8)] + [",".join(columns)] + rows
                started = True
            yield pd.DataFrame({"value": rows})

    text.mapInPandas(lines, "value string").write.text(folder)
    return folder


def write_broken_index(spark: SparkSession, sf_dir: str, columns: list[str]) -> str:
    """The index as text files; some lines are cut off, some too long, some quoted, some not numbers."""
    folder = f"{scratch(spark)}/{BIOGEOCHEMICAL.index_file}"
    key = F.col("ord")
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    quoted = [F.when(key % 107 == 0, F.concat(F.lit('"'), cells[0], F.lit('"'))).otherwise(cells[0]), *cells[1:]]
    wrong = F.when(key % 109 == 0, "deep").otherwise(cells[2])
    line = (
        F.when(key % 101 == 0, F.concat_ws(",", *cells[:3]))
        .when(key % 103 == 0, F.concat_ws(",", *cells, F.lit("more")))
        .otherwise(F.concat_ws(",", *quoted[:2], wrong, *cells[3:]))
    )

    def lines(batches):
        started = False
        for frame in batches:
            rows = frame["value"].tolist()
            if rows and not started:
                rows = ["# preamble", ",".join(columns), *rows]
                started = True
            yield pd.DataFrame({"value": rows})

    index_text(spark, sf_dir).select(line.alias("value")).mapInPandas(lines, "value string").write.text(folder)
    return folder


def remote_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        _float_file(REMOTE_ROOT).alias("url"),
        F.when(key % 23 != 0, _day("1999-01-01", key * 11 % 1800)).alias("remote_mtime"),
        F.when(key % 29 == 0, 404).otherwise(200).alias("status"),
    )


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One profile per order, one file per customer, levels from the line numbers.

    Lines that share a level are merged, so an order is reduced before it is
    shuffled and its arrays stay short. Files are padded to seven to nine
    levels, by customer.
    """
    level = (F.col("l_linenumber") - 1) % LEVELS
    merged = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            (F.max(level) + 1).cast("int").alias("own_levels"),
            *(F.sum(F.when(level == k, F.col("l_quantity"))).alias(f"p{k}") for k in range(LEVELS)),
            *(
                F.max(F.when(level == k, F.col("l_extendedprice"))).alias(f"t{k}")
                for k in range(LEVELS)
            ),
        )
    )

    def array(values: list[Column], kind: str) -> Column:
        return F.slice(F.array(*values), 1, F.col("own_levels")).cast(f"array<{kind}>")

    span = range(LEVELS)
    return (
        table(spark, sf_dir, "orders")
        .join(merged, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .select(
            F.col("o_custkey").cast("string").alias("source_file"),
            F.col("o_orderkey").alias("N_PROF"),
            (F.lit(LEVELS) + F.col("o_custkey") % 3).cast("int").alias("level_count"),
            (F.lit(1900000) + F.col("o_custkey")).alias("PLATFORM_NUMBER"),
            (F.col("o_orderkey") % 300 + 1).alias("CYCLE_NUMBER"),
            F.when(F.col("o_orderkey") % 10 == 0, "D").otherwise("A").alias("DIRECTION"),
            (F.col("o_orderkey") * 7919 % 18001 / 100 - 90).alias("LATITUDE"),
            (F.col("o_orderkey") * 104729 % 36001 / 100 - 180).alias("LONGITUDE"),
            F.col("o_orderdate").alias("JULD"),
            array([F.col(f"p{k}") for k in span], "float").alias("PRES"),
            array([F.col(f"t{k}") / 1000 for k in span], "float").alias("TEMP"),
            array(
                [F.when(F.col(f"p{k}").isNotNull(), k + 1) for k in span], "smallint"
            ).alias("TEMP_QC"),
        )
    )


def staged_uneven(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same profiles; some files declare no number of levels, some only two."""
    customer = F.col("source_file").cast("bigint")
    count = F.when(customer % 5 == 0, 2).when(customer % 7 != 0, F.col("level_count"))
    return staged(spark, sf_dir).withColumn("level_count", count)


def parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles with parameter names and data modes, one level per event.

    One file per user, one profile per user and block of event ids; a file has as
    many levels as its longest profile.
    """
    event, user = F.col("event_id"), F.col("source_file").cast("bigint")
    name = F.create_map(*(F.lit(x) for kv in EVENT_PARAMETERS.items() for x in kv))
    letters = F.array(F.lit("R"), F.lit("A"), F.lit("D"))
    entry = F.struct(
        event,
        name[F.col("event_type")].alias("name"),
        F.when(event % 501 == 0, "RR").otherwise(F.get(letters, event % 3)).alias("mode"),
        (event % 701 == 0).alias("differs"),
        "value",
    )
    grouped = (
        table(spark, sf_dir, "events")
        .groupBy(
            F.col("user_id").cast("string").alias("source_file"),
            F.floor(event / BLOCK).alias("N_PROF"),
        )
        .agg(F.sort_array(F.collect_list(entry)).alias("e"), F.max("ts").alias("JULD"))
    )
    longest = grouped.groupBy("source_file").agg(F.max(F.size("e")).alias("level_count"))
    return grouped.join(longest, "source_file").select(
        "source_file",
        "N_PROF",
        "level_count",
        user.alias("PLATFORM_NUMBER"),
        "JULD",
        F.transform("e", lambda e: e["value"].cast("float")).alias("TEMP"),
        F.array(
            F.transform("e", lambda e: e["name"]),
            F.transform("e", lambda e: F.when(e["differs"], "X").otherwise(e["name"])),
        ).alias("PARAMETER"),
        F.when(user % 10 != 0, F.transform("e", lambda e: e["mode"])).alias("PARAMETER_DATA_MODE"),
    )


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Level rows with positions, one per event."""
    event, user = F.col("event_id"), F.col("user_id")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("ts").alias("JULD"),
        F.col("value").alias("PRES_ADJUSTED"),
        (user * 271 % 5001 / 100 + 30).alias("LATITUDE"),
        (user * 613 % 4001 / 100 - 85).alias("LONGITUDE"),
        F.when(event % 13 == 0, None)
        .when(event % 11 == 0, float("nan"))
        .otherwise(F.col("value") / 100)
        .alias("CHLA_ADJUSTED"),
        (event % 9 + 1).alias("CHLA_ADJUSTED_QC"),
    )


def wide_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Biogeochemical profiles with every measurement of the schema and all data modes."""
    narrow = staged(spark, sf_dir)
    source = {"float": F.col("TEMP"), "smallint": F.col("TEMP_QC")}
    fields = [
        f
        for f in staged_schema("bgc")
        if isinstance(f.dataType, ArrayType) and not f.name.startswith("PARAMETER")
    ]
    names = F.array(*map(F.lit, BIOGEOCHEMICAL.data_mode_parameters))
    letter = F.get(F.array(F.lit("R"), F.lit("A"), F.lit("D")), F.col("N_PROF") % 3)
    return narrow.select(
        *(c for c in narrow.columns if c not in {"PRES", "TEMP", "TEMP_QC"}),
        *(source[f.dataType.elementType.simpleString()].alias(f.name) for f in fields),
        F.array(names, names).alias("PARAMETER"),
        F.transform(names, lambda n: letter).alias("PARAMETER_DATA_MODE"),
    )
