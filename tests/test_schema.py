import pytest
from pyspark.sql import types as T

from profilelake import schema as S
from profilelake.flavour import BIOGEOCHEMICAL, CORE, flavour, flavours


def test_column_counts_and_order():
    core, bgc = S.level_schema("phy"), S.level_schema("BGC")
    assert len(core) == 26 and len(bgc) == 219
    assert core.fieldNames()[:7] == [
        "PLATFORM_NUMBER", "N_PROF", "N_LEVELS", "CYCLE_NUMBER", "DIRECTION", "DATA_MODE",
        "LATITUDE",
    ]
    assert core.fieldNames()[-5:] == [
        "PSAL", "PSAL_QC", "PSAL_ADJUSTED", "PSAL_ADJUSTED_QC", "PSAL_ADJUSTED_ERROR"
    ]
    assert "DATA_MODE" not in bgc.fieldNames()
    assert bgc.fieldNames()[10:16] == [
        "PRES", "PRES_QC", "PRES_ADJUSTED", "PRES_ADJUSTED_QC", "PRES_ADJUSTED_ERROR",
        "PRES_DATA_MODE",
    ]
    assert bgc.fieldNames()[18] == "TEMP_dPRES"
    assert bgc.fieldNames()[-1] == "DOWNWELLING_PAR_DATA_MODE"
    assert len({n.lower() for n in bgc.fieldNames()}) == 219


@pytest.mark.parametrize(
    "name, expected",
    [
        ("PLATFORM_NUMBER", T.LongType()),
        ("N_LEVELS", T.LongType()),
        ("JULD_QC", T.ShortType()),
        ("TEMP_ADJUSTED_QC", T.ShortType()),
        ("LATITUDE", T.DoubleType()),
        ("JULD", T.TimestampNTZType()),
        ("DIRECTION", T.StringType()),
        ("DATA_MODE", T.StringType()),
        ("CHLA_DATA_MODE", T.StringType()),
        ("TEMP_dPRES", T.FloatType()),
        ("PRES_ADJUSTED_ERROR", T.FloatType()),
    ],
)
def test_type_rules(name, expected):
    assert S.column_type(name) == expected
    assert all(f.nullable for f in S.level_schema("bgc"))


def test_flavours():
    assert flavour("Phy") is CORE and flavour("BGC") is BIOGEOCHEMICAL
    assert flavours() == (CORE, BIOGEOCHEMICAL) and flavours("bgc") == (BIOGEOCHEMICAL,)
    assert len(BIOGEOCHEMICAL.data_mode_parameters) == 30
    assert CORE.data_mode_parameters == ()
    for bad in ("core", "", None, 3):
        with pytest.raises(ValueError):
            flavour(bad)


def test_save_and_load(spark, tmp_path):
    path = str(tmp_path / "schema")
    S.save_schema(spark, S.level_schema("bgc"), path)
    assert S.load_schema(spark, path) == S.level_schema("bgc")
    with pytest.raises(ValueError):
        S.save_schema(spark, None, path)


def test_sorted_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "TEMP_dPRES int, TEMP_QC int, CHLA int")
    assert S.column_names(df) == ["CHLA", "TEMP_QC", "TEMP_dPRES"]
    assert S.column_names(S.level_schema("phy"))[0] == "CYCLE_NUMBER"


def test_staged_schema_has_one_array_per_measurement():
    fields = {f.name: f.dataType for f in S.staged_schema("bgc")}
    assert fields["TEMP_dPRES"] == T.ArrayType(T.FloatType())
    assert fields["CHLA_QC"] == T.ArrayType(T.ShortType())
    assert fields["JULD_QC"] == T.ShortType()
    assert "TEMP_DATA_MODE" not in fields and "N_LEVELS" not in fields
    narrow = S.staged_schema("bgc", ["PRES"]).fieldNames()
    assert "PRES_ADJUSTED_QC" in narrow and "TEMP" not in narrow
