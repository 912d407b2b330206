import datetime as dt
import decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F, types as T

from tests.conftest import rows
from tidemark.functions import (ADD_ONE_DAY, NUMBER_BYTES, convert_columns, enum_to_text, flatten_columns,
                                int_divide, is_type_default, json_column, nest_columns, parent_key,
                                parse_json_column, quote, restore_columns, round_timestamp, truncate_timestamp)
from tidemark.functions import EPOCH_MICROS
from tidemark.functions.arithmetic import bit_not

D = decimal.Decimal


@pytest.mark.parametrize("value, dtype, expected", [
    (0, "int", True), (1, "int", False), (-1, "int", False), (0.0, "float", True), (-1.0, "float", False),
    (0.0, "double", True), (-1.0, "double", False), (D(0), "decimal(10,2)", True), (D(-1), "decimal(10,2)", False),
    (None, "string", True), ("", "string", False), (" ", "string", False), (False, "boolean", True),
    (True, "boolean", False), (dt.datetime(1, 1, 1), "timestamp_ntz", True),
    (dt.datetime(2000, 1, 1), "timestamp_ntz", False), (dt.date(1, 1, 1), "date", True),
    (dt.date(2000, 1, 1), "date", False), (dt.time(0, 0), "time(6)", True), (dt.time(1, 0), "time(6)", False),
    (None, "int", True), (b"", "binary", False),
])
def test_type_defaults(spark, value, dtype, expected):
    df = spark.createDataFrame([(value,)], f"v {dtype}")
    assert df.select(is_type_default(F.col("v"), df.schema["v"].dataType)).first()[0] is expected


def test_empty_uuid_is_a_default_when_asked(spark):
    df = spark.createDataFrame([("00000000-0000-0000-0000-000000000000",), ("6f9619ff-8b86-d011-b42d-00c04fc964ff",)], "v string")
    assert [r[0] for r in df.select(is_type_default(F.col("v"), T.StringType(), uuid=True)).collect()] == [True, False]


@pytest.mark.parametrize("digits, cut, rounded", [
    (3, "2020-01-01 00:00:00.324", "2020-01-01 00:00:00.325"),
    (0, "2020-01-01 00:00:00", "2020-01-01 00:00:00"),
    (6, "2020-01-01 00:00:00.3245", "2020-01-01 00:00:00.3245"),
])
def test_timestamp_precision(spark, digits, cut, rounded):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2020-01-01 00:00:00.3245' AS ts")
    row = df.select(truncate_timestamp(F.col("ts"), digits).cast("string"),
                    round_timestamp(F.col("ts"), digits).cast("string")).first()
    assert row == (cut, rounded)
    with pytest.raises(ValueError, match="precision"):
        round_timestamp(F.col("ts"), 7)


def test_timestamps_before_1970_are_cut_towards_the_past(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '1969-12-31 23:59:59.9995' AS ts")
    assert df.select(truncate_timestamp(F.col("ts"), 3).cast("string")).first()[0] == "1969-12-31 23:59:59.999"


def test_timestamps_as_numbers(spark):
    df = spark.sql("""SELECT TIMESTAMP_NTZ '2024-03-31 02:30:00.123456' AS ts UNION ALL
                      SELECT TIMESTAMP_NTZ '1969-12-31 23:59:59.999999' UNION ALL SELECT NULL""")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")  # 02:30 does not exist there on that day
        stored = convert_columns(df, {"ts": EPOCH_MICROS})
        assert rows(stored) == [(-1,), (1711852200123456,), (None,)]
        assert rows(restore_columns(stored, {"ts": EPOCH_MICROS})) == rows(df)
        cut = df.select(truncate_timestamp(F.col("ts"), 3).cast("string").alias("c"))
        assert rows(cut) == [("1969-12-31 23:59:59.999",), ("2024-03-31 02:30:00.123",), (None,)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_integer_arithmetic(spark):
    assert spark.range(1).select(int_divide(F.lit(7), F.lit(2)), int_divide(F.lit(-7), F.lit(2))).first() == (3, -3)
    assert spark.range(1).select(bit_not(F.lit(6), T.IntegerType()), bit_not(F.lit(True), T.BooleanType())).first() == (-7, False)


def test_converters_undo_themselves(spark):
    df = spark.createDataFrame([(1, dt.datetime(2020, 2, 28), 5), (2, None, None), (1, None, -9)], "e int, d timestamp_ntz, n bigint")
    converters = {"e": enum_to_text({1: "one", 2: "two"}), "d": ADD_ONE_DAY, "n": NUMBER_BYTES, "absent": NUMBER_BYTES}
    stored = convert_columns(df, converters)
    assert rows(stored, "e", "d")[0] == ("one", dt.datetime(2020, 2, 29))
    assert rows(restore_columns(stored, converters)) == rows(df)


def test_deep_structs(spark):
    df = spark.sql("""SELECT 1 AS id, named_struct('c', named_struct('g', named_struct('v', 5), 'w', 'x'), 'n', 2) AS root
                      UNION ALL SELECT 2, NULL""")
    flat = flatten_columns(df)
    assert flat.columns == ["id", "root_c_g_v", "root_c_w", "root_n"]
    assert rows(flat) == [(1, 5, "x", 2), (2, None, None, None)]
    layout = {"root": {"c": {"g": {"v": "root_c_g_v"}, "w": "root_c_w"}, "n": "root_n"}}
    assert sorted(map(str, nest_columns(flat, layout).collect())) == sorted(map(str, df.collect()))
    assert flatten_columns(df, exclude=["root.c"]).columns == ["id", "root_n"]
    assert flatten_columns(df, keep=["root.c"]).columns == ["id", "root_c", "root_n"]
    with pytest.raises(ValueError, match="both"):
        flatten_columns(df, include=["id"], exclude=["id"])


def test_json_columns(spark):
    df = spark.sql("SELECT 1 AS id, named_struct('address', named_struct('city', 'Rom'), 'phone', NULL) AS contact")
    text = json_column(df, "contact")
    assert text.first()["contact"] == '{"address":{"city":"Rom"}}'
    back = parse_json_column(text, {"contact": "address struct<city:string>, phone string"})
    assert back.select("contact.address.city").first()[0] == "Rom"


def test_names_and_references(spark):
    df = spark.createDataFrame([(1,)], "`a.b``c` int")
    assert df.select(quote("a.b`c")).first()[0] == 1
    nested = spark.sql("SELECT 1 AS id, named_struct('id', 9, 'name', 'x') AS parent UNION ALL SELECT 2, NULL")
    assert rows(parent_key(nested, "parent", "id")) == [(1, 9), (2, None)]


def test_an_unknown_member_fails(spark):
    kinds = enum_to_text({1: "one", 2: "two"})
    df = spark.createDataFrame([(1,), (None,), (3,)], "n int")
    assert [r[0] for r in df.filter("n IS NULL OR n < 3").select(kinds.to_store(F.col("n"))).collect()] == ["one", None]
    with pytest.raises(PySparkException, match="no member of the enumeration: 3"):
        df.select(kinds.to_store(F.col("n"))).collect()
