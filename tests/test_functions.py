from __future__ import annotations

import hashlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from tidemark.functions import (
    clean_string,
    clean_strings,
    day_stamp,
    empty_to_null,
    file_stamp,
    file_stamp_of,
    fingerprint,
    parse_instant,
    parse_keys,
    require_columns,
    second_stamp,
    second_stamp_of,
    string_columns,
)


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_fingerprint_joins_the_columns_in_order(spark):
    df = spark.createDataFrame([("a", 1, 2.5)], "x string, y int, z double")
    assert rows(df.select(fingerprint(["x", "y", "z"])))[0][0] == digest("a||1||2.5")
    assert rows(df.select(fingerprint(["z", "x", "y"])))[0][0] == digest("2.5||a||1")


def test_fingerprint_number_text_is_that_of_spark(spark):
    df = spark.createDataFrame([(0.00001, 12345678.0)], "x double, y double")
    assert rows(df.select(fingerprint(["x", "y"])))[0][0] == digest("1.0E-5||1.2345678E7")


def test_fingerprint_leaves_nulls_out(spark):
    df = spark.createDataFrame(
        [("a", None, "b"), ("a", "b", None), (None, None, None)], "x string, y string, z string"
    )
    first, second, third = [r[0] for r in df.select(fingerprint(["x", "y", "z"])).collect()]
    assert first == second == digest("a||b")
    assert third == digest("")


def test_fingerprint_null_token_keeps_positions_apart(spark):
    df = spark.createDataFrame(
        [("a", None, 1), ("a", "1", None)], "x string, y string, z int"
    )
    found = [r[0] for r in df.select(fingerprint(["x", "y", "z"], "~")).collect()]
    assert found == [digest("a||~||1"), digest("a||1||~")]


def test_fingerprint_takes_awkward_names(spark):
    df = spark.createDataFrame([("a", "b")], "`x.y` string, `z w` string")
    assert rows(df.select(fingerprint(["x.y", "z w"])))[0][0] == digest("a||b")


def test_fingerprint_needs_columns():
    with pytest.raises(ValueError, match="at least one"):
        fingerprint([])


def test_parse_keys():
    assert parse_keys("ID,ESTAB") == ["ID", "ESTAB"]
    assert parse_keys(" id , name") == ["id", "name"]
    assert parse_keys(["id"]) == ["id"]
    with pytest.raises(ValueError, match="empty key"):
        parse_keys("id,,name")


def test_require_columns_names_the_missing_ones(spark):
    with pytest.raises(ValueError, match=r"stage has no column \['hash_colums'\]"):
        require_columns(spark.range(1), ["id", "hash_colums"], "stage")


@pytest.mark.parametrize(
    ("raw", "cleaned"),
    [
        ("", None),
        (None, None),
        ("  ", ""),
        (" aave ", "AAVE"),
        ("\tx\t", "\tX\t"),
        ("https://a/b.png?1", "HTTPS://A/B.PNG?1"),
        ("2025-06-21T19:27:01.000Z", "2025-06-21T19:27:01.000Z"),
        ("straße", "STRASSE"),
    ],
)
def test_clean_string(spark, raw, cleaned):
    df = spark.createDataFrame([(raw,)], "s string")
    assert df.select(clean_string(F.col("s"))).first()[0] == cleaned


def test_empty_to_null_keeps_blanks(spark):
    df = spark.createDataFrame([("",), (" ",), (None,), ("a",)], "s string")
    assert [r[0] for r in df.select(empty_to_null(F.col("s"))).collect()] == [None, " ", None, "a"]


def test_clean_strings_chooses_by_type(spark):
    schema = T.StructType(
        [
            T.StructField("id", T.StringType()),
            T.StructField("n", T.LongType()),
            T.StructField("note", T.StringType()),
            T.StructField("hash_columns", T.StringType()),
            T.StructField("tags", T.ArrayType(T.StringType())),
        ]
    )
    df = spark.createDataFrame([(" a", 1, "", "ff", ["x"])], schema)
    assert string_columns(df, exclude=["hash_columns"]) == ["id", "note"]
    assert string_columns(df, include=["note", "n"]) == ["note"]
    cleaned = clean_strings(df, exclude=["hash_columns"])
    assert cleaned.columns == df.columns
    assert cleaned.collect()[0].asDict() == {
        "id": "A",
        "n": 1,
        "note": None,
        "hash_columns": "ff",
        "tags": ["x"],
    }


def test_clean_strings_is_one_projection(spark):
    df = spark.createDataFrame([("a",) * 30], ",".join(f"c{i} string" for i in range(30)))
    logical = clean_strings(df)._jdf.queryExecution().analyzed().toString()
    assert logical.count("Project") == 1


def test_parse_instant_turns_bad_text_into_null(spark):
    df = spark.createDataFrame(
        [("2025-06-21 16:27:36",), ("2025-06-21",), ("yesterday",), (None,), ("",)], "s string"
    )
    assert [r[0] for r in df.select(parse_instant(F.col("s"))).collect()] == [
        datetime(2025, 6, 21, 16, 27, 36),
        datetime(2025, 6, 21),
        None,
        None,
        None,
    ]
    assert df.select(parse_instant(F.col("s"), "timestamp")).schema[0].dataType == T.TimestampType()


def test_clock_formats_agree_with_python(spark):
    at = datetime(2024, 5, 1, 13, 5, 11)
    assert file_stamp(at) == "20240501_130511"
    assert second_stamp(at) == "2024-05-01 13:05:11"
    assert day_stamp(at) == "2024-05-01"
    df = spark.createDataFrame([(at,)], "at timestamp_ntz")
    assert tuple(df.select(file_stamp_of(F.col("at")), second_stamp_of(F.col("at"))).first()) == (
        file_stamp(at),
        second_stamp(at),
    )
