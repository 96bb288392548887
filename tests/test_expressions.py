from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, IntegerType, StringType, TimestampType

from lapidar.functions.expressions import (
    is_blank,
    month_start,
    ratio,
    surrogate_key,
    tolerant_cast,
    version_key,
)


def one(spark, text, expression):
    df = spark.createDataFrame([(text,)], "v string")
    return df.select(expression).first()[0]


@pytest.mark.parametrize(
    "text, dtype, expected",
    [
        ("7", IntegerType(), 7),
        (" 7 ", IntegerType(), 7),
        ("1.0", IntegerType(), 1),
        ("1.9", IntegerType(), 1),
        ("-3.7", IntegerType(), -3),
        ("", IntegerType(), None),
        ("  ", IntegerType(), None),
        ("abc", IntegerType(), None),
        ("12a", IntegerType(), None),
        ("12345678901", IntegerType(), None),
        ("1e3", IntegerType(), None),
        (None, IntegerType(), None),
        ("12.345", DecimalType(10, 2), Decimal("12.35")),
        (" 5 ", DecimalType(10, 2), Decimal("5.00")),
        ("123456789.12", DecimalType(10, 2), None),
        ("R$ 1", DecimalType(10, 2), None),
        ("2024-01-02", DateType(), date(2024, 1, 2)),
        ("02/01/2024", DateType(), None),
        ("2024-01-02 03:04:05", TimestampType(), datetime(2024, 1, 2, 3, 4, 5)),
        ("02/01/2024", TimestampType(), None),
        ("  a b ", StringType(), "a b"),
    ],
)
def test_tolerant_cast(spark, text, dtype, expected):
    value = one(spark, text, tolerant_cast("v", dtype))
    assert value == expected


def test_blank_and_keys(spark):
    assert [one(spark, t, is_blank("v")) for t in (None, "", "  ", "x")] == [True, True, True, False]
    # MD5 of "42" as published in every MD5 table
    assert one(spark, "42", surrogate_key("v")) == "a1d0c6e83f027327d8461063f4ac58a6"


def test_version_key_differs_between_versions(spark):
    starts = [datetime(1900, 1, 1), datetime(2024, 1, 1)]
    df = spark.createDataFrame([(1, s) for s in starts], "k int, s timestamp")
    assert df.select(version_key("k", "s")).distinct().count() == 2
    assert df.select(surrogate_key("k")).distinct().count() == 1


def test_ratio_guards_zero_and_null(spark):
    df = spark.createDataFrame([(1, 2), (1, 0), (None, 2)], "a int, b int")
    assert [r[0] for r in df.select(ratio(F.col("a"), F.col("b"))).collect()] == [0.5, 0.0, 0.0]


def test_month_start(spark):
    df = spark.createDataFrame([(datetime(2024, 5, 17, 8),)], "t timestamp")
    assert df.select(month_start("t")).first()[0] == datetime(2024, 5, 1)
