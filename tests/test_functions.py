from __future__ import annotations

import hashlib
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry import functions as fn
from basketry import schemas


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_surrogate_key_formula(spark):
    got = value(spark, fn.surrogate_key(F.lit("a"), F.lit(None).cast("string"), F.lit(3)))
    assert got == hashlib.md5(b"a-_dbt_utils_surrogate_key_null_-3").hexdigest()


@pytest.mark.parametrize("text,expected", [("2.7", 3), ("2.5", 3), ("-2.5", -3), ("4", 4), (None, None)])
def test_int_cast_rounds(spark, text, expected):
    assert value(spark, fn.to_int(F.lit(text).cast("string"))) == expected


def test_int_cast_of_integers_is_plain(spark):
    assert value(spark, fn.to_int(F.lit(7).cast("bigint"), T.LongType())) == 7


@pytest.mark.parametrize(
    "text,expected",
    [
        ("2023-01-01", datetime(2023, 1, 1)),
        ("2023-01-01 00:00:00", datetime(2023, 1, 1)),
        ("2025-02-03 14:34:14.535012", datetime(2025, 2, 3, 14, 34, 14, 535012)),
        ("2025-02-03T14:34:14.500", datetime(2025, 2, 3, 14, 34, 14, 500000)),
        ("x", None),
        ("", None),
        ("2024-02-30", None),
    ],
)
def test_timestamp_text(spark, text, expected):
    assert value(spark, fn.parse_timestamp(F.lit(text))) == expected


def test_bad_numbers_raise(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        value(spark, fn.cast_to(F.lit("abc"), "decimal(12,2)"))


def test_greatest_is_null_strict(spark):
    assert value(spark, fn.greatest_strict(F.lit(1.0), F.lit(None).cast("double"))) is None
    assert value(spark, fn.greatest_strict(F.lit(1.0), F.lit(2.0))) == 2.0


def test_days(spark):
    sunday = F.lit(date(2024, 1, 7))
    assert value(spark, fn.day_number_sunday0(sunday)) == 0
    late = F.lit(datetime(2024, 1, 1, 23, 59)).cast("timestamp_ntz")
    early = F.lit(datetime(2024, 1, 2, 0, 1)).cast("timestamp_ntz")
    assert value(spark, fn.days_between(late, early)) == 1
    assert value(spark, fn.months_before(F.lit(date(2024, 5, 31)), 3)) == date(2024, 2, 29)


@pytest.mark.parametrize(
    "num,den,digits,expected",
    [("1.00", "8.00", 2, "0.13"), ("-1.00", "8.00", 2, "-0.13"), ("2", "3", 1, "0.7"), ("9", "4", 1, "2.3")],
)
def test_rounded_ratio(spark, num, den, digits, expected):
    got = fn.rounded_ratio(
        F.lit(Decimal(num)).cast("decimal(22,2)"), F.lit(Decimal(den)).cast("decimal(22,2)"), digits
    )
    assert value(spark, got) == Decimal(expected)


def test_ratio_of_zero_is_null(spark):
    assert value(spark, fn.ratio(F.lit(1), F.lit(0))) is None


@pytest.mark.parametrize(
    "address,city", [("12 Main St", ""), ("1 A St, Austin, Texas, USA", "Austin"), (" , , ", ""), (None, None)]
)
def test_address_part(spark, address, city):
    assert value(spark, fn.address_part(F.lit(address).cast("string"), -3)) == city


def test_registry():
    assert schemas.primary_key("latest_interactions") == "event_id"
    assert schemas.primary_key("unheard_of") == "id"
    assert schemas.date_column("customers") == "signup_date"
    assert schemas.date_column("unheard_of") is None
    assert schemas.valid_date_column("customers", ["LAST_LOGIN"]) == "last_login"
    assert schemas.valid_date_column("products", ["price"]) is None
