"""Text and fixed-point column functions against Python's own decimal and time parsing."""

from __future__ import annotations

import random
from datetime import date, datetime
from decimal import Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from pricefold.functions import scalars


def applied(spark, function, values):
    frame = spark.createDataFrame([(index, value) for index, value in enumerate(values)], "id int, value string")
    rows = frame.select("id", function("value").alias("result")).orderBy("id").collect()
    return [row["result"] for row in rows]


def test_scaled_truncates(spark):
    numbers = [
        "23.45019", "0.00009999999999999", "28.75", " 1e3 ", "5.", ".5", "+5", "0.99999", "-0.00001", "-0.0", "0",
        "1e-40", "1e-4", "9e-5", "123456789.1234", "99999999999.999", "99999999999999", "0.1234", "00012.30", "1.0000",
        "99999999.99999999999999999", "922337203685477.5807", "0.3333333333333333", "7e-5",
    ]
    assert applied(spark, scalars.scaled, numbers) == [int(Decimal(number) * 10000) for number in numbers]


def test_scaled_rejects(spark):
    bad = ["", " ", "NaN", "abc", "1_000", "Infinity", "1,5", "-0.0001", "-3", "922337203685477.5808", "0x10", "1.2.3", ".", "1d", "5f", "-5.1", "1 2", None]
    assert applied(spark, scalars.scaled, bad) == [None] * len(bad)


def test_scaled_reciprocal(spark):
    numbers = ["0.5", "0.142857143", "2", "3", "1", "7", "0.0001", "1.5", "0.3333333333334", "1e3", "0.373", "30000"]
    numbers += ["100.000000000000000001", "99.999999999999999999", "1000000", "1e7", "123456789012", "9999.99", "10000"]
    numbers += ["10000.000000001", "0.000099", "0.00010000000000000001", "3.000000000000000000000001", "1e30", "0.1"]
    # In whole numbers, since a quotient of 28 digits is rounded.
    expected = [int(Fraction(10000) / Fraction(number)) for number in numbers]
    assert expected[:2] == [20000, 69999]
    assert applied(spark, scalars.scaled_reciprocal, numbers) == expected
    bad = ["0", "-2", "", "x", "NaN", "Infinity", "-1e7", "1e-30", None]
    assert applied(spark, scalars.scaled_reciprocal, bad) == [None] * len(bad)


def test_every_two_decimal_reciprocal(spark):
    numbers = [f"{cents / 100:.2f}" for cents in range(1, 2000)]
    expected = [int(1 / Decimal(number) * 10000) for number in numbers]
    assert applied(spark, scalars.scaled_reciprocal, numbers) == expected


def test_descaled(spark):
    values = [0, 1, 287500, 280000, 9223372036854775807]
    frame = spark.createDataFrame([(value,) for value in values], "value bigint")
    rows = frame.select("value", scalars.descaled("value").alias("result")).collect()
    assert {row["value"]: row["result"] for row in rows} == {value: Decimal(value) / 10000 for value in values}


def test_dates(spark):
    good = ["1980-12-12", "1980-1-2", "0001-01-01"]
    assert applied(spark, scalars.parsed_date, good) == [date(1980, 12, 12), date(1980, 1, 2), date(1, 1, 1)]
    bad = ["80-1-2", "1980/1/2", "1980-13-01", "1981-02-29", "1980-01-02 ", "1980-01-02T00:00:00", "", "19800-1-1"]
    assert applied(spark, scalars.parsed_date, bad) == [None] * len(bad)

    def dotted(value):
        return scalars.parsed_date(value, separator=".")

    day = date(2014, 6, 9)
    assert applied(spark, dotted, ["2014.6.9", "2014.06.09", "2014-06-09", "14.6.9", None]) == [day, day] + [None] * 3


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_times_do_not_depend_on_the_session_zone(spark, zone):
    # 02:30 on 2021-03-14 does not exist in New York.
    good = ["2013-12-09 12:00:00", "2021-03-14 02:30:00", "2020-1-2 3:4:5"]
    bad = ["2020-01-02T03:04:05", "2020-01-02 03:04:60", "2020-01-02 03:04", "2020-01-02 03:04:05.5", "20-1-2 3:4:5"]
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert applied(spark, scalars.parsed_time, good + bad) == [
            datetime(2013, 12, 9, 12), datetime(2021, 3, 14, 2, 30), datetime(2020, 1, 2, 3, 4, 5), *[None] * len(bad)
        ]
        row = spark.sql("select timestamp_ntz'2021-03-14 02:30:00' as value")
        assert row.select(scalars.day_of("value").alias("day")).first()["day"] == date(2021, 3, 14)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_truncated(spark):
    frame = spark.sql("select 9999.9999d as value")
    assert frame.select(scalars.truncated("value")).first()[0] == 9999


def test_short_and_long_numbers_equal_wide_arithmetic(spark):
    draw = random.Random(3)
    texts = ["", ".", "1.", ".5", "-0", "1e3", " 1e3 ", "1E-4", "9.9999e-1", "12345.67129999999999", "1.23456.7", "1.23456-7", "NaN"]
    texts += ["Infinity", "1d", "0x1p3", "1_000", "+1.5", "1e", "1234567890123456", "1e15", "1e38", "1.99999999999999", "1..2", "1.2345."]
    texts += ["1e999999999", "1e-999999999", "0e5", "99999999.999999", "99999999.99999999e3", "8.7e-9", "0.00009999"]
    for _ in range(5_000):
        digits = "".join(draw.choice("0123456789") for _ in range(draw.randint(1, 13)))
        cut = draw.randint(0, len(digits))
        power = f"e{draw.randint(-9, 6)}" if draw.random() < 0.5 else "9" * draw.randint(0, 9)
        texts.append(digits[:cut] + draw.choice([".", "."  , ""]) + digits[cut:] + power)
    frame = spark.createDataFrame([(text,) for text in texts], "text string")
    wide = scalars._scaled_widely(F.trim("text"))
    assert frame.where(~scalars.scaled("text").eqNullSafe(wide)).collect() == []
