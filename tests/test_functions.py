from __future__ import annotations

import random
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallymart.fixed_values import DATE_FORMATS, ISO_DATE_FORMAT, TIMESTAMP_FORMATS
from tallymart.functions import (
    average_order_value,
    parse_date,
    parse_timestamp,
    to_money,
    to_whole,
)


def evaluate(spark, values, column, kind="string"):
    df = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    return [row[0] for row in df.orderBy("i").select(column).collect()]


TIMES = {
    "2025-12-30 10:00:05": datetime(2025, 12, 30, 10, 0, 5),
    "12/30/2025 10:00": datetime(2025, 12, 30, 10, 0),
    "12/30/2025 10:00:30": datetime(2025, 12, 30, 10, 0, 30),
    "2025/12/30 10:00:30": datetime(2025, 12, 30, 10, 0, 30),
    "1/5/2026 8:00": datetime(2026, 1, 5, 8, 0),
    "01/05/2026 08:00": datetime(2026, 1, 5, 8, 0),
    "2026-1-5 8:0:0": datetime(2026, 1, 5, 8, 0),
    "12/30/2025 10:00junk": None,
    "13/45/2025 10:00": None,
    "2/30/2025 10:00": None,
    "12/30/25 10:00": None,
    "junk": None,
    "": None,
}


def test_timestamp_formats(spark):
    found = evaluate(spark, [*TIMES, None], parse_timestamp(F.col("v")))
    assert found == [*TIMES.values(), None]


def test_shapes_hide_no_readable_text(spark):
    """Same result as trying every format on every text."""
    dice = random.Random(7)
    numbers = ["1", "07", "12", "31", "007", "2025", "25", "12025", "+12025", "-1", "+5", "0", ""]
    plain_numbers = ["1", "07", "11", "2025"]
    signs = ["-", "/", " ", ":", " ", "T", ""]
    texts = [
        "".join(dice.choice(numbers) + dice.choice(signs) for _ in range(6)) for _ in range(3000)
    ]
    for pattern in ("{}-{}-{} {}:{}:{}", "{}/{}/{} {}:{}:{}", "{}/{}/{} {}:{}", "{}/{}/{}"):
        for choice in (numbers, plain_numbers):
            texts += [
                pattern.format(*(dice.choice(choice) for _ in range(6))) for _ in range(2000)
            ]
    for formats in (TIMESTAMP_FORMATS, (*DATE_FORMATS, ISO_DATE_FORMAT)):
        plain = F.coalesce(*(F.try_to_timestamp("v", F.lit(fmt)) for fmt in formats))
        expected = evaluate(spark, texts, plain.cast("string"))
        assert evaluate(spark, texts, parse_timestamp(F.col("v"), formats).cast("string")) == (
            expected
        )
        assert sum(value is not None for value in expected) > 100


DATES = {
    "2025-12-30 10:00:05": date(2025, 12, 30),
    "12/30/2025": date(2025, 12, 30),
    "1/5/2026": date(2026, 1, 5),
    "12/30/2025 23:59:59": date(2025, 12, 30),
    "1/5/2026 8:00": date(2026, 1, 5),
    "2025-12-30": None,
    "2025/12/30": None,
    "n/a": None,
}


def test_date_formats(spark):
    assert evaluate(spark, DATES, parse_date(F.col("v"))) == list(DATES.values())


def test_iso_dates_on_request(spark):
    parsed = parse_date(F.col("v"), (*DATE_FORMATS, ISO_DATE_FORMAT))
    assert evaluate(spark, ["2025-12-30", "12/30/2025"], parsed) == [date(2025, 12, 30)] * 2


def test_whole_numbers_cut_fractions(spark):
    values = ["2", "2.7", "-2.7", "1e3", " 7 ", "abc", "", None, "3000000000", "NaN"]
    expected = [2, 2, -2, 1000, 7, None, None, None, None, None]
    assert evaluate(spark, values, to_whole(F.col("v"), "int")) == expected


def test_large_ids_stay_exact(spark):
    ids = ["9007199254740993", "9223372036854775807"]
    assert evaluate(spark, ids, to_whole(F.col("v"), "bigint")) == [int(v) for v in ids]


def test_whole_numbers_from_double(spark):
    assert evaluate(spark, [2.7, -0.5, None], to_whole(F.col("v"), "int"), "double") == [
        2,
        0,
        None,
    ]


def test_money_rounds_half_up(spark):
    values = ["10.5", "10.505", "10.504", "-10.505", "free", "", "99999999999.99", None]
    expected = [*map(Decimal, ("10.50", "10.51", "10.50", "-10.51")), None, None, None, None]
    assert evaluate(spark, values, to_money(F.col("v"))) == expected


@pytest.mark.parametrize(("lines", "expected"), [(2, 5.0), (0, None)])
def test_average_order_value(spark, lines, expected):
    value = average_order_value(F.lit(10.0), F.lit(lines))
    assert spark.range(1).select(value).first()[0] == expected
