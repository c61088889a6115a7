from __future__ import annotations

import random
from datetime import date
from decimal import Decimal

import pytest
from conftest import rows

from tallymart.operators.marts import (
    CUSTOMER_DAY,
    customer_category_revenue,
    customer_order_value,
    daily_category_summary,
    daily_customer_summary,
    rank_categories,
    top_category,
)

LINES = (
    "ORDER_ID bigint, CUSTOMER_ID bigint, ORDER_DATE date, COUNTRY string, CATEGORY string, "
    "QUANTITY int, REVENUE_LOCAL decimal(23,2), REVENUE_USD {usd}"
)
DAY = date(2026, 1, 5)
NAN = float("nan")


def line(order=1, customer=1, category="A", usd=1.0, day=DAY, country="US", quantity=1):
    return (order, customer, day, country, category, quantity, Decimal("2.00"), usd)


def frame(spark, lines, usd="double"):
    if usd != "double":
        lines = [(*row[:7], None if row[7] is None else Decimal(str(row[7]))) for row in lines]
    return spark.createDataFrame(lines, LINES.format(usd=usd))


def two_branches(df):
    """The customer table the long way: aggregate twice and join."""
    return customer_order_value(df).join(
        top_category(customer_category_revenue(df)), list(CUSTOMER_DAY)
    )


def test_category_summary(spark):
    df = frame(
        spark,
        [line(1, usd=1.5, quantity=2), line(1, usd=2.0, quantity=3), line(2), line(category="B")],
    )
    summary = daily_category_summary(df)
    assert summary.dtypes == [
        ("ORDER_DATE", "date"),
        ("COUNTRY", "string"),
        ("CATEGORY", "string"),
        ("TOTAL_ORDERS", "bigint"),
        ("TOTAL_QUANTITY", "bigint"),
        ("TOTAL_REVENUE_LOCAL", "decimal(33,2)"),
        ("TOTAL_REVENUE_USD", "double"),
    ]
    assert rows(summary) == [
        (DAY, "US", "A", 2, 6, Decimal("6.00"), 4.5),
        (DAY, "US", "B", 1, 1, Decimal("2.00"), 1.0),
    ]


def test_customer_summary_columns(spark):
    assert daily_customer_summary(frame(spark, [line()])).dtypes == [
        ("CUSTOMER_ID", "bigint"),
        ("ORDER_DATE", "date"),
        ("COUNTRY", "string"),
        ("TOTAL_ORDERS", "bigint"),
        ("AVG_ORDER_VALUE_USD", "double"),
        ("TOP_CATEGORY", "string"),
    ]


CUSTOMER_CASES = {
    "mean per line, one order": ([line(1, usd=1.0), line(1, usd=2.0)], (1, 1.5, "A")),
    "order over two categories": (
        [line(1, category="A", usd=1.0), line(1, category="B", usd=5.0), line(2, usd=1.0)],
        (2, 7.0 / 3, "B"),
    ),
    "tie goes to the alphabet": ([line(1, category="C"), line(2, category="B")], (2, 1.0, "B")),
    "no order id": ([line(None, usd=3.0)], (0, None, "A")),
    "some lines without order id": ([line(None, usd=3.0), line(1, usd=1.0)], (1, 4.0, "A")),
    "no revenue at all": ([line(1, category="B", usd=None), line(1, usd=None)], (1, None, "A")),
    "missing total ranks last": ([line(1, usd=None), line(1, category="Z", usd=-1.0)],
                                 (1, -0.5, "Z")),
    "missing category": ([line(1, category=None, usd=9.0), line(2)], (2, 5.0, None)),
    "named category wins a tie": ([line(1, category=None), line(2, category="B")],
                                  (2, 1.0, "B")),
    "negative revenue": ([line(1, usd=-2.0), line(1, category="B", usd=-1.0)], (1, -1.5, "B")),
}


@pytest.mark.parametrize("usd", ["double", "decimal(34,8)"])
@pytest.mark.parametrize("case", CUSTOMER_CASES)
def test_customer_summary(spark, case, usd):
    lines, expected = CUSTOMER_CASES[case]
    df = frame(spark, lines, usd)
    assert rows(daily_customer_summary(df)) == [(1, DAY, "US", *expected)]
    assert rows(two_branches(df)) == [(1, DAY, "US", *expected)]


def test_not_a_number_ranks_first(spark):
    df = frame(spark, [line(1, category="B", usd=NAN), line(1, usd=5.0)])
    assert daily_customer_summary(df).first()["TOP_CATEGORY"] == "B"
    assert two_branches(df).first()["TOP_CATEGORY"] == "B"


def test_lines_without_customer(spark):
    df = frame(spark, [line(1, customer=None), line(2)])
    assert daily_category_summary(df).first()["TOTAL_ORDERS"] == 2
    assert [row.CUSTOMER_ID for row in daily_customer_summary(df).collect()] == [1]


def test_rank_by_another_measure(spark):
    totals = spark.createDataFrame(
        [(1, DAY, "US", "A", 5), (1, DAY, "US", "B", 7), (1, DAY, "US", "C", 7)],
        "CUSTOMER_ID int, ORDER_DATE date, COUNTRY string, CATEGORY string, units int",
    )
    ranked = rank_categories(totals, by="units").select("RANK_CATEGORY", "CATEGORY")
    assert rows(ranked) == [(1, "B"), (2, "C"), (3, "A")]
    assert rows(top_category(totals, by="units")) == [(1, DAY, "US", "B")]


@pytest.mark.parametrize("seed", range(3))
def test_one_pass_equals_two_branches_with_a_hot_customer(spark, seed):
    """A third of all lines belongs to one customer, another third to none."""
    dice = random.Random(seed)
    lines = [
        line(
            order=dice.choice([None, *range(40)]),
            customer=dice.choice([1, None, dice.randrange(30)]),
            category=dice.choice("ABCD"),
            usd=dice.choice([None, 0.25, 0.5, -0.25, 1.0]),
            country=dice.choice(["US", "UK", None]),
            day=dice.choice([DAY, date(2026, 1, 6), None]),
        )
        for _ in range(3000)
    ]
    df = frame(spark, lines)
    assert rows(daily_customer_summary(df)) == rows(two_branches(df))
