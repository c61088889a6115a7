from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from conftest import rows

from tallymart.operators.enrich import enrich_sales, gain_audit, repeated_keys

SALES = (
    "ORDER_ID bigint, CUSTOMER_ID bigint, PRODUCT_ID string, QUANTITY int, "
    "PRICE decimal(12,2), ORDER_TIMESTAMP timestamp, COUNTRY string, ORDER_DATE date"
)
DAY = date(2026, 1, 5)


def line(order, product="P1", country="US", day=DAY):
    moment = datetime(2026, 1, 5, 10) if day else None
    return (order, 1, product, 2, Decimal("10.50"), moment, country, day)


def run(spark, lines, products=None, rates=None, rate_type="double"):
    products = products or [("P1", "Keyboard", "Electronics")]
    rates = rates or [(DAY, "US", "USD", 1.5)]
    rates_df = spark.createDataFrame(
        rates, "DATE date, COUNTRY string, CURRENCY string, EXCHANGE_RATE_TO_USD double"
    )
    rates_df = rates_df.withColumn(
        "EXCHANGE_RATE_TO_USD", rates_df.EXCHANGE_RATE_TO_USD.cast(rate_type)
    )
    return enrich_sales(
        spark.createDataFrame(lines, SALES),
        spark.createDataFrame(
            products, "PRODUCT_ID string, PRODUCT_NAME string, CATEGORY string"
        ),
        rates_df,
    )


def test_columns_types_and_revenue(spark):
    df = run(spark, [line(1)])
    assert df.columns == [
        "ORDER_ID",
        "CUSTOMER_ID",
        "PRODUCT_ID",
        "ORDER_DATE",
        "ORDER_TIMESTAMP",
        "COUNTRY",
        "CATEGORY",
        "QUANTITY",
        "PRICE",
        "EXCHANGE_RATE_TO_USD",
        "REVENUE_LOCAL",
        "REVENUE_USD",
    ]
    types = dict(df.dtypes)
    assert (types["REVENUE_LOCAL"], types["REVENUE_USD"]) == ("decimal(23,2)", "double")
    assert rows(df.select("REVENUE_LOCAL", "REVENUE_USD")) == [(Decimal("21.00"), 31.5)]


def test_exact_rates_give_exact_revenue(spark):
    df = run(spark, [line(1)], rate_type="decimal(10,6)")
    assert dict(df.dtypes)["REVENUE_USD"] == "decimal(34,8)"
    assert df.first()["REVENUE_USD"] == Decimal("31.5")


def test_lines_without_product_rate_or_day_drop(spark):
    lines = [
        line(1),
        line(2, product="P9"),
        line(3, product=None),
        line(4, country="UK"),
        line(5, country=None),
        line(6, day=None),
        line(7, day=date(2026, 1, 6)),
    ]
    assert rows(run(spark, lines).select("ORDER_ID")) == [(1,)]


def test_duplicate_products_and_rates_fan_out(spark):
    twice = [("P1", "Keyboard", "Electronics")] * 2
    assert run(spark, [line(1)], products=twice).count() == 2
    assert run(spark, [line(1)], products=twice, rates=[(DAY, "US", "USD", 1.0)] * 3).count() == 6


def test_gains_are_found_from_repeated_keys(spark):
    lines = [line(1), line(2), line(3, product="P9"), line(4, country="UK"), line(5, product=None)]
    sales = spark.createDataFrame(lines, SALES)
    products = [("P1", "Keyboard", "Electronics")] * 2 + [(None, "x", "y")] * 2
    rates = [(DAY, "US", "USD", 1.0)] * 3 + [(DAY, "FR", "EUR", 1.0)] * 2
    products = spark.createDataFrame(products, "PRODUCT_ID string, PRODUCT_NAME string, CATEGORY string")
    rates = spark.createDataFrame(rates, "DATE date, COUNTRY string, CURRENCY string, EXCHANGE_RATE_TO_USD double")
    assert tuple(gain_audit(sales, products, rates).first()) == (2, 2, 2, 12, 10)
    assert tuple(repeated_keys(products, rates).first()) == (1, 2)
    assert tuple(gain_audit(sales.limit(0), products, rates).first()) == (0, 0, 0, 0, 0)
    assert enrich_sales(sales, products, rates).count() == 12
