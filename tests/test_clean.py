from __future__ import annotations

import math

import pytest
from conftest import rows

from tallymart.fixed_values import FRACTION_FORMAT, TIMESTAMP_FORMATS
from tallymart.operators.clean import (
    cast_rates,
    cast_sales,
    drop_audit,
    prep_sales,
    remove_nulls,
)
from tallymart.sources.csv_files import read_csv

SAMPLE = "k int, a int, b double"
VALUES = [(1, 1, 1.0), (2, None, 1.0), (3, 1, None), (4, 1, math.nan), (5, None, None)]


def test_remove_nulls(spark):
    df = spark.createDataFrame(VALUES, SAMPLE)
    assert rows(remove_nulls(df, ["a", "b"]).select("k")) == [(1,)]
    assert rows(remove_nulls(df, ["a"]).select("k")) == [(1,), (3,), (4,)]


def test_drop_audit_agrees_with_remove_nulls(spark):
    df = spark.createDataFrame(VALUES, SAMPLE)
    for columns in (["a"], ["b"], ["a", "b"], ["k"]):
        kept = remove_nulls(df, columns).count()
        assert tuple(drop_audit(df, columns).first()) == (5, kept, 5 - kept)


def test_column_list_is_checked(spark):
    df = spark.createDataFrame(VALUES, SAMPLE)
    with pytest.raises(ValueError, match="Column list cannot be empty"):
        remove_nulls(df, [])
    with pytest.raises(ValueError, match=r"Columns not found in DataFrame: \['A', 'X'\]"):
        remove_nulls(df, ["A", "b", "X"])


def test_sample_is_typed_and_prepared(spark, sample):
    typed = cast_sales(read_csv(spark, sample["sales"]))
    assert typed.dtypes == [
        ("ORDER_ID", "bigint"),
        ("CUSTOMER_ID", "string"),
        ("PRODUCT_ID", "string"),
        ("QUANTITY", "int"),
        ("PRICE", "decimal(12,2)"),
        ("ORDER_TIMESTAMP", "timestamp"),
        ("COUNTRY", "string"),
    ]
    assert dict(cast_sales(read_csv(spark, sample["sales"]), "int").dtypes)["ORDER_ID"] == "int"
    numbers = cast_sales(read_csv(spark, sample["sales"]), customer_id_type="bigint")
    assert dict(numbers.dtypes)["CUSTOMER_ID"] == "bigint"
    assert {row[0] for row in rows(typed.select("CUSTOMER_ID"))} == {"kim", "lou", "mo", None}
    prepared = prep_sales(typed)
    assert prepared.columns[-1] == "ORDER_DATE"
    assert [row[0] for row in rows(prepared.select("ORDER_ID"))] == [*range(880, 884), 885, 886, 886]


def test_fractions_of_a_second_on_request(spark):
    df = spark.createDataFrame(
        [("2026-01-05 10:00:00.250",), ("2026-01-05 10:00:00",)], "ORDER_TIMESTAMP string"
    ).selectExpr(
        "'1' ORDER_ID", "'1' CUSTOMER_ID", "'1' QUANTITY", "'1' PRICE", "ORDER_TIMESTAMP"
    )
    assert cast_sales(df).where("ORDER_TIMESTAMP IS NULL").count() == 1
    both = cast_sales(df, timestamp_formats=(*TIMESTAMP_FORMATS, FRACTION_FORMAT))
    assert [row[0].microsecond for row in both.select("ORDER_TIMESTAMP").collect()] == [250000, 0]


def test_typed_input_stays_typed(spark, sample):
    once = cast_sales(read_csv(spark, sample["sales"]))
    assert rows(cast_sales(once)) == rows(once)
    rates = cast_rates(read_csv(spark, sample["rates"]))
    assert rates.dtypes[0] == ("DATE", "date")
    assert rates.dtypes[3] == ("EXCHANGE_RATE_TO_USD", "double")
    assert rows(cast_rates(rates)) == rows(rates)


def test_operators_run_no_job(spark, sample):
    typed = cast_sales(read_csv(spark, sample["sales"]))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lazy", "must stay empty")
    prep_sales(typed)
    drop_audit(typed, ["PRICE"])
    assert tracker.getJobIdsForGroup("lazy") == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
