"""Typing and cleaning of the raw inputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.fixed_values import (
    DATE_FORMATS,
    QUANTITY_TYPE,
    RATE_TYPE,
    REQUIRED_SALES_COLUMNS,
    TIMESTAMP_FORMATS,
)
from tallymart.functions import (
    all_present,
    parse_date,
    parse_timestamp,
    to_money,
    to_whole,
)
from tallymart.schemas import require_columns


def cast_sales(
    sales: DataFrame,
    id_type: str = "bigint",
    timestamp_formats: Sequence[str] = TIMESTAMP_FORMATS,
    customer_id_type: str | None = None,
) -> DataFrame:
    """Typed sales lines. ``id_type`` applies to ORDER_ID.

    Order ids are 64-bit by default: a 32-bit id turns to NULL past 2.1 billion, which at scale would
    silently lower the distinct order counts. CUSTOMER_ID stays as it is, so that ids of any form
    survive, unless ``customer_id_type`` asks for a cast. A column that already has a time type is
    kept.
    """
    already_time = dict(sales.dtypes)["ORDER_TIMESTAMP"].startswith("timestamp")
    moment = F.col("ORDER_TIMESTAMP")
    customer = F.col("CUSTOMER_ID")
    return sales.withColumns(
        {
            "ORDER_ID": to_whole(F.col("ORDER_ID"), id_type),
            "CUSTOMER_ID": to_whole(customer, customer_id_type) if customer_id_type else customer,
            "QUANTITY": to_whole(F.col("QUANTITY"), QUANTITY_TYPE),
            "PRICE": to_money(F.col("PRICE")),
            "ORDER_TIMESTAMP": (
                moment if already_time else parse_timestamp(moment, timestamp_formats)
            ),
        }
    )


def cast_rates(
    rates: DataFrame,
    rate_type: str = RATE_TYPE,
    formats: Sequence[str] = DATE_FORMATS,
) -> DataFrame:
    """Typed exchange rates; ``rate_type="decimal(10,6)"`` makes every USD sum exact."""
    already_date = dict(rates.dtypes)["DATE"] == "date"
    day = F.col("DATE")
    return rates.withColumns(
        {
            "DATE": day if already_date else parse_date(day, formats),
            "EXCHANGE_RATE_TO_USD": F.col("EXCHANGE_RATE_TO_USD").try_cast(rate_type),
        }
    )


def cast_types(
    sales: DataFrame,
    products: DataFrame,
    rates: DataFrame,
    id_type: str = "bigint",
    rate_type: str = RATE_TYPE,
    date_formats: Sequence[str] = DATE_FORMATS,
    timestamp_formats: Sequence[str] = TIMESTAMP_FORMATS,
    customer_id_type: str | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All three inputs typed; products are text already and pass through."""
    typed = cast_sales(sales, id_type, timestamp_formats, customer_id_type)
    return typed, products, cast_rates(rates, rate_type, date_formats)


def _complete(df: DataFrame, columns: Sequence[str]) -> Column:
    require_columns(df.columns, list(columns))
    fractions = [name for name, kind in df.dtypes if kind in ("double", "float")]
    return all_present(columns, with_nan=fractions)


def remove_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a value (neither NULL nor NaN) in every listed column. Runs no job."""
    return df.where(_complete(df, columns))


def drop_audit_columns(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Aggregates for rows before, after and dropped; usable in ``agg`` and ``observe``."""
    keeps = _complete(df, columns)
    return [
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(keeps).alias("rows_after"),
        F.count_if(~keeps).alias("rows_dropped"),
    ]


def drop_audit(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the counts of :func:`drop_audit_columns`, from one pass over ``df``."""
    return df.agg(*drop_audit_columns(df, columns))


def loss_columns() -> list[Column]:
    """Aggregates for the complete lines that joins will lose or that lack their order id."""
    complete = F.col("QUANTITY").isNotNull() & F.col("PRICE").isNotNull()
    return [
        F.count_if(complete & F.col(name).isNull()).alias(f"without_{name.lower()}")
        for name in ("ORDER_TIMESTAMP", "ORDER_ID", "PRODUCT_ID")
    ]


def malformed_column(name: str) -> Column:
    """Aggregate for the lines that ``read_csv`` marked in column ``name``."""
    return F.count_if(F.col(name).isNotNull()).alias("malformed")


def add_order_date(sales: DataFrame) -> DataFrame:
    return sales.withColumn("ORDER_DATE", F.to_date("ORDER_TIMESTAMP"))


def prep_sales(sales: DataFrame) -> DataFrame:
    """Complete sales lines with their ORDER_DATE."""
    return add_order_date(remove_nulls(sales, REQUIRED_SALES_COLUMNS))
