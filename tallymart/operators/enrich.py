"""Product and exchange-rate joins, then revenue.

Both joins are inner equi-joins with no strategy hint. Products and rates are broadcast only when
the optimizer sees them under ``spark.sql.autoBroadcastJoinThreshold``; beyond that the join is a
sort-merge join and adaptive execution splits the partition of a hot product or a hot day and
country. Duplicate product or rate rows fan out; unmatched and NULL keys drop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.functions import all_present, local_revenue, usd_revenue


def join_products(sales: DataFrame, products: DataFrame) -> DataFrame:
    return sales.join(products, "PRODUCT_ID", "inner")


def join_rates(sales: DataFrame, rates: DataFrame) -> DataFrame:
    """Adds the rate of the order's day and country."""
    quotes = rates.select(F.col("DATE").alias("ORDER_DATE"), "COUNTRY", "EXCHANGE_RATE_TO_USD")
    return sales.join(quotes, ["ORDER_DATE", "COUNTRY"], "inner")


def add_revenue(lines: DataFrame) -> DataFrame:
    local = local_revenue(F.col("QUANTITY"), F.col("PRICE"))
    return lines.withColumns(
        {
            "REVENUE_LOCAL": local,
            "REVENUE_USD": usd_revenue(local, F.col("EXCHANGE_RATE_TO_USD")),
        }
    )


def enrich_sales(sales: DataFrame, products: DataFrame, rates: DataFrame) -> DataFrame:
    """Priced sales lines: one row per line that has a product and a rate."""
    priced = join_rates(join_products(sales, products), rates)
    wanted = priced.select(
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
    )
    return add_revenue(wanted)


def repeated_keys(products: DataFrame, rates: DataFrame) -> DataFrame:
    """One row: product ids and days with country (of a rate) that are listed more than once."""

    def repeats(df: DataFrame, kind: str, *keys: str) -> DataFrame:
        counted = df.where(all_present(keys)).groupBy(*keys).count().where("count > 1")
        return counted.select(F.lit(kind).alias("kind"))

    found = repeats(products, "product", "PRODUCT_ID").unionAll(repeats(rates, "rate", "DATE", "COUNTRY"))
    return found.agg(
        F.count_if(F.col("kind") == "product").alias("products"),
        F.count_if(F.col("kind") == "rate").alias("rates"),
    )


def gain_audit(sales: DataFrame, products: DataFrame, rates: DataFrame) -> DataFrame:
    """One row: what repeated products and rates add to the priced lines, and so to the revenue.

    ``matched``: lines with a product and a rate; ``priced``: lines after the joins; ``gained``: the
    difference; ``of_repeated_products`` and ``of_repeated_rates``: matched lines whose key is listed
    more than once. Lists are counted by key first, so the joins multiply nothing.
    """
    listed = products.groupBy(F.col("PRODUCT_ID").alias("known")).agg(F.count("*").alias("listings"))
    quoted = rates.groupBy(F.col("DATE").alias("day"), F.col("COUNTRY").alias("place")).agg(
        F.count("*").alias("quotes")
    )
    matched = sales.join(listed, F.col("PRODUCT_ID") == F.col("known")).join(
        quoted, (F.col("ORDER_DATE") == F.col("day")) & (F.col("COUNTRY") == F.col("place"))
    )
    priced = F.coalesce(F.sum(F.col("listings") * F.col("quotes")), F.lit(0))
    return matched.agg(
        F.count(F.lit(1)).alias("matched"),
        F.count_if(F.col("listings") > 1).alias("of_repeated_products"),
        F.count_if(F.col("quotes") > 1).alias("of_repeated_rates"),
        priced.alias("priced"),
        (priced - F.count(F.lit(1))).alias("gained"),
    )


def loss_audit(sales: DataFrame, products: DataFrame, rates: DataFrame) -> DataFrame:
    """One row: the prepared lines, and how many of them the joins lose, by the first reason.

    ``without_time``: no readable order time; ``without_product``: no such product;
    ``without_rate``: no rate for the day and country. Products and rates count once per key.
    """
    known = products.select(F.col("PRODUCT_ID").alias("known")).distinct()
    quoted = rates.select(F.col("DATE").alias("day"), F.col("COUNTRY").alias("place")).distinct()
    met = sales.join(known, F.col("PRODUCT_ID") == F.col("known"), "left").join(
        quoted, (F.col("ORDER_DATE") == F.col("day")) & (F.col("COUNTRY") == F.col("place")), "left"
    )
    untimed, unknown = F.col("ORDER_DATE").isNull(), F.col("known").isNull()
    unquoted = F.col("day").isNull()
    return met.agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(untimed).alias("without_time"),
        F.count_if(~untimed & unknown).alias("without_product"),
        F.count_if(~untimed & ~unknown & unquoted).alias("without_rate"),
        F.count_if(~untimed & ~unknown & ~unquoted).alias("priced"),
    )
