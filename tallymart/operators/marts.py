"""The two daily tables and the aggregates they are made of.

Skew: no step brings a raw group together in one task. Distinct orders are first reduced per group
*and order* (so a group with a third of all lines is spread over the cluster by its order ids) and
only the reduced counts meet per group; sums are combined on the map side. Ranking works on
category totals, at most one row per category in a group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymart.functions import all_present, average_order_value

CUSTOMER_DAY = ("CUSTOMER_ID", "ORDER_DATE", "COUNTRY")


def daily_category_summary(lines: DataFrame) -> DataFrame:
    """Orders, units and revenue per day, country and category."""
    return lines.groupBy("ORDER_DATE", "COUNTRY", "CATEGORY").agg(
        F.count_distinct("ORDER_ID").alias("TOTAL_ORDERS"),
        F.sum("QUANTITY").alias("TOTAL_QUANTITY"),
        F.sum("REVENUE_LOCAL").alias("TOTAL_REVENUE_LOCAL"),
        F.sum("REVENUE_USD").alias("TOTAL_REVENUE_USD"),
    )


def customer_category_revenue(lines: DataFrame) -> DataFrame:
    """USD revenue per customer, day, country and category."""
    return lines.groupBy(*CUSTOMER_DAY, "CATEGORY").agg(
        F.sum("REVENUE_USD").alias("CATEGORY_REVENUE_USD")
    )


def rank_categories(totals: DataFrame, by: str = "CATEGORY_REVENUE_USD") -> DataFrame:
    """RANK_CATEGORY within customer, day and country: highest first, then alphabetical."""
    order = Window.partitionBy(*CUSTOMER_DAY).orderBy(
        F.desc_nulls_last(by), F.asc_nulls_last("CATEGORY")
    )
    return totals.withColumn("RANK_CATEGORY", F.row_number().over(order))


def top_category(totals: DataFrame, by: str = "CATEGORY_REVENUE_USD") -> DataFrame:
    """The first category of each customer, day and country."""
    return (
        rank_categories(totals, by)
        .where("RANK_CATEGORY = 1")
        .select(*CUSTOMER_DAY, F.col("CATEGORY").alias("TOP_CATEGORY"))
    )


def customer_order_value(lines: DataFrame) -> DataFrame:
    """Distinct orders and mean USD per line for each customer, day and country."""
    return lines.groupBy(*CUSTOMER_DAY).agg(
        F.count_distinct("ORDER_ID").alias("TOTAL_ORDERS"),
        average_order_value(F.sum("REVENUE_USD"), F.count("ORDER_ID")).alias(
            "AVG_ORDER_VALUE_USD"
        ),
    )


def daily_customer_summary(lines: DataFrame) -> DataFrame:
    """Orders, mean USD per line and top category per customer, day and country.

    One pass over ``lines``. Every line counts once for its category and once for its order; the
    first aggregation reduces both kinds of rows, the second merges them per customer, day and
    country. That replaces two scans, a window and a join. Lines without a customer, day or
    country belong to no group of this table.
    """
    twice = F.stack(
        F.lit(2),
        *(F.lit(False), F.col("CATEGORY"), F.lit(None)),
        *(F.lit(True), F.lit(None), F.col("ORDER_ID")),
    ).alias("per_order", "CATEGORY", "ORDER_ID")
    parts = (
        lines.where(all_present(CUSTOMER_DAY))
        .select(*CUSTOMER_DAY, "REVENUE_USD", twice)
        .groupBy(*CUSTOMER_DAY, "per_order", "CATEGORY", "ORDER_ID")
        .agg(F.sum("REVENUE_USD").alias("usd"), F.count("ORDER_ID").alias("order_lines"))
    )
    per_order, usd = F.col("per_order"), F.col("usd")
    # Same order as rank_categories, smallest first: NULL totals last, NaN above every number.
    is_number = ~F.isnan(usd) if dict(lines.dtypes)["REVENUE_USD"] == "double" else F.lit(True)
    standing = F.struct(
        usd.isNull(), is_number, -usd, F.col("CATEGORY").isNull(), F.col("CATEGORY")
    )
    return parts.groupBy(*CUSTOMER_DAY).agg(
        F.count_if(per_order & F.col("ORDER_ID").isNotNull()).alias("TOTAL_ORDERS"),
        average_order_value(F.sum(F.when(per_order, usd)), F.sum("order_lines")).alias(
            "AVG_ORDER_VALUE_USD"
        ),
        F.min_by("CATEGORY", F.when(~per_order, standing)).alias("TOP_CATEGORY"),
    )
