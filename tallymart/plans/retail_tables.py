"""The order tables of a TPC-H-like warehouse, seen as sales lines, products and rates.

``sales`` is the clean typed view, ``raw_sales`` the same lines as text the way a CSV delivers
them, with formats mixed and values spoiled by the row's own attributes. The warehouse has no rate
table: rates are one quote per country and day, except on the weekly closing day of the country's
region, so that lines without a rate occur.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The last order day, and the span of days recent_sales folds all orders into.
LAST_ORDER_DAY = "2001-08-01"
RECENT_DAYS = 80

# Products that may be broadcast: at most so many, about 65 bytes each in memory.
BROADCAST_ROWS = 2_000_000
# Lines that one task joins with their orders and adds up, about 600 bytes each in memory.
LINES_PER_TASK = 500_000


# Columns and types of the warehouse tables that are read.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One warehouse table; with the schema declared, no job has to open files for it."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def _placed_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with the customer's country.

    The small tables meet the orders first, so that the lines, the largest input by far, are
    shuffled once (by order) and not a second time by customer. Customers and orders both grow with
    the data; their compressed files look small enough to broadcast long after their rows are not.
    """
    country = (
        table(spark, folder, "customer")
        .join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(F.col("c_custkey").alias("o_custkey"), F.col("n_name").alias("COUNTRY"))
    )
    return table(spark, folder, "orders").join(country.hint("merge"), "o_custkey")


def _dealt_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The lines, in partitions by order of about LINES_PER_TASK rows once they are more than the cores
    share out. Left to adaptive execution, partitions are packed by their compressed bytes, and a
    task holds several million narrow lines. The lines are counted in the file footers."""
    lines = table(spark, folder, "lineitem")
    tasks = -(-lines.count() // LINES_PER_TASK)
    if tasks <= spark.sparkContext.defaultParallelism:
        return lines
    # With fewer partitions than the session's number Spark would deal the lines anew.
    return lines.repartition(max(tasks, int(spark.conf.get("spark.sql.shuffle.partitions"))), "l_orderkey")


def _order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines with their order; both sides grow with the data, so neither may be broadcast."""
    orders = _placed_orders(spark, folder).withColumnRenamed("o_orderkey", "l_orderkey")
    return _dealt_lines(spark, folder).join(orders.hint("merge"), "l_orderkey")


def sales(spark: SparkSession, folder: str) -> DataFrame:
    """Typed sales lines with ORDER_DATE."""
    return _order_lines(spark, folder).select(
        F.col("l_orderkey").alias("ORDER_ID"),
        F.col("o_custkey").alias("CUSTOMER_ID"),
        F.col("l_partkey").alias("PRODUCT_ID"),
        F.col("l_quantity").cast("int").alias("QUANTITY"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("PRICE"),
        F.col("o_orderdate").alias("ORDER_TIMESTAMP"),
        "COUNTRY",
        F.to_date("o_orderdate").alias("ORDER_DATE"),
    )


def _few_broadcast(spark: SparkSession, folder: str, listed: DataFrame) -> DataFrame:
    """Products to join: counted in the file footers, and beyond BROADCAST_ROWS never broadcast."""
    few = table(spark, folder, "part").count() <= BROADCAST_ROWS
    return listed if few else listed.hint("merge")


def listed_products(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("PRODUCT_ID"),
        F.col("p_name").alias("PRODUCT_NAME"),
        F.col("p_type").alias("CATEGORY"),
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    return _few_broadcast(spark, folder, listed_products(spark, folder))


def rates(spark: SparkSession, folder: str) -> DataFrame:
    """Exact decimal(10,6) rates per day and country, from the first to the last order's day."""
    days = table(spark, folder, "orders").select(F.to_date("o_orderdate").alias("day"))
    first = days.select(F.min("day")).scalar()
    last = F.greatest(days.select(F.max("day")).scalar(), F.lit(LAST_ORDER_DAY).cast("date"))
    calendar = F.sequence(F.least(first, last), last)
    hundredths = 50 + (F.dayofyear("DATE") * 7 + F.col("n_nationkey") * 13) % 100
    return (
        table(spark, folder, "nation")
        .withColumn("DATE", F.explode(calendar))
        .where(F.dayofweek("DATE") != F.col("n_regionkey") + 1)
        .select(
            "DATE",
            F.col("n_name").alias("COUNTRY"),
            (hundredths.cast("decimal(10,6)") * F.lit("0.01").cast("decimal(3,2)"))
            .cast("decimal(10,6)")
            .alias("EXCHANGE_RATE_TO_USD"),
        )
    )


def _by_priority(urgent: Column, high: Column, medium: Column, unset: Column, low: Column):
    priority = F.col("o_orderpriority")
    return (
        F.when(priority == "1-URGENT", urgent)
        .when(priority == "2-HIGH", high)
        .when(priority == "3-MEDIUM", medium)
        .when(priority == "4-NOT SPECIFIED", unset)
        .otherwise(low)
    )


def timestamp_text() -> Column:
    """Order time as text: four formats by priority, and no readable time for low priority."""
    seconds = (F.col("o_custkey") % 86400).cast("int")
    moment = F.col("o_orderdate") + F.make_dt_interval(secs=seconds)
    return _by_priority(
        F.date_format(moment, "yyyy-MM-dd HH:mm:ss"),
        F.date_format(moment, "M/d/yyyy H:mm"),
        F.date_format(moment, "MM/dd/yyyy HH:mm:ss"),
        F.date_format(moment, "yyyy/MM/dd HH:mm:ss"),
        F.lit("n/a"),
    )


def date_text() -> Column:
    """Order day as text: four formats by priority, and date-only ISO for low priority."""
    day = F.col("o_orderdate")
    return _by_priority(
        F.date_format(day, "yyyy-MM-dd HH:mm:ss"),
        F.date_format(day, "M/d/yyyy"),
        F.date_format(day, "MM/dd/yyyy HH:mm:ss"),
        F.date_format(day, "M/d/yyyy H:mm"),
        F.date_format(day, "yyyy-MM-dd"),
    )


def quantity_text() -> Column:
    """Quantity as text: with a fraction for N; some R lines blank, unreadable or zero."""
    units = F.col("l_quantity").cast("int").cast("string")
    returned, line = F.col("l_returnflag") == "R", F.col("l_linenumber")
    return (
        F.when(returned & (line == 5), F.lit(None))
        .when(returned & (line == 6), F.lit("n/a"))
        .when(returned & (line == 7), F.lit("0"))
        .when(F.col("l_returnflag") == "N", F.concat(units, F.lit(".7")))
        .otherwise(units)
    )


def price_text() -> Column:
    """Price as text: a third decimal for N and A; some R lines blank, bad, huge or negative."""
    price = F.col("l_extendedprice").cast("decimal(12,2)").cast("string")
    returned, line = F.col("l_returnflag") == "R", F.col("l_linenumber")
    return (
        F.when(returned & (line == 1), F.lit(None))
        .when(returned & (line == 2), F.lit("free"))
        .when(returned & (line == 3), F.concat(F.lit("99999999"), price))
        .when(returned & (line == 4), F.concat(F.lit("-"), price))
        .when(F.col("l_returnflag") == "N", F.concat(price, F.lit("5")))
        .when(F.col("l_returnflag") == "A", F.concat(price, F.lit("4")))
        .otherwise(price)
    )


def raw_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Sales lines as untyped text. Part of the pending, unset-priority orders lack their id."""
    anonymous = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "4-NOT SPECIFIED")
    return _order_lines(spark, folder).select(
        F.when(~anonymous, F.col("l_orderkey").cast("string")).alias("ORDER_ID"),
        F.col("o_custkey").cast("string").alias("CUSTOMER_ID"),
        F.col("l_partkey").cast("string").alias("PRODUCT_ID"),
        quantity_text().alias("QUANTITY"),
        price_text().alias("PRICE"),
        timestamp_text().alias("ORDER_TIMESTAMP"),
        "COUNTRY",
    )


def recent_sales(spark: SparkSession, folder: str) -> DataFrame:
    """All sales lines as text, with their days folded into the last weeks of the calendar."""
    last = F.lit(LAST_ORDER_DAY).cast("date")
    day = F.date_sub(last, F.date_diff(last, "ORDER_DATE") % RECENT_DAYS)
    return sales(spark, folder).select(
        F.col("ORDER_ID").cast("string"),
        F.col("CUSTOMER_ID").cast("string"),
        F.col("PRODUCT_ID").cast("string"),
        F.col("QUANTITY").cast("string"),
        F.col("PRICE").cast("string"),
        F.date_format(day, "M/d/yyyy H:mm").alias("ORDER_TIMESTAMP"),
        "COUNTRY",
    )


def products_with_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """Every seventh product is missing, every eleventh is listed twice."""
    listed = listed_products(spark, folder).where("PRODUCT_ID % 7 <> 0")
    again = listed.where("PRODUCT_ID % 11 = 0").withColumn(
        "PRODUCT_NAME", F.concat("PRODUCT_NAME", F.lit(" again"))
    )
    return _few_broadcast(spark, folder, listed.unionAll(again))


def spoiled_rates(spark: SparkSession, folder: str) -> DataFrame:
    """Rates of which those of some days are zero or negative."""
    day, rate = F.dayofyear("DATE"), F.col("EXCHANGE_RATE_TO_USD")
    spoiled = F.when(day % 5 == 0, rate * 0).when(day % 7 == 0, -rate).otherwise(rate)
    return rates(spark, folder).withColumn("EXCHANGE_RATE_TO_USD", spoiled.cast("decimal(10,6)"))
