"""The registered queries: every operator, run over the whole warehouse tables.

Results are put into a form two engines agree on: days and times as ISO text, decimals as the
nearest double.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.fixed_values import (
    CATEGORY_KEYS,
    CATEGORY_PARTITIONS,
    CATEGORY_TABLE,
    CUSTOMER_KEYS,
    CUSTOMER_PARTITIONS,
    CUSTOMER_TABLE,
    DATE_FORMATS,
    EXACT_RATE_TYPE,
    GATE_DATE_COLUMN,
    GATE_MISSING_COLUMNS,
    GATE_NUMERIC_COLUMNS,
    GATE_RATE_COLUMN,
    INCREMENT_COLUMN,
    ISO_DATE_FORMAT,
    REQUIRED_SALES_COLUMNS,
)
from tallymart.functions import (
    local_revenue,
    parse_date,
    parse_timestamp,
    to_money,
    to_whole,
)
from tallymart.operators import marts, quality
from tallymart.operators.clean import (
    add_order_date,
    cast_sales,
    drop_audit,
    malformed_column,
    prep_sales,
    remove_nulls,
)
from tallymart.operators.enrich import (
    add_revenue,
    enrich_sales,
    gain_audit,
    join_products,
    join_rates,
    loss_audit,
)
from tallymart.operators.upsert import increment, late_rows, publish
from tallymart.plans import retail_tables as tables
from tallymart.plans.daily_job import run_daily_job, verify_outputs
from tallymart.session import recommended, shared_folder
from tallymart.sources.csv_files import read_csv
from tallymart.sources.published import read_stored, table_path

Query = Callable[[SparkSession, str], DataFrame]

# The moment the quality rules look back from, the day that is published again and
# the country a pruned read asks for.
GATE_MOMENT = "1998-08-02 12:00:00"
PUBLISH_DAY = "1998-08-05"
READ_COUNTRY = "NATION_7"


def shown(df: DataFrame) -> DataFrame:
    """Days and times as ISO text, decimals as doubles."""

    def column(name: str, kind: str):
        if kind == "date":
            return F.date_format(name, "yyyy-MM-dd").alias(name)
        if kind.startswith("timestamp"):
            return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)
        if kind.startswith("decimal"):
            return F.col(name).cast("double").alias(name)
        return F.col(name)

    return df.select(*(column(name, kind) for name, kind in df.dtypes))


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    return enrich_sales(
        tables.sales(spark, folder), tables.products(spark, folder), tables.rates(spark, folder)
    )


def _typed(spark: SparkSession, folder: str) -> DataFrame:
    return cast_sales(tables.raw_sales(spark, folder), customer_id_type="bigint")


def _text_ids(products: DataFrame) -> DataFrame:
    return products.withColumn("PRODUCT_ID", F.col("PRODUCT_ID").cast("string"))


def _typed_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Priced lines of the uncleaned text inputs, after cleaning."""
    products = _text_ids(tables.products(spark, folder))
    return enrich_sales(prep_sales(_typed(spark, folder)), products, tables.rates(spark, folder))


def _output(spark: SparkSession, name: str) -> str:
    """An empty folder for the tables one query publishes; the query's next run empties it again."""
    context = spark.sparkContext
    path = f"{shared_folder(spark)}/tallymart/{context.applicationId}/{name}"
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)
    return path


# Sources


def ingest_csv(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{_output(spark, 'ingest_csv')}/sales_csv"
    tables.raw_sales(spark, folder).write.csv(path, header=True)
    return read_csv(spark, path)


# Parsing, casting, cleaning


def parse_timestamps(spark: SparkSession, folder: str) -> DataFrame:
    text = tables.timestamp_text()
    return tables.table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("ORDER_ID"),
        text.alias("ORDER_TEXT"),
        parse_timestamp(text).alias("ORDER_TIMESTAMP"),
    )


def parse_dates(spark: SparkSession, folder: str) -> DataFrame:
    text = tables.date_text()
    return tables.table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("ORDER_ID"),
        text.alias("DATE_TEXT"),
        parse_date(text).alias("ORDER_DATE"),
        parse_date(text, (*DATE_FORMATS, ISO_DATE_FORMAT)).alias("ORDER_DATE_ISO"),
    )


def order_date(spark: SparkSession, folder: str) -> DataFrame:
    orders = tables.table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("ORDER_ID"), F.col("o_orderdate").alias("ORDER_TIMESTAMP")
    )
    return add_order_date(orders)


def cast_int(spark: SparkSession, folder: str) -> DataFrame:
    text = tables.quantity_text()
    return tables.table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("ORDER_ID"),
        text.alias("QUANTITY_TEXT"),
        to_whole(text, "int").alias("QUANTITY"),
    )


def cast_decimal(spark: SparkSession, folder: str) -> DataFrame:
    text = tables.price_text()
    return tables.table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("ORDER_ID"),
        text.alias("PRICE_TEXT"),
        to_money(text).alias("PRICE"),
    )


def typed_sales(spark: SparkSession, folder: str) -> DataFrame:
    return _typed(spark, folder)


def prepared_sales(spark: SparkSession, folder: str) -> DataFrame:
    return prep_sales(_typed(spark, folder))


def drop_nulls(spark: SparkSession, folder: str) -> DataFrame:
    return remove_nulls(_typed(spark, folder), REQUIRED_SALES_COLUMNS)


def drop_audit_report(spark: SparkSession, folder: str) -> DataFrame:
    return drop_audit(_typed(spark, folder), REQUIRED_SALES_COLUMNS)


# Joins and revenue


def join_product(spark: SparkSession, folder: str) -> DataFrame:
    joined = join_products(tables.sales(spark, folder), tables.products(spark, folder))
    return joined.select("ORDER_ID", "PRODUCT_ID", "PRODUCT_NAME", "CATEGORY", "QUANTITY")


def join_fx(spark: SparkSession, folder: str) -> DataFrame:
    joined = join_rates(tables.sales(spark, folder), tables.rates(spark, folder))
    return joined.select("ORDER_ID", "ORDER_DATE", "COUNTRY", "PRICE", "EXCHANGE_RATE_TO_USD")


def revenue_local(spark: SparkSession, folder: str) -> DataFrame:
    revenue = local_revenue(F.col("QUANTITY"), F.col("PRICE")).alias("REVENUE_LOCAL")
    return tables.sales(spark, folder).select("ORDER_ID", "QUANTITY", "PRICE", revenue)


def revenue_usd(spark: SparkSession, folder: str) -> DataFrame:
    priced = add_revenue(join_rates(tables.sales(spark, folder), tables.rates(spark, folder)))
    return priced.select("ORDER_ID", "REVENUE_LOCAL", "EXCHANGE_RATE_TO_USD", "REVENUE_USD")


# Quality


def dq_rules(
    spark: SparkSession,
    folder: str,
    rules: Callable[[DataFrame], list[quality.Rule]],
    source: Query = _typed_lines,
) -> DataFrame:
    df = source(spark, folder)
    return quality.quality_report(df, rules(df))


def _typed_with_rates(spark: SparkSession, folder: str) -> DataFrame:
    """Lines before cleaning, with the rate of their day where there is one."""
    typed = add_order_date(_typed(spark, folder))
    quotes = tables.rates(spark, folder).withColumnRenamed("DATE", "ORDER_DATE")
    return add_revenue(typed.join(quotes, ["ORDER_DATE", "COUNTRY"], "left"))


def _full_gate(df: DataFrame) -> list[quality.Rule]:
    return quality.gate_rules(
        df,
        GATE_MISSING_COLUMNS,
        GATE_NUMERIC_COLUMNS,
        GATE_DATE_COLUMN,
        GATE_RATE_COLUMN,
        GATE_MOMENT,
    )


def output_null_scan(spark: SparkSession, folder: str) -> DataFrame:
    output = _output(spark, "output_null_scan")
    path = _publish_customers(spark, _typed_lines(spark, folder), output)
    return quality.stored_null_scan(read_stored(spark, path), path)


# Aggregates and ranking


def sum_by_day(spark: SparkSession, folder: str) -> DataFrame:
    return (
        _lines(spark, folder)
        .groupBy("ORDER_DATE")
        .agg(
            F.sum("QUANTITY").alias("TOTAL_QUANTITY"),
            F.sum("REVENUE_LOCAL").alias("TOTAL_REVENUE_LOCAL"),
            F.sum("REVENUE_USD").alias("TOTAL_REVENUE_USD"),
        )
    )


def distinct_orders(spark: SparkSession, folder: str) -> DataFrame:
    return (
        _typed_lines(spark, folder)
        .groupBy("ORDER_DATE", "COUNTRY")
        .agg(F.count_distinct("ORDER_ID").alias("TOTAL_ORDERS"))
    )


def avg_order_value(spark: SparkSession, folder: str) -> DataFrame:
    return marts.customer_order_value(_typed_lines(spark, folder))


def category_summary(spark: SparkSession, folder: str) -> DataFrame:
    return marts.daily_category_summary(_lines(spark, folder))


def customer_category_revenue(spark: SparkSession, folder: str) -> DataFrame:
    return marts.customer_category_revenue(_lines(spark, folder))


def rank_categories(spark: SparkSession, folder: str) -> DataFrame:
    return marts.rank_categories(marts.customer_category_revenue(_lines(spark, folder)))


def top_category(spark: SparkSession, folder: str) -> DataFrame:
    return marts.top_category(marts.customer_category_revenue(_lines(spark, folder)))


def top_category_by_quantity(spark: SparkSession, folder: str) -> DataFrame:
    """Ranked by units, where ties are frequent."""
    units = (
        _lines(spark, folder)
        .groupBy(*marts.CUSTOMER_DAY, "CATEGORY")
        .agg(F.sum("QUANTITY").alias("CATEGORY_QUANTITY"))
    )
    return marts.top_category(units, by="CATEGORY_QUANTITY")


def customer_summary(spark: SparkSession, folder: str) -> DataFrame:
    return marts.daily_customer_summary(_lines(spark, folder))


def customer_summary_from_text(spark: SparkSession, folder: str) -> DataFrame:
    """The same table from uncleaned text: missing order ids, zero and negative revenue."""
    return marts.daily_customer_summary(_typed_lines(spark, folder))


# Publishing


def _publish_categories(
    spark: SparkSession, lines: DataFrame, output: str, as_of: str = PUBLISH_DAY
) -> str:
    publish(
        marts.daily_category_summary(lines),
        output,
        CATEGORY_TABLE,
        CATEGORY_KEYS,
        INCREMENT_COLUMN,
        as_of,
        CATEGORY_PARTITIONS,
    )
    return table_path(output, CATEGORY_TABLE)


def _publish_customers(spark: SparkSession, lines: DataFrame, output: str) -> str:
    publish(
        marts.daily_customer_summary(lines),
        output,
        CUSTOMER_TABLE,
        CUSTOMER_KEYS,
        INCREMENT_COLUMN,
        PUBLISH_DAY,
        CUSTOMER_PARTITIONS,
    )
    return table_path(output, CUSTOMER_TABLE)


def increment_filter(spark: SparkSession, folder: str) -> DataFrame:
    return increment(
        marts.daily_category_summary(_lines(spark, folder)), INCREMENT_COLUMN, PUBLISH_DAY
    )


def publish_initial(spark: SparkSession, folder: str) -> DataFrame:
    output = _output(spark, "publish_initial")
    return read_stored(spark, _publish_customers(spark, _lines(spark, folder), output))


def read_published_table(spark: SparkSession, folder: str) -> DataFrame:
    output = _output(spark, "read_published")
    return read_stored(spark, _publish_categories(spark, _lines(spark, folder), output))


def partition_pruned_read(spark: SparkSession, folder: str) -> DataFrame:
    output = _output(spark, "partition_pruned_read")
    path = _publish_categories(spark, _lines(spark, folder), output)
    return read_stored(spark, path).where(F.col("COUNTRY") == READ_COUNTRY)


def _dearer(lines: DataFrame) -> DataFrame:
    return add_revenue(lines.withColumn("PRICE", to_money(F.col("PRICE") + 1)))


def upsert_update(spark: SparkSession, folder: str) -> DataFrame:
    """All prices go up by one after the first load; only the published day may change."""
    lines, output = _lines(spark, folder), _output(spark, "upsert_update")
    _publish_categories(spark, lines, output)
    return read_stored(spark, _publish_categories(spark, _dearer(lines), output))


def upsert_by_day(spark: SparkSession, folder: str) -> DataFrame:
    """The same with a folder for each day, of which one is rewritten."""
    lines, output = _lines(spark, folder), _output(spark, "upsert_by_day")
    _publish_customers(spark, lines, output)
    return read_stored(spark, _publish_customers(spark, _dearer(lines), output))


def upsert_append(spark: SparkSession, folder: str) -> DataFrame:
    """The table ends before the published day, which is then added; later days stay out."""
    lines, output = _lines(spark, folder), _output(spark, "upsert_append")
    day = F.lit(PUBLISH_DAY).cast("date")
    _publish_categories(spark, lines.where(F.col("ORDER_DATE") < day), output)
    return read_stored(spark, _publish_categories(spark, lines, output))


def upsert_insert(spark: SparkSession, folder: str) -> DataFrame:
    """Lines over 25 units arrive after the first load; the published day gains their rows."""
    lines, output = _lines(spark, folder), _output(spark, "upsert_insert")
    _publish_customers(spark, lines.where("QUANTITY <= 25"), output)
    return read_stored(spark, _publish_customers(spark, lines, output))


def upsert_many_partitions(spark: SparkSession, folder: str) -> DataFrame:
    """All lines as of one day, in a folder for each country and category, that are all merged into but
    those of small lines."""
    lines = _lines(spark, folder).withColumn("ORDER_DATE", F.lit(PUBLISH_DAY).cast("date"))
    lines = lines.withColumn("CATEGORY", F.concat_ws("/", "CATEGORY", F.col("PRODUCT_ID") % 12))
    output = _output(spark, "upsert_many_partitions")

    def load(some: DataFrame) -> None:
        rows = marts.daily_category_summary(some)
        by = ["COUNTRY", "CATEGORY"]
        publish(rows, output, CATEGORY_TABLE, CATEGORY_KEYS, INCREMENT_COLUMN, PUBLISH_DAY, by)

    load(lines)
    load(_dearer(lines.where("QUANTITY > 10")))
    return read_stored(spark, table_path(output, CATEGORY_TABLE))


def late_rows_report(spark: SparkSession, folder: str) -> DataFrame:
    """Lines over 25 units arrive after the first load, those of earlier days too late."""
    lines, output = _lines(spark, folder), _output(spark, "late_rows")
    _publish_categories(spark, lines.where("QUANTITY <= 25"), output)
    return late_rows(
        marts.daily_category_summary(lines),
        output,
        CATEGORY_TABLE,
        CATEGORY_KEYS,
        INCREMENT_COLUMN,
        PUBLISH_DAY,
        CATEGORY_PARTITIONS,
    )


# Inputs with gaps


def csv_malformed(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of which some lack the last field and some have one more, by country."""
    path = f"{_output(spark, 'csv_malformed')}/sales_csv"
    sales = tables.sales(spark, folder).withColumn("ORDER_TIMESTAMP", F.date_format("ORDER_TIMESTAMP", "M/d/yyyy H:mm"))
    names = ["ORDER_ID", "PRODUCT_ID", "QUANTITY", "ORDER_TIMESTAMP", "COUNTRY"]
    whole = F.concat_ws(",", *names)
    text = (
        F.when(F.col("ORDER_ID") % 10 == 3, F.concat_ws(",", *names[:-1]))
        .when(F.col("ORDER_ID") % 10 == 7, F.concat(whole, F.lit(",more")))
        .otherwise(whole)
    )
    # One column whose name and values hold the commas: a line of any number of fields.
    sales.select(text.alias(",".join(names))).write.csv(path, header=True, sep="\u0001")
    marked = read_csv(spark, path, malformed="LINE")
    return marked.groupBy("COUNTRY").agg(
        F.count(F.lit(1)).alias("LINES"),
        malformed_column("LINE"),
        F.sum(F.col("QUANTITY").cast("long")).alias("QUANTITY"),
    )


def gain_audit_report(spark: SparkSession, folder: str) -> DataFrame:
    return gain_audit(
        prep_sales(_typed(spark, folder)),
        _text_ids(tables.products_with_gaps(spark, folder)),
        tables.rates(spark, folder),
    )


def join_product_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of missing products drop, lines of a product listed twice appear twice."""
    listed = tables.products_with_gaps(spark, folder)
    joined = join_products(tables.sales(spark, folder), listed)
    return joined.select("ORDER_ID", "PRODUCT_ID", "PRODUCT_NAME", "CATEGORY", "QUANTITY")


def dq_rate_nonpositive(spark: SparkSession, folder: str) -> DataFrame:
    priced = join_rates(tables.sales(spark, folder), tables.spoiled_rates(spark, folder))
    return quality.quality_report(priced, [quality.rate_rule(GATE_RATE_COLUMN)])


def loss_audit_report(spark: SparkSession, folder: str) -> DataFrame:
    return loss_audit(
        prep_sales(_typed(spark, folder)),
        _text_ids(tables.products_with_gaps(spark, folder)),
        tables.rates(spark, folder),
    )


def customer_summary_text_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Customer ids that are no numbers."""
    raw = tables.raw_sales(spark, folder).withColumn(
        "CUSTOMER_ID", F.concat(F.lit("C-"), "CUSTOMER_ID")
    )
    products = _text_ids(tables.products(spark, folder))
    lines = enrich_sales(prep_sales(cast_sales(raw)), products, tables.rates(spark, folder))
    return marts.daily_customer_summary(lines)


# The whole job


def _run_job(spark: SparkSession, output: str, inputs: dict[str, DataFrame]) -> None:
    """CSV files to published tables, checked."""
    for name, df in inputs.items():
        df.write.mode("overwrite").csv(f"{output}/{name}_csv", header=True)
    run_daily_job(
        spark,
        *(f"{output}/{name}_csv" for name in inputs),
        output,
        f"{tables.LAST_ORDER_DAY} 23:59:59",
        rate_type=EXACT_RATE_TYPE,
        customer_id_type="bigint",
    )
    verify_outputs(spark, output)


def _job_inputs(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    quotes = tables.rates(spark, folder).select(
        F.date_format("DATE", "M/d/yyyy").alias("DATE"),
        "COUNTRY",
        F.lit("").alias("CURRENCY"),
        "EXCHANGE_RATE_TO_USD",
    )
    return {
        "sales": tables.recent_sales(spark, folder),
        "products": tables.listed_products(spark, folder),
        "rates": quotes,
    }


def daily_job_categories(spark: SparkSession, folder: str) -> DataFrame:
    output = _output(spark, "daily_job_categories")
    _run_job(spark, output, _job_inputs(spark, folder))
    return read_stored(spark, table_path(output, CATEGORY_TABLE))


def daily_job_customers(spark: SparkSession, folder: str) -> DataFrame:
    output = _output(spark, "daily_job_customers")
    _run_job(spark, output, _job_inputs(spark, folder))
    return read_stored(spark, table_path(output, CUSTOMER_TABLE))


def daily_job_second_run(spark: SparkSession, folder: str) -> DataFrame:
    """The job runs again after every line's quantity went up; only the as-of day may change."""
    output = _output(spark, "daily_job_second_run")
    inputs = _job_inputs(spark, folder)
    _run_job(spark, output, inputs)
    more = (F.col("QUANTITY").cast("int") + 1).cast("string")
    _run_job(spark, output, inputs | {"sales": inputs["sales"].withColumn("QUANTITY", more)})
    return read_stored(spark, table_path(output, CATEGORY_TABLE))


def _entries() -> dict[str, Query]:
    now = partial(quality.moment, GATE_MOMENT)
    return {
        "ingest_csv": ingest_csv,
        "parse_timestamp": parse_timestamps,
        "parse_date": parse_dates,
        "order_date": order_date,
        "cast_int": cast_int,
        "cast_decimal": cast_decimal,
        "typed_sales": typed_sales,
        "prepared_sales": prepared_sales,
        "drop_nulls": drop_nulls,
        "drop_audit": drop_audit_report,
        "join_product": join_product,
        "join_fx": join_fx,
        "revenue_local": revenue_local,
        "revenue_usd": revenue_usd,
        "enrich_sales": _lines,
        "dq_missing": partial(
            dq_rules,
            rules=lambda df: quality.missing_rules(GATE_MISSING_COLUMNS),
            source=_typed,
        ),
        "dq_nonpositive": partial(
            dq_rules, rules=lambda df: quality.non_positive_rules(GATE_NUMERIC_COLUMNS)
        ),
        "dq_stale": partial(
            dq_rules,
            rules=lambda df: [quality.stale_rule(GATE_DATE_COLUMN, now())],
            source=_typed,
        ),
        "dq_future": partial(
            dq_rules,
            rules=lambda df: [quality.future_rule(GATE_DATE_COLUMN, now())],
            source=_typed,
        ),
        "dq_rate": partial(
            dq_rules,
            rules=lambda df: [quality.rate_rule(GATE_RATE_COLUMN)],
            source=_typed_with_rates,
        ),
        "dq_report": partial(dq_rules, rules=_full_gate),
        "dq_report_before_joins": partial(dq_rules, rules=_full_gate, source=_typed_with_rates),
        "output_null_scan": output_null_scan,
        "sum_by_day": sum_by_day,
        "distinct_orders": distinct_orders,
        "avg_order_value": avg_order_value,
        "category_summary": category_summary,
        "customer_category_revenue": customer_category_revenue,
        "rank_categories": rank_categories,
        "top_category": top_category,
        "top_category_by_quantity": top_category_by_quantity,
        "customer_summary": customer_summary,
        "customer_summary_from_text": customer_summary_from_text,
        "increment_filter": increment_filter,
        "publish_initial": publish_initial,
        "read_published": read_published_table,
        "partition_pruned_read": partition_pruned_read,
        "upsert_update": upsert_update,
        "upsert_insert": upsert_insert,
        "upsert_append": upsert_append,
        "upsert_by_day": upsert_by_day,
        "join_product_gaps": join_product_gaps,
        "dq_rate_nonpositive": dq_rate_nonpositive,
        "loss_audit": loss_audit_report,
        "gain_audit": gain_audit_report,
        "csv_malformed": csv_malformed,
        "late_rows": late_rows_report,
        "upsert_many_partitions": upsert_many_partitions,
        "customer_summary_text_ids": customer_summary_text_ids,
        "daily_job_categories": daily_job_categories,
        "daily_job_customers": daily_job_customers,
        "daily_job_second_run": daily_job_second_run,
    }


def queries() -> dict[str, Query]:
    """Name to query; every result is ready for comparison."""

    def comparable(query: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            with recommended(spark):
                return shown(query(spark, folder))

        return run

    return {name: comparable(query) for name, query in _entries().items()}
