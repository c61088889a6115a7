"""The daily job: three CSV inputs to two published tables, and the check on the result.

The inputs are parsed once. Cleaned lines and priced lines are each written once to the shared
folder, and both counts the job needs (drop audit, quality gate) ride along on those writes: they
are observed in the stage that commits the files, where a lost executor cannot make a row count
twice. The two tables then read only the columns they need from the stored lines. Once both tables
exist, the cleaned lines of other days are stored without their ids, for the gate alone, and only the
priced lines of the as-of day are stored for the tables.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallymart.fixed_values import (
    CATEGORY_KEYS,
    CATEGORY_PARTITIONS,
    CATEGORY_TABLE,
    CUSTOMER_KEYS,
    CUSTOMER_PARTITIONS,
    CUSTOMER_TABLE,
    DATE_FORMATS,
    GATE_DATE_COLUMN,
    GATE_MISSING_COLUMNS,
    GATE_NUMERIC_COLUMNS,
    GATE_RATE_COLUMN,
    INCREMENT_COLUMN,
    MISSING_OUTPUT_MESSAGE,
    NULL_OUTPUT_MESSAGE,
    RATE_TYPE,
    REQUIRED_SALES_COLUMNS,
    TIMESTAMP_FORMATS,
)
from tallymart.operators.clean import (
    cast_types,
    drop_audit_columns,
    loss_columns,
    malformed_column,
    prep_sales,
)
from tallymart.operators.enrich import enrich_sales, repeated_keys
from tallymart.operators.marts import daily_category_summary, daily_customer_summary
from tallymart.operators.quality import (
    enforce,
    gate_rules,
    null_scan,
    stored_null_scan,
    rule_counters,
)
from tallymart.operators.upsert import increment, is_loaded, publish
from tallymart.schemas import PRODUCT_COLUMNS, RATE_COLUMNS, SALES_COLUMNS, require_columns
from tallymart.session import stage
from tallymart.sources.csv_files import read_csv
from tallymart.sources.published import path_exists, read_stored, table_path

log = logging.getLogger("tallymart")


MALFORMED = "_MALFORMED_LINE"


def _read(
    spark: SparkSession, path: str, columns: tuple[str, ...], malformed: str | None = None
) -> DataFrame:
    df = read_csv(spark, path, malformed=malformed)
    require_columns(df.columns, columns)
    return df


def run_daily_job(
    spark: SparkSession,
    sales_path: str,
    products_path: str,
    rates_path: str,
    output: str,
    as_of: date | datetime | str,
    id_type: str = "bigint",
    rate_type: str = RATE_TYPE,
    date_formats: Sequence[str] = DATE_FORMATS,
    timestamp_formats: Sequence[str] = TIMESTAMP_FORMATS,
    customer_id_type: str | None = None,
    category_partitions: Sequence[str] = CATEGORY_PARTITIONS,
    customer_partitions: Sequence[str] = CUSTOMER_PARTITIONS,
) -> dict[str, str]:
    """Publish both tables for the as-of day; returns what was done to each.

    The types and formats are those of ``cast_types``. Partitions must be among the tables' keys and
    stay as they were at the first load; with ORDER_DATE among them no run rewrites older days.

    Raises ValueError when the quality gate fails; nothing is published then.
    """
    sales, products, rates = cast_types(
        _read(spark, sales_path, SALES_COLUMNS, MALFORMED),
        _read(spark, products_path, PRODUCT_COLUMNS),
        _read(spark, rates_path, RATE_COLUMNS),
        id_type,
        rate_type,
        date_formats,
        timestamp_formats,
        customer_id_type,
    )

    audit = Observation("drop_audit")
    watched = sales.observe(
        audit,
        *drop_audit_columns(sales, REQUIRED_SALES_COLUMNS),
        *loss_columns(),
        malformed_column(MALFORMED),
    ).drop(MALFORMED)
    prepared = prep_sales(watched)
    later = all(is_loaded(spark, output, name) for name in (CATEGORY_TABLE, CUSTOMER_TABLE))
    if later:
        # Every line is counted in the tasks that write the day's, no other line is stored.
        prepared = increment(prepared, INCREMENT_COLUMN, as_of)
    prepared = stage(prepared, output, "prepared_sales")
    counts = audit.get
    log.info(
        "Sales lines read: %s, complete: %s, left out as incomplete: %s",
        counts["rows_before"],
        counts["rows_after"],
        counts["rows_dropped"],
    )
    if counts["malformed"]:
        log.warning("Sales lines with fewer or more fields than the header: %s", counts["malformed"])
    for name in ("order_timestamp", "order_id", "product_id"):
        if missing := counts[f"without_{name}"]:
            log.warning("Complete lines without a readable %s: %s", name.upper(), missing)

    repeated = repeated_keys(products, rates).first()
    if repeated.products or repeated.rates:
        log.warning(
            "Listed more than once, so that lines multiply: %s products, %s rates",
            repeated.products,
            repeated.rates,
        )

    lines = enrich_sales(prepared, products, rates)
    # On a later run the gate judges all lines from the text, in an aggregate that stores none.
    every = enrich_sales(prep_sales(sales.drop(MALFORMED)), products, rates) if later else lines
    rules = gate_rules(
        every,
        GATE_MISSING_COLUMNS,
        GATE_NUMERIC_COLUMNS,
        GATE_DATE_COLUMN,
        GATE_RATE_COLUMN,
        as_of,
    )
    counters = [*rule_counters(rules), F.count(F.lit(1)).alias("priced")]
    if later:
        judged = every.agg(*counters).first()
    else:
        gate = Observation("quality_gate")
        lines = lines.observe(gate, *counters)
    lines = stage(lines, output, "priced_sales")
    if not later:
        judged = gate.get
    log.info("Lines priced: %s of %s", judged["priced"], counts["rows_after"])
    enforce(rules, judged)
    log.info("All rules of the quality gate hold")

    done = {}
    for table, rows, keys, partitions in (
        (CATEGORY_TABLE, daily_category_summary(lines), CATEGORY_KEYS, category_partitions),
        (CUSTOMER_TABLE, daily_customer_summary(lines), CUSTOMER_KEYS, customer_partitions),
    ):
        done[table] = publish(rows, output, table, keys, INCREMENT_COLUMN, as_of, partitions)
        log.info("%s: %s", table, done[table])
    return done


def verify_outputs(
    spark: SparkSession, output: str, as_of: date | datetime | str | None = None
) -> None:
    """Both tables must exist and hold no NULL in any column.

    A table without rows is one. With ``as_of`` only the rows of that day are looked at; without it
    the footers of all files are, and the data of columns that may hold NaN.
    """
    paths = {name: table_path(output, name) for name in (CATEGORY_TABLE, CUSTOMER_TABLE)}
    if not all(path_exists(spark, path) for path in paths.values()):
        raise FileNotFoundError(MISSING_OUTPUT_MESSAGE)
    for name, path in paths.items():
        table = read_stored(spark, path)
        if table is None:
            continue
        if as_of is None:
            scan = stored_null_scan(table, path)
        else:
            scan = null_scan(increment(table, INCREMENT_COLUMN, as_of))
        if not scan.where(F.col("nulls") > 0).isEmpty():
            raise ValueError(NULL_OUTPUT_MESSAGE.format(table=name))
    log.info("Both published tables are there and complete")
