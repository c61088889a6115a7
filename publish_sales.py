"""spark-submit entry point: publish the two daily sales tables, then check them."""

from __future__ import annotations

import argparse
import logging

from tallymart.fixed_values import (
    CATEGORY_PARTITIONS,
    CUSTOMER_PARTITIONS,
    DATE_FORMATS,
    RATE_TYPE,
    TIMESTAMP_FORMATS,
)
from tallymart.plans.daily_job import run_daily_job, verify_outputs
from tallymart.session import make_session


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    for name in ("--sales", "--products", "--rates", "--output", "--as-of"):
        parser.add_argument(name, required=True)
    parser.add_argument("--id-type", default="bigint")
    parser.add_argument("--customer-id-type", help="cast customer ids; left as they are otherwise")
    parser.add_argument("--rate-type", default=RATE_TYPE)
    for name, columns in (("category", CATEGORY_PARTITIONS), ("customer", CUSTOMER_PARTITIONS)):
        parser.add_argument(
            f"--{name}-partitions",
            nargs="*",
            default=list(columns),
            help="columns among the table's keys; to be the same in every run",
        )
    parser.add_argument("--check-all", action="store_true", help="check every day, not the as-of day")
    parser.add_argument("--date-format", action="append", help="instead of the default formats")
    parser.add_argument("--timestamp-format", action="append", help="instead of the default formats")
    arguments = parser.parse_args()
    logging.basicConfig(level=logging.INFO, format="%(asctime)s - %(levelname)s - %(message)s")

    spark = make_session()
    run_daily_job(
        spark,
        arguments.sales,
        arguments.products,
        arguments.rates,
        arguments.output,
        arguments.as_of,
        arguments.id_type,
        arguments.rate_type,
        arguments.date_format or DATE_FORMATS,
        arguments.timestamp_format or TIMESTAMP_FORMATS,
        arguments.customer_id_type,
        arguments.category_partitions,
        arguments.customer_partitions,
    )
    verify_outputs(spark, arguments.output, None if arguments.check_all else arguments.as_of)


if __name__ == "__main__":
    main()
