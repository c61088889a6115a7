from __future__ import annotations

import logging
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import pytest
from conftest import rows

from tallymart.fixed_values import (
    DATE_FORMATS,
    FRACTION_FORMAT,
    ISO_DATE_FORMAT,
    TIMESTAMP_FORMATS,
)
from tallymart.operators import upsert
from tallymart.plans.daily_job import run_daily_job, verify_outputs
from tallymart.session import owned_folder
from tallymart.sources.published import read_published, table_path

AS_OF = datetime(2026, 5, 8)
LAST_MOMENT = datetime(2026, 5, 7, 9, 15)
TABLES = ("category_summary", "customer_summary")
OLDEST_LIMIT = datetime(2026, 8, 2, 18, 30)

GOLDEN_CATEGORY = [
    (date(2026, 5, 4), "NO", "Garden", 1, 6, Decimal("9.00"), 2.25),
    (date(2026, 5, 4), "NO", "Kitchen", 1, 1, Decimal("40.00"), 10.0),
    (date(2026, 5, 6), "KE", "Kitchen", 1, 2, Decimal("81.00"), 10.125),
    (date(2026, 5, 6), "NO", "Garden", 1, 10, Decimal("7.50"), 3.75),
    (date(2026, 5, 6), "NO", "Kitchen", 1, 3, Decimal("36.00"), 18.0),
    (date(2026, 5, 7), "NO", "Garden", 1, 6, Decimal("7.00"), 1.75),
]
GOLDEN_CUSTOMER = [
    ("kim", date(2026, 5, 4), "NO", 2, 6.125, "Kitchen"),
    ("kim", date(2026, 5, 7), "NO", 1, 0.875, "Garden"),
    ("lou", date(2026, 5, 6), "NO", 2, 10.875, "Kitchen"),
    ("mo", date(2026, 5, 6), "KE", 1, 10.125, "Kitchen"),
]


def category(spark, out):
    table = read_published(spark, table_path(out, "category_summary"))
    return rows(
        table.select(
            "ORDER_DATE",
            "COUNTRY",
            "CATEGORY",
            "TOTAL_ORDERS",
            "TOTAL_QUANTITY",
            "TOTAL_REVENUE_LOCAL",
            "TOTAL_REVENUE_USD",
        )
    )


def customer(spark, out):
    table = read_published(spark, table_path(out, "customer_summary"))
    return rows(
        table.select(
            "CUSTOMER_ID",
            "ORDER_DATE",
            "COUNTRY",
            "TOTAL_ORDERS",
            "AVG_ORDER_VALUE_USD",
            "TOP_CATEGORY",
        )
    )


def test_golden_run(spark, sample, tmp_path, caplog):
    out = str(tmp_path / "out")
    with caplog.at_level(logging.INFO, logger="tallymart"):
        done = run_daily_job(
            spark, sample["sales"], sample["products"], sample["rates"], out, AS_OF
        )
    assert done == {"category_summary": "created", "customer_summary": "created"}
    assert "Sales lines read: 9, complete: 7, left out as incomplete: 2" in caplog.text
    assert "Lines priced: 7 of 7" in caplog.text
    assert "fewer or more fields" not in caplog.text and "multiply" not in caplog.text
    assert category(spark, out) == GOLDEN_CATEGORY
    assert customer(spark, out) == GOLDEN_CUSTOMER
    verify_outputs(spark, out)

    types = dict(read_published(spark, table_path(out, "category_summary")).dtypes)
    assert types["TOTAL_REVENUE_LOCAL"] == "decimal(33,2)"
    assert types["TOTAL_REVENUE_USD"] == "double"


def test_second_run_touches_only_its_day(spark, sample, tmp_path):
    out = str(tmp_path / "out")
    run_daily_job(spark, sample["sales"], sample["products"], sample["rates"], out, AS_OF)
    changed = open(sample["sales"]).read().replace("886,kim,C-3,4,0.75", "886,kim,C-3,8,0.75")
    changed = changed.replace("883,mo,A-1,2,40.5", "883,mo,A-1,7,40.5")
    open(sample["sales"], "w").write(changed)
    done = run_daily_job(
        spark,
        sample["sales"],
        sample["products"],
        sample["rates"],
        out,
        LAST_MOMENT,
    )
    assert done == {"category_summary": "merged", "customer_summary": "merged"}
    assert category(spark, out) == [
        *GOLDEN_CATEGORY[:5],
        (date(2026, 5, 7), "NO", "Garden", 1, 10, Decimal("10.00"), 2.5),
    ]
    assert customer(spark, out) == [
        GOLDEN_CUSTOMER[0],
        ("kim", date(2026, 5, 7), "NO", 1, 1.25, "Garden"),
        *GOLDEN_CUSTOMER[2:],
    ]
    stored = spark.read.parquet(f"{owned_folder(spark, out)}/priced_sales")
    assert [tuple(row) for row in stored.select("ORDER_DATE").distinct().collect()] == [
        (date(2026, 5, 7),)
    ]


def stored_bytes(folder):
    return sum(f.stat().st_size for f in Path(folder.removeprefix("file:")).rglob("*.parquet"))


def test_later_runs_store_the_lines_of_their_day_only(spark, sample, tmp_path):
    """Also by bytes, with many more lines of earlier days; all lines are counted and judged."""
    out, head = str(tmp_path / "out"), open(sample["sales"]).read()
    more = "".join(f"{i},c{i},A-{1 + i % 2},{1 + i % 9},{i % 97}.5,2026-05-04 10:00:00,NO\n" for i in range(20_000))
    open(sample["sales"], "w").write(head + more)
    inputs = (sample["sales"], sample["products"], sample["rates"], out)
    run_daily_job(spark, *inputs, AS_OF)
    folder = owned_folder(spark, out)
    names = ("prepared_sales", "priced_sales")
    first = {name: stored_bytes(f"{folder}/{name}") for name in names}
    published = {name: rows(read_published(spark, table_path(out, name))) for name in TABLES}
    run_daily_job(spark, *inputs, LAST_MOMENT)
    for name in names:
        stored = spark.read.parquet(f"{folder}/{name}")
        assert rows(stored.select("ORDER_ID", "ORDER_DATE")) == [(886, date(2026, 5, 7))] * 2
        assert stored_bytes(f"{folder}/{name}") < first[name] / 10
    assert {name: rows(read_published(spark, table_path(out, name))) for name in TABLES} == published


def test_lines_of_other_length_and_repeated_keys_are_reported(spark, sample, tmp_path, caplog):
    for name, more in (("sales", "887,kim,B-7,1,2\n888,lou,C-3,1,2,5/6/2026 7:00,NO,more\n"),
                       ("products", "B-7,Rope again,Garden\n")):
        open(sample[name], "a").write(more)
    with caplog.at_level(logging.INFO, logger="tallymart"):
        run_daily_job(spark, sample["sales"], sample["products"], sample["rates"], str(tmp_path / "out"), AS_OF)
    assert "fewer or more fields than the header: 2" in caplog.text
    assert "lines multiply: 1 products, 0 rates" in caplog.text
    assert "Sales lines read: 11, complete: 9" in caplog.text
    # The line cut short has no time, the other is taken; two lines of the repeated product count twice.
    assert "Lines priced: 10 of 9" in caplog.text


def test_gate_judges_every_line_on_later_runs(spark, sample, tmp_path):
    out = str(tmp_path / "out")
    run_daily_job(spark, sample["sales"], sample["products"], sample["rates"], out, AS_OF)
    changed = open(sample["sales"]).read().replace("883,mo,A-1,2,40.5", "883,mo,A-1,0,40.5")
    open(sample["sales"], "w").write(changed)
    with pytest.raises(ValueError, match="Column 'QUANTITY' has 1 non-positive values"):
        run_daily_job(
            spark,
            sample["sales"],
            sample["products"],
            sample["rates"],
            out,
            LAST_MOMENT,
        )
    assert category(spark, out) == GOLDEN_CATEGORY


def test_interrupted_first_load_is_repeated_in_full(spark, sample, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    genuine = upsert._write

    def dying(df, path, *arguments, **options):
        genuine(df.limit(1), path, *arguments, **options)
        if path.endswith("customer_summary"):
            raise KeyboardInterrupt

    inputs = (sample["sales"], sample["products"], sample["rates"], out)
    monkeypatch.setattr(upsert, "_write", dying)
    with pytest.raises(KeyboardInterrupt):
        run_daily_job(spark, *inputs, AS_OF)
    monkeypatch.setattr(upsert, "_write", genuine)
    done = run_daily_job(spark, *inputs, LAST_MOMENT)
    assert done["customer_summary"] == "created"
    assert customer(spark, out) == GOLDEN_CUSTOMER


@pytest.mark.parametrize(
    ("as_of", "message"),
    [
        (datetime(2026, 5, 7, 9), "Column 'ORDER_TIMESTAMP' has 2 future timestamp"),
        (
            datetime(2026, 8, 2, 18, 30, 1),
            "Column 'ORDER_TIMESTAMP' has 1 records outside last 90 days",
        ),
    ],
)
def test_gate_stops_publishing(spark, sample, tmp_path, as_of, message):
    out = str(tmp_path / "out")
    with pytest.raises(ValueError, match="Data validation failed:\n" + message):
        run_daily_job(spark, sample["sales"], sample["products"], sample["rates"], out, as_of)
    with pytest.raises(FileNotFoundError, match="Output directories not found!"):
        verify_outputs(spark, out)


@pytest.mark.parametrize("as_of", [LAST_MOMENT, OLDEST_LIMIT])
def test_gate_limits_are_inclusive(spark, sample, tmp_path, as_of):
    out = str(tmp_path / "out")
    run_daily_job(spark, sample["sales"], sample["products"], sample["rates"], out, as_of)
    assert category(spark, out) == GOLDEN_CATEGORY


def test_exact_rates(spark, sample, tmp_path):
    out = str(tmp_path / "out")
    run_daily_job(
        spark,
        sample["sales"],
        sample["products"],
        sample["rates"],
        out,
        AS_OF,
        rate_type="decimal(10,6)",
    )
    totals = [row[6] for row in category(spark, out)]
    assert totals == [Decimal(str(row[6])) for row in GOLDEN_CATEGORY]
    assert customer(spark, out) == GOLDEN_CUSTOMER


def test_iso_dates_in_rates_on_request(spark, sample, tmp_path):
    text = open(sample["rates"]).read()
    open(sample["rates"], "w").write(text.replace("5/6/2026", "2026-05-06"))
    inputs = (sample["sales"], sample["products"], sample["rates"])
    run_daily_job(spark, *inputs, str(tmp_path / "strict"), AS_OF)
    assert category(spark, str(tmp_path / "strict")) == [*GOLDEN_CATEGORY[:2], GOLDEN_CATEGORY[5]]
    formats = (*DATE_FORMATS, ISO_DATE_FORMAT)
    run_daily_job(spark, *inputs, str(tmp_path / "iso"), AS_OF, "int", date_formats=formats)
    assert category(spark, str(tmp_path / "iso")) == GOLDEN_CATEGORY
    assert customer(spark, str(tmp_path / "iso")) == GOLDEN_CUSTOMER


def test_null_in_output_is_reported(spark, sample, tmp_path):
    out = str(tmp_path / "out")
    run_daily_job(spark, sample["sales"], sample["products"], sample["rates"], out, AS_OF)
    path = table_path(out, "customer_summary")
    extra = read_published(spark, path).selectExpr(
        "CUSTOMER_ID",
        "TOTAL_ORDERS",
        "cast(NULL as double) AVG_ORDER_VALUE_USD",
        "TOP_CATEGORY",
        "COUNTRY",
        "ORDER_DATE",
    )
    extra.write.mode("append").partitionBy("ORDER_DATE").parquet(path)
    with pytest.raises(ValueError, match="Null values found in customer_summary output"):
        verify_outputs(spark, out)


def test_missing_input_raises(spark, sample, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        run_daily_job(
            spark, "/nowhere/sales.csv", sample["products"], sample["rates"], str(tmp_path), AS_OF
        )


def test_numeric_ids_on_request(spark, sample, tmp_path):
    text = open(sample["sales"]).read()
    for at, name in enumerate(("kim", "lou", "mo")):
        text = text.replace(name, str(at + 1))
    open(sample["sales"], "w").write(text)
    inputs = (sample["sales"], sample["products"], sample["rates"])
    run_daily_job(spark, *inputs, str(tmp_path / "out"), AS_OF, customer_id_type="bigint")
    assert customer(spark, str(tmp_path / "out"))[0][0] == 1


def test_lines_that_cannot_be_priced_are_reported(spark, sample, tmp_path, caplog):
    text = open(sample["sales"]).read()
    text = text.replace("5/6/2026 0:05", "2026-05-06 00:05:00.000").replace("885,lou", "n/a,lou")
    open(sample["sales"], "w").write(text)
    inputs = (sample["sales"], sample["products"], sample["rates"])
    with caplog.at_level(logging.INFO, logger="tallymart"):
        run_daily_job(spark, *inputs, str(tmp_path / "out"), AS_OF)
    assert "without a readable ORDER_TIMESTAMP: 1" in caplog.text
    assert "without a readable ORDER_ID: 1" in caplog.text
    assert "Lines priced: 6 of 7" in caplog.text
    caplog.clear()
    formats = (*TIMESTAMP_FORMATS, FRACTION_FORMAT)
    with caplog.at_level(logging.INFO, logger="tallymart"):
        run_daily_job(spark, *inputs, str(tmp_path / "all"), AS_OF, timestamp_formats=formats)
    assert "Lines priced: 7 of 7" in caplog.text


def test_table_without_rows_is_merged_into(spark, sample, tmp_path):
    """A first run on an empty sales file loads empty tables; the next publishes its day only."""
    out, full = str(tmp_path / "out"), open(sample["sales"]).read()
    open(sample["sales"], "w").write(full.splitlines()[0] + "\n")
    inputs = (sample["sales"], sample["products"], sample["rates"], out)
    run_daily_job(spark, *inputs, AS_OF)
    verify_outputs(spark, out)
    open(sample["sales"], "w").write(full)
    done = run_daily_job(spark, *inputs, LAST_MOMENT)
    assert set(done.values()) == {"appended"}
    assert category(spark, out) == GOLDEN_CATEGORY[5:]
    verify_outputs(spark, out)
    verify_outputs(spark, out, LAST_MOMENT)


def test_partitions_are_the_callers_choice(spark, sample, tmp_path):
    out = str(tmp_path / "out")
    inputs = (sample["sales"], sample["products"], sample["rates"], out)
    run_daily_job(spark, *inputs, AS_OF, category_partitions=["ORDER_DATE"])
    old = {f: f.stat().st_mtime_ns for f in (tmp_path / "out").rglob("ORDER_DATE=2026-05-0[46]/*")}
    assert old
    done = run_daily_job(spark, *inputs, LAST_MOMENT, category_partitions=["ORDER_DATE"])
    assert done["category_summary"] == "merged"
    assert all(f.stat().st_mtime_ns == stamp for f, stamp in old.items())
    assert category(spark, out) == GOLDEN_CATEGORY
