from __future__ import annotations

import math
from datetime import datetime
from decimal import Decimal
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from conftest import rows

from tallymart.operators.quality import (
    gate_rules,
    null_scan,
    quality_report,
    stored_null_scan,
    validate,
)
from tallymart.sources.published import read_published

AS_OF = datetime(2026, 3, 30, 9)
OLDEST = datetime(2025, 12, 30, 9)
SCHEMA = "c string, q int, x double, t timestamp, r double"
GOOD = ("US", 1, 1.0, datetime(2026, 3, 1), 1.0)


def gate(spark, *bad, as_of=AS_OF, time_type="timestamp"):
    df = spark.createDataFrame([GOOD, *bad], SCHEMA)
    df = df.withColumn("t", df.t.cast(time_type))
    rules = gate_rules(df, ["c", "q"], ["q", "x"], "t", "r", as_of)
    validate(df, ["c", "q"], ["q", "x"], "t", "r", as_of)
    return quality_report(df, rules)


def changed(**values):
    names = ["c", "q", "x", "t", "r"]
    return tuple(values.get(name, good) for name, good in zip(names, GOOD, strict=True))


def test_clean_rows_pass(spark):
    report = gate(spark)
    assert report.columns == ["position", "rule", "column", "violations"]
    assert [row.violations for row in report.collect()] == [0] * 7


@pytest.mark.parametrize(
    ("values", "message"),
    [
        ({"c": None}, "Column 'c' has 1 missing values"),
        ({"q": 0}, "Column 'q' has 1 non-positive values"),
        ({"x": -0.5}, "Column 'x' has 1 non-positive values"),
        ({"t": None}, "Column 't' has 1 records outside last 90 days"),
        ({"t": datetime(2025, 12, 30, 8, 59, 59)}, "Column 't' has 1 records outside last 90"),
        ({"t": datetime(2026, 3, 30, 9, 0, 1)}, "Column 't' has 1 future timestamp"),
        ({"r": None}, "Column 'r' has 1 invalid exchange rates"),
        ({"r": 0.0}, "Column 'r' has 1 invalid exchange rates"),
    ],
)
def test_single_violation(spark, values, message):
    with pytest.raises(ValueError, match=message):
        gate(spark, changed(**values))


@pytest.mark.parametrize(
    "values", [{"t": OLDEST}, {"t": AS_OF}, {"x": None}, {"x": math.nan}, {"r": math.nan}]
)
def test_limits_and_gaps_that_pass(spark, values):
    gate(spark, changed(**values))


def test_all_messages_in_one_error(spark):
    bad = changed(c=None, q=-1, t=datetime(2030, 1, 1), r=-1.0)
    with pytest.raises(ValueError) as raised:
        gate(spark, bad, bad)
    assert str(raised.value) == "\n".join(
        [
            "Data validation failed:",
            "Column 'c' has 2 missing values",
            "Column 'q' has 2 non-positive values",
            "Column 't' has 2 future timestamp",
            "Column 'r' has 2 invalid exchange rates",
        ]
    )


def test_as_of_as_text_and_zoneless_times(spark):
    gate(spark, changed(t=OLDEST), as_of="2026-03-30 09:00:00", time_type="timestamp_ntz")
    with pytest.raises(ValueError, match="future"):
        gate(spark, changed(t=AS_OF), as_of="2026-03-30 08:59:59", time_type="timestamp_ntz")


def test_unknown_column(spark):
    df = spark.createDataFrame([GOOD], SCHEMA)
    with pytest.raises(ValueError, match=r"Columns not found in DataFrame: \['nope'\]"):
        validate(df, ["nope"], ["q"], "t", "r", AS_OF)


def test_null_scan(spark):
    df = spark.createDataFrame([(1, None, math.nan), (2, "a", 1.0), (3, None, None)],
                               "k int, s string, d double")
    assert rows(null_scan(df)) == [("d", 2), ("k", 0), ("s", 2)]


STORED = "k int, s string, m decimal(12,2), t timestamp, d double, P string, N int"


def stored(spark, tmp_path, *more):
    data = [
        (1, None, Decimal("1.5"), None, math.nan, "a", 1),
        (None, "y", None, datetime(2026, 3, 1), None, None, 2),
        (None, "z", None, None, 2.0, None, None),
        *more,
    ]
    df = spark.createDataFrame(data, STORED)
    path = str(tmp_path / "t")
    df.write.partitionBy("P", "N").parquet(path)
    return read_published(spark, path, df.schema), path


def test_nulls_from_footers_are_those_of_a_scan(spark, tmp_path):
    table, path = stored(spark, tmp_path)
    got = rows(stored_null_scan(table, path))
    assert got == rows(null_scan(table))
    assert dict(got) == {"k": 2, "s": 1, "m": 2, "t": 2, "d": 2, "P": 2, "N": 1}


def test_data_pages_of_columns_counted_in_footers_are_not_read(spark, tmp_path):
    table, path = stored(spark, tmp_path)
    want = rows(null_scan(table))
    for file in Path(path).rglob("*.parquet"):
        group = pq.ParquetFile(file).metadata.row_group(0)
        content = bytearray(file.read_bytes())
        for at in range(group.num_columns):
            chunk = group.column(at)
            if chunk.path_in_schema != "d":
                first = chunk.dictionary_page_offset or chunk.data_page_offset
                end = first + chunk.total_compressed_size
                content[first:end] = b"\xff" * (end - first)
        file.write_bytes(content)
        (file.parent / f".{file.name}.crc").unlink()
    assert rows(stored_null_scan(table, path)) == want
    with pytest.raises(Exception, match="FAILED_READ_FILE|Parquet|parquet"):
        null_scan(table).collect()


def test_values_too_long_for_footers_are_read(spark, tmp_path):
    table, path = stored(spark, tmp_path, (1, "x" * 5000, None, None, 1.0, "a", 1))
    assert rows(stored_null_scan(table, path)) == rows(null_scan(table))


def test_stored_null_scan_without_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(0).write.parquet(path)
    assert rows(stored_null_scan(read_published(spark, path), path)) == [("id", 0)]
