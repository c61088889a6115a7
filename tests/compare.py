"""Run registered queries against their SQL: python tests/compare.py [folder] [query ...]"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as registered  # noqa: E402
from tallymart.session import make_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NULL"
    return "NULL" if value is None else f"{type(value).__name__}:{value!r}"


def _sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda at: names[at])
    return sorted(tuple(_plain(row[at]) for at in order) for row in rows)


def compare(spark, folder: str, name: str) -> str:
    """Empty when names, row count and every value agree, else what differs."""
    started = time.time()
    df = registered.queries()[name](spark, folder)
    ours = _sorted_rows(df.columns, [tuple(row) for row in df.collect()])
    elapsed = time.time() - started
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')"
        )
    result = connection.execute(registered.oracle_sql()[name])
    names = [entry[0] for entry in result.description]
    theirs = _sorted_rows(names, result.fetchall())
    print(f"{name}: {len(ours)} rows, {elapsed:.1f} s", flush=True)
    if sorted(names) != sorted(df.columns):
        return f"{name}: columns {sorted(df.columns)} against {sorted(names)}"
    if len(ours) != len(theirs):
        return f"{name}: {len(ours)} rows against {len(theirs)}"
    differing = [pair for pair in zip(ours, theirs, strict=True) if pair[0] != pair[1]]
    return f"{name}: {len(differing)} rows differ, first {differing[0]}" if differing else ""


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(registered.oracle_sql())
    spark = make_session(
        {
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
        }
    )
    spark.sparkContext.setLogLevel("ERROR")
    problems = []
    for name in names:
        if problem := compare(spark, folder, name):
            problems.append(problem)
            print(problem, flush=True)
    print(f"{len(problems)} of {len(names)} differ" if problems else "all equal")
    return len(problems)


if __name__ == "__main__":
    sys.exit(main())
