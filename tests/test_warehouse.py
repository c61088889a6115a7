"""The warehouse seen as sales lines: what may be broadcast, and how lines are dealt to tasks."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from tallymart.operators import upsert
from tallymart.plans import catalog, daily_job
from tallymart.plans import retail_tables as tables
from tallymart.session import RECOMMENDED

LINES = 2000


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Two countries, 40 customers, 30 products, 500 orders of four lines each."""
    path = str(tmp_path_factory.mktemp("warehouse"))
    i = F.col("id")
    day = F.expr("timestamp_ntz'1998-08-01' + make_dt_interval(int(id % 9))")
    made = {
        "nation": (2, [i, F.concat(F.lit("NATION_"), i + 6), i]),
        "customer": (40, [i, F.lit("name"), i % 2, F.lit(1), F.lit("A")]),
        "part": (30, [i, F.concat(F.lit("p"), i), F.lit("B"), F.concat(F.lit("T"), i % 4), F.lit(1), F.lit(1)]),
        "orders": (500, [i, i % 40, F.lit("O"), F.lit(1), day, F.lit("1-URGENT")]),
        "lineitem": (
            LINES,
            [i % 500, i % 30, F.lit(1), F.floor(i / 500) + 1, i % 50 + 1, i % 90 + 1]
            + [F.lit(0), F.lit(0), F.lit("N"), F.lit("O"), day],
        ),
    }
    for name, (n, values) in made.items():
        schema = spark.createDataFrame([], tables.SCHEMAS[name]).schema
        typed = [v.cast(f.dataType).alias(f.name) for v, f in zip(values, schema, strict=True)]
        spark.range(n).select(*typed).coalesce(1).write.parquet(f"{path}/{name}.parquet")
    return path


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def written(monkeypatch) -> list[str]:
    """Plans of all that is written from now on, by ``publish`` or by the daily job."""
    plans = []
    for module, writer in ((upsert, "_write"), (daily_job, "stage")):

        def watched(df, *arguments, genuine=getattr(module, writer), **options):
            plans.append(plan(df))
            return genuine(df, *arguments, **options)

        monkeypatch.setattr(module, writer, watched)
    return plans


@pytest.mark.parametrize(
    "name",
    [
        "late_rows",
        "partition_pruned_read",
        "publish_initial",
        "read_published",
        "upsert_by_day",
        "upsert_insert",
        "upsert_many_partitions",
        "upsert_update",
    ],
)
def test_orders_and_customers_are_not_broadcast(spark, folder, monkeypatch, name):
    plans = written(monkeypatch)
    catalog.queries()[name](spark, folder)
    assert "SortMergeJoin [o_custkey" in plans[0]
    for text in plans:
        assert not re.search(r"BroadcastHashJoin \[(o_custkey|l_orderkey)", text)


def test_orders_and_customers_are_not_broadcast_in_the_job_inputs(spark, folder):
    for make in (tables.recent_sales, tables.raw_sales):
        text = plan(make(spark, folder))
        assert "SortMergeJoin [o_custkey" in text and "SortMergeJoin [l_orderkey" in text


def test_broadcast_threshold_is_for_compressed_files():
    assert RECOMMENDED["spark.sql.autoBroadcastJoinThreshold"] == "10MB"


@pytest.mark.parametrize("query", ["category_summary", "join_product_gaps"])
def test_many_products_are_not_broadcast(spark, folder, monkeypatch, query):
    run = catalog.queries()[query]
    few = run(spark, folder)
    assert "BroadcastHashJoin [PRODUCT_ID" in plan(few)
    monkeypatch.setattr(tables, "BROADCAST_ROWS", 29)
    many = run(spark, folder)
    assert "SortMergeJoin [PRODUCT_ID" in plan(many)
    assert sorted(map(tuple, many.collect())) == sorted(map(tuple, few.collect()))


def test_lines_of_a_task_are_bounded_by_rows(spark, folder, monkeypatch):
    few = catalog.queries()["category_summary"](spark, folder)
    monkeypatch.setattr(tables, "LINES_PER_TASK", 50)
    many = catalog.queries()["category_summary"](spark, folder)
    joined = tables.sales(spark, folder)
    counts = joined.groupBy(F.spark_partition_id().alias("task")).count().collect()
    # 40 partitions; one that adaptive execution packed by bytes would hold them all.
    assert sum(row["count"] for row in counts) == LINES
    assert len(counts) > 20 and max(row["count"] for row in counts) <= 4 * 50
    assert sorted(map(tuple, many.collect())) == sorted(map(tuple, few.collect()))


def test_lines_that_the_cores_share_out_are_left_to_adaptive_execution(spark, folder, monkeypatch):
    monkeypatch.setattr(tables, "LINES_PER_TASK", LINES // 8)
    assert "REPARTITION_BY_NUM" not in plan(tables.sales(spark, folder))
    monkeypatch.setattr(tables, "LINES_PER_TASK", LINES // 9)
    assert "REPARTITION_BY_NUM" in plan(tables.sales(spark, folder))
