"""Properties that keep the jobs fast on large and skewed data, checked on plans and files."""

from __future__ import annotations

from contextlib import contextmanager
from datetime import date
from pathlib import Path

import pytest
from conftest import rows
from pyspark import TaskContext
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tallymart.operators.clean import drop_audit_columns, remove_nulls
from tallymart.operators.enrich import add_revenue, enrich_sales, join_rates
from tallymart.operators.marts import daily_category_summary, daily_customer_summary
from tallymart.operators.quality import gate_rules, quality_report
from tallymart.operators import upsert
from tallymart.operators.upsert import increment, publish, touched_rows
from tallymart.plans import catalog, daily_job
from tallymart.session import stage
from tallymart.sources.published import read_published, table_path

SMALL = "/root/testdata/sf0.001"
DAY = date(2026, 1, 5)


@contextmanager
def settings(spark, **values):
    names = {key.replace("__", "."): value for key, value in values.items()}
    before = {name: spark.conf.get(name) for name in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_no_cross_join_and_no_python(spark, name, monkeypatch):
    """In the plan of the result and in those of everything written on the way."""
    plans = []
    for module, writer in ((upsert, "_write"), (upsert, "_staged"), (daily_job, "stage")):

        def watched(df, *arguments, genuine=getattr(module, writer), **options):
            plans.append(plan(df))
            return genuine(df, *arguments, **options)

        monkeypatch.setattr(module, writer, watched)
    plans.append(plan(catalog.queries()[name](spark, SMALL)))
    if name.startswith(("upsert", "daily_job", "publish")):
        assert len(plans) > 1
    for text in plans:
        for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
            assert unwanted not in text


def hot_sales(spark, path):
    """Half of the lines carry one product; every line costs one."""
    lines = spark.range(60000).select(
        F.col("id").alias("ORDER_ID"),
        (F.col("id") % 100).alias("CUSTOMER_ID"),
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias(
            "PRODUCT_ID"
        ),
        F.lit(1).alias("QUANTITY"),
        F.lit(1).cast("decimal(12,2)").alias("PRICE"),
        F.lit("2026-01-05 10:00:00").cast("timestamp").alias("ORDER_TIMESTAMP"),
        F.lit("US").alias("COUNTRY"),
        F.lit(DAY).alias("ORDER_DATE"),
    )
    lines.write.parquet(path)
    return spark.read.parquet(path)


def test_hot_product_is_split_when_products_are_too_large_to_broadcast(spark, tmp_path):
    sales = hot_sales(spark, str(tmp_path / "sales"))
    sales.select("PRODUCT_ID").distinct().select(
        "PRODUCT_ID", F.lit("name").alias("PRODUCT_NAME"), F.lit("A").alias("CATEGORY")
    ).write.parquet(str(tmp_path / "products"))
    products = spark.read.parquet(str(tmp_path / "products"))
    rates = spark.createDataFrame(
        [(DAY, "US", 1.0)], "DATE date, COUNTRY string, EXCHANGE_RATE_TO_USD double"
    )
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="16KB",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="32KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
    ):
        df = enrich_sales(sales, products, rates).select("ORDER_ID")
        collected = df.collect()
        assert len(collected) == len({row[0] for row in collected}) == 60000
        assert "SortMergeJoin(skew=true)" in plan(df)
        summary = daily_category_summary(enrich_sales(sales, products, rates)).first()
    assert (summary["TOTAL_ORDERS"], summary["TOTAL_QUANTITY"]) == (60000, 60000)


def test_hot_day_is_split_although_the_summary_could_keep_the_join_partitioning(
    spark, tmp_path
):
    """Rates too large to broadcast, half of the lines on one day, grouped by day right after."""
    sales = hot_sales(spark, str(tmp_path / "sales")).withColumn(
        "ORDER_DATE",
        F.when(F.col("PRODUCT_ID") == "hot", F.col("ORDER_DATE")).otherwise(
            F.date_add("ORDER_DATE", (F.col("ORDER_ID") % 400).cast("int"))
        ),
    )
    sales.write.parquet(str(tmp_path / "days"))
    sales = spark.read.parquet(str(tmp_path / "days"))
    sales.select(F.col("ORDER_DATE").alias("DATE"), "COUNTRY").distinct().withColumn(
        "EXCHANGE_RATE_TO_USD", F.lit(2.0)
    ).write.parquet(str(tmp_path / "rates"))
    rates = spark.read.parquet(str(tmp_path / "rates"))
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="16KB",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="32KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
    ):
        lines = add_revenue(join_rates(sales.withColumn("CATEGORY", F.lit("A")), rates))
        df = daily_category_summary(lines)
        summary = {row.ORDER_DATE: row for row in df.collect()}
        assert "SortMergeJoin(skew=true)" in plan(df)
    assert sum(row.TOTAL_ORDERS for row in summary.values()) == 60000
    assert summary[DAY].TOTAL_REVENUE_USD == 2.0 * summary[DAY].TOTAL_ORDERS >= 60000


def test_small_products_and_rates_are_broadcast(spark, tmp_path):
    hot_sales(spark, str(tmp_path / "sales"))
    products = spark.createDataFrame(
        [("hot", "n", "A")], "PRODUCT_ID string, PRODUCT_NAME string, CATEGORY string"
    )
    products.write.parquet(str(tmp_path / "products"))
    rates = spark.createDataFrame(
        [(DAY, "US", 1.0)], "DATE date, COUNTRY string, EXCHANGE_RATE_TO_USD double"
    )
    rates.write.parquet(str(tmp_path / "rates"))
    inputs = [spark.read.parquet(str(tmp_path / n)) for n in ("sales", "products", "rates")]
    text = plan(enrich_sales(*inputs))
    assert text.count("BroadcastHashJoin") == 2
    assert "hashpartitioning" not in text
    assert "PRODUCT_NAME" not in text


def test_customer_summary_is_one_pass_without_join_or_window(spark, tmp_path):
    path = str(tmp_path / "lines")
    catalog._lines(spark, SMALL).write.parquet(path)
    lines = spark.read.parquet(path)
    text = plan(daily_customer_summary(lines))
    assert text.count("FileScan") == 1
    assert "Join" not in text and "Window" not in text
    for mart in (daily_customer_summary, daily_category_summary):
        text = plan(increment(mart(lines), "ORDER_DATE", "1998-08-05"))
        assert "EqualTo(ORDER_DATE,1998-08-05)" in text
        assert "ORDER_TIMESTAMP" not in text


def test_gate_reads_its_input_once(spark, tmp_path):
    path = str(tmp_path / "lines")
    catalog._lines(spark, SMALL).write.parquet(path)
    lines = spark.read.parquet(path)
    rules = gate_rules(
        lines, ["COUNTRY"], ["QUANTITY", "PRICE"], "ORDER_TIMESTAMP", "EXCHANGE_RATE_TO_USD",
        "1998-08-02",
    )
    text = plan(quality_report(lines, rules))
    assert text.count("FileScan") == 1
    assert "CATEGORY" not in text


def test_null_test_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "lines")
    spark.range(5).withColumn("x", F.col("id").cast("int")).write.parquet(path)
    assert "IsNotNull(x)" in plan(remove_nulls(spark.read.parquet(path), ["x"]))


def test_counts_taken_while_storing_are_exact_when_tasks_are_repeated(spark, tmp_path):
    @F.udf("boolean")
    def dies_at_first(value):
        if TaskContext.get().attemptNumber() == 0 and value % 1000 == 999:
            raise RuntimeError("lost")
        return True

    sales = spark.range(8000).repartition(8).select(
        F.col("id").cast("int").alias("QUANTITY"),
        F.when(F.col("id") % 4 > 0, F.lit(1)).alias("PRICE"),
        "id",
    )
    audit = Observation("audit")
    watched = sales.observe(audit, *drop_audit_columns(sales, ["QUANTITY", "PRICE"]))
    kept = remove_nulls(watched, ["QUANTITY", "PRICE"]).where(dies_at_first("id"))
    assert stage(kept, str(tmp_path), "kept").count() == 6000
    assert audit.get == {"rows_before": 8000, "rows_after": 6000, "rows_dropped": 2000}


SCHEMA = "COUNTRY string, ORDER_DATE date, k bigint, v string"


def mart(spark, day=DAY, value="old"):
    """Two thirds of the rows lie in one country."""
    return spark.range(90000).select(
        F.when(F.col("id") % 3 < 2, "hot").otherwise(
            F.concat(F.lit("C"), (F.col("id") % 20).cast("string"))
        ).alias("COUNTRY"),
        F.lit(day).alias("ORDER_DATE"),
        F.col("id").alias("k"),
        F.lit(value).alias("v"),
    )


def test_hot_partition_is_written_by_several_tasks(spark, tmp_path):
    with settings(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB"):
        publish(
            mart(spark), str(tmp_path), "t", ["COUNTRY", "ORDER_DATE", "k"], "ORDER_DATE", DAY,
            ["COUNTRY"],
        )
    files = {
        folder.name: len(list(folder.glob("*.parquet")))
        for folder in Path(table_path(str(tmp_path), "t")).glob("COUNTRY=*")
    }
    hot = files.pop("COUNTRY=hot")
    assert hot >= 4
    # Only countries that share the hot one's shuffle partition are spread with it.
    assert sorted(files.values())[len(files) // 2] == 1
    assert read_published(spark, table_path(str(tmp_path), "t")).count() == 90000


def files_read(df) -> int:
    """Files that the scans of ``df`` opened."""
    df.collect()
    scans = df._jdf.queryExecution().executedPlan().collectLeaves()
    counts = []
    for i in range(scans.size()):
        metrics = scans.apply(i).metrics()
        if metrics.contains("numFiles"):
            counts.append(metrics.apply("numFiles").value())
    return sum(counts)


def test_merge_reads_the_touched_partitions_only_however_large_the_day(spark, tmp_path):
    target_path, source_path = str(tmp_path / "target"), str(tmp_path / "source")
    mart(spark).repartition(4).write.partitionBy("COUNTRY").parquet(target_path)
    mart(spark).where("COUNTRY = 'C1'").write.parquet(source_path)
    schema = mart(spark).schema
    source = increment(spark.read.schema(schema).parquet(source_path), "ORDER_DATE", DAY)
    with settings(
        spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false"
    ):
        for target in (
            spark.read.schema(schema).parquet(target_path),
            increment(spark.read.schema(schema).parquet(target_path), "ORDER_DATE", DAY),
        ):
            df = touched_rows(target, source, ["COUNTRY"])
            assert files_read(df.select("COUNTRY", "k")) == 4
            assert {row.COUNTRY for row in df.select("COUNTRY").distinct().collect()} == {"C1"}
            matched = df.join(source.select("COUNTRY", "k"), ["COUNTRY", "k"], "left_semi")
            assert "Exchange" in plan(matched) and "C1" in plan(matched)


@pytest.mark.parametrize("touched", [1000, 5000])
@pytest.mark.parametrize("columns", [["a"], ["a", "b"]])
def test_merge_touches_thousands_of_partitions(spark, tmp_path, touched, columns):
    """On the default stack; the scan opens the touched files alone. Odd values, NULL among them."""
    total = touched + 200
    value = F.when(F.col("id") == 7, None).when(F.col("id") == 8, "it's \\ 100% `q`")
    frame = spark.range(total).select(
        F.coalesce(value, F.when(F.col("id") != 7, F.concat(F.lit("v"), "id"))).alias("a"),
        (F.col("id") % 3).cast("int").alias("b"),
        F.lit(DAY).cast("date").alias("ORDER_DATE"),
        F.col("id").alias("n"),
    )
    frame.repartition(8, "a").write.partitionBy(*columns).parquet(str(tmp_path / "t"))
    target = spark.read.schema(frame.schema).parquet(str(tmp_path / "t"))
    source = frame.where(F.col("n") < touched)
    read = touched_rows(target, source, columns)
    assert files_read(read.select(*columns, "n")) == touched
    assert rows(read.agg(F.count("*"), F.sum("n"))) == [(touched, touched * (touched - 1) // 2)]
    if touched == 1000:
        merged = source.withColumn("n", F.col("n") + 10_000)
        done = publish(merged, str(tmp_path), "t", ["a", "b", "ORDER_DATE"], "ORDER_DATE", DAY, columns)
        assert done == "merged"
        table = read_published(spark, str(tmp_path / "t"), frame.schema)
        nulls = 1  # its key never matches, so it is added
        assert table.count() == total + nulls
        assert table.where("n >= 10000").count() == touched


def test_merge_beyond_the_named_partitions_is_joined(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(upsert, "NAMED_PARTITIONS", 20)
    frame = spark.range(90).select((F.col("id") % 30).alias("a"), (F.col("id") % 2).alias("b"), "id")
    frame.write.partitionBy("a", "b").parquet(str(tmp_path / "t"))
    target = spark.read.schema(frame.schema).parquet(str(tmp_path / "t"))
    source = frame.where("a < 25 AND b = 1 AND a <> 3")
    read = touched_rows(target, source, ["a", "b"])
    assert rows(read.select("id")) == rows(frame.where("a < 25 AND b = 1 AND a <> 3").select("id"))
    assert "b" in plan(read).split("PartitionFilters: [")[1].split("]")[0]


def test_published_read_is_pruned(spark, tmp_path):
    path = str(tmp_path / "t")
    mart(spark).write.partitionBy("COUNTRY").parquet(path)
    df = read_published(spark, path).where("COUNTRY = 'C1'")
    assert "(COUNTRY" in plan(df).split("PartitionFilters: [")[1].split("]")[0]
    assert rows(df.select("COUNTRY").distinct()) == [("C1",)]
