"""Columns by exact name, and tables kept in the shared folder between two jobs."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.session import shared_folder


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The first column of each exact name, whatever other columns there are.

    Other columns may differ from a name by case only, repeat it or hold dots: columns are taken by
    place. A name that is absent raises ValueError.
    """
    absent = [name for name in names if name not in df.columns]
    if absent:
        raise ValueError(f"Columns not found in DataFrame: {absent}")
    numbered = df.toDF(*(f"column_{i}" for i in range(len(df.columns))))
    return numbered.select(
        *(F.col(f"column_{df.columns.index(name)}").alias(name) for name in names)
    )


def with_row(df: DataFrame, *names: str) -> DataFrame:
    """``pick`` of the names with prefix "_", beside the whole row as struct "_row".

    ``rows_of`` gives the row back, so a stage can judge rows without touching their columns.
    """
    numbered = df.toDF(*(f"column_{i}" for i in range(len(df.columns))))
    return numbered.select(
        F.struct(*numbered.columns).alias("_row"),
        *(F.col(f"column_{df.columns.index(name)}").alias(f"_{name}") for name in names),
    )


def rows_of(judged: DataFrame, names: list[str]) -> DataFrame:
    return judged.select("_row.*").toDF(*names)


def text_key(text: Column) -> list[Column]:
    """128 hash bits of a text, as k1 and k2; never null."""
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2")]


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@contextmanager
def small_batches(spark: SparkSession, rows: int = 2000) -> Iterator[None]:
    """Rows handed to Python at once while this lasts: a bound of memory where texts are long."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, min(rows, int(before)) if int(before) > 0 else rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


class Shelf:
    """Tables of one call in the shared folder; a table that is no longer read can be dropped.

    Each ``put`` computes a DataFrame once and reads it back, so that work before it is not
    repeated when executors are lost, nor run again for a second reader.
    """

    def __init__(self, spark: SparkSession, owner: str):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/tallymart/llm/{owner}-{uuid4().hex}"

    def put(self, df: DataFrame, name: str, slim: bool = False) -> DataFrame:
        """``slim``: rows so narrow that a file for each shuffle partition would be tiny; few tasks,
        though no fewer than twice the cores, write them."""
        path = f"{self.folder}/{name}"
        if slim:
            shuffled = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            df = df.coalesce(max(2 * self.spark.sparkContext.defaultParallelism, shuffled // 16))
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        context = self.spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
