"""CSV input with a header row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_csv(
    spark: SparkSession,
    path: str,
    fail_fast: bool = False,
    infer: bool = False,
    malformed: str | None = None,
) -> DataFrame:
    """CSV rows as text, columns bound by the names in the header.

    Types are applied later by cast, so they never depend on the values in a file, and the extra
    pass that type inference needs is saved (``infer=True`` brings it back). Files of one folder
    whose headers differ raise instead of landing in the wrong columns. A missing path raises
    Spark's own PATH_NOT_FOUND on any file system. ``fail_fast=True`` reads one row right away.

    A line with fewer fields than the header has NULL in the rest, further fields are left out.
    ``malformed`` names a column that keeps the whole text of such lines and is NULL elsewhere.
    """
    df = spark.read.csv(path, header=True, inferSchema=infer, enforceSchema=False)
    if malformed:
        # Lines are told by the number of their fields, so all have to be parsed.
        reader = spark.read.schema(df.schema.add(malformed, "string")).option("columnPruning", False)
        df = reader.csv(path, header=True, enforceSchema=False, columnNameOfCorruptRecord=malformed)
        # A filter on the column itself would reach the parser, before it has marked the line.
        df = df.withColumn(malformed, F.when(F.col(malformed).isNotNull(), F.col(malformed)))
    if fail_fast:
        df.isEmpty()
    return df
