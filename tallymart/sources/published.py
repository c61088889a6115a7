"""Published tables: partitioned Parquet under ``<base>/<lower-case name>``."""

from __future__ import annotations

import json
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def table_path(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name.lower()}"


def read_published(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """The live rows of a published table.

    With ``schema``, partition values get its types (a COUNTRY of ``01`` stays text) and a table
    without rows can be read; without it their types are guessed from the folder names.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system that ``path`` lies in."""
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(context._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return file_system(spark, path).exists(folder)


def find_published(
    spark: SparkSession, path: str, schema: StructType | None = None
) -> DataFrame | None:
    """The table at ``path``, or None when there is none. A table without rows is a table; to read
    one, ``schema`` must be given."""
    return read_published(spark, path, schema) if path_exists(spark, path) else None


def stored_types(table: DataFrame) -> dict[str, str] | None:
    """Column types as written in a file of the table; partition columns are not among them.

    None when the table has no file with rows.
    """
    location = table.select("_metadata.file_path").first()
    if location is None:
        return None
    return dict(table.sparkSession.read.parquet(unquote(location.file_path)).dtypes)


def schema_note(path: str) -> str:
    """Where the columns of the table at ``path`` are noted: beside it, hidden from readers."""
    base, _, table = path.rpartition("/")
    return f"{base}/_{table}/schema"


def read_stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The table with the columns it was first written with.

    None for a table without rows of which no columns are noted.
    """
    if path_exists(spark, schema_note(path)):
        noted = spark.read.schema("columns string").parquet(schema_note(path)).first()
        if noted:
            return read_published(spark, path, StructType.fromJson(json.loads(noted.columns)))
    try:
        return read_published(spark, path)
    except AnalysisException as error:
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return None
        raise


def _by_footers(spark: SparkSession) -> SparkSession:
    """A session of the same application whose counts over whole Parquet files come from their footers."""
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return session


def footer_nulls(table: DataFrame, path: str, columns: list[str]) -> dict[str, int] | None:
    """NULLs of each of the columns that the files of the table at ``path`` hold; no data page is read.

    None when a footer lacks the count, as that of a column chunk whose values are too long for
    statistics does.
    """
    if not columns:
        return {}
    stored = _by_footers(table.sparkSession).read.schema(table.schema).parquet(path)
    counts = [F.count(name).alias(name) for name in columns]
    try:
        found = stored.agg(F.count("*").alias("rows of the table"), *counts).first()
    except Exception as error:
        if "aggregatePushdown" in str(error):
            return None
        raise
    return {name: (found["rows of the table"] or 0) - (found[name] or 0) for name in columns}
