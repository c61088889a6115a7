"""Session and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache
from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession

RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key even where the next aggregation could have kept the join's partitioning.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Product lists and rates up to this size spare the sales lines a shuffle. Spark compares it with
    # the size of files; compressed ones take ten times as much and more on the driver.
    "spark.sql.autoBroadcastJoinThreshold": "10MB",
    # Larger splits of text make fewer, larger files of cleaned lines.
    "spark.sql.files.maxPartitionBytes": "256MB",
}


@contextmanager
def recommended(spark: SparkSession) -> Iterator[None]:
    """The recommended settings while a query is made; afterwards the caller's own are back."""
    given = spark.conf.getAll
    added = [name for name in RECOMMENDED if name not in given]
    recommend(spark)
    try:
        yield
    finally:
        for name in added:
            spark.conf.unset(name)


def recommend(spark: SparkSession) -> None:
    """Apply the recommended settings that nobody has set for this session."""
    given = spark.conf.getAll
    for name, value in RECOMMENDED.items():
        if name not in given:
            spark.conf.set(name, value)


def make_session(conf: dict[str, str] | None = None, app_name: str = "tallymart") -> SparkSession:
    """Session with ``conf`` and, where neither it nor spark-submit says otherwise, the
    recommended settings."""
    spark = SparkSession.builder.appName(app_name).config(map=conf or {}).getOrCreate()
    recommend(spark)
    return spark


@cache
def _test_folder(application_id: str) -> str:
    return tempfile.mkdtemp(prefix=f"tallymart-{application_id}-")


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a ``local`` master, where driver and executors are one process, may go without it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("Set spark.checkpoint.dir to a folder all executors can reach")
    return _test_folder(context.applicationId)


def owned_folder(spark: SparkSession, owner: str) -> str:
    """Folder inside the shared folder that belongs to one output path."""
    return f"{shared_folder(spark)}/tallymart/{sha256(owner.encode()).hexdigest()[:16]}"


def stage(df: DataFrame, owner: str, name: str) -> DataFrame:
    """Compute ``df`` once into Parquet in the shared folder and read it back.

    The result no longer depends on the work before it: losing executors costs no recomputation,
    later readers get column pruning and row-group filters, and Spark knows its size. A new run
    for the same owner replaces the copy, so at most one is kept per table.
    """
    spark = df.sparkSession
    path = f"{owned_folder(spark, owner)}/{name}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
