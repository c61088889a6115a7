"""Bounded samples of labelled rows, from which the classifiers are fitted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.llm.frames import pick


def remainder(doc_id: Column | str, of: int) -> Column:
    """crc32 of the doc_id as text, modulo ``of``; a null doc_id is the empty text."""
    text = F.coalesce(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id, F.lit(""))
    return F.crc32(text.cast("binary")) % of


def sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    may_learn: Column,
    rows_per_class: int,
) -> tuple[list[tuple[str, object]], dict[object, int]]:
    """(text, label) of up to ``rows_per_class`` rows a class, and the count of all rows a class.

    ``may_learn`` is a condition on ``doc_id``. Rows are chosen by the hash of their doc_id, so the
    sample is the same in every run; rows without label, id or text are left out.
    """
    marked = (
        pick(labels, "doc_id", label)
        .toDF("doc_id", "label")
        .where(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & may_learn)
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    counts = dict(marked.groupBy("label").agg(F.count("*")).collect())  # one row a class
    order = F.xxhash64(F.lit(5), "doc_id")
    spark: SparkSession = docs.sparkSession
    chosen = None
    for value in counts:
        top = marked.where(F.col("label") == F.lit(value)).orderBy(order, "doc_id").limit(rows_per_class)
        chosen = top if chosen is None else chosen.unionAll(top)
    if chosen is None:
        return [], {}
    few = spark.createDataFrame(chosen.collect(), chosen.schema)  # at most rows_per_class a class
    texts = (
        pick(docs, "doc_id", "text")
        .where(F.col("text").isNotNull())
        .join(F.broadcast(few), "doc_id")
        .groupBy("doc_id")
        .agg(F.min("text").alias("text"), F.first("label").alias("label"))
        .orderBy(order, "doc_id")
    )
    return [(r.text, r.label) for r in texts.select("text", "label").collect()], counts
