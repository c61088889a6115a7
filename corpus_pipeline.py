"""From raw documents to packed training sequences, stage by stage.

Every stage but the last filters whole rows and returns the columns of ``documents``. Stages are
written as Parquet and read again, so none repeats another's work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallymart.llm import decontamination, ngram_join, packing, quality_rules, toxicity
from tallymart.llm.frames import Shelf, read_table, rows_of, text_key, with_row

TOXIC = 0.7


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose toxicity is under TOXIC; learnt from all labelled documents that are there."""
    model = toxicity.fit_on(docs, read_table(spark, sf_dir, "labels"), F.lit(True))
    judged = with_row(docs, "text").withColumn("_score", toxicity.score(model, "_text"))
    return rows_of(judged.where(F.col("_score") < TOXIC), docs.columns)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality rules keep."""
    judged = with_row(docs, "text").withColumn("_verdict", quality_rules.verdict("_text"))
    return rows_of(judged.where("_verdict.kept"), docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of the n-gram join: the one of least doc_id.

    Rows without an id stand behind the others. Rows without a shingle are all kept.
    """
    key = ["doc_id", "k1", "k2"]
    joined = Shelf(spark, "near_copies").put(ngram_join.ngram_join(docs), "joined", slim=True)
    first = F.struct(F.col("doc_id").isNull().alias("last"), *key)
    grouped = joined.where("group_id IS NOT NULL").groupBy("group_id").agg(F.min(first).alias("row"))
    lone = joined.where("group_id IS NULL").select(*key, F.lit(False).alias("once")).distinct()
    kept = grouped.select(*(F.col(f"row.{x}").alias(x) for x in key), F.lit(True).alias("once"))
    kept = kept.unionAll(lone)
    rows = with_row(docs, "doc_id", "text").select(
        "_row", F.col("_doc_id").cast("long").alias("_doc_id"), *text_key(F.col("_text"))
    )
    held = rows.alias("a").join(
        kept.alias("b"),
        (F.col("a.k1") == F.col("b.k1"))
        & (F.col("a.k2") == F.col("b.k2"))
        & F.col("a._doc_id").eqNullSafe(F.col("b.doc_id")),
    )
    held = held.select("_row", "a.k1", "a.k2", "_doc_id", "once")
    copies = Window.partitionBy("k1", "k2", "_doc_id").orderBy("_doc_id")
    single = held.where("once").withColumn("_copy", F.row_number().over(copies)).where("_copy = 1")
    return rows_of(single.select("_row").unionAll(held.where("NOT once").select("_row")), docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows in which no window of a benchmark item occurs."""
    found = decontamination.occurrences(docs, read_table(spark, sf_dir, "benchmark"))
    hit = Shelf(spark, "contaminated").put(found.select("k1", "k2").distinct(), "texts", slim=True)
    rows = with_row(docs, "text").select("_row", *text_key(F.col("_text")))
    return rows_of(rows.join(hit, ["k1", "k2"], "left_anti"), docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document that is left."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality rules", drop_low_quality),
    ("n-gram jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("best-fit packing", pack_sequences),
]

# SQL cannot fit the factorization machine nor run the tokenizers.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    shelf = Shelf(spark, "pipeline")
    docs = read_table(spark, sf_dir, "documents")
    for place, (_, stage) in enumerate(STAGES):
        docs = shelf.put(stage(spark, docs, sf_dir), f"stage{place}")
        if place:
            shelf.drop(f"stage{place - 1}")
    return docs
