"""Sharding by proportional stratified interleaving.

Rows are shuffled by a seeded hash within each source, and a row's fractional rank is its place
there divided by the number of the source's rows. Sorted by fractional rank, every stretch of the
order has the mixture of the whole, so cutting it into equal stretches gives shards that match it.

Both ranks are counted in two steps, so that a source with most rows is no single task: rows fall
into buckets by the value they are sorted by, a running sum over the buckets' counts gives each
bucket its base, and rows are numbered within their bucket. A fractional rank that many rows have, as
0.5 where most sources have one row, is spread over buckets by the hash (``_bands``).

Texts are read once: their sizes and hashes go to the shelf, and all counting reads these narrow rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart.llm.frames import Shelf, pick

HASH_SPACE = 1 << 32


def _numbered(
    df: DataFrame, keys: list[str], bucket: Column, order: list[str], name: str
) -> DataFrame:
    """``name``: place from 0 by bucket, then ``order``, within ``keys``; ``name_of``: rows there."""
    df = df.withColumn("_bucket", bucket)
    totals = df.groupBy(*keys, "_bucket").agg(F.count("*").alias("_own"))
    before = Window.partitionBy(*keys).orderBy("_bucket")
    bases = totals.select(
        *(F.col(k).alias(f"_{k}") for k in keys),
        F.col("_bucket").alias("_at"),
        (F.sum("_own").over(before) - F.col("_own")).alias("_base"),
        F.sum("_own").over(Window.partitionBy(*keys)).alias(f"{name}_of"),
    )
    within = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    numbered = df.withColumn("_row", F.row_number().over(within))
    same = F.col("_bucket") == F.col("_at")
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_{key}"))
    return (
        numbered.join(bases, same)
        .withColumn(name, F.col("_base") + F.col("_row") - 1)
        .drop("_bucket", "_at", "_base", "_row", *(f"_{k}" for k in keys))
    )


def _bands(ranked: DataFrame, rows: DataFrame, bands: int) -> tuple[DataFrame, Column]:
    """``ranked`` and the bucket of a row by fraction, then _hash.

    A fraction is hot if sources of at most 2 * ``bands`` rows give it a share of 1 / (2 * ``bands``)
    of all rows; the larger sources are too few to add as much again. Hot fractions, 2 * ``bands`` at
    most, have buckets of their own by ranges of _hash.
    """
    total = rows.count()
    own = rows.groupBy("source").agg(F.count("*").alias("n")).where(F.col("n") <= 2 * bands)
    places = own.groupBy("n").agg(F.count("*").alias("sources")).select(
        "n", "sources", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("k")
    )
    hot = (
        places.groupBy(((F.col("k") + 0.5) / F.col("n")).alias("at"))
        .agg(F.sum("sources").alias("held"))
        .where(F.col("held") * (2 * bands) >= total)
        .withColumn("parts", F.ceil(F.col("held") * bands / F.lit(max(total, 1))))
        .groupBy(F.floor(F.col("at") * bands).alias("_near"))
        .agg(F.collect_list(F.struct("at", "parts")).alias("_hot"))
    )
    band = F.floor(F.col("fraction") * bands)
    none = F.col("_hot").isNull()
    same = F.filter("_hot", lambda x: x["at"] == F.col("fraction"))
    below = F.size(F.filter("_hot", lambda x: x["at"] < F.col("fraction")))
    part = F.floor(F.col("_hash") * F.get(same, F.lit(0))["parts"] / HASH_SPACE)
    bucket = F.struct(
        band.alias("band"),
        F.when(none, 0).otherwise(2 * below + F.size(same)).alias("cell"),
        F.coalesce(part, F.lit(0)).alias("part"),
    )
    return ranked.join(F.broadcast(hot), band == F.col("_near"), "left"), bucket


def shards(
    docs: DataFrame, n_shards: int = 16, seed: int = 17, buckets: int | None = None
) -> DataFrame:
    """Shard and slot of every row by the law ``rows``: counts differ by one at most.

    Returns doc_id, source, size (UTF-8 bytes of the text plus 1; null text: 1), text_crc32, law,
    shard, slot (gapless from 0 within the shard, in the interleaved order), grown_shard (null: the
    law fixes counts, so another shard takes rows from all), source_rank and fraction.

    Rows without a source are a source of their own. Repeated rows, also of one doc_id, are rows of
    their own; rows equal in doc_id, source and text are interchangeable. An empty table gives no rows.
    """
    if buckets is None:
        buckets = max(16, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    text = F.coalesce("text", F.lit(""))
    rows = pick(docs, "doc_id", "source", "text").select(
        "doc_id",
        "source",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    rows = rows.withColumn(
        "_hash",
        F.pmod(F.xxhash64(F.lit(seed), "doc_id", "source", "text_crc32", "size"), F.lit(HASH_SPACE)),
    )
    rows = Shelf(docs.sparkSession, "sharding").put(rows, "rows")
    ties = ["doc_id", "text_crc32", "size"]
    ranked = _numbered(
        rows,
        ["source"],
        F.floor(F.col("_hash") * buckets / HASH_SPACE),
        ["_hash", *ties],
        "source_rank",
    )
    ranked = ranked.withColumn(
        "fraction", (F.col("source_rank") + 0.5) / F.col("source_rank_of")
    )
    banded, bucket = _bands(ranked, rows, 8 * buckets)
    placed = _numbered(
        banded.withColumn("_all", F.lit(0)),
        ["_all"],
        bucket,
        ["fraction", "_hash", "source", *ties],
        "_place",
    )
    shard = F.floor(F.col("_place") * n_shards / F.col("_place_of"))
    # Shard s holds the places p with s <= p * n / rows; the first of them is ceil(s * rows / n).
    first = F.ceil(F.col("shard") * F.col("_place_of") / n_shards)
    return placed.withColumn("shard", shard.cast("int")).select(
        "doc_id",
        "source",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        (F.col("_place") - first).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "source_rank",
        "fraction",
    )
