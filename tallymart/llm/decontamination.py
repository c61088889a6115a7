"""Benchmark decontamination by a prefix-filtered set join, on built-in functions alone.

Texts are lower-cased (A-Z) and cut into words. A *window* is ``window`` consecutive words of an
item, or the whole of a shorter one, and stands for the set of its placed shingles (``shingle`` words,
fewer in shorter windows). A window occurs where a document holds all of them in place. So one
shingle is a necessary prefix, and the best is the one that documents hold least often:

1. Each document's shingles are met once with the distinct shingles of all items; that leaves the
   *matches* (document, place, shingle), from which shingles are ordered by rarity.
2. Windows with a shingle that no document holds are dropped. Of the others the rarest shingle is
   joined with the matches; place and length bound where its window can lie.
3. A candidate is verified by all its shingles, each expected at its own place.

Texts are known by 128 hash bits, so copies are one text to steps 1 to 3. Items' shingles are
broadcast up to ``BROADCAST_ROWS`` (counted first); beyond that they are joined by a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart.llm.frames import Shelf, pick, text_key

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BROADCAST_ROWS = 2_000_000  # of 8 bytes each
KEY = ["k1", "k2"]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, UPPER, LOWER), SEPARATORS, -1), "")


def shingles_of(words: Column, size: int) -> Column:
    """Hashes of every ``size`` consecutive words, by place."""

    def hashed(at: Column) -> Column:
        return F.xxhash64(*(F.get(words, at + i) for i in range(size)))

    places = F.sequence(F.lit(0), F.size(words) - size)
    return F.when(F.size(words) >= size, F.transform(places, hashed)).otherwise(
        F.array().cast("array<bigint>")
    )


def item_windows(benchmark: DataFrame, window: int, shingle: int) -> DataFrame:
    """Distinct windows: their length, the size of their shingles, the shingles, the item_ids."""
    items = pick(benchmark, "item_id", "text").select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"),
        words_of(F.coalesce("text", F.lit(""))).alias("words"),
    )
    items = items.where(F.size("words") > 0).withColumn(
        "length", F.least(F.size("words"), F.lit(window))
    )
    cut = items.withColumn(
        "start", F.explode(F.sequence(F.lit(0), F.size("words") - F.col("length")))
    ).select("item_id", "length", F.slice("words", F.col("start") + 1, F.col("length")).alias("words"))
    cut = cut.withColumn("size", F.least("length", F.lit(shingle)))
    # One size is fixed in each branch, as the number of words hashed is part of the expression.
    hashes = F.lit(None).cast("array<bigint>")
    for size in range(1, shingle + 1):
        hashes = F.when(F.col("size") == size, shingles_of(F.col("words"), size)).otherwise(hashes)
    return (
        cut.select("item_id", "length", "size", hashes.alias("hashes"))
        .groupBy("length", "size", "hashes")
        .agg(F.collect_set("item_id").alias("item_ids"))
        .withColumn("window", F.xxhash64("length", "hashes"))
    )


def occurrences(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, shingle: int = 5
) -> DataFrame:
    """Every occurrence of an item's window in a text: k1, k2 (the text's key), start, length
    (both in words) and item_ids."""
    shelf = Shelf(docs.sparkSession, "decontamination")
    windows = shelf.put(item_windows(benchmark, window, shingle), "windows", slim=True)
    sizes = [r.size for r in windows.select("size").distinct().collect()]  # 1 to ``shingle``
    held = windows.select(F.explode("hashes").alias("hash")).distinct()
    if held.count() <= BROADCAST_ROWS:
        held = F.broadcast(held)
    cut = pick(docs, "text").where(F.col("text").isNotNull()).select(
        *text_key(F.col("text")), words_of(F.col("text")).alias("words")
    )
    arrays = [shingles_of(F.col("words"), size) for size in sorted(sizes)]
    matches = None
    for array in arrays:
        own = cut.select(*KEY, F.posexplode(array).alias("place", "hash")).join(held, "hash")
        matches = own if matches is None else matches.unionAll(own)
    if matches is None:
        return docs.sparkSession.createDataFrame(
            [], "k1 long, k2 long, start int, length int, item_ids array<string>"
        )
    matches = shelf.put(matches.dropDuplicates([*KEY, "place", "hash"]), "matches", slim=True)
    rarity = matches.groupBy("hash").agg(F.count("*").alias("n"))
    # The rarest shingle of each window; a window that lacks one in all documents is dropped.
    ranked = (
        windows.select("window", F.size("hashes").alias("parts"), F.posexplode("hashes").alias("at", "hash"))
        .join(rarity, "hash")
        .groupBy("window")
        .agg(
            F.count("*").alias("found"),
            F.first("parts").alias("parts"),
            F.min(F.struct("n", "at", "hash")).alias("rarest"),
        )
        .where("found = parts")
        .select("window", F.col("rarest.at").alias("at"), F.col("rarest.hash").alias("hash"))
    )
    candidates = (
        matches.join(ranked, "hash")
        .select(*KEY, (F.col("place") - F.col("at")).alias("start"), "window")
        .where("start >= 0")
    )
    expected = candidates.join(windows.select("window", "hashes"), "window").select(
        *KEY, "start", "window", F.size("hashes").alias("parts"), F.posexplode("hashes").alias("at", "hash")
    )
    verified = (
        expected.withColumn("place", F.col("start") + F.col("at"))
        .join(matches, [*KEY, "place", "hash"], "left_semi")
        .groupBy(*KEY, "start", "window", "parts")
        .agg(F.count("*").alias("found"))
        .where("found = parts")
    )
    return verified.join(windows.select("window", "length", "item_ids"), "window").select(
        *KEY, "start", "length", "item_ids"
    )


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, shingle: int = 5
) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of each row.

    Null and empty texts have no words; items without words have no window. Repeated rows have the
    same result each. An item with a null item_id counts as the item "". Items of one item_id are one
    item. An empty table of documents gives no rows; without items nothing is contaminated.
    """
    found = Shelf(docs.sparkSession, "contamination").put(
        occurrences(docs, benchmark, window, shingle), "occurrences", slim=True
    )
    end = F.col("start") + F.col("length")
    before = Window.partitionBy(*KEY).orderBy("start", "length").rowsBetween(Window.unboundedPreceding, -1)
    spans = found.select(*KEY, "start", "length").distinct()
    hit = (
        spans.withColumn("reach", F.coalesce(F.max(end).over(before), F.lit(0)))
        .groupBy(*KEY)
        .agg(F.sum(F.greatest(F.lit(0), end - F.greatest("start", "reach"))).alias("n_hit"))
    )
    items = (
        found.select(*KEY, F.explode("item_ids").alias("item_id"))
        .groupBy(*KEY)
        .agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    )
    rows = pick(docs, "doc_id", "text").select(
        "doc_id",
        *text_key(F.col("text")),
        F.size(words_of(F.coalesce("text", F.lit("")))).cast("long").alias("n_words"),
    )
    joined = rows.join(hit.join(items, KEY), KEY, "left")
    return joined.select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


ORACLE = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS t
  FROM (SELECT *, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)
), lengths AS (SELECT DISTINCT n FROM win),
placed AS (
  SELECT r, n, i, array_to_string(w[i : i + n - 1], ' ') AS t
  FROM (SELECT d.r, d.w, l.n, unnest(range(1, len(d.w) - l.n + 2)) AS i FROM d, lengths l WHERE len(d.w) >= l.n)
), hits AS (SELECT a.r, a.i, a.n, win.item_id FROM placed a JOIN win ON a.n = win.n AND a.t = win.t),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
items AS (
  SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT r, item_id FROM hits) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""
