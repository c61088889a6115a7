"""Best-two-fit packing of tokenised documents into sequences, at any number of documents.

What fits where depends on lengths alone, and there are at most ``size`` lengths. So the plan is
made from the count of pieces of each length: a *pattern* is the content of one sequence, and the
same pattern is repeated until one of its lengths runs out. There are at most about two patterns
for each length, whatever the input, which bounds the driver's work and the plan.

A pattern starts with the longest length left and is filled greedily with the longest that fits.
When a gap remains, its smallest document is replaced by the two unpacked documents that fit the
gap expanded by it most tightly, if they fill more of it than the smallest did.

Pieces get their place by their rank within their length: ranks are counted in buckets of a hash,
so that no task holds all pieces of a frequent length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymart.llm.frames import Shelf, pick
from tallymart.llm.vocab import encoded_blocks, unit_encoder

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
RANK_BITS = 45


def cut_pieces(docs: DataFrame, vocabulary: str, size: int, end_id: int) -> DataFrame:
    """Token pieces of each document, ``end_id`` appended; a null text has the end alone."""

    def cut(batches):
        encoder = unit_encoder(vocabulary, False)
        ending = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for first, end, ids, bounds in encoded_blocks(texts, encoder):
                raw, rows = ids.astype("<u4").tobytes(), []
                edges = (4 * bounds).tolist()
                for i in range(end - first):
                    own = raw[edges[i] : edges[i + 1]] + ending
                    for k, at in enumerate(range(0, len(own), 4 * size)):
                        part = own[at : at + 4 * size]
                        rows.append((doc_ids[first + i], k, at // 4, len(part) // 4, zlib.crc32(part)))
                columns = zip(*rows, strict=True)
                types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                    ["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    rows = pick(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    return rows.mapInArrow(cut, PIECE)


def fill_one(counts: np.ndarray, size: int) -> list[int]:
    """Lengths in one sequence, longest first; ``counts[l]`` pieces of length l are unpacked."""
    there = np.flatnonzero(counts).tolist()
    content: dict[int, int] = {}
    gap = size
    while gap:
        at = bisect_right(there, gap) - 1
        while at >= 0 and content.get(there[at], 0) >= counts[there[at]]:
            at -= 1
        if at < 0:
            break
        length = there[at]
        more = min(gap // length, int(counts[length]) - content.get(length, 0))
        content[length] = content.get(length, 0) + more
        gap -= more * length
    if gap and content:
        smallest = min(content)
        room = gap + smallest
        left = counts.copy()
        for length, used in content.items():
            left[length] -= used
        pair = best_two(left, room)
        if pair and sum(pair) > smallest:
            content[smallest] -= 1
            for length in pair:
                content[length] = content.get(length, 0) + 1
    return sorted((x for x, n in content.items() for _ in range(n)), reverse=True)


def best_two(left: np.ndarray, room: int) -> tuple[int, int] | None:
    """The two unpacked lengths with the largest sum of at most ``room``; ties: the longest."""
    first = np.flatnonzero(left[: room + 1])
    first = first[first < room]
    if not len(first):
        return None
    floor = np.maximum.accumulate(np.where(left > 0, np.arange(len(left)), 0))
    second = floor[np.minimum(room - first, first)]
    lone = (second == first) & (left[first] < 2)
    second = np.where(lone, floor[np.maximum(second - 1, 0)], second)
    total = np.where(second > 0, first + second, 0)
    best = len(total) - 1 - int(np.argmax(total[::-1]))
    return (int(first[best]), int(second[best])) if total[best] else None


def make_plan(counts: np.ndarray, size: int) -> dict[str, np.ndarray]:
    """Where the pieces of each length go, by rank.

    Entry i serves ranks from ``rank[i]`` on of length ``length[i]`` (up to the next entry of that
    length): ``uses[i]`` of them to each sequence from ``sequence[i]`` on, one after another from
    ``offset[i]``. Entries are sorted by length and rank.
    """
    counts, taken = counts.copy(), np.zeros_like(counts)
    entries, sequence = [], 0
    while counts.any():
        pattern = fill_one(counts, size)
        lengths, uses = np.unique(pattern, return_counts=True)
        times = int((counts[lengths] // uses).min())
        offset = 0
        for length, use in zip(lengths[::-1].tolist(), uses[::-1].tolist(), strict=True):
            entries.append((length, int(taken[length]), sequence, offset, use))
            taken[length] += times * use
            counts[length] -= times * use
            offset += length * use
        sequence += times
    entries.sort()
    names = ("length", "rank", "sequence", "offset", "uses")
    columns = np.array(entries, np.int64).reshape(-1, 5).T
    return dict(zip(names, columns, strict=True))


def _ranked(pieces: DataFrame) -> DataFrame:
    """Pieces with ``rank``, gapless from 0 within their length."""
    buckets = max(8, int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    salted = pieces.withColumn(
        "bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(buckets)).cast("int")
    )
    before = Window.partitionBy("length").orderBy("bucket")
    totals = salted.groupBy("length", "bucket").agg(F.count("*").alias("own"))
    bases = totals.select(
        "length", "bucket", (F.sum("own").over(before) - F.col("own")).alias("base")
    )
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = salted.withColumn("at", F.row_number().over(within))
    return ranked.join(bases, ["length", "bucket"]).withColumn(
        "rank", F.col("base") + F.col("at") - 1
    )


def pack(
    docs: DataFrame,
    vocabulary: str = "word_bpe_49k.json",
    size: int = 2048,
    end_id: int = 0,
) -> DataFrame:
    """Place of every piece of every document: PIECE's columns, sequence_id and offset.

    Null and empty texts are one piece with the end alone. Rows with a null doc_id, and repeated
    rows, are packed as documents of their own. An empty table gives no rows.
    """
    spark = docs.sparkSession
    pieces = Shelf(spark, "packing").put(cut_pieces(docs, vocabulary, size, end_id), "pieces")
    counts = np.zeros(size + 1, np.int64)
    for length, n in pieces.groupBy("length").agg(F.count("*")).collect():  # at most ``size`` rows
        counts[length] = n
    plan = make_plan(counts, size)
    keys = (plan["length"] << RANK_BITS) + plan["rank"]

    def assign(batches):
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            at = np.searchsorted(keys, (length << RANK_BITS) + rank, "right") - 1
            turn = rank - plan["rank"][at]
            sequence = plan["sequence"][at] + turn // plan["uses"][at]
            offset = plan["offset"][at] + turn % plan["uses"][at] * length
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    ranked = _ranked(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "rank")
    return ranked.mapInArrow(assign, f"{PIECE}, sequence_id long, offset long")
