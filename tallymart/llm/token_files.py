"""Token ids as canonical length-limited Huffman code in files of independent blocks.

Writing takes two passes. The first encodes whole texts in ascending doc_id order into *segments*
(consecutive documents, about ``SEGMENT`` ids) and counts each id over the whole corpus. From these
counts come code lengths of at most ``limit`` bits (package-merge), and from the lengths alone the
canonical code. The second pass codes each segment on its own.

A segment's bytes: magic, numbers of documents, ids and blocks, ids per block, then the bit offset
at which each block begins, whether each document has a doc_id, the doc_ids, the number of ids of
each document, and the bit stream. Blocks decode independently of each other by one table look-up
an id, so all blocks of a segment are decoded in step.

On disk a file set is a folder of three tables: ``codebook`` (id, length), ``segments`` (part,
segment, payload), ``index`` (part, segment, first id). Spark writes and commits them, so any store
that Spark reaches will do and a repeated task leaves nothing behind.
"""

from __future__ import annotations

import struct
import zlib
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallymart.llm.frames import Shelf, pick
from tallymart.llm.vocab import encoded_blocks, unit_encoder

MAGIC = b"TMH1"
HEAD = struct.Struct("<4sIQII")
SEGMENT = 1 << 20
BLOCK = 512
LIMIT = 16


def code_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """Bits of each symbol in an optimal prefix code of at most ``limit`` bits (package-merge).

    Symbols without a count get none. ``limit`` grows where the symbols would not fit.
    """
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    limit = max(limit, int(np.ceil(np.log2(len(used)))))
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.float64)
    leaf, merged = [], weights
    leaf.append(np.ones(len(weights), bool))
    for _ in range(limit - 1):
        pairs = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([weights, pairs])
        place = np.argsort(both, kind="stable")
        merged = both[place]
        leaf.append(place < len(weights))
    take = 2 * len(weights) - 2
    own = np.zeros(len(weights) + 1, np.int64)
    for is_leaf in reversed(leaf):
        leaves = int(is_leaf[:take].sum())
        own[0] += 1
        own[leaves] -= 1
        take = 2 * (take - leaves)
    lengths[order] = np.cumsum(own)[:-1]
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of length, then symbol; they follow from the lengths alone."""
    codes = np.zeros(len(lengths), np.uint32)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    if not len(order):
        return codes
    bits = lengths[order].astype(np.int64)
    top = int(bits[-1])
    steps = np.left_shift(np.int64(1), top - bits)
    codes[order] = (np.cumsum(steps) - steps) >> (top - bits)
    return codes


def encode_bits(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray, block: int):
    """(bit stream, bit offset of each block)."""
    bits = lengths[ids].astype(np.int64)
    ends = np.cumsum(bits)
    starts = ends - bits
    size = (int(ends[-1]) + 7) // 8 if len(ids) else 0
    word = codes[ids].astype(np.int64) << (32 - (starts & 7) - bits)
    stream = np.zeros(size + 4)
    for i in range(4):
        stream += np.bincount(
            (starts >> 3) + i, (word >> (24 - 8 * i)) & 0xFF, minlength=size + 4
        )[: size + 4]
    return stream[:size].astype(np.uint8), starts[::block].astype("<u8")


class Decoder:
    """Table-driven: the next ``top`` bits give the id and the length of its code."""

    def __init__(self, lengths: np.ndarray):
        self.top = max(1, int(lengths.max(initial=0)))
        codes = canonical_codes(lengths).astype(np.int64)
        used = np.flatnonzero(lengths)
        bits = lengths[used].astype(np.int64)
        order = np.argsort(codes[used] << (self.top - bits), kind="stable")
        used, bits = used[order], bits[order]
        spread = np.left_shift(np.int64(1), self.top - bits)
        self.symbol = np.zeros(1 << self.top, np.uint32)
        self.bits = np.ones(1 << self.top, np.int64)
        filled = int(spread.sum())
        self.symbol[:filled] = np.repeat(used, spread)
        self.bits[:filled] = np.repeat(bits, spread)

    def decode(self, stream: np.ndarray, offsets: np.ndarray, count: int, block: int) -> np.ndarray:
        """The ids of all blocks; ``offsets`` are where they begin, in bits."""
        out = np.zeros((len(offsets), block), np.uint32)
        b = np.concatenate([stream, np.zeros(4, np.uint8)]).astype(np.uint32)
        word = (b[:-3] << 24) | (b[1:-2] << 16) | (b[2:-1] << 8) | b[3:]
        at = offsets.astype(np.int64)
        shift = np.uint32(32 - self.top)
        last = len(word) - 1
        for i in range(block):
            window = (word[np.minimum(at >> 3, last)] << (at & 7).astype(np.uint32)) >> shift
            out[:, i] = self.symbol[window]
            at += self.bits[window]
        return out.reshape(-1)[:count]


def pack_segment(
    doc_ids: list[int | None], sizes: np.ndarray, ids: np.ndarray, lengths, codes, block: int
) -> bytes:
    stream, offsets = encode_bits(ids, lengths, codes, block)
    head = HEAD.pack(MAGIC, len(doc_ids), len(ids), len(offsets), block)
    known = np.array([x is not None for x in doc_ids], np.uint8)
    numbers = np.array([x or 0 for x in doc_ids], "<i8")
    parts = (offsets, known, numbers, sizes.astype("<u4"), stream)
    return head + b"".join(x.tobytes() for x in parts)


def unpack_segment(payload: bytes, decoder: Decoder):
    """(doc_ids, number of ids of each document, all ids)."""
    magic, n_docs, n_ids, n_blocks, block = HEAD.unpack_from(payload)
    if magic != MAGIC:
        raise ValueError("Not a token segment")
    at = HEAD.size

    def take(kind: str, n: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(payload, kind, n, at)
        at += out.nbytes
        return out

    offsets, known = take("<u8", n_blocks), take("u1", n_docs)
    numbers, sizes = take("<i8", n_docs), take("<u4", n_docs)
    stream = np.frombuffer(payload, np.uint8, -1, at)
    doc_ids = [n if k else None for n, k in zip(numbers.tolist(), known, strict=True)]
    return doc_ids, sizes, decoder.decode(stream, offsets, n_ids, block)


def _raw_segments(docs: DataFrame, vocabulary: str, end_id: int, segment: int) -> DataFrame:
    """Plain ids of each segment (kind 0) and each task's counts of ids (kind 1)."""
    rows = pick(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    ordered = (
        rows.withColumn("tie", F.xxhash64("text"))
        .repartitionByRange("doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
        .withColumn("part", F.spark_partition_id())
    )

    def encode(batches):
        encoder = unit_encoder(vocabulary, True)
        top = max(encoder.tokenizer.get_vocab_size(with_added_tokens=True), end_id + 1)
        counts = np.zeros(top, np.int64)
        kept: list[tuple[list, np.ndarray, np.ndarray]] = []
        number, held, part = 0, 0, 0

        def row(kind: int, docs_: list, sizes: np.ndarray, ids: np.ndarray):
            known = np.array([x is not None for x in docs_], np.uint8)
            numbers = np.array([x or 0 for x in docs_], "<i8")
            columns = (
                pa.array([part], pa.int32()),
                pa.array([number], pa.int32()),
                pa.array([kind], pa.int32()),
                pa.array([int(sizes.sum())], pa.int64()),
                *(
                    pa.array([x.tobytes()], pa.binary())
                    for x in (known, numbers, sizes.astype("<u4"), ids)
                ),
            )
            return pa.RecordBatch.from_arrays(list(columns), NAMES)

        def flush():
            return row(
                0,
                [x for k in kept for x in k[0]],
                np.concatenate([k[1] for k in kept]),
                np.concatenate([k[2] for k in kept]).astype("<u2" if top <= 1 << 16 else "<u4"),
            )

        for batch in batches:
            doc_ids, part = batch.column(0).to_pylist(), batch.column(2)[0].as_py()
            for first, end, ids, bounds in encoded_blocks(batch.column(1), encoder):
                ids = np.insert(ids, bounds[1:], end_id)
                counts += np.bincount(ids, minlength=top)
                kept.append((doc_ids[first:end], np.diff(bounds) + 1, ids))
                held += len(ids)
                if held >= segment:
                    yield flush()
                    kept, held, number = [], 0, number + 1
        if kept:
            yield flush()
            number += 1
        seen = np.flatnonzero(counts)
        if len(seen):
            yield row(1, [], counts[seen], seen.astype("<u4"))

    return ordered.select("doc_id", "text", "part").mapInArrow(encode, RAW)


NAMES = ["part", "segment", "kind", "n_ids", "known", "doc_ids", "sizes", "ids"]
RAW = "part int, segment int, kind int, n_ids long, known binary, doc_ids binary, sizes binary, ids binary"


def _count_ids(raw: DataFrame) -> dict[int, int]:
    """Corpus count of each id: as many rows as the vocabulary has ids, at most."""

    def unfold(batches):
        for batch in batches:
            for ids, sizes in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.frombuffer(ids, "<u4").astype(np.int64)),
                        pa.array(np.frombuffer(sizes, "<u4").astype(np.int64)),
                    ],
                    ["id", "n"],
                )

    rows = raw.where("kind = 1").select("ids", "sizes").mapInArrow(unfold, "id long, n long")
    return dict(rows.groupBy("id").agg(F.sum("n")).collect())


def write_token_files(
    docs: DataFrame,
    folder: str,
    vocabulary: str = "byte_bpe_50k.json",
    end_id: int = 0,
    limit: int = LIMIT,
    segment: int = SEGMENT,
    block: int = BLOCK,
) -> None:
    """Encode whole texts (null: empty), ``end_id`` after each, into a file set at ``folder``.

    Documents are in ascending doc_id order, null first; rows of one doc_id are ordered by a hash of
    their texts. An empty table gives an empty file set.
    """
    spark = docs.sparkSession
    shelf = Shelf(spark, "token_files")
    raw = shelf.put(_raw_segments(docs, vocabulary, end_id, segment), "raw")
    counted = _count_ids(raw)
    counts = np.zeros(max(counted, default=0) + 1, np.int64)
    counts[list(counted)] = list(counted.values())
    lengths = code_lengths(counts, limit)
    codes = canonical_codes(lengths)
    wide = "<u2" if library_top(vocabulary, end_id) <= 1 << 16 else "<u4"

    def code(batches):
        for batch in batches:
            for part, number, known, numbers, sizes, ids in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                known = np.frombuffer(known, np.uint8)
                numbers = np.frombuffer(numbers, "<i8").tolist()
                payload = pack_segment(
                    [n if k else None for n, k in zip(numbers, known, strict=True)],
                    np.frombuffer(sizes, "<u4"),
                    np.frombuffer(ids, wide),
                    lengths,
                    codes,
                    block,
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([payload], pa.binary())],
                    ["part", "segment", "payload"],
                )

    segments = raw.where("kind = 0").select("part", "segment", "known", "doc_ids", "sizes", "ids")
    segments.mapInArrow(code, "part int, segment int, payload binary").write.parquet(
        f"{folder}/segments"
    )
    parts = raw.where("kind = 0").groupBy("part").agg(F.sum("n_ids").alias("n"))
    parts = parts.select(
        F.col("part").alias("p"),
        (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("part_first"),
    )
    inside = Window.partitionBy("part").orderBy("segment")
    places = raw.where("kind = 0").select(
        "part", "segment", (F.sum("n_ids").over(inside) - F.col("n_ids")).alias("in_part")
    )
    places.join(parts, F.col("part") == F.col("p")).select(
        "part", "segment", (F.col("part_first") + F.col("in_part")).alias("first")
    ).write.parquet(f"{folder}/index")
    used = np.flatnonzero(lengths)
    book = list(zip(used.tolist(), lengths[used].tolist(), strict=True))
    spark.createDataFrame(book, "id long, length int").coalesce(1).write.parquet(f"{folder}/codebook")
    shelf.drop("raw")


@cache
def library_top(vocabulary: str, end_id: int) -> int:
    encoder = unit_encoder(vocabulary, True)
    return max(encoder.tokenizer.get_vocab_size(with_added_tokens=True), end_id + 1)


def read_token_files(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 and, if asked, the ids."""
    book = spark.read.parquet(f"{folder}/codebook").collect()  # as many rows as the vocabulary
    lengths = np.zeros(max((r.id for r in book), default=0) + 1, np.uint8)
    for r in book:
        lengths[r.id] = r.length
    kind = "part int, segment int, doc_id long, at long, n_tokens long, ids_crc32 long" + (
        ", ids array<int>" * with_ids
    )

    def decode(batches):
        decoder = Decoder(lengths)
        for batch in batches:
            for part, number, payload in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                doc_ids, sizes, ids = unpack_segment(payload, decoder)
                ends = np.cumsum(sizes.astype(np.int64))
                raw, edges = memoryview(ids.astype("<u4").tobytes()), (4 * ends).tolist()
                crcs = [zlib.crc32(raw[a:b]) for a, b in zip([0, *edges], edges)]
                columns = [
                    pa.array(np.full(len(doc_ids), part, np.int32)),
                    pa.array(np.full(len(doc_ids), number, np.int32)),
                    pa.array(doc_ids, pa.int64()),
                    pa.array(ends - sizes),
                    pa.array(sizes.astype(np.int64)),
                    pa.array(crcs, pa.int64()),
                ]
                names = ["part", "segment", "doc_id", "at", "n_tokens", "ids_crc32"]
                if with_ids:
                    bounds = np.concatenate([[0], ends]).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(bounds, ids.astype(np.int32)))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    segments = spark.read.parquet(f"{folder}/segments").select("part", "segment", "payload")
    index = spark.read.parquet(f"{folder}/index")
    decoded = segments.mapInArrow(decode, kind).join(index, ["part", "segment"])
    return decoded.select(
        "doc_id",
        (F.col("first") + F.col("at")).alias("start"),
        "n_tokens",
        "ids_crc32",
        *["ids"] * with_ids,
    )
