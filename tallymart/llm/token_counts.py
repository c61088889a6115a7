"""Token counts of whole texts by overlap resynchronisation.

A text of up to ``chunk`` characters is encoded at once. A longer one is encoded in overlapping
chunks of ``chunk`` bytes. Neighbours are spliced at a place inside the overlap where both put the
start of a token and where no merge can reach over: between two characters that no piece of the
vocabulary holds side by side. So texts without blanks are spliced as well, in scripts of many
letters nearly anywhere. Up to there the left chunk and from there on the right chunk have the tokens of
the whole text. Where an overlap holds no such place it is doubled, up to the rest of the text.

Results: null and empty texts have 0 tokens; repeated rows each have their own result.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.llm.frames import pick
from tallymart.llm.vocab import hold, sentence_tokenizer

CHUNK = 65_536
OVERLAP = 512
BLANK = "▁"  # how the vocabulary writes a blank


def neighbours(vocabulary: str) -> set[str]:
    """All pairs of characters that some piece holds side by side."""

    def make() -> set[str]:
        tokenizer = sentence_tokenizer(vocabulary)
        pieces = [tokenizer.id_to_piece(i) for i in range(tokenizer.get_piece_size()) if not tokenizer.is_byte(i)]
        return {piece[i : i + 2] for piece in pieces for i in range(len(piece) - 1)}

    return hold(vocabulary, "neighbours", make)


def _tokens(raw: bytes, vocabulary: str) -> tuple[list[int], list[int]]:
    """(byte of the text at which each token begins, its id); the blank put before the text is at 0."""
    pieces = sentence_tokenizer(vocabulary).encode(raw.decode(), return_type="proto").pieces
    return [piece.begin for piece in pieces], [piece.id for piece in pieces]


def _stable(raw: bytes, place: int, together: set[str]) -> bool:
    """Whether no merge reaches over the place, where a character begins."""
    after = raw[place : place + 4].decode(errors="ignore")[:1]
    before = raw[max(place - 4, 0) : place].decode(errors="ignore")[-1:]
    return (before + after).replace(" ", BLANK) not in together


def _character(raw: bytes, place: int) -> int:
    """The last place up to ``place`` where a character begins."""
    while place < len(raw) and raw[place] & 0xC0 == 0x80:
        place -= 1
    return min(place, len(raw))


def id_parts(
    text: str, vocabulary: str, chunk: int = CHUNK, overlap: int = OVERLAP
) -> Iterator[list[int]]:
    """The ids of one text, encoded chunk by chunk (``chunk`` and ``overlap`` in bytes)."""
    if len(text) <= chunk:
        yield sentence_tokenizer(vocabulary).encode(text, num_threads=1)
        return
    together = neighbours(vocabulary)
    raw = text.encode()
    start, left_start = 0, 0  # tokens before ``start`` are given
    while True:
        reach, wide = left_start + chunk, overlap
        while True:
            end = _character(raw, reach + wide)
            places, ids = _tokens(raw[left_start:end], vocabulary)
            ours = bisect_left(places, start - left_start)  # before a splice, the chunk's head is not ours
            if end == len(raw):
                yield ids[ours:]
                return
            right_start = _character(raw, max(reach - overlap, start))
            right = {right_start + x for x in _tokens(raw[right_start:end], vocabulary)[0]}
            late = bisect_right(places, right_start - left_start, ours)
            common = (
                at
                for at in range(late, len(places))
                if left_start + places[at] in right and _stable(raw, left_start + places[at], together)
            )
            splice = next(common, None)
            if splice is not None:
                break
            wide *= 2
        yield ids[ours:splice]
        start, left_start = left_start + places[splice], right_start


def count_tokens(text: str, vocabulary: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    return sum(map(len, id_parts(text, vocabulary, chunk, overlap)))


def token_counts(
    docs: DataFrame,
    vocabulary: str = "piece_bpe_32k.model",
    limit: int = 4096,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) of each row; an empty table
    gives no rows."""

    @F.arrow_udf("long")
    def tokens(texts: pa.Array) -> pa.Array:
        return pa.array(
            [count_tokens(text or "", vocabulary, chunk, overlap) for text in texts.to_pylist()],
            pa.int64(),
        )

    text = F.coalesce("text", F.lit(""))
    counted = pick(docs, "doc_id", "text").select(
        "doc_id",
        F.octet_length(text).cast("long").alias("n_bytes"),
        tokens.asNondeterministic()(text).alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
