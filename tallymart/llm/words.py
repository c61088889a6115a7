"""Words of whole texts as 64-bit hashes, computed for many texts at once on their bytes.

Every separator used here is ASCII, so working on UTF-8 bytes equals working on characters. A word
is hashed 8 bytes at a time, all words of a block together. Words of up to 8 bytes and equal length have
different hashes. Longer ones pass through two states that are mixed differently at every step, so that
no arithmetic of their bytes makes two alike; very long ones are hashed by BLAKE2.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20
def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# What is kept of 8 bytes, little-endian, of which only the first 0 to 8 belong to a word.
KEPT = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)
ODD = np.uint64(0x9E3779B97F4A7C15)
LONG = 256  # bytes from which on a word is hashed on its own


def byte_class(separators: str | range | list[int], lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """(is a word's byte, byte after lower-casing A-Z) for each byte."""
    word = np.ones(256, bool)
    word[list(separators)] = False
    to = np.arange(256, dtype=np.uint8)
    if lower:
        to[ord("A") : ord("Z") + 1] += 32
    return word, to


WHITE = [0x20, *range(0x09, 0x0E)]
NOT_ALPHANUMERIC = [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]


def _bounds(is_word: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of words; none reaches over a text's bounds."""
    size = len(is_word)
    inner = offsets[(offsets > 0) & (offsets < size)]
    before = np.empty(size, bool)
    before[:1] = False
    before[1:] = is_word[:-1]
    before[inner] = False
    after = np.empty(size, bool)
    after[-1:] = False
    after[:-1] = is_word[1:]
    after[inner - 1] = False
    return np.flatnonzero(is_word & ~before), np.flatnonzero(is_word & ~after) + 1


@dataclass
class Words:
    """Words of consecutive texts: ``hashes[offsets[i]:offsets[i + 1]]`` belong to the i-th.

    ``starts`` and ``ends`` are byte places in ``raw``, the bytes of these texts, whose bounds are
    ``raw_offsets``.
    """

    hashes: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    raw: np.ndarray
    raw_offsets: np.ndarray


def _eight(words: np.ndarray, places: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on as a number, those from ``left`` on zero."""
    at, shift = places >> 3, ((places & 7) << 3).astype(np.uint64)
    out = words[at] >> shift
    high = words[at + 1] << (np.uint64(64) - np.maximum(shift, np.uint64(1)))
    out |= np.where(shift > 0, high, np.uint64(0))
    return out & KEPT[np.minimum(left, 8)]


def _padded(values: np.ndarray) -> np.ndarray:
    padded = np.zeros((len(values) + 23) & ~7, np.uint8)
    padded[: len(values)] = values
    return padded.view("<u8")


def heads(values: np.ndarray, starts: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The first 8 bytes of each span as a number; those beyond a shorter span are zero."""
    return _eight(_padded(values), starts, size)


def hash_spans(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each of the spans of bytes."""
    words, size = _padded(values), ends - starts
    seed = mix(size.astype(np.uint64) * ODD)
    first = _eight(words, starts, size)
    out = mix(seed ^ first)
    long = np.flatnonzero(size > 8)
    if not len(long):
        return out
    other = first[long] * ODD + seed[long]
    place, left, one = starts[long] + 8, size[long] - 8, out[long]
    for i in np.flatnonzero(left > LONG):
        digest = blake2b(values[place[i] : place[i] + left[i]], digest_size=16).digest()
        a, b = np.frombuffer(digest, "<u8")
        one[i], other[i], left[i] = one[i] ^ a, other[i] ^ b, 0
    going = np.flatnonzero(left > 0)
    while len(going):
        eight = _eight(words, place[going], left[going])
        one[going] = mix(one[going] ^ eight)
        turned = other[going]
        turned = ((turned << np.uint64(23)) | (turned >> np.uint64(41))) + eight
        turned *= ODD
        other[going] = turned ^ (turned >> np.uint64(29))
        place[going] += 8
        left[going] -= 8
        going = going[left[going] > 0]
    out[long] = mix(one ^ mix(other))
    return out


def _words(raw: np.ndarray, offsets: np.ndarray, kind: tuple[np.ndarray, np.ndarray]) -> Words:
    is_word, to = kind
    starts, ends = _bounds(is_word[raw], offsets)
    hashes = hash_spans(to[raw], starts, ends)
    return Words(hashes, np.searchsorted(starts, offsets), starts, ends, raw, offsets)


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts one after another, and their bounds; null is empty."""
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(
    texts: pa.Array, rows: int = 4096
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, bounds) of spans of about BLOCK_BYTES."""
    if not len(texts):
        return
    raw, offsets = raw_bytes(texts)
    row = 0
    while row < len(texts):
        end = int(np.searchsorted(offsets, offsets[row] + BLOCK_BYTES, "right")) - 1
        end = min(max(end, row + 1), row + rows, len(texts))
        yield row, end, raw[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def word_blocks(
    texts: pa.Array, kind: tuple[np.ndarray, np.ndarray], rows: int = 4096
) -> Iterator[tuple[int, int, Words]]:
    for first, end, raw, offsets in blocks(texts, rows):
        yield first, end, _words(raw, offsets, kind)


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` consecutive words, also across text bounds; fewer give none."""
    if len(hashes) < size:
        return np.empty(0, np.uint64)
    count = len(hashes) - size + 1
    out = np.zeros(count, np.uint64)
    for i in range(size):
        out = out * np.uint64(0xD6E8FEB86659FD93) + hashes[i : i + count]
    return mix(out)
