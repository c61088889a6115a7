"""Public tokenizers by file name; a worker process loads a vocabulary once and holds one at a time."""

from __future__ import annotations

import os
from collections.abc import Callable

import numpy as np
import pyarrow as pa

from tallymart.llm.words import blocks, hash_spans, heads

# Units a process remembers: a bound of memory. When it is reached, all are forgotten.
REMEMBERED = 1_000_000
FEWEST_SLOTS = 1 << 14  # of the table at first; it is doubled when half of it is taken

_held: dict[tuple, object] = {}


def hold(name: str, kind: str, make: Callable[[], object]):
    """What ``make`` gives, kept until another vocabulary is asked for: worker processes are used again by
    later stages, which need the memory."""
    if any(key[0] != name for key in _held):
        release()
    if (name, kind) not in _held:
        made = make()
        _held[name, kind] = made
    return _held[name, kind]


def release() -> None:
    """Forget the vocabulary that this process holds."""
    _held.clear()


def place(name: str) -> str:
    """``name`` is a file of the public vocabularies or a path."""
    if os.path.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def library_tokenizer(name: str):
    def make():
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(place(name))
        tokenizer.no_truncation()
        tokenizer.no_padding()
        return tokenizer

    return hold(name, "library", make)


def sentence_tokenizer(name: str):
    def make():
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_file=place(name))

    return hold(name, "sentences", make)


def _flags(*numbers: int | range) -> np.ndarray:
    out = np.zeros(256, bool)
    for x in numbers:
        out[list(x) if isinstance(x, range) else x] = True
    return out


# White space, or the first byte of a character that may be white space.
MAYBE_WHITE = _flags(range(0x09, 0x0E), range(0x1C, 0x21), 0xC2, 0xE1, 0xE2, 0xE3)
LETTER = _flags(range(0x41, 0x5B), range(0x61, 0x7B))
# Second bytes, after 0xC3, of the two Latin-1 signs among the letters there.
NOT_LATIN = _flags(0x97, 0xB7)
MARK = _flags(ord(","), ord("."))


def unit_starts(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Places where texts can be cut without changing a token.

    Before a blank that a non-blank follows: a run of blanks leaves its last one to the next word,
    so a pre-token (or, where blanks are dropped, a gap) begins here. Before a comma or full stop
    that follows a letter: letters and marks are never in one pre-token. Special strings hold
    neither, and no such place is inside a composed character.
    """
    size = len(raw)
    cut = np.zeros(size, bool)
    if size > 1:
        cut[:-1] = (raw[:-1] == 0x20) & ~MAYBE_WHITE[raw[1:]]
        letter = LETTER[raw[:-1]]
        letter[1:] |= (raw[:-2] == 0xC3) & ~NOT_LATIN[raw[1:-1]] & (raw[1:-1] >= 0x80)
        cut[1:] |= MARK[raw[1:]] & letter
    cut[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    ends = offsets[1:][offsets[1:] > 0]
    odd = ends[raw[ends - 1] == 0x20] - 1  # a blank at a text's end follows the unit before it
    cut[odd] = np.isin(odd, offsets)
    return np.flatnonzero(cut)


class UnitEncoder:
    """Ids of whole texts, with the library encoding each distinct unit once.

    The ids of a text are the ids of its units (see ``unit_starts``) in order. Units are looked up
    by 64-bit hash in an open-addressing table of numpy arrays, and compared byte by byte with what is
    there; units whose hash belongs to another are encoded each time.

    Words of letters alone are encoded many at a time: each is one pre-token, so its ids begin with
    the one id that holds the blank (``blank_first``) or end with the one that ends a word. A batch
    where these do not number as the words do is encoded word by word.
    """

    def __init__(self, name: str, blank_first: bool):
        self.tokenizer, self.blank_first = library_tokenizer(name), blank_first
        vocabulary = self.tokenizer.get_vocab()
        self.mark = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, number in vocabulary.items():
            self.mark[number] = token[0] == "Ġ" if blank_first else token.endswith("</w>")
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(FEWEST_SLOTS, np.uint64)
        self.entry = np.zeros(FEWEST_SLOTS, np.int32)
        self.known = 0  # entries that have a key
        # Entry i has ids pool[first[i]:first[i + 1]] and bytes text[begin[i]:begin[i + 1]].
        self.count = 0
        self.first, self.begin = np.zeros(FEWEST_SLOTS, np.int64), np.zeros(FEWEST_SLOTS, np.int64)
        self.head = np.zeros(FEWEST_SLOTS, np.uint64)  # the first 8 of its bytes
        self.pool, self.text = np.zeros(1 << 16, np.uint32), np.zeros(1 << 16, np.uint8)

    def _library(self, texts: list[str]) -> list[np.ndarray]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, np.uint32) for e in encoded]

    def _encode_units(self, units: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray | None] = [None] * len(units)
        words = [i for i, x in enumerate(units) if x[0] == " " and x[1:].isalpha()]
        groups = [words[i : i + 64] for i in range(0, len(words), 64)]
        lines = ["".join([units[i] for i in group]) for group in groups]
        for group, ids in zip(groups, self._library(lines), strict=True):
            marks = np.flatnonzero(self.mark[ids])
            if len(marks) == len(group):
                cuts = marks[1:] if self.blank_first else marks[:-1] + 1
                for i, part in zip(group, np.split(ids, cuts), strict=True):
                    out[i] = part
        rest = [i for i, x in enumerate(out) if x is None]
        for i, ids in zip(rest, self._library([units[i] for i in rest]), strict=True):
            out[i] = ids
        return out

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """Entry of each hash, -1 for unknown ones."""
        out = np.full(len(hashes), -1, np.int64)
        last = len(self.keys) - 1
        slots = (hashes & np.uint64(last)).astype(np.int64)
        open_ = np.arange(len(hashes))
        while len(open_):
            keys = self.keys[slots]
            hit = keys == hashes[open_]
            out[open_[hit]] = self.entry[slots[hit]]
            go = ~hit & (keys != 0)
            open_, slots = open_[go], (slots[go] + 1) & last
        return out

    def _append(self, ids: list[np.ndarray], units: list[bytes]) -> np.ndarray:
        """New entries."""
        base, new = self.count, len(ids)

        def extend(bounds: np.ndarray, held: np.ndarray, sizes: list[int], values: np.ndarray):
            if base + new + 1 > len(bounds):
                bounds = np.concatenate([bounds, np.zeros(max(new + 1, len(bounds)), np.int64)])
            bounds[base + 1 : base + new + 1] = bounds[base] + np.cumsum(sizes)
            top = int(bounds[base + new])
            if top > len(held):
                held = np.concatenate([held, np.zeros(max(top - len(held), len(held)), held.dtype)])
            held[bounds[base] : top] = values
            return bounds, held

        self.first, self.pool = extend(self.first, self.pool, [len(x) for x in ids], np.concatenate(ids))
        joined = np.frombuffer(b"".join(units), np.uint8)
        sizes = np.array([len(x) for x in units])
        self.begin, self.text = extend(self.begin, self.text, sizes, joined)
        if base + new > len(self.head):
            self.head = np.concatenate([self.head, np.zeros(max(new, len(self.head)), np.uint64)])
        self.head[base : base + new] = heads(joined, np.cumsum(sizes) - sizes, sizes)
        self.count += new
        return np.arange(base, base + new)

    def _put(self, hashes: np.ndarray, entries: np.ndarray) -> None:
        """Give entries their keys: distinct and unknown ones."""
        self.known += len(hashes)
        if 2 * self.known > len(self.keys):
            taken = self.keys != 0
            hashes = np.concatenate([self.keys[taken], hashes])
            entries = np.concatenate([self.entry[taken], entries])
            slots = 1 << int(4 * self.known - 1).bit_length()
            self.keys, self.entry = np.zeros(slots, np.uint64), np.zeros(slots, np.int32)
        last = len(self.keys) - 1
        slots = (hashes & np.uint64(last)).astype(np.int64)
        while len(slots):
            free = self.keys[slots] == 0
            self.keys[slots[free]] = hashes[free]
            mine = self.keys[slots] == hashes
            self.entry[slots[mine]] = entries[mine]
            hashes, entries, slots = hashes[~mine], entries[~mine], (slots[~mine] + 1) & last

    def _others(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, found: np.ndarray) -> np.ndarray:
        """The units that are not those of the entries found for them."""
        size, begin = ends - starts, self.begin[found]
        same = (size == self.begin[found + 1] - begin) & (heads(raw, starts, size) == self.head[found])
        rows = np.flatnonzero(same & (size > 8))
        for first in range(0, len(rows), 1 << 16):
            some = rows[first : first + (1 << 16)]
            length = size[some] - 8
            upto = np.cumsum(length)
            within = np.arange(upto[-1]) - np.repeat(upto - length, length) + 8
            mine = raw[np.repeat(starts[some], length) + within]
            differs = mine != self.text[np.repeat(begin[some], length) + within]
            if differs.any():
                same[np.repeat(some, length)[differs]] = False
        return np.flatnonzero(~same)

    def _entries(self, raw: np.ndarray, starts: np.ndarray) -> np.ndarray:
        if self.count > REMEMBERED:
            self._forget()
        ends = np.append(starts[1:], len(raw))
        hashes = hash_spans(raw, starts, ends) | np.uint64(1)  # 0 marks a free slot
        found = self._find(hashes)
        view = raw.tobytes()

        def encoded(where: np.ndarray) -> tuple[list[np.ndarray], list[bytes]]:
            units = [view[a:b] for a, b in zip(starts[where].tolist(), ends[where].tolist(), strict=True)]
            return self._encode_units([unit.decode() for unit in units]), units

        unknown = np.flatnonzero(found < 0)
        if len(unknown):
            distinct, where = np.unique(hashes[unknown], return_index=True)
            for i in range(0, len(distinct), 1 << 15):
                part = slice(i, i + (1 << 15))
                self._put(distinct[part], self._append(*encoded(unknown[where[part]])))
            found[unknown] = self._find(hashes[unknown])
        others = self._others(raw, starts, ends, found)
        if len(others):
            found[others] = self._append(*encoded(others))
        return found

    def encode_block(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, their bounds)."""
        starts = unit_starts(raw, offsets)
        if not len(starts):
            return np.empty(0, np.uint32), np.zeros(len(offsets), np.int64)
        parts, ends = [], [np.zeros(1, np.int64)]
        for first in range(0, len(starts), 1 << 18):  # a huge text goes span by span
            some = starts[first : first + (1 << 18)]
            base = some[0]
            stop = starts[first + (1 << 18)] if first + (1 << 18) < len(starts) else len(raw)
            found = self._entries(raw[base:stop], some - base)
            begin, size = self.first[found], self.first[found + 1] - self.first[found]
            upto = np.cumsum(size)
            pick = np.repeat(begin - (upto - size), size) + np.arange(upto[-1])
            parts.append(self.pool[pick])
            ends.append(ends[-1][-1] + upto)
        total = np.concatenate(ends)
        return np.concatenate(parts), total[np.searchsorted(starts, offsets)]


def unit_encoder(name: str, blank_first: bool) -> UnitEncoder:
    return hold(name, "units", lambda: UnitEncoder(name, blank_first))


def encoded_blocks(texts: pa.Array, encoder: UnitEncoder):
    """(first row, row after the last, ids, bounds of each text's ids); null is empty."""
    for first, end, raw, offsets in blocks(texts):
        yield first, end, *encoder.encode_block(raw, offsets)
