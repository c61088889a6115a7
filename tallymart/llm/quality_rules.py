"""Quality rules by tokeniser fertility.

A public vocabulary with byte fallback measures each whole text: characters per token, the share
of tokens that are single fallback bytes, and the entropy of the text's own tokens in bits. Broken
encodings and noise cost many tokens, machine repetition and filling have low entropy for their length,
and text in a script that the vocabulary lacks falls back to bytes. Each script has its own band, as
have texts without letters; a text outside is rejected.

Beside the bands stand exact counts of words, symbols, repeated lines and repeated windows, and two
base rules on them.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.llm.frames import pick
from tallymart.llm.token_counts import CHUNK, id_parts
from tallymart.llm.vocab import hold, sentence_tokenizer
from tallymart.llm.words import WHITE, Words, byte_class, hash_spans, mix, word_blocks

WORDS = byte_class(WHITE, lower=False)
SYMBOLS = np.isin(np.arange(256), list(b"#*$%&|<>"))
WINDOW = 8
VERDICT = (
    "struct<n_words: long, word_chars: long, n_symbols: long, n_dup_lines: long, "
    "n_repeat_words: long, base_failed: boolean, script: string, n_tokens: long, "
    "chars_per_token: double, byte_share: double, token_entropy: double, kept: boolean>"
)


@dataclass(frozen=True)
class Band:
    """What a text of one script may measure.

    ``entropy`` are points (tokens, least entropy), joined by lines over the logarithm of the tokens;
    texts of fewer tokens than the first point are not held against it.
    """

    chars_low: float
    chars_high: float
    byte_share: float
    entropy: tuple[tuple[int, float], ...] = ((64, 4.0),)
    entropy_high: float = np.inf

    def holds(self, tokens: int, per_token: float, byte_share: float, entropy: float) -> bool:
        if not (self.chars_low <= per_token <= self.chars_high and byte_share <= self.byte_share):
            return False
        if tokens < self.entropy[0][0]:
            return True
        counts, floors = zip(*self.entropy, strict=True)
        return float(np.interp(np.log2(tokens), np.log2(counts), floors)) <= entropy <= self.entropy_high


# Code points of scripts. Other letters are "other"; a text of which less than a third is letters is
# "none"; Latin text with many letters beyond ASCII is "latin_marked".
SCRIPTS = {
    "latin": [(0x41, 0x5A), (0x61, 0x7A), (0xC0, 0x36F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF)],
    "cyrillic": [(0x400, 0x52F)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cjk": [(0x3400, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)],
    "kana": [(0x3040, 0x30FF)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F)],
    "hebrew": [(0x590, 0x5FF)],
    "devanagari": [(0x900, 0x97F)],
    "indic": [(0x980, 0xDFF)],
    "thai": [(0xE00, 0xE7F)],
    "lao": [(0xE80, 0xEFF)],
    "georgian": [(0x10A0, 0x10FF), (0x1C90, 0x1CBF)],
    "armenian": [(0x530, 0x58F)],
    "ethiopic": [(0x1200, 0x139F)],
}
MARKED = 0.2  # share of a Latin text's letters beyond ASCII
# Latin: measured on check_s, where they lie just outside what texts labelled good measure. The
# others: between natural sentences and noise of the script (README).
BANDS = {
    "latin": Band(
        1.85, 5.5, 0.1,
        ((32, 4.4), (64, 4.75), (128, 5.25), (256, 5.75), (512, 6.1), (1024, 6.25), (2048, 6.4), (8192, 6.55)),
    ),
    "latin_marked": Band(1.15, 5.0, 0.25),
    "cyrillic": Band(1.4, 4.5, 0.1),
    "greek": Band(0.8, 2.0, 0.1, ((64, 3.5),), 5.5),
    "cjk": Band(0.45, 2.0, 0.75),
    "kana": Band(0.6, 2.0, 0.42),
    "hangul": Band(0.55, 2.0, 0.6),
    "arabic": Band(0.8, 2.0, 0.12, ((64, 3.5),)),
    "hebrew": Band(0.8, 2.0, 0.1, ((64, 3.5),), 4.6),
    "devanagari": Band(0.65, 2.0, 0.4, ((64, 3.5),)),
    "indic": Band(0.45, 2.0, 0.8, ((64, 3.2),)),
    "thai": Band(0.8, 2.0, 0.2, ((64, 3.5),)),
    "lao": Band(0.33, 2.0, 0.95, ((64, 3.0),)),
    "georgian": Band(0.85, 2.0, 0.15, ((64, 3.5),)),
    "armenian": Band(0.8, 2.0, 0.35, ((64, 3.5),)),
    "ethiopic": Band(0.4, 2.0, 0.9, ((64, 3.5),)),
    "other": Band(0.4, 4.0, 0.9, ((64, 3.0),), 5.3),
    "none": Band(2.0, 4.0, 0.05),
}


def _byte_tokens(vocabulary: str) -> np.ndarray:
    """Fallback bytes but white space, which this vocabulary writes as bytes in any text."""

    def make() -> np.ndarray:
        tokenizer = sentence_tokenizer(vocabulary)
        out = np.zeros(tokenizer.get_piece_size(), bool)
        for i in range(len(out)):
            if tokenizer.is_byte(i) and int(tokenizer.id_to_piece(i)[1:-1], 16) not in (9, 10, 13):
                out[i] = True
        return out

    return hold(vocabulary, "bytes", make)


NAMES = [*SCRIPTS, "other"]
PART = 1 << 20  # code points looked at together
BLANK = 255


@cache
def _letters() -> np.ndarray:
    """Of each code point: 1 + place in NAMES of a letter or mark, BLANK for white space, else 0."""
    kinds = [unicodedata.category(chr(i)) for i in range(0x110000)]
    letter = np.array([kind[0] in "LM" for kind in kinds])
    out = np.where(letter, len(NAMES), 0).astype(np.uint8)
    for place, ranges in enumerate(SCRIPTS.values()):
        for a, b in ranges:
            out[a : b + 1][letter[a : b + 1]] = place + 1
    out[[kind[0] == "Z" for kind in kinds]] = BLANK
    out[[9, 10, 11, 12, 13]] = BLANK
    return out


def script_of(text: str) -> str:
    """The script with most letters (ties: the first listed), or "none"."""
    counts, marked = np.zeros(BLANK + 1, np.int64), 0
    for at in range(0, len(text), PART):
        points = np.frombuffer(text[at : at + PART].encode("utf-32-le"), "<u4")
        scripts = _letters()[points]
        counts += np.bincount(scripts, minlength=BLANK + 1)
        marked += int(((scripts == 1) & (points >= 0x80)).sum())
    own = counts[1 : len(NAMES) + 1]
    if not own.any() or 3 * own.sum() < len(text) - counts[BLANK]:
        return "none"
    best = NAMES[int(own.argmax())]
    return "latin_marked" if best == "latin" and marked >= MARKED * own[0] else best


def fertility(text: str, vocabulary: str) -> tuple[int, float, float, float]:
    """(tokens, characters per token, share of fallback bytes, entropy); zeros without tokens."""
    if len(text) <= CHUNK:
        ids = np.array(sentence_tokenizer(vocabulary).encode(text, num_threads=1), np.int64)
        found, counts = np.unique(ids, return_counts=True)
    else:
        every = np.zeros(sentence_tokenizer(vocabulary).get_piece_size(), np.int64)
        for part in id_parts(text, vocabulary):
            every += np.bincount(np.array(part, np.int64), minlength=len(every))
        found = np.flatnonzero(every)
        counts = every[found]
    total = int(counts.sum())
    if not total:
        return 0, 0.0, 0.0, 0.0
    share = counts / total
    entropy = float(-(share * np.log2(share)).sum())
    fallback = int(counts[_byte_tokens(vocabulary)[found]].sum())
    return total, len(text) / total, fallback / total, entropy


def _per_text(places: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many of the ascending places each text holds."""
    return np.diff(np.searchsorted(places, offsets))


def repeated_lines(words: Words) -> np.ndarray:
    """Lines with a word that equal an earlier line of their text, per text."""
    raw, offsets = words.raw, words.raw_offsets
    if not len(raw):
        return np.zeros(len(offsets) - 1, np.int64)
    breaks = np.flatnonzero(raw == 10)
    edges = np.unique(np.concatenate([breaks + 1, offsets[:-1]]))
    starts = edges[edges < len(raw)]
    ends = np.append(starts[1:], len(raw))
    ends = ends - ((raw[ends - 1] == 10) & (ends > starts))
    text = np.searchsorted(offsets, starts, "right") - 1
    first = np.searchsorted(words.starts, starts)
    wordy = (first < len(words.starts)) & (np.append(words.starts, len(raw))[first] < ends)
    starts, ends, text = starts[wordy], ends[wordy], text[wordy]
    keys = hash_spans(raw, starts, ends) ^ mix(text.astype(np.uint64) + np.uint64(1))
    count = len(offsets) - 1
    distinct = np.unique(keys, return_index=True)[1]
    return np.bincount(text, minlength=count) - np.bincount(text[distinct], minlength=count)


def repeated_words(words: Words) -> np.ndarray:
    """Words inside 8-word windows found twice or more in their text, per text."""
    count, total = len(words.offsets) - 1, len(words.hashes)
    if total < WINDOW:
        return np.zeros(count, np.int64)
    text = np.repeat(np.arange(count), np.diff(words.offsets))
    starts = np.flatnonzero(text[: total - WINDOW + 1] == text[WINDOW - 1 :])
    keys = np.zeros(len(starts), np.uint64)
    for i in range(WINDOW):
        keys = keys * np.uint64(0xD6E8FEB86659FD93) + words.hashes[starts + i]
    keys = mix(keys) ^ mix(text[starts].astype(np.uint64) + np.uint64(1))
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(starts), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = np.zeros(total + 1, np.int64)
    cover[starts[twice]] += 1
    cover[starts[twice] + WINDOW] -= 1  # starts are distinct, and so are these
    return _per_text(np.flatnonzero(np.cumsum(cover[:-1])), words.offsets)


def verdicts(texts: pa.Array, vocabulary: str, bands: dict[str, Band]) -> pa.Array:
    """A VERDICT for each text."""
    rows = []
    for first, end, words in word_blocks(texts, WORDS):
        raw, offsets = words.raw, words.raw_offsets
        characters = np.flatnonzero(((raw & 0xC0) != 0x80) & WORDS[0][raw])
        columns = (
            np.diff(words.offsets),
            _per_text(characters, offsets),
            _per_text(np.flatnonzero(SYMBOLS[raw]), offsets),
            repeated_lines(words),
            repeated_words(words),
        )
        counts = zip(*(x.tolist() for x in columns), strict=True)
        for text, (n, chars, symbols, lines, repeats) in zip(
            texts[first:end].to_pylist(), counts, strict=True
        ):
            text = text or ""
            failed = n < 20 or 100 * repeats > 30 * n
            script = script_of(text)
            tokens, per_token, byte_share, entropy = fertility(text, vocabulary)
            band = bands.get(script, bands["other"])
            inside = band.holds(tokens, per_token, byte_share, entropy)
            rows.append(
                {
                    "n_words": n,
                    "word_chars": chars,
                    "n_symbols": symbols,
                    "n_dup_lines": lines,
                    "n_repeat_words": repeats,
                    "base_failed": failed,
                    "script": script,
                    "n_tokens": tokens,
                    "chars_per_token": per_token,
                    "byte_share": byte_share,
                    "token_entropy": entropy,
                    "kept": not failed and inside,
                }
            )
    return pa.array(rows, VERDICT_TYPE)


VERDICT_TYPE = pa.struct(
    [
        *((x, pa.int64()) for x in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
        ("base_failed", pa.bool_()),
        ("script", pa.string()),
        ("n_tokens", pa.int64()),
        *((x, pa.float64()) for x in ("chars_per_token", "byte_share", "token_entropy")),
        ("kept", pa.bool_()),
    ]
)


def verdict(
    text: Column | str, vocabulary: str = "piece_bpe_32k.model", bands: dict[str, Band] = BANDS
) -> Column:
    """The verdict on a column of texts, a struct."""

    @F.arrow_udf(VERDICT)
    def judge(texts: pa.Array) -> pa.Array:
        return verdicts(texts, vocabulary, bands)

    return judge.asNondeterministic()(text)


def quality_rules(
    docs: DataFrame, vocabulary: str = "piece_bpe_32k.model", bands: dict[str, Band] = BANDS
) -> DataFrame:
    """doc_id and the verdict's columns for each row.

    Null and empty texts have no words and fail the base rule; every row is judged on its own, so
    repeated rows and null ids need no care. An empty table gives no rows.
    """
    judged = pick(docs, "doc_id", "text").select("doc_id", verdict("text", vocabulary, bands).alias("v"))
    return judged.select("doc_id", "v.*")
