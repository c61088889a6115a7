"""Language identification by a bidirectional gated recurrent network over bytes.

A text's bytes are read in segments of ``SEGMENT`` positions, forwards and backwards, by two gated
recurrent layers. Both states at a position give it a probability for each language, and a text's
probabilities are the mean over all its positions. Numpy does both the reading and the training
(back-propagation through time, Adam), the latter on a bounded sample of ``rows_per_language`` texts a
language. Learning draws from all segments of these texts, and judging reads whole texts.

Gates are (1 + tanh(a)) / 2, which is the logistic curve of 2a.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.llm.frames import pick
from tallymart.llm.labelled import remainder, sample
from tallymart.llm.words import blocks

HIDDEN = 8
SEGMENT = 128
ROWS = 300
BATCH = 1024
UNKNOWN = "und"


@dataclass
class Network:
    """Index 0 reads forwards, 1 backwards; ``inputs`` holds what each byte adds to the gates."""

    languages: list[str]
    inputs: np.ndarray  # (2, 256, 3 * hidden): update gate, reset gate, candidate
    recurrent: np.ndarray  # (2, hidden, 3 * hidden)
    outputs: np.ndarray  # (2, hidden, languages)
    bias: np.ndarray

    def parts(self) -> list[np.ndarray]:
        return [self.inputs, self.recurrent, self.outputs, self.bias]


def new_network(languages: list[str], hidden: int = HIDDEN) -> Network:
    rng = np.random.default_rng(0)

    def normal(*shape: int, scale: float) -> np.ndarray:
        return rng.normal(0, scale, shape).astype(np.float32)

    return Network(
        languages,
        normal(2, 256, 3 * hidden, scale=0.5),
        normal(2, hidden, 3 * hidden, scale=0.5 / np.sqrt(hidden)),
        normal(2, hidden, len(languages), scale=0.3),
        np.zeros(len(languages), np.float32),
    )


def read(net: Network, x: np.ndarray, mask: np.ndarray | None, keep: list | None = None) -> np.ndarray:
    """States (2, steps, batch, hidden); those of the backward layer are in its own order.

    ``x`` is (batch, steps); ``mask`` is 0 at positions behind a segment's end. ``keep`` collects what
    training needs of each step.
    """
    batch, steps = x.shape
    hidden = net.recurrent.shape[1]
    two = 2 * hidden
    forward = np.ascontiguousarray(x.T)
    h = np.zeros((2, batch, hidden), np.float32)
    states = np.empty((2, steps, batch, hidden), np.float32)
    a = np.empty((2, batch, 3 * hidden), np.float32)
    for t in range(steps):
        np.take(net.inputs[0], forward[t], axis=0, out=a[0], mode="clip")
        np.take(net.inputs[1], forward[steps - 1 - t], axis=0, out=a[1], mode="clip")
        g = np.matmul(h, net.recurrent)
        gates = np.tanh(a[..., :two] + g[..., :two])
        gates += 1
        gates *= 0.5
        z, r = gates[..., :hidden], gates[..., hidden:]
        n = np.tanh(a[..., two:] + r * g[..., two:])
        if keep is not None:
            keep.append((h, z, r, n, g[..., two:]))
        h = n + z * (h - n)
        if mask is not None:
            h[0] *= mask[:, t, None]
            h[1] *= mask[:, steps - 1 - t, None]
        states[:, t] = h
    return states


def position_probabilities(net: Network, states: np.ndarray) -> np.ndarray:
    """(steps, batch, languages)."""
    logits = states[0] @ net.outputs[0] + states[1][::-1] @ net.outputs[1] + net.bias
    logits -= logits.max(-1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(-1, keepdims=True)
    return logits


def gradients(net: Network, x: np.ndarray, mask: np.ndarray, label: np.ndarray) -> list[np.ndarray]:
    """Of the mean cross-entropy over all positions, by back-propagation through time."""
    steps = x.shape[1]
    kept: list = []
    states = read(net, x, mask, kept)
    slope = position_probabilities(net, states)
    slope[:, np.arange(len(label)), label] -= 1
    slope *= (mask.T / mask.sum())[..., None]
    d_outputs = np.stack(
        [
            np.einsum("tbh,tbc->hc", states[0], slope),
            np.einsum("tbh,tbc->hc", states[1][::-1], slope),
        ]
    )
    from_out = np.stack([slope @ net.outputs[0].T, (slope @ net.outputs[1].T)[::-1]])
    d_recurrent = np.zeros_like(net.recurrent)
    d_inputs = np.zeros_like(net.inputs)
    carry = np.zeros_like(states[:, 0])
    d_a = np.empty((2, steps, len(label), net.inputs.shape[-1]), np.float32)
    for t in range(steps - 1, -1, -1):
        before, z, r, n, g = kept[t]
        dh = from_out[:, t] + carry
        dh[0] *= mask[:, t, None]
        dh[1] *= mask[:, steps - 1 - t, None]
        d_cand = dh * (1 - z) * (1 - n * n)
        # A gate y = (1 + tanh a) / 2 has slope 2 y (1 - y).
        d_z = dh * (before - n) * 2 * z * (1 - z)
        d_r = d_cand * g * 2 * r * (1 - r)
        d_g = np.concatenate([d_z, d_r, d_cand * r], -1)
        d_recurrent += np.matmul(before.transpose(0, 2, 1), d_g)
        carry = dh * z + np.matmul(d_g, net.recurrent.transpose(0, 2, 1))
        d_a[:, t] = np.concatenate([d_z, d_r, d_cand], -1)
    for way, bytes_ in enumerate((x.T, x.T[::-1])):
        order = np.argsort(bytes_.reshape(-1), kind="stable")
        seen, first = np.unique(bytes_.reshape(-1)[order], return_index=True)
        flat = d_a[way].reshape(-1, d_a.shape[-1])[order]
        d_inputs[way][seen] = np.add.reduceat(flat, first, axis=0)
    return [d_inputs, d_recurrent, d_outputs, slope.sum((0, 1))]


def segments(
    raw: np.ndarray, offsets: np.ndarray, size: int = SEGMENT
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, text) of every segment of every text."""
    length = np.diff(offsets)
    count = -(-length // size)
    text = np.repeat(np.arange(len(length)), count)
    number = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    start = offsets[text] + number * size
    return start, np.minimum(size, offsets[text + 1] - start), text


def _cut(raw: np.ndarray, start: np.ndarray, length: np.ndarray, size: int):
    """Bytes (segments, size) and mask, which is None if all are full."""
    place = start[:, None] + np.arange(size)
    x = raw[np.minimum(place, len(raw) - 1)]
    if length.min() == size:
        return x, None
    return x, (np.arange(size) < length[:, None]).astype(np.float32)


def train(
    rows: list[tuple[str, str]], hidden: int = HIDDEN, epochs: int = 2, step: float = 0.02
) -> Network:
    """Languages are the labels met, sorted; a single one needs no training.

    Segments are drawn from all of all texts, ``epochs`` times as many as there are, and cut out of the
    texts' bytes batch by batch, so little more is held than the texts.
    """
    languages = sorted({label for _, label in rows})
    net = new_network(languages, hidden)
    if len(languages) < 2:
        return net
    rng = np.random.default_rng(1)
    texts = [text.encode() for text, _ in rows]
    raw = np.frombuffer(b"".join(texts), np.uint8)
    if not len(raw):
        return net
    start, length, text = segments(raw, np.cumsum([0, *map(len, texts)]))
    label = np.array([languages.index(label) for _, label in rows])[text]
    # Languages weigh alike: the rarer ones' segments are drawn again.
    size = np.bincount(label, minlength=len(languages))
    odds = (1 / np.maximum(size, 1))[label]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in net.parts()]
    batch = min(128, len(start))
    turns = max(30, epochs * len(start) // batch)
    odds /= odds.sum()
    for turn in range(1, turns + 1):
        some = rng.choice(len(start), batch, p=odds)
        x, mask = _cut(raw, start[some], length[some], SEGMENT)
        if mask is None:
            mask = np.ones(x.shape, np.float32)
        rate = step * min(1.0, 2 * (1 - turn / (turns + 1)))
        for part, slope, (mean, square) in zip(
            net.parts(), gradients(net, x, mask, label[some]), moments, strict=True
        ):
            slope = np.clip(slope, -1, 1)
            mean += 0.1 * (slope - mean)
            square += 0.01 * (slope * slope - square)
            fixed = mean / (1 - 0.9**turn)
            part -= rate * fixed / (np.sqrt(square / (1 - 0.99**turn)) + 1e-6)
    return net


def text_probabilities(net: Network, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(texts, languages): the mean over all positions; zeros for empty texts."""
    count = len(offsets) - 1
    out = np.zeros((count, len(net.languages)))
    if not net.languages:
        return out
    start, length, text = segments(raw, offsets)
    order = np.argsort(-length, kind="stable")  # full segments need no mask
    for at in range(0, len(order), BATCH):
        some = order[at : at + BATCH]
        widest = int(length[some].max())
        x, mask = _cut(raw, start[some], length[some], widest)
        p = position_probabilities(net, read(net, x, mask))
        if mask is not None:
            p *= mask.T[..., None]
        total = p.sum(0)
        for k in range(out.shape[1]):
            out[:, k] += np.bincount(text[some], total[:, k], count)
    return out / np.maximum(np.diff(offsets), 1)[:, None]


RESULT = "struct<lang_pred: string, score: double>"


def predict(net: Network, text: Column | str) -> Column:
    """lang_pred and score of each whole text, a struct; "und" and 0 where it has no letter."""

    @F.arrow_udf(RESULT)
    def predicted(texts: pa.Array) -> pa.Array:
        names, scores = [], []
        for first, end, raw, offsets in blocks(texts):
            p = text_probabilities(net, raw, offsets)
            best = p.argmax(1) if p.shape[1] else np.zeros(end - first, np.int64)
            for i, value in enumerate(texts[first:end].to_pylist()):
                known = bool(net.languages) and value is not None and any(map(str.isalpha, value))
                names.append(net.languages[best[i]] if known else UNKNOWN)
                scores.append(min(1.0, float(p[i, best[i]])) if known else 0.0)
        return pa.StructArray.from_arrays(
            [pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"]
        )

    return predicted.asNondeterministic()(text)


def train_on(docs: DataFrame, may_learn: Column, rows_per_language: int = ROWS) -> Network:
    """Train on text and lang of documents that meet ``may_learn`` (a condition on doc_id)."""
    rows, _ = sample(docs, docs, "lang", may_learn, rows_per_language)
    return train(rows)


def languages(
    docs: DataFrame,
    folds: int = 4,
    held: int = 2,
    rows_per_language: int = ROWS,
) -> DataFrame:
    """doc_id, held_out, lang_pred and score of each row.

    Documents whose crc32(doc_id as text) modulo ``folds`` is ``held`` are not learnt from. Up to
    ``rows_per_language`` whole texts a language are. Each row is judged on its whole text alone:
    repeated rows are judged alike, texts that are null, empty or
    without a letter are "und" with score 0 (as is everything when no lang is given at all), and an
    empty table gives no rows.
    """
    may_learn = remainder("doc_id", folds) != held
    net = train_on(docs, may_learn, rows_per_language)
    judged = pick(docs, "doc_id", "text").select(
        "doc_id",
        (remainder("doc_id", folds) == held).alias("held_out"),
        predict(net, "text").alias("v"),
    )
    return judged.select("doc_id", "held_out", "v.*")
