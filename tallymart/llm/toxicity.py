"""Toxicity by a factorization machine over hashed terms.

The terms of a text are its words (ASCII letters lower-cased) and the first bytes of longer words,
each hashed to one of ``BUCKETS``; a text has a term or not. The machine adds, to the weights of
the terms present, the inner products of their factors over all pairs. So an insult near a group's
name can weigh more than both alone, which a linear model cannot express.

A term has a row of weight and factors if its presence differs between the classes by ``Z`` standard
errors, and by more than the largest of so many would differ by chance; or, among the terms of at least
``FREQUENT`` of the rows, if it is one of a pair whose presence together tells what its members' own
presence does not (``interacting``). Other terms have none; that keeps long harmless texts from adding
up noise. The fit is AdaGrad on the
logistic loss, over a bounded sample (``ROWS`` a class, whole texts); the intercept is then moved
from the sample's share of toxic rows to that of all labelled rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.llm.frames import pick
from tallymart.llm.labelled import remainder, sample
from tallymart.llm.vocab import release
from tallymart.llm.words import NOT_ALPHANUMERIC, byte_class, hash_spans, word_blocks

BUCKETS = 1 << 18
ROWS = 3000
Z = 3.0
FREQUENT = 0.05  # share of the rows from which on pairs of terms are tested
FACTORS = 4
PREFIXES = (4, 5)
WORDS = byte_class(NOT_ALPHANUMERIC, lower=True)


@dataclass(frozen=True)
class Machine:
    """``place[bucket]`` is a term's row in ``weights`` and ``factors``; row 0 is zero."""

    intercept: float
    place: np.ndarray
    weights: np.ndarray
    factors: np.ndarray


def terms(texts: pa.Array):
    """(first row, row after the last, text of each term, bucket): distinct terms of each text."""
    for first, end, words in word_blocks(texts, WORDS):
        text = np.repeat(np.arange(end - first), np.diff(words.offsets))
        raw = WORDS[1][words.raw]
        found, owner = [words.hashes], [text]
        for size in PREFIXES:
            longer = words.ends - words.starts > size
            starts = words.starts[longer]
            found.append(~hash_spans(raw, starts, starts + size))
            owner.append(text[longer])
        buckets = np.concatenate(found) >> np.uint64(64 - 18)
        yield first, end, np.concatenate(owner), buckets.astype(np.int64)


def _distinct(owner: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.unique(owner * BUCKETS + bucket)
    return keys // BUCKETS, keys % BUCKETS


def _rows(place: np.ndarray, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text, row of the machine) of each text's terms that have one, each once, text by text."""
    owners, rows = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for first, _, owner, bucket in terms(texts):
        owner, bucket = _distinct(owner, bucket)
        row = place[bucket].astype(np.int64)
        owners.append(owner[row > 0] + first)
        rows.append(row[row > 0])
    return np.concatenate(owners), np.concatenate(rows)


def raw_scores(model: Machine, count: int, owner: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Machine's value of each text, from its terms' rows (row 0 left out before or harmless)."""
    linear = np.bincount(owner, model.weights[row], count)
    pairs = np.zeros(count)
    for k in range(model.factors.shape[1]):
        v = model.factors[row, k]
        pairs += np.bincount(owner, v, count) ** 2 - np.bincount(owner, v * v, count)
    return model.intercept + linear + pairs / 2


def interacting(present: np.ndarray, y: np.ndarray, z: float) -> np.ndarray:
    """Which terms (columns of ``present``, 0 or 1) are in a pair that interacts.

    For two terms the rows fall into four cells by presence; the contrast of the cells' shares of toxic
    rows is zero where the terms' effects add up. It has to be twice ``z`` standard errors, or twice the
    largest of so many by chance: twice, as near copies among the rows are no independent witnesses.
    """
    width = present.shape[1]
    out = np.zeros(width, bool)
    if width < 2:
        return out
    z = max(z, float(np.sqrt(2 * np.log(width * (width - 1) / 2))))
    every, toxic = present.astype(np.float32), present[y == 1].astype(np.float32)
    share = y.mean()
    for first in range(0, width, 256):
        some = slice(first, first + 256)

        def cells(part: np.ndarray, some=some) -> list[np.ndarray]:
            total = part.sum(axis=0, dtype=np.float64)
            both = (part[:, some].T @ part).astype(np.float64)
            one, other = total[some, None] - both, total[None, :] - both
            return [both, one, other, len(part) - both - one - other]

        contrast, variance = 0.0, 0.0
        rows, hits = cells(every), cells(toxic)
        for n, t, sign in zip(rows, hits, (1, -1, -1, 1), strict=True):
            contrast = contrast + sign * (t + share) / (n + 1)
            variance = variance + share * (1 - share) / (n + 1)
        strong = np.abs(contrast) >= 2 * z * np.sqrt(variance)
        # A term and itself, or its own prefix, have no rows with one alone.
        out[some] |= (strong & (rows[1] > 0) & (rows[2] > 0)).any(axis=1)
    return out


def fit(
    rows: list[tuple[str, int]],
    counts: dict[int, int],
    epochs: int = 20,
    step: float = 0.1,
    shrink: float = 3e-5,
    z: float = Z,
) -> Machine:
    """Without rows of both classes the machine scores the share of toxic rows (0.5 without any)."""
    total = sum(counts.values())
    share = (sum(n for value, n in counts.items() if value) + 0.5) / (total + 1)
    prior = float(np.log(share / (1 - share)))
    y = np.array([int(bool(label)) for _, label in rows])
    empty = Machine(prior, np.zeros(BUCKETS, np.int32), np.zeros(1), np.zeros((1, FACTORS)))
    if not len(y) or y.min() == y.max():
        return empty
    texts = pa.array([text for text, _ in rows], pa.large_string())
    n1, n0 = int(y.sum()), int((1 - y).sum())
    in1, in0 = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for first, _, owner, bucket in terms(texts):  # the terms of all texts at once would be large
        owner, bucket = _distinct(owner, bucket)
        toxic = y[owner + first]
        in1 += np.bincount(bucket, toxic, BUCKETS)
        in0 += np.bincount(bucket, 1 - toxic, BUCKETS)
    pooled = (in1 + in0 + 1) / (n1 + n0 + 2)
    error = np.sqrt(pooled * (1 - pooled) * (1 / n1 + 1 / n0))
    met = in1 + in0 >= 3
    z = max(z, float(np.sqrt(2 * np.log(max(met.sum(), 1)))))  # so many terms stray by chance
    telling = (np.abs(in1 / n1 - in0 / n0) >= z * error) & met
    frequent = np.flatnonzero(in1 + in0 >= max(3, FREQUENT * len(y)))
    column = np.full(BUCKETS, -1, np.int64)
    column[frequent] = np.arange(len(frequent))
    present = np.zeros((len(y), len(frequent)), np.uint8)
    for first, _, owner, bucket in terms(texts):
        known = column[bucket] >= 0
        present[owner[known] + first, column[bucket[known]]] = 1
    telling[frequent[interacting(present, y, Z)]] = True
    telling = np.flatnonzero(telling)
    place = np.zeros(BUCKETS, np.int32)
    place[telling] = np.arange(1, len(telling) + 1)
    owner, row = _rows(place, texts)
    edges = np.searchsorted(owner, np.arange(len(y) + 1))
    rng = np.random.default_rng(0)
    w = np.zeros(len(telling) + 1)
    v = rng.normal(0, 0.05, (len(telling) + 1, FACTORS))
    v[0] = 0
    bias = float(np.log(n1 / n0))
    gw, gv, gb = np.full(w.shape, 1e-6), np.full(v.shape, 1e-6), 1e-6
    size = 64
    for _ in range(epochs):
        shuffled = rng.permutation(len(y))
        for at in range(0, len(y), size):
            some = shuffled[at : at + size]
            length = edges[some + 1] - edges[some]
            mine = np.repeat(np.arange(len(some)), length)
            upto = np.cumsum(length)
            r = row[np.repeat(edges[some] - (upto - length), length) + np.arange(len(mine))]
            sums = np.stack([np.bincount(mine, v[r, k], len(some)) for k in range(FACTORS)], 1)
            squares = np.bincount(mine, (v[r] ** 2).sum(1), len(some))
            value = bias + np.bincount(mine, w[r], len(some)) + ((sums**2).sum(1) - squares) / 2
            slope = 1 / (1 + np.exp(-np.clip(value, -30, 30))) - y[some]
            there, back = np.unique(r, return_inverse=True)
            dw = np.bincount(back, slope[mine]) / len(some) + shrink * w[there]
            pull = slope[mine][:, None] * (sums[mine] - v[r])
            dv = np.stack([np.bincount(back, pull[:, k]) for k in range(FACTORS)], 1) / len(some)
            dv += shrink * v[there]
            gw[there] += dw**2
            gv[there] += dv**2
            w[there] -= step * dw / np.sqrt(gw[there])
            v[there] -= step * dv / np.sqrt(gv[there])
            db = slope.mean()
            gb += db**2
            bias -= step * db / np.sqrt(gb)
    return Machine(bias + prior - float(np.log(n1 / n0)), place, w, v)


def fit_on(
    docs: DataFrame, labels: DataFrame, may_learn: Column, rows_per_class: int = ROWS
) -> Machine:
    """Fit on ``labels.toxic`` of documents that meet ``may_learn`` (a condition on doc_id)."""
    return fit(*sample(docs, labels, "toxic", may_learn, rows_per_class))


def score(model: Machine, text: Column | str) -> Column:
    """Probability that each whole text is toxic; null and empty texts have no terms."""

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        release()  # the process may hold what an earlier stage needed
        out = np.zeros(len(texts))
        for first, end, owner, bucket in terms(texts):
            row = model.place[bucket]
            keys = np.unique(owner[row > 0] * len(model.weights) + row[row > 0])
            owner, row = keys // len(model.weights), keys % len(model.weights)
            out[first:end] = raw_scores(model, end - first, owner, row)
        return pa.array(1 / (1 + np.exp(-np.clip(out, -30, 30))))

    return scored.asNondeterministic()(text)


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    folds: int = 3,
    held: int = 1,
    threshold: float = 0.7,
    rows_per_class: int = ROWS,
) -> DataFrame:
    """doc_id, held_out, score and predicted of each row.

    Documents whose crc32(doc_id as text) modulo ``folds`` is ``held`` are not learnt from. Each row
    is scored on its whole text alone: repeated rows score alike, a null or empty text scores the
    intercept, and an empty table gives no rows.
    """
    model = fit_on(docs, labels, remainder("doc_id", folds) != held, rows_per_class)
    scored = pick(docs, "doc_id", "text").select(
        "doc_id",
        (remainder("doc_id", folds) == held).alias("held_out"),
        score(model, "text").alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
