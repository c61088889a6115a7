"""Quality by naive Bayes support vectors.

The features of a text are indicators of n-grams in two groups. Its wording: 1 and 2 words
(alphanumeric, ASCII lower-cased) and 4 bytes. Its form: 1 to 3 bytes (ASCII letters are one symbol a
case, so spelling does not matter but shouting, marks and numbers do), and 1 to 4 words by their
form (case, marks, digits, length, and whether the word repeats one of the last words). Each
indicator is scaled by the log-count ratio of the classes, each group of a text to length one, and a
linear hinge-loss model is fitted on these features by dual coordinate descent. As is usual for this model, its weights are mixed with
their mean magnitude. A logistic curve fitted on the margins of held-back rows gives scores.

The fit takes up to ``ROWS`` whole texts a class.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.llm.frames import pick
from tallymart.llm.labelled import remainder, sample
from tallymart.llm.words import NOT_ALPHANUMERIC, WHITE, byte_class, mix, word_blocks

FORMS, WORDINGS = 1 << 14, 1 << 16  # columns of each group
BUCKETS = FORMS + WORDINGS
GROUPS = (slice(0, FORMS), slice(FORMS, BUCKETS))
# Added to the counts of a form or wording in each class: words are many and mostly rare.
SMOOTHED = np.where(np.arange(BUCKETS) < FORMS, 1.0, 4.0)
ROWS = 2000
MIXED = 0.25  # share of the support vectors' weights; the rest is their mean magnitude
WORDS = byte_class(WHITE, lower=False)
PLAIN_WORDS = byte_class(NOT_ALPHANUMERIC, lower=True)


def _symbols() -> np.ndarray:
    """Bytes to at most 64 symbols: a case, digits, bytes beyond ASCII, each mark of its own."""
    out = np.zeros(256, np.int64)
    out[ord("a") : ord("z") + 1] = 1
    out[ord("A") : ord("Z") + 1] = 2
    out[ord("0") : ord("9") + 1] = 3
    out[0x80:] = 1  # as a small letter
    marks = [i for i in range(0x80) if out[i] == 0]
    out[marks] = 4 + np.arange(len(marks)) % 60
    return out


SYMBOLS = _symbols()


def _word_forms(words) -> np.ndarray:
    """A small number for each word's form."""
    symbols = SYMBOLS[words.raw]

    def count(flag: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flag)])
        return total[words.ends] - total[words.starts]

    size = words.ends - words.starts
    upper, digits = count(symbols == 2), count(symbols == 3)
    marks = size - upper - digits - count(symbols == 1)
    form = np.minimum(marks, 3) + 4 * (digits > 0) + 8 * ((upper > 0) + (upper > 1))
    form += 24 * (np.digitize(size, (2, 4, 8, 16)))
    text = np.repeat(np.arange(len(words.offsets) - 1), np.diff(words.offsets))
    repeats = np.zeros(len(size), np.int64)
    for back in (1, 2):
        same = (words.hashes[back:] == words.hashes[:-back]) & (text[back:] == text[:-back])
        repeats[back:] |= same.astype(np.int64) * back
    return form + 120 * repeats


def indicators(texts: pa.Array):
    """(first row, row after the last, flags): flags[i, b] is 1 if text i has an n-gram in bucket b.

    N-grams do not reach over a text's bounds.
    """
    both = zip(word_blocks(texts, WORDS, rows=64), word_blocks(texts, PLAIN_WORDS, rows=64), strict=True)
    for (first, end, words), (_, _, plain_words) in both:
        count = end - first
        flags = np.zeros((count + 1, BUCKETS), np.uint8)  # the last row takes what spans two texts
        plain = flags.reshape(-1)
        for kind, values, offsets, longest in (
            (1, SYMBOLS[words.raw], words.raw_offsets, 3),
            (2, _word_forms(words), words.offsets, 4),
        ):
            values = values.astype(np.uint32)
            row = np.repeat(np.arange(count, dtype=np.uint32) * np.uint32(BUCKETS), np.diff(offsets))
            keys = np.full(len(values), kind, np.uint32)
            for size in range(1, longest + 1):
                if len(values) < size:
                    break
                keys = keys[: len(values) - size + 1] * np.uint32(521) + values[size - 1 :]
                place = (keys * np.uint32(0x9E3779B1)) >> np.uint32(32 - 14)  # one of FORMS
                place += row[: len(place)]
                for back in range(1, size):
                    across = offsets[1:-1] - back
                    place[across[(across >= 0) & (across < len(place))]] = count * BUCKETS
                plain[place] = 1
        for owner, hashes in _wordings(plain_words):
            flags[owner, FORMS + (hashes >> np.uint64(64 - 16)).astype(np.int64)] = 1
        yield first, end, flags[:count]


def _wordings(words):
    """(text, hash) of the words, pairs of words and 4 bytes of each text."""

    def owners(offsets: np.ndarray) -> np.ndarray:
        return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))

    text = owners(words.offsets)
    yield text, words.hashes
    if len(text) > 1:
        within = text[1:] == text[:-1]
        yield text[1:][within], mix(words.hashes[:-1] * np.uint64(3) + words.hashes[1:])[within]
    raw = PLAIN_WORDS[1][words.raw].astype(np.uint64)
    if len(raw) > 3:
        text = owners(words.raw_offsets)
        within = text[3:] == text[:-3]
        four = raw[:-3] | (raw[1:-2] << np.uint64(8)) | (raw[2:-1] << np.uint64(16)) | (raw[3:] << np.uint64(24))
        yield text[3:][within], mix(four[within])


@dataclass(frozen=True)
class Model:
    """The probability of an indicator row x is the logistic of slope * margin + shift, where the
    margin is the sum over the groups of x @ weights / |x * ratio|, plus the bias; the ratios are
    multiplied into the weights."""

    weights: np.ndarray
    ratio: np.ndarray
    bias: float
    slope: float
    shift: float

    def margins(self, flags: np.ndarray) -> np.ndarray:
        out = np.full(len(flags), self.bias)
        for group in GROUPS:
            x = flags[:, group].astype(np.float32)
            both = x @ np.stack([self.weights[group], self.ratio[group] ** 2], 1).astype(np.float32)
            out += both[:, 0] / np.sqrt(np.maximum(both[:, 1], 1e-9))
        return out

    def scores(self, flags: np.ndarray) -> np.ndarray:
        value = self.slope * self.margins(flags).astype(np.float64) + self.shift
        return 1 / (1 + np.exp(-np.clip(value, -30, 30)))


def dual_descent(
    features: list[tuple[np.ndarray, np.ndarray]],
    y: np.ndarray,
    size: int,
    cost: np.ndarray,
    passes: int = 20,
) -> np.ndarray:
    """Weights of the hinge-loss model (the last one is the bias), one row's dual at a time.

    ``features`` are (columns, values) of each row; ``y`` is -1 or 1; ``cost`` bounds a row's dual.
    """
    weights, alpha = np.zeros(size + 1), np.zeros(len(y))
    norms = np.array([float(v @ v) + 1 for _, v in features])  # 1 for the bias
    rng = np.random.default_rng(0)
    for _ in range(passes):
        moved = 0.0
        for i in rng.permutation(len(y)):
            columns, values = features[i]
            slope = y[i] * (float(weights[columns] @ values) + weights[-1]) - 1
            new = min(max(alpha[i] - slope / norms[i], 0.0), cost[i])
            step = (new - alpha[i]) * y[i]
            if step:
                weights[columns] += step * values
                weights[-1] += step
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-3:
            break
    return weights


def _logistic(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the curve from margins to probabilities (Newton steps, smoothed targets)."""
    n1, n0 = int(y.sum()), int((1 - y).sum())
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    design = np.stack([margins, np.ones(len(y))], 1)
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (p - target) + 1e-3 * beta
        curve = (design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, gradient)
        beta -= step * min(1.0, 2 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-6:
            break
    return float(beta[0]), float(beta[1])


def fit(rows: list[tuple[str, int]], counts: dict[int, int], cost: float = 1.0) -> Model:
    """Without rows of both classes every score is the share of good rows (0.5 without any)."""
    total = sum(counts.values())
    share = (sum(n for value, n in counts.items() if value) + 0.5) / (total + 1)
    prior = float(np.log(share / (1 - share)))
    y = np.array([int(bool(label)) for _, label in rows])
    if len(y) < 4 or y.min() == y.max():
        return Model(np.zeros(BUCKETS), np.zeros(BUCKETS), 0.0, 0.0, prior)
    columns = []
    for _, _, flags in indicators(pa.array([text for text, _ in rows], pa.large_string())):
        columns += [np.flatnonzero(row) for row in flags]

    def train(some: np.ndarray) -> Model:
        present = np.stack([SMOOTHED, SMOOTHED])
        for i in some:
            present[y[i], columns[i]] += 1
        ratio = np.zeros(BUCKETS)
        for group in GROUPS:
            good, bad = present[1, group], present[0, group]
            ratio[group] = np.log((good / good.sum()) / (bad / bad.sum()))
        ratio[(present == SMOOTHED).all(axis=0) & (np.arange(BUCKETS) >= FORMS)] = 0  # unknown words
        features = []
        for i in some:
            values, wording = ratio[columns[i]], columns[i] >= FORMS
            for part in (wording, ~wording):
                values[part] /= max(np.linalg.norm(values[part]), 1e-9)
            features.append((columns[i], values))
        half = len(some) / 2
        costs = cost * np.where(y[some] == 1, half / y[some].sum(), half / (1 - y[some]).sum())
        w = dual_descent(features, 2.0 * y[some] - 1, BUCKETS, costs)
        mixed = np.empty(BUCKETS)
        for group in GROUPS:
            mean = np.abs(w[:-1][group]).mean()
            mixed[group] = ((1 - MIXED) * mean + MIXED * w[:-1][group]) * ratio[group]
        return Model(mixed, ratio, MIXED * w[-1], 1.0, 0.0)

    def margins(model: Model, some: np.ndarray) -> np.ndarray:
        flags = np.zeros((1, BUCKETS), np.uint8)
        out = []
        for i in some:
            flags[:] = 0
            flags[0, columns[i]] = 1
            out.append(model.margins(flags)[0])
        return np.array(out)

    held = np.arange(len(y)) % 5 == 0
    if 0 < y[~held].mean() < 1 and 0 < y[held].mean() < 1:
        judged, model = np.flatnonzero(held), train(np.flatnonzero(~held))
    else:
        judged, model = np.arange(len(y)), train(np.arange(len(y)))
    held_margins = margins(model, judged)
    spread = max(float(np.abs(held_margins).mean()), 1e-9)
    slope, shift = _logistic(held_margins / spread, y[judged])
    model = train(np.arange(len(y)))
    # The curve holds for the sample's share of good rows; move it to that of all labelled rows.
    here = float(np.log(y.mean() / (1 - y.mean())))
    return Model(model.weights, model.ratio, model.bias, slope / spread, shift + prior - here)


def fit_on(
    docs: DataFrame, labels: DataFrame, may_learn: Column, rows_per_class: int = ROWS
) -> Model:
    """Fit on ``labels.quality`` of documents that meet ``may_learn`` (a condition on doc_id)."""
    return fit(*sample(docs, labels, "quality", may_learn, rows_per_class))


def score(model: Model, text: Column | str) -> Column:
    """Probability that each whole text is good; null and empty texts have no n-gram."""

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        out = np.zeros(len(texts))
        for first, end, flags in indicators(texts):
            out[first:end] = model.scores(flags)
        return pa.array(out)

    return scored.asNondeterministic()(text)


def quality(
    docs: DataFrame,
    labels: DataFrame,
    folds: int = 5,
    held: int = 0,
    threshold: float = 0.3,
    rows_per_class: int = ROWS,
) -> DataFrame:
    """doc_id, held_out, score and predicted of each row.

    Documents whose crc32(doc_id as text) modulo ``folds`` is ``held`` are not learnt from. Each row
    is scored on its whole text alone: repeated rows score alike, a null or empty text scores the
    bias, and an empty table gives no rows.
    """
    model = fit_on(docs, labels, remainder("doc_id", folds) != held, rows_per_class)
    scored = pick(docs, "doc_id", "text").select(
        "doc_id",
        (remainder("doc_id", folds) == held).alias("held_out"),
        score(model, "text").alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
