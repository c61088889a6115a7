"""Embedding whitening: leading eigenpairs of the covariance by a block Jacobi-Davidson iteration.

The covariance is never formed. Spark multiplies it with a few columns at a time: every partition of the
fit list gives C'(C B) of its centred rows C, and the partial products are added up in two steps, so the
driver holds matrices of the embedding's dimension only, never rows.

Entries are whole numbers x, so a centred entry (n x - S) / n is rounded once, however far the mean is
from zero.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.llm.frames import Shelf, pick

COMPONENTS = 16
STEP = 64  # whole-number steps a unit
SHIFT = 1_000_000
LARGEST = 2**31 - 1 - SHIFT  # |64 c| beyond it has no place in 32 bits
INNER_STEPS = 6
ROUNDS = 200
BLOCK_ENTRIES = 1 << 20  # entries held as numbers at once
DIRECT = 64  # partial products that the driver adds up itself
EPS = float(np.finfo(np.float64).eps)

Product = Callable[[np.ndarray], np.ndarray]


def orthonormal(vectors: np.ndarray, against: np.ndarray) -> np.ndarray:
    """A basis of what ``vectors`` add to the orthonormal columns ``against``; maybe fewer columns."""
    lengths = np.linalg.norm(vectors, axis=0)
    vectors = vectors[:, lengths > 0] / lengths[lengths > 0]
    for _ in range(2):
        vectors = vectors - against @ (against.T @ vectors)
    q, lengths, _ = np.linalg.svd(vectors, full_matrices=False)
    q = q[:, lengths > 1e-10]
    q = q - against @ (against.T @ q)
    return np.linalg.qr(q)[0] if q.shape[1] else q


def minres(apply: Product, right: np.ndarray, steps: int, goal: float) -> np.ndarray:
    """Solutions of a symmetric (maybe indefinite) system for several right sides at once.

    All columns take their Lanczos steps together, so a step costs one product; each column keeps its
    own rotations and stands still when it is solved.
    """
    columns = right.shape[1]
    out = np.zeros_like(right)
    beta = np.linalg.norm(right, axis=0)
    start = np.where(beta > 0, beta, 1.0)
    v, v_old = right / start, np.zeros_like(right)
    d, d_old = np.zeros_like(right), np.zeros_like(right)
    cos, cos_old = np.ones(columns), np.ones(columns)
    sin, sin_old = np.zeros(columns), np.zeros(columns)
    rest, beta_now = beta.copy(), np.zeros(columns)
    going = beta > 0
    for _ in range(steps):
        if not going.any():
            break
        w = apply(v)
        alpha = np.einsum("ij,ij->j", v, w)
        w = w - alpha * v - beta_now * v_old
        beta_next = np.linalg.norm(w, axis=0)
        # The new column of the tridiagonal matrix under the last two rotations.
        epsilon, bar = sin_old * beta_now, cos_old * beta_now
        delta = cos * bar + sin * alpha
        gamma_bar = -sin * bar + cos * alpha
        gamma = np.hypot(gamma_bar, beta_next)
        safe = np.where(gamma > 0, gamma, 1.0)
        cos_old, sin_old = cos, sin
        cos, sin = gamma_bar / safe, beta_next / safe
        d_new = (v - delta * d - epsilon * d_old) / safe
        d_old, d = d, d_new
        out += np.where(going & (gamma > 0), cos * rest, 0.0) * d
        rest = -sin * rest
        going &= (gamma > 0) & (beta_next > 1e-14 * start) & (np.abs(rest) > goal * start)
        v_old, v = v, w / np.where(beta_next > 0, beta_next, 1.0)
        beta_now = beta_next
    return out


@dataclass
class Eigenpairs:
    values: np.ndarray
    vectors: np.ndarray
    residuals: np.ndarray
    rounds: int
    products: int


def jacobi_davidson(
    product: Product, size: int, wanted: int, seed: int = 1, inner_steps: int = INNER_STEPS
) -> Eigenpairs:
    """The ``wanted`` largest eigenpairs of a symmetric operator known by its products alone.

    Each round: Rayleigh-Ritz in the subspace; leading pairs whose residual has reached double precision
    are locked; for the others the correction equation (I-QQ')(A-tI)(I-QQ') z = -r is solved roughly by
    MINRES and z widens the subspace, which is cut back to its leading Ritz vectors when it is full.
    """
    wanted = min(wanted, size)
    count = 0

    def counted(block: np.ndarray) -> np.ndarray:
        nonlocal count
        count += 1
        return product(block)

    most = min(size, 4 * wanted + 16)
    locked, values, residuals = np.zeros((size, 0)), [], []
    start = np.random.default_rng(seed).standard_normal((size, min(size, wanted + 4)))
    basis = orthonormal(start, locked)
    image = counted(basis)
    best, still, top = math.inf, 0, 0.0
    for turn in range(1, ROUNDS + 1):
        inner = basis.T @ image
        theta, turned = np.linalg.eigh((inner + inner.T) / 2)
        theta, turned = theta[::-1], turned[:, ::-1]
        basis, image = basis @ turned, image @ turned
        open_ = wanted - len(values)
        top = max([top, *values, *np.abs(theta[:1])])
        off = image[:, :open_] - basis[:, :open_] * theta[:open_]
        off -= locked @ (locked.T @ off)
        norms = np.linalg.norm(off, axis=0)
        whole = basis.shape[1] + locked.shape[1] >= size
        worst = float(norms.max(initial=0.0))
        best, still = (worst, 0) if worst < best / 2 else (best, still + 1)
        # At the floor of rounding residuals no longer fall; they must have got near it, though.
        goal = 16 * EPS * top if still < 3 else 4096 * EPS * top
        done = norms <= goal
        ready = open_ if done.all() or (whole and still >= 1) else int(np.argmin(done))
        if ready:
            locked = np.hstack([locked, basis[:, :ready]])
            values += theta[:ready].tolist()
            residuals += norms[:ready].tolist()
            basis, image = basis[:, ready:], image[:, ready:]
            theta, off = theta[ready:], off[:, ready:]
            open_ -= ready
            best, still = math.inf, 0
        if not open_:
            break
        if whole:
            # Nothing is left to add: only rounding of the images remains, so take them afresh.
            basis = orthonormal(basis, locked)
            image = counted(basis)
            continue
        if basis.shape[1] + open_ > most - locked.shape[1]:
            keep = min(basis.shape[1], max(open_ + 4, (most - locked.shape[1]) // 2))
            basis, image = basis[:, :keep], image[:, :keep]
        shift, held = theta[:open_], np.hstack([locked, basis[:, :open_]])

        def projected(block: np.ndarray, held=held, shift=shift) -> np.ndarray:
            block = block - held @ (held.T @ block)
            block = counted(block) - block * shift
            return block - held @ (held.T @ block)

        right = -(off - held @ (held.T @ off))
        step = minres(projected, right, inner_steps, 0.05)
        new = orthonormal(step, np.hstack([locked, basis]))
        if not new.shape[1]:
            fresh = np.random.default_rng(seed + turn).standard_normal((size, open_))
            new = orthonormal(fresh, np.hstack([locked, basis]))
        basis, image = np.hstack([basis, new]), np.hstack([image, counted(new)])
    else:
        raise ArithmeticError(f"Eigenpairs not found in {ROUNDS} rounds")
    order = np.argsort(np.array(values))[::-1]
    return Eigenpairs(
        np.array(values)[order], locked[:, order], np.array(residuals)[order], turn, count
    )


def whole_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, x as little-endian 32-bit numbers) of the rows whose vector is whole and in range."""
    narrow = dict(pick(embeddings, "embedding").dtypes)["embedding"] == "array<float>"
    kind = pa.large_list(pa.float32() if narrow else pa.float64())

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, out = [], []
            for vec_id, vector in zip(batch.column(0).to_pylist(), batch.column(1).cast(kind), strict=True):
                values = vector.values if vector.is_valid else None
                if values is None or values.null_count or not len(values):
                    continue
                x = np.floor(STEP * values.to_numpy().astype(np.float64))
                if np.abs(x).max() <= LARGEST:  # so not where an entry is not finite
                    ids.append(vec_id)
                    out.append((x.astype(np.int64) + SHIFT).astype("<i4").tobytes())
            columns = [pa.array(ids, pa.int64()), pa.array(out, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "x"])

    rows = pick(embeddings, "vec_id", "embedding").select(F.col("vec_id").cast("long"), "embedding")
    return rows.mapInArrow(convert, "vec_id long, x binary")


def _matrices(batch: pa.RecordBatch, dim: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, x) of the batch's last column, BLOCK_ENTRIES at a time."""
    step = max(1, BLOCK_ENTRIES // dim)
    for first in range(0, batch.num_rows, step):
        some = batch.column(batch.num_columns - 1).slice(first, step).to_pylist()
        yield first, np.frombuffer(b"".join(some), "<i4").reshape(-1, dim).astype(np.int64)


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """(n x - S) / n, exact up to the division where n x fits 64 bits."""
    if n < 1 << 30:
        return (n * x - np.array(sums, np.int64)) / n
    mean = [divmod(s, n) for s in sums]  # whole and remainder, so nothing cancels
    whole, part = (np.array(m) for m in zip(*mean, strict=True))
    return (x - whole.astype(np.int64)) - part.astype(np.float64) / n


class FitList:
    """The distinct vectors of one dimension, on the shelf, with their number and sums."""

    def __init__(self, fit: DataFrame, dim: int, n: int, sums: list[int]):
        self.fit, self.dim, self.n, self.sums = fit, dim, n, sums

    def total(self, shape: tuple[int, int], of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """The sum over all centred blocks of rows of ``of``, a matrix of ``shape``."""
        dim, n, sums = self.dim, self.n, self.sums
        parts = self.fit.rdd.getNumPartitions()
        fan = max(1, math.isqrt(parts))

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros(shape)
            for batch in batches:
                for _, x in _matrices(batch, dim):
                    out += of(_centred(x, n, sums))
            group = TaskContext.get().partitionId() % fan
            row = [pa.array([group]), pa.array([out.tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(row, ["part", "sums"])

        def add(table: pa.Table) -> pa.Table:
            out = sum(np.frombuffer(x, np.float64) for x in table.column("sums").to_pylist())
            return pa.table({"part": table.column("part")[:1], "sums": pa.array([out.tobytes()], pa.binary())})

        schema = "part long, sums binary"
        some = self.fit.select("x").mapInArrow(partial, schema)
        if parts > DIRECT:
            some = some.groupBy("part").applyInArrow(add, schema)
        found = some.collect()  # at most the root of the number of partitions, or DIRECT
        return sum((np.frombuffer(r.sums, np.float64) for r in found), np.zeros(math.prod(shape))).reshape(shape)

    def covariance_times(self, block: np.ndarray) -> np.ndarray:
        return self.total(block.shape, lambda rows: rows.T @ (rows @ block)) / self.n

    def trace(self) -> float:
        return float(self.total((1, 1), lambda rows: np.einsum("ij,ij->", rows, rows).reshape(1, 1))[0, 0]) / self.n

    def identity_error(self, project: np.ndarray) -> float:
        """Largest entry, in size, of the projected rows' covariance minus the identity."""
        k = project.shape[1]

        def moments(rows: np.ndarray) -> np.ndarray:
            y = rows @ project
            return np.vstack([y.T @ y, y.sum(axis=0, keepdims=True)])

        both = self.total((k + 1, k), moments) / self.n
        return float(np.abs(both[:k] - np.outer(both[k], both[k]) - np.eye(k)).max())


def fit_list(vectors: DataFrame, shelf: Shelf) -> FitList | None:
    """Each distinct vector once, of the dimension that most rows have (the larger of two); None if empty."""
    dims = vectors.groupBy((F.length("x") / 4).cast("int").alias("dim")).agg(F.count("*").alias("rows"))
    most = dims.orderBy(F.desc("rows"), F.desc("dim")).first()
    if most is None:
        return None
    dim = most.dim
    fit = shelf.put(vectors.where(F.length("x") == 4 * dim).select("x").distinct(), "fit")

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, np.zeros(dim, np.int64)
        for batch in batches:
            n += batch.num_rows
            for _, x in _matrices(batch, dim):
                sums += x.sum(axis=0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(dim)), pa.array(sums), pa.array(np.where(np.arange(dim) == 0, n, 0))],
            ["i", "s", "n"],
        )

    sums = (
        fit.mapInArrow(add_up, "i long, s long, n long")
        .groupBy("i")
        .agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n"))
        .collect()  # a row for each dimension
    )
    by_place = {r.i: r for r in sums}
    return FitList(fit, dim, int(by_place[0].n), [int(by_place[i].s) for i in range(dim)])


OUT = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, "
    "identity_error double"
)


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum of (n x - S)^2 of each row, exact; null where it is beyond 64 bits."""
    rough = (n * x.astype(np.float64) - np.array(sums, np.float64)) ** 2
    if rough.sum(axis=1).max(initial=0.0) < 2.0**62 and n < 1 << 30:
        d = n * x - np.array(sums, np.int64)
        return (d * d).sum(axis=1).tolist()
    out = [sum((n * a - s) ** 2 for a, s in zip(row, sums, strict=True)) for row in x.tolist()]
    return [v if v < 1 << 63 else None for v in out]


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error of every whole vector.

    Rows whose vector is null, empty or holds null or non-finite entries give nothing, nor do rows of
    another dimension than most rows have, or with an entry of over 33 million in size, whose x has no
    place in 32 bits. A row of any vec_id, null included, counts; repeated rows are projected each, but fitted
    once. Components whose eigenvalue is zero up to rounding can't be scaled and are left out, so a table
    of one distinct vector gives no rows, as an empty one does. ``deviation`` is null beyond 64 bits.
    Other columns are not read.
    """
    spark = embeddings.sparkSession
    shelf = Shelf(spark, "whitening")
    vectors = whole_vectors(embeddings)
    known = fit_list(vectors, shelf)
    if known is None or known.n < 2:
        return spark.createDataFrame([], OUT)
    trace = known.trace()
    pairs = jacobi_davidson(known.covariance_times, known.dim, components)
    rank = int(np.count_nonzero(pairs.values > 64 * EPS * known.dim * pairs.values[0]))
    values, project = pairs.values[:rank], pairs.vectors[:, :rank] / np.sqrt(pairs.values[:rank])
    error = known.identity_error(project)
    dim, n, sums = known.dim, known.n, known.sums

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, x in _matrices(batch, dim):
                rows, each = len(x), np.repeat(np.arange(len(x)), rank)
                whitened = _centred(x, n, sums) @ project
                deviation = pa.array(_deviations(x, n, sums), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, rows).take(pa.array(each)),
                        pa.array(np.tile(np.arange(1, rank + 1, dtype=np.int32), rows)),
                        pa.array(np.full(rows * rank, n)),
                        deviation.take(pa.array(each)),
                        pa.array(whitened.reshape(-1)),
                        pa.array(np.tile(values / trace, rows)),
                        pa.array(np.full(rows * rank, error)),
                    ],
                    [field.split()[0] for field in OUT.split(", ")],
                )

    return vectors.where(F.length("x") == 4 * dim).mapInArrow(apply, OUT)
