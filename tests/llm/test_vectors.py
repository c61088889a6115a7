"""Whitening and near-duplicate vectors against plain numpy."""

from __future__ import annotations

import numpy as np
import pytest

from tallymart.llm import embedding_dedup, whitening

SCHEMA = "vec_id long, embedding array<float>, label int"
CLASHING = "vec_id long, embedding array<float>, label int, VEC_ID string, component string, `a.b` int, kept int"


def invented(seed, rows=260, dim=24):
    """Groups of near copies, exact copies and lone vectors of three labels."""
    dice = np.random.default_rng(seed)
    out = []
    for group in range(12):
        centre = dice.standard_normal(dim)
        for _ in range(dice.integers(1, 30)):
            out.append((centre + dice.standard_normal(dim) * dice.choice([0.02, 0.15, 0.2]), group % 3))
    while len(out) < rows:
        out.append((dice.standard_normal(dim), len(out) % 3))
    out += [out[i] for i in dice.integers(0, len(out), 40)]
    return [(i * 3 - 50, v.astype(np.float32).tolist(), label) for i, (v, label) in enumerate(out)]


def odd_rows(dim=24):
    """Vectors that link with nothing, or only among themselves."""
    one = [1.0] * dim
    return [
        (9001, None, 1),
        (9002, [], 1),
        (9003, [0.0] * dim, 1),
        (9004, [None] + one[1:], 1),
        (9005, [float("nan")] + one[1:], 1),
        (9006, [float("inf")] + one[1:], 1),
        (9007, one, None),
        (9008, one, 7),
        (9008, one, 7),
        (None, [2.0] * dim, 7),
        (9010, [1.0, -0.0], 7),
        (9011, [1.0, 0.0], 7),
        (None, [1e30] * dim, 8),
    ]


def brute_links(rows, similar):
    """n_links and component of each row by all pairs; rows are numbered."""
    usable = [
        i
        for i, (_, v, label) in enumerate(rows)
        if label is not None and v and None not in v and np.isfinite(v).all() and any(v)
    ]
    links = {i: set() for i in range(len(rows))}
    for i in usable:
        for j in usable:
            a, b = np.array(rows[i][1], float), np.array(rows[j][1], float)
            if i != j and rows[i][2] == rows[j][2] and len(a) == len(b):
                if a @ b / np.sqrt(a @ a) / np.sqrt(b @ b) >= similar:
                    links[i].add(j)
    seen, out = {}, []
    for i in links:
        if i not in seen:
            part, stack = {i}, [i]
            while stack:
                for j in links[stack.pop()] - part:
                    part.add(j)
                    stack.append(j)
            least = min((rows[j][0] for j in part if rows[j][0] is not None), default=None)
            seen.update(dict.fromkeys(part, least))
    for i, (vec_id, _, _) in enumerate(rows):
        out.append((vec_id, len(links[i]), seen[i], vec_id == seen[i]))
    return sorted(out, key=str)


@pytest.mark.parametrize("tile_bytes", [1 << 22, 24 * 4 * 20])
def test_links_against_all_pairs(spark, tile_bytes):
    """One tile a label, and many tiles by pivots."""
    rows = invented(tile_bytes % 7) + odd_rows()
    df = spark.createDataFrame(rows, SCHEMA)
    got = embedding_dedup.embedding_dedup(df, tile_bytes=tile_bytes, pivots=5)
    expected = brute_links(rows, 0.98)
    assert sorted((tuple(r) for r in got.collect()), key=str) == expected
    assert sum(r[1] for r in expected) > 200


def test_bounds_hold_and_decide():
    dice = np.random.default_rng(3)
    for dim in (3, 64, 1500):
        centre = dice.standard_normal((1, dim))
        units = embedding_dedup.unit_rows(centre + dice.standard_normal((200, dim)) * 0.1)
        kept = embedding_dedup.Quantised(units)
        lower, upper = kept.bounds(slice(0, 100), kept, slice(100, 200))
        exact = units[:100] @ units[100:].T
        assert (lower <= exact).all() and (exact <= upper).all()
        assert (upper - lower).max() < 0.1
        for similar in (0.9, 0.98, float(np.median(exact))):
            linked = embedding_dedup.block_links(units[:100], units[100:], (lower, upper), similar)
            assert (linked == (exact >= similar)).mean() == 1.0


def test_parts_of_a_chain_and_a_clique():
    linked = np.zeros((50, 50), bool)
    linked[np.arange(49), np.arange(1, 50)] = True
    parts = embedding_dedup.Parts(50)
    parts.unite(linked | linked.T, range(50), range(50))
    assert set(parts.roots(range(50)).tolist()) == {0}
    parts = embedding_dedup.Parts(8)
    parts.unite(np.eye(4, dtype=bool), range(4), range(4, 8))
    assert parts.roots(range(8)).tolist() == [0, 1, 2, 3, 0, 1, 2, 3]


def test_vectors_of_clashing_and_empty_tables(spark):
    rows = [(*row, "x", "y", 1, 2) for row in invented(5, rows=60)[:60] + odd_rows()]
    for operator in (embedding_dedup.embedding_dedup, whitening.whiten):
        df = spark.createDataFrame(rows, CLASHING)
        plain = operator(spark.createDataFrame([row[:3] for row in rows], SCHEMA))
        assert sorted(map(str, operator(df).collect())) == sorted(map(str, plain.collect()))
        empty = operator(df.limit(0))
        assert empty.dtypes == plain.dtypes and empty.collect() == []
    wide = spark.createDataFrame([row[:3] for row in rows], SCHEMA.replace("float", "double"))
    assert embedding_dedup.embedding_dedup(wide).count() == len(rows)


@pytest.mark.parametrize(("dim", "wanted"), [(1, 3), (5, 16), (60, 6), (200, 10)])
def test_eigenpairs_against_lapack(dim, wanted):
    dice = np.random.default_rng(dim)
    root = dice.standard_normal((dim, dim)) * np.exp(-np.arange(dim) / dim)
    matrix = root @ root.T
    found = whitening.jacobi_davidson(lambda block: matrix @ block, dim, wanted)
    exact = np.linalg.eigvalsh(matrix)[::-1][: min(dim, wanted)]
    assert np.abs(found.values - exact).max() < 1e-13 * exact[0] * dim
    assert found.residuals.max() < 1e-12 * exact[0]
    gram = found.vectors.T @ found.vectors
    assert np.abs(gram - np.eye(len(exact))).max() < 1e-13
    assert np.linalg.norm(matrix @ found.vectors - found.vectors * found.values) < 1e-11 * exact[0]


def test_eigenpairs_of_equal_eigenvalues():
    matrix = np.diag(np.array([7.0] * 9 + [1.0] * 50 + [0.0] * 21))
    found = whitening.jacobi_davidson(lambda block: matrix @ block, 80, 16)
    assert np.allclose(found.values, [7.0] * 9 + [1.0] * 7, atol=1e-13)


def test_inner_solver_on_an_indefinite_system():
    dice = np.random.default_rng(8)
    turned = np.linalg.qr(dice.standard_normal((30, 30)))[0]
    matrix = turned @ np.diag(np.linspace(-3, 5, 30)) @ turned.T
    right = dice.standard_normal((30, 4))
    right[:, 2] = 0
    found = whitening.minres(lambda block: matrix @ block, right, 200, 1e-12)
    assert np.abs(matrix @ found - right).max() < 1e-8


def brute_whitened(rows, dim):
    x = [
        (i, np.floor(64 * np.array(v, np.float32).astype(float)).astype(int) + 10**6)
        for i, v, _ in rows
        if v and len(v) == dim and None not in v and np.isfinite(v).all() and max(map(abs, v)) < 1e7
    ]
    every = np.array([v for _, v in x])
    fit = np.unique(every, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = (n * fit - sums) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:16], vectors[:, ::-1][:, :16]
    project = vectors / np.sqrt(values)
    trace = (centred**2).sum() / n
    return [i for i, _ in x], n, (n * every - sums) ** 2, ((n * every - sums) / n) @ project, values / trace


def test_whitening_against_lapack(spark):
    rows = invented(4) + odd_rows()
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    ids, n, deviations, whitened, explained = brute_whitened(rows, 24)
    assert len(got) == len(ids) * 16 and {r.n for r in got} == {n}
    assert n < len(ids)  # repeated rows are fitted once
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-10
    expected = sorted(zip(ids, deviations.sum(axis=1).tolist(), strict=True), key=str)
    assert sorted(((r.vec_id, r.deviation) for r in got if r.component == 1), key=str) == expected
    for k in range(16):
        mine = sorted((str(r.vec_id), r.whitened) for r in got if r.component == k + 1)
        theirs = sorted((str(i), w) for i, w in zip(ids, whitened[:, k].tolist(), strict=True))
        turned = sorted((str(i), -w) for i, w in zip(ids, whitened[:, k].tolist(), strict=True))
        near = lambda a, b: [x for x, _ in a] == [x for x, _ in b] and np.allclose(
            [y for _, y in a], [y for _, y in b], atol=1e-8
        )
        assert near(mine, theirs) or near(mine, turned)
        assert abs({r.explained for r in got if r.component == k + 1}.pop() - explained[k]) < 1e-12


def test_whitening_of_few_rows(spark):
    """One distinct vector has no direction, two have one."""
    one = [(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0), (3, None, 0)]
    assert whitening.whiten(spark.createDataFrame(one, SCHEMA)).collect() == []
    two = [*one, (4, [3.0, 2.0], 0), (5, [9.0], 0)]
    got = whitening.whiten(spark.createDataFrame(two, SCHEMA)).orderBy("vec_id").collect()
    assert [(r.vec_id, r.component, r.n, r.deviation) for r in got] == [(i, 1, 2, 128**2) for i in (1, 2, 4)]
    assert np.allclose(np.abs([r.whitened for r in got]), 1) and got[0].whitened == -got[2].whitened


def test_deviations_are_exact_or_null():
    x = np.array([[2**31 - 1, 0], [5, 7]], np.int64)
    small = whitening._deviations(np.array([[3, 4]]), 3, [3, 6])
    assert small == [(9 - 3) ** 2 + (12 - 6) ** 2]
    n = 1 << 31
    assert whitening._deviations(x, n, [0, 0])[0] is None
    assert whitening._deviations(np.array([[1, 1]]), n, [n - 3, n + 4]) == [9 + 16]
    assert np.allclose(whitening._centred(np.array([[10**6 + 1]]), n, [n * 10**6 + 7]), 1 - 7 / n, rtol=1e-15)
