"""Whitening and the pivot-permutation index against brute force."""

import math
from fractions import Fraction

import numpy as np
import pytest

from evgraph.llm import pivot_index, whitening
from evgraph.llm.vectors import matrix

SCHEMA = "vec_id long, embedding array<float>, label int, uid string, component int, n_links string, vec string"


def frame(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], 0, "u", 7, "x", None) for i, v in zip(ids, vectors)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def odd(dim):
    nan, inf = float("nan"), float("inf")
    return [None, [None] + [1.0] * (dim - 1), [nan] * dim, [inf] + [0.0] * (dim - 1)]


def spun(rng, centre, cosine):
    """A vector at the given cosine from a unit one."""
    side = rng.normal(size=len(centre))
    side -= (side @ centre) * centre
    return cosine * centre + math.sqrt(1 - cosine**2) * side / np.linalg.norm(side)


def test_whitening_equals_a_plain_eigendecomposition(spark):
    rng = np.random.default_rng(4)
    mix = rng.normal(size=(12, 12)) * np.linspace(0.02, 0.4, 12)
    given = (rng.normal(size=(300, 12)) @ mix).astype(np.float32)
    given = np.concatenate([given, given[:40]])  # copies count
    rows = whitening.whitened(frame(spark, [*given, *odd(12)])).collect()
    n = len(given)
    x = np.floor(1024 * given.astype(float)).astype(np.int64) + 100_000
    sums = [int(s) for s in x.sum(0)]
    cov = np.cov(x.T.astype(float), bias=True)
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    assert len(rows) == 8 * n and {r.n for r in rows} == {n}
    got = {(r.vec_id, r.component): r for r in rows}
    centred = x - x.mean(0)
    for k in range(8):
        want = centred @ vectors[:, k] / math.sqrt(values[k])
        mine = np.array([got[i, k + 1].whitened for i in range(n)])
        assert min(abs(mine - want).max(), abs(mine + want).max()) < 1e-8
        assert got[0, k + 1].explained == pytest.approx(values[k] / cov.trace(), rel=1e-10)
    for i in range(n):
        far = sum((n * int(a) - s) ** 2 for a, s in zip(x[i], sums))
        assert got[i, 1].deviation == far and int(got[i, 8].deviation_exact) == far
    assert max(r.identity_error for r in rows) < 1e-10


def test_whitening_of_degenerate_tables(spark):
    assert whitening.whitened(frame(spark, [])).count() == 0
    assert whitening.whitened(frame(spark, odd(3))).count() == 0
    assert whitening.whitened(frame(spark, [[1, 2, 3]] * 5)).count() == 0  # no variance, no component
    assert whitening.whitened(frame(spark, [[]] * 3)).count() == 0
    line = whitening.whitened(frame(spark, [[0, 0], [1, 1], [3, 3]])).collect()  # one direction only
    assert {r.component for r in line} == {1} and len(line) == 3
    assert {round(r.explained, 12) for r in line} == {1.0}
    short = whitening.whitened(frame(spark, [[1, 0, 2], [1], [0, 2, 1], [3, 1, 0], []], [None, 1, 1, 2, 3]))
    assert short.columns[:7] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert sorted(str(r.vec_id) for r in short.where("component = 1").collect()) == ["1", "1", "2", "3", "None"]


def test_whitening_stays_exact_for_large_entries(spark):
    given = [[1e12, -3.0], [2e9, 5e11], [-7e11, 1.0], [0.5, 0.25], [1e38, 0.0]]  # the last is past the grid
    rows = whitening.whitened(frame(spark, given)).where("component = 1").orderBy("vec_id").collect()
    x = [[math.floor(Fraction(1024) * Fraction(float(np.float32(c)))) + 100_000 for c in v] for v in given[:4]]
    sums = [sum(c) for c in zip(*x)]
    far = [sum((4 * a - s) ** 2 for a, s in zip(v, sums)) for v in x]
    assert [int(r.deviation_exact) for r in rows] == far
    assert [r.deviation for r in rows] == [f if f < 2**63 else None for f in far]


def test_cholesky_and_jacobi(rng=np.random.default_rng(9)):
    for size, rank in ((1, 1), (2, 2), (7, 7), (9, 4)):
        base = rng.normal(size=(size, rank))
        values, units = whitening.principal(base @ base.T)
        assert units.shape == (size, rank)
        assert np.allclose(units * values @ units.T, base @ base.T, atol=1e-10)
        assert np.allclose(units.T @ units, np.eye(rank), atol=1e-12) and (np.diff(values) <= 1e-9).all()


def brute(vectors, ids, cosine=0.95):
    n = len(vectors)
    length = max((len(v) for v in vectors if v is not None), default=0)
    full, some = np.zeros((n, length)), np.zeros(n, bool)
    for i, v in enumerate(vectors):
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            full[i, : len(v)] = np.asarray(v, np.float32).astype(float)
            some[i] = np.any(full[i] != 0)
    norm = np.sqrt((full * full).sum(1))
    near = (full @ full.T >= cosine * np.outer(norm, norm)) & np.outer(some, some)
    np.fill_diagonal(near, False)
    label = np.arange(n)
    while True:
        fresh = np.minimum(label, np.where(near, label[None, :], n).min(1, initial=n))
        if (fresh == label).all():
            break
        label = fresh
    least = {}
    for i in range(n):
        least.setdefault(label[i], []).append((ids[i] is None, ids[i] if ids[i] is not None else 0))
    return near.sum(1), [min(least[label[i]])[1] if not min(least[label[i]])[0] else None for i in range(n)]


def compared(spark, vectors, ids=None):
    ids = list(range(len(vectors))) if ids is None else ids
    found = pivot_index.near_classes(frame(spark, vectors, ids))
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    key = lambda t: tuple((x is None, x) for x in t)
    mine = sorted(((r.vec_id, r.n_links, r.component_id) for r in found.collect()), key=key)
    n, component = brute(vectors, ids)
    return mine, sorted(((i, int(a), c) for i, a, c in zip(ids, n, component)), key=key)


def groups(rng, dim=48):
    """Unlike vectors, pairs, a tight crowd, a wide one whose members are linked though none lies near its centre, copies."""
    unit = lambda: (lambda v: v / np.linalg.norm(v))(rng.normal(size=dim))
    vectors = [unit() for _ in range(300)]
    for _ in range(30):
        base = unit()
        vectors += [base, 3 * spun(rng, base, 0.975)]
    for apart, size in ((0.995, 150), (0.979, 120)):  # two members are about apart ** 2 from each other
        base = unit()
        vectors += [spun(rng, base, apart) for _ in range(size)]
    vectors += [vectors[0]] * 40 + [2 * vectors[1]] * 3
    return vectors


@pytest.mark.parametrize("block", [16, 1024])
def test_components_and_links_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(pivot_index, "BLOCK", block)
    rng = np.random.default_rng(5)
    vectors = groups(rng) + odd(48) + [[0.0] * 48, [], [1.0], [2.0]]
    mine, want = compared(spark, vectors)
    assert mine == want
    assert max(w[1] for w in want) > 100


def test_recall_at_the_threshold_and_no_false_link(spark):
    rng = np.random.default_rng(6)
    vectors = []
    for _ in range(1500):
        base = rng.normal(size=64)
        base /= np.linalg.norm(base)
        vectors += [base, spun(rng, base, 0.951), spun(rng, base, 0.949)]
    mine, want = compared(spark, vectors)
    found, there = (sum(r[1] for r in rows) for rows in (mine, want))
    assert 0.9 * there <= found <= there
    assert all(a[1] <= b[1] for a, b in zip(mine, want))


def test_crowds_lose_no_pair_of_any_list(spark, monkeypatch):
    rng = np.random.default_rng(8)
    vectors = []
    for _ in range(60):  # pairs and chains around common directions, so that vectors lie in several long lists
        base = spun(rng, np.eye(24)[rng.integers(3)], 0.8)
        vectors += [base, spun(rng, base, 0.955), spun(rng, base, 0.97)]
    monkeypatch.setattr(pivot_index, "CROWD", 10**9)
    every, _ = compared(spark, vectors)
    for crowd in (2, 12):
        monkeypatch.setattr(pivot_index, "CROWD", crowd)
        assert compared(spark, vectors)[0] == every


def test_small_tables_null_and_repeated_keys(spark):
    assert pivot_index.near_classes(frame(spark, [])).count() == 0
    for vectors, ids in (
        ([[1.0, 0.0], [1.0, 0.0], None, [0.0, 1.0], [-0.0, 2.0]], [None, 4, None, 4, 2]),
        ([[1.0, 2.0]], [3]),
        ([None, [0.0]], [2, 1]),
        ([[1.0, 2.0], [2.0, 4.1], [2.0, -1.0]], [5, 5, 5]),
        ([[1e-30, 2e-30], [1e30, 2e30]], [1, 2]),
    ):
        mine, want = compared(spark, vectors, ids)
        assert mine == want
    kept = pivot_index.near_classes(frame(spark, [[1.0, 0.0], [1.0, 0.01], None], [7, 9, None])).collect()
    assert {(r.vec_id, r.kept) for r in kept} == {(7, True), (9, False), (None, True)}


def test_matrix_takes_slices_and_short_vectors():
    import pyarrow as pa

    column = pa.array([[9.0], [1.0, 2.0], None, [3.0], [], [4.0, None]]).slice(1)
    rows, values = matrix(column, 2)
    assert rows.tolist() == [0, 2, 3] and values.tolist() == [[1, 2], [3, 0], [0, 0]]
