import numpy as np
import pytest

from rallyframe.llm import whitening as W
from rallyframe.llm.common import prepare
from rallyframe.llm.queries import QUERIES


def plain(rows, components=16):
    """Numpy's eigenvectors of each length's covariance: {size: (n, sums, ids, x, values, vectors, trace)}."""
    by_size = {}
    for i, v in rows:
        if v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v):
            by_size.setdefault(len(v), []).append((i, [int(np.floor(64 * float(c))) + 1_000_000 for c in v]))
    out = {}
    for size, own in by_size.items():
        x = np.array([v for _, v in own], np.int64)
        once = np.unique(x, axis=0)
        away = (len(once) * once - once.sum(0)) / len(once)
        values, vectors = np.linalg.eigh(away.T @ away / len(once))
        out[size] = (len(once), once.sum(0), [i for i, _ in own], x, values[::-1][:components], vectors[:, ::-1][:, :components], values.sum())
    return out


def agree(found, rows):
    want = plain(rows)
    got = {}
    for r in found:
        got.setdefault((r.n, r.component), []).append(r)
    for n, sums, ids, x, values, vectors, trace in want.values():
        real = values > 1e-10 * trace
        for j in np.flatnonzero(real):
            own = got.pop((n, j + 1))
            away = (n * x - sums) / n
            white = away @ vectors[:, j] / np.sqrt(values[j])
            mine = {}
            for r in own:
                mine.setdefault(r.vec_id, []).append(r)
            sign = None
            for i, w, d in zip(ids, white, ((n * x - sums) ** 2).sum(1)):
                r = next(r for r in mine[i] if r.deviation == d)
                mine[i].remove(r)
                sign = sign or (1 if r.whitened * w >= 0 else -1) if abs(w) > 1e-3 else sign
                assert r.whitened == pytest.approx((sign or 1) * w, abs=1e-7)
                assert r.explained == pytest.approx(values[j] / trace, rel=1e-9) and r.identity_error < 1e-8
            assert not any(mine.values())
    assert not got


def run(spark, rows):
    prepare(spark)
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    return W.whiten(vectors, W.fit(W.distinct_vectors(vectors, "embedding"))).collect()


def test_query_equals_numpy(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    agree(QUERIES["op12_whitening"](spark, sf).collect(), rows)


def test_odd_vectors(spark):
    """Nulls, no entries, two lengths, repeats, fewer vectors than dimensions, no variance at all."""
    draw = np.random.default_rng(1)
    rows = [(i, draw.standard_normal(5).tolist()) for i in range(40)] + [(100 + i, draw.standard_normal(12).tolist()) for i in range(7)]
    rows += [(i + 200, rows[3][1]) for i in range(30)] + [(7, rows[3][1]), (300, None), (301, []), (302, [1.0, None, 1.0, 1.0, 1.0]), (303, [float("nan")] * 5), (304, [float("inf")] * 12), (305, [1.0, 2.0, 3.0])]
    agree(run(spark, rows), rows)
    assert run(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])]) == [] and run(spark, [(1, None)]) == []


def test_large_entries(spark):
    """Deviations that no long holds are null; what no long holds at all is an error."""
    found = run(spark, [(1, [1e8, 0.0]), (2, [0.0, 3e4]), (3, [0.0, -4e4])])
    assert len(found) == 6 and all(r.deviation is None for r in found) and found[0].identity_error < 1e-6
    with pytest.raises(Exception, match="beyond"):
        run(spark, [(1, [3e20]), (2, [1.0])])


@pytest.mark.parametrize("kind", ["plain", "decay", "equal", "thin"])
def test_eigenvectors_of_larger_matrices(kind):
    """Spaces that must restart, close, equal and missing eigenvalues."""
    draw, d = np.random.default_rng(4), 220
    turn, _ = np.linalg.qr(draw.standard_normal((d, d)))
    values = {"plain": draw.uniform(1, 2, d), "decay": 1 / np.arange(1.0, d + 1), "equal": np.where(np.arange(d) < 20, 5.0, 1.0), "thin": np.where(np.arange(d) < 6, 3.0, 0.0)}[kind]
    matrix = (turn * values) @ turn.T
    found, vectors = W.principal(lambda b: matrix @ b, d, 16)
    want = np.sort(values)[::-1][:16]
    assert np.abs(found - want).max() < 1e-12 * want[0]
    assert np.linalg.norm(matrix @ vectors - vectors * found, axis=0).max() < 2e-12 * want[0]
    assert np.abs(vectors.T @ vectors - np.eye(16)).max() < 1e-12


def test_minres_solves():
    draw = np.random.default_rng(2)
    matrix = draw.standard_normal((30, 30))
    matrix = matrix + matrix.T
    right = draw.standard_normal((30, 4))
    assert np.allclose(matrix @ W.minres(lambda p: matrix @ p, right, 60), right, atol=1e-6)
