import random

import pytest
from pyspark.sql import functions as F

from rallyframe.llm import va_topk as T
from rallyframe.llm.common import prepare

INF, NAN = float("inf"), float("nan")


def plain(rows, k, every=20):
    """Brute force: longest and greatest vector per id, scores to all others of its length."""
    sound = {}
    for i, v in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        if v is not None and all(x is not None and x - x == 0 for x in v):
            w = [int(64 * float(__import__("numpy").float32(x)) // 1) for x in v]
            sound[i] = max(w, sound.get(i, w), key=lambda x: (len(x), x))
    out = []
    for q in sound:
        if q % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(sound[q], v)), i) for i, v in sound.items() if i != q and len(v) == len(sound[q]))
            out += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def found(spark, rows, k=20):
    prepare(spark)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("own")).withColumn("v", F.lit(1))
    got = T.top_k(frame, F.col("vec_id") % 20 == 0, k, value=lambda x: T.whole_part(x.cast("double") * 64))
    return sorted((r.query_id, r["rank"], r.vec_id, int(r.score)) for r in got.collect())


def vectors(seed, n, size):
    draw = random.Random(seed)
    return [(i, [draw.choice([-0.5, -0.25, 0.125, 0.25, 0.375, 0.5]) * draw.random() for _ in range(size)]) for i in range(n)]


@pytest.mark.parametrize("query_rows, vector_rows, cells", [(2048, 16384, 32), (3, 50, 4), (4, 64, 2)])
def test_equals_brute_force(spark, monkeypatch, query_rows, vector_rows, cells):
    for name, value in (("QUERY_ROWS", query_rows), ("VECTOR_ROWS", vector_rows), ("CELLS", cells)):
        monkeypatch.setattr(T, name, value)
    rows = [(i, [round(x, 3) for x in v]) for i, v in vectors(cells, 260, 6)]
    as_floats = [(i, list(map(float, __import__("numpy").float32(v)))) for i, v in rows]
    assert found(spark, as_floats) == plain(as_floats, 20)


def test_ties_copies_and_few_candidates(spark):
    same = [(i, [0.5, -0.25]) for i in range(0, 90)] + [(100, [0.5, 0.5]), (101, [-1.0, 0.0])]
    assert found(spark, same) == plain(same, 20)
    few = [(0, [1.0]), (3, [1.0]), (20, [-1.0])]
    assert found(spark, few) == plain(few, 20) and len(plain(few, 20)) == 4
    assert found(spark, [(0, [1.0])]) == []


def test_odd_vectors(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [None, 1.0]), (3, [NAN, 1.0]), (4, [INF, 1.0]), (5, [1.0]), (None, [1.0, 1.0]), (6, []), (7, [0.5, -3.0]),
            (7, [0.5, -3.0]), (8, [0.5, 1.0]), (8, [0.75, 0.0]), (20, [0.0, 0.0])]
    assert found(spark, rows) == plain(rows, 20)
    assert found(spark, []) == [] and found(spark, [(0, None)]) == []


def test_every_finite_vector_takes_part(spark):
    """Several lengths, the empty one first, and components whose products no long or double holds."""
    rows = [(0, []), (1, []), (20, []), (40, [1.0]), (41, [0.5])] + [(i + 60, v) for i, v in vectors(1, 60, 3)] + [(i + 200, v) for i, v in vectors(2, 40, 5)]
    rows += [(300, [1e10, -1e10, 3.0]), (301, [1e10, 1e10, 0.25]), (302, [-1e10, 2.0, 1e-3]), (303, [1.5e10, 1.5e10, 0.5])]
    assert found(spark, rows) == plain(rows, 20)
    with pytest.raises(Exception, match="not below"):
        found(spark, [(0, [1e30]), (1, [1.0])])


def test_bounds_hold_and_rule_out(spark):
    prepare(spark)
    rows = spark.createDataFrame([(i, [float(int(64 * x)) for x in v]) for i, v in vectors(5, 400, 16)], "vec_id long, v array<double>")
    cells = T.fit_cells(rows)
    held = T.candidates(rows.where("vec_id % 50 = 0"), T.approximate(rows, cells), cells, 5).collect()
    values = {r.vec_id: r.v for r in rows.collect()}
    for r in held:
        score = sum(a * b for a, b in zip(values[r.query_id], values[r.vec_id]))
        assert r.low <= score <= r.high
    assert len(held) < 0.5 * 8 * 400
