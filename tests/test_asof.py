import random

import pytest
from pyspark.sql import functions as F

from rallyframe.operators.asof import as_of
from rallyframe.operators.components import components


def plain(left, right, inclusive):
    out = []
    for key, t, u, name in left:
        before = [(rt, ru, v) for k, rt, ru, v in right if k == key and ((rt, ru) < (t, u) or inclusive and (rt, ru) == (t, u))]
        out.append((key, t, u, name, max(before)[2] if before else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("inclusive", [False, True])
def test_as_of_equals_looking_for_the_last_row(spark, inclusive):
    """One key holds most rows and is spread over all partitions; keys and values may be null."""
    draw = random.Random(6)
    key = lambda: draw.choice(["hot"] * 8 + ["a", "b", None])
    right = list({(k, t, u): (k, t, u, draw.choice([None, 1, 2, 3])) for k, t, u in ((key(), draw.randrange(50), draw.randrange(4)) for _ in range(300))}.values())
    left = [(key(), draw.randrange(-3, 55), draw.randrange(4), f"r{i}") for i in range(200)] + [("gone", 60, 0, "x")]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several ranges
    try:
        found = as_of(spark.createDataFrame(left, "k string, t int, u int, name string"), spark.createDataFrame(right, "k string, t int, u int, v int"), ["k"], ["t", "u"], ["v"], inclusive)
        got = sorted(((r.k, r.t, r.u, r.name, r.v) for r in found.collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == plain(left, right, inclusive)


def test_as_of_empty_tables(spark):
    none = spark.createDataFrame([], "k string, t int, v int")
    one = spark.createDataFrame([("a", 1)], "k string, t int")
    assert [r.v for r in as_of(one, none, ["k"], ["t"], ["v"]).collect()] == [None]
    assert as_of(none.drop("v"), none, ["k"], ["t"], ["v"]).count() == 0


def test_components_equal_a_plain_search(spark):
    draw = random.Random(3)
    edges = [(draw.randrange(400), draw.randrange(400)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1060)] + [(7, 7)]
    group = {}
    for a, b in edges:
        ga, gb = group.setdefault(a, {a}), group.setdefault(b, {b})
        if ga is not gb:
            ga |= gb
            for x in gb:
                group[x] = ga
    want = {x: min(g) for x, g in group.items() if min(g) != x}
    found = components(spark.createDataFrame(edges, "x long, y long"), "x", "y")
    assert {r.node: r.root for r in found.collect()} == want
    assert components(spark.createDataFrame([], "x long, y long"), "x", "y").count() == 0
    assert found.where(F.col("node") <= F.col("root")).count() == 0
