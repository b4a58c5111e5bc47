import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from rallyframe.llm import simhash_vp as V
from rallyframe.llm.common import prepare
from rallyframe.llm.queries import QUERIES

from .conftest import prose


def plain_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in lowered + " ":
        if c in " \t\n\v\f\r":
            words += [word] if word else []
            word = ""
        else:
            word += c
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(fps):
    """Smallest member of each code's group, by trying all pairs."""
    codes = sorted(set(fps))
    group = {c: c for c in codes}

    def root(c):
        while group[c] != c:
            c = group[c]
        return c

    for i, a in enumerate(codes):
        for b in codes[:i]:
            if (a ^ b).bit_count() <= 3:
                x, y = sorted((root(a), root(b)))
                group[y] = x
    return {c: root(c) for c in codes}


def near(draw, code, bits):
    for b in draw.sample(range(64), bits):
        code ^= 1 << b
    return code


def codes_with_groups(seed, n):
    draw = random.Random(seed)
    codes = [draw.getrandbits(64) for _ in range(n)]
    for code in codes[:n // 5]:
        codes += [near(draw, code, draw.randrange(1, 6)) for _ in range(3)]
    centre = draw.getrandbits(64)
    codes += [near(draw, centre, draw.randrange(4)) for _ in range(n // 3)]     # a dense group
    chain = centre ^ 0xFFFFFFFF
    for _ in range(n // 20):                                                    # and a long chain
        chain = near(draw, chain, 3)
        codes.append(chain)
    return sorted(set(codes))


@pytest.mark.parametrize("text", ["", None, " \n", "One", "one TWO", "one two three", "Ä É ä a b c", "x y z\vx y z\fx", prose(3, 70_000)])
def test_fingerprint(text):
    assert V.fingerprint(text) == plain_fingerprint(text)


def test_spark_hash_is_the_shingle_hash(spark):
    assert spark.sql("SELECT xxhash64('one two three')").first()[0] % (1 << 64) == V.fingerprint("One  two\tthree")


@pytest.mark.parametrize("seed", range(4))
def test_trees_lose_no_near_pair(seed):
    codes = np.array(codes_with_groups(seed, 400), np.uint64)
    trees = [V.grow(V._half(codes, w), 5) for w in range(2)]
    row, shard, home = V._placed(codes, trees)
    seen = [set() for _ in codes]
    for r, s in zip(row, shard):
        seen[r].add(s)
    own = [{s for r, s, h in zip(row, shard, home) if h and r == i} for i in range(len(codes))]
    for i, a in enumerate(codes):
        for j, b in enumerate(codes[:i]):
            if int(a ^ b).bit_count() <= 3:
                assert (own[i] & seen[j]) | (own[j] & seen[i])


@pytest.mark.parametrize("cells", [1 << 20, 200])
def test_spanning_links_are_the_groups(monkeypatch, cells):
    monkeypatch.setattr(V, "CELLS", cells)
    codes = codes_with_groups(9, 300)
    a, b = V.spanning(np.array(codes, np.uint64), np.ones(len(codes), bool))
    want = plain_groups(codes)
    assert dict(zip(a.tolist(), b.tolist())) == {c: r for c, r in want.items() if c != r}


@pytest.mark.parametrize("rows", [50_000, 40])
def test_components_equal_trying_all_pairs(spark, monkeypatch, rows):
    """Also with shards cut into many blocks."""
    prepare(spark)
    monkeypatch.setattr(V, "SHARD_ROWS", rows)
    monkeypatch.setattr(V, "LEAF", 32)
    codes = codes_with_groups(11, 500)
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    links = V.links(spark.createDataFrame([(c,) for c in signed], "fp long"))
    found = {r.a % (1 << 64): r.root % (1 << 64) for r in V.components(links).collect()}
    want = plain_groups(codes)
    groups = lambda of: {frozenset(c for c in codes if of(c) == r) for r in map(of, codes)}
    assert groups(lambda c: found.get(c, c)) == groups(lambda c: want[c])
    assert links.count() <= 40 * len(codes)      # not all pairs of the dense group


def test_components_of_a_long_path(spark):
    prepare(spark)
    edges = spark.range(300).select((F.col("id") * 7 % 301).alias("a"), ((F.col("id") + 1) * 7 % 301).alias("b"))
    assert {r.root for r in V.components(edges).collect()} == {0}


def expected(rows):
    fps = [plain_fingerprint(t) for _, t in rows]
    root = plain_groups(fps)
    least = {}
    for (i, _), f in zip(rows, fps):
        if i is not None:
            least[root[f]] = min(i, least.get(root[f], i))
    return sorted(str((i, f"{f:016x}", least.get(root[f]))) for (i, _), f in zip(rows, fps))


def test_query_equals_trying_all_pairs(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op6_simhash"](spark, sf).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted(str(tuple(r)) for r in got) == expected(docs)


def test_odd_texts(spark, odd, odd_rows, clashing, none):
    prepare(spark)
    for docs in (odd, clashing):
        got = V.near_duplicates(docs).select("id", F.lower(F.lpad(F.hex("fp"), 16, "0")), "component_id").collect()
        assert sorted(str(tuple(r)) for r in got) == expected([r[:2] for r in odd_rows])
    kept = V.keep_one(clashing)
    assert kept.columns == clashing.columns
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(map(str, [1, 4, None, 5, 7, 8, 9, 10, 11, 12]))
    assert V.near_duplicates(none).count() == 0 and V.keep_one(none).count() == 0


def test_only_null_ids(spark):
    prepare(spark)
    rows = spark.createDataFrame([(None, "a b c d"), (None, "A b c d"), (None, "other words here now")], "doc_id long, text string")
    assert {r.component_id for r in V.near_duplicates(rows).collect()} == {None}
    assert V.keep_one(rows).count() == 2
