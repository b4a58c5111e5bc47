import math
import random
import re

import pytest

from rallyframe.llm import mask_search as M
from rallyframe.llm.common import prepare

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(docs, items, k):
    """Every document scored for every item."""
    held = [(i, terms(t)) for i, t in docs]
    big_n, big_l = sum(bool(w) for _, w in held), sum(len(w) for _, w in held)
    df = {}
    for _, w in held:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    out = []
    for item, text in dict.fromkeys(items):
        asked, found = terms(text), []
        for i, w in held:
            m = 75 + (25 * len(w) * big_n) // big_l if w else 0
            score = sum(math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1))) * ((10**9 * w.count(t)) // (1000 * w.count(t) + 12 * m)) for t in asked if t in w)
            if score > 0:
                found.append((-score, i is None, i or 0))
        out += [(item, rank, None if none else i, -s) for rank, (s, none, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=repr)


def got(spark, docs, items, k, **more):
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    found = M.search(frame, spark.createDataFrame(items, "item_id long, text string"), k, **more).collect()
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in found), key=repr)


def corpus(seed=5):
    """Common and rare words, copies, long texts, and items of few to many terms, repeats and shared ids."""
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(150)]
    pick = lambda n: " ".join(words[min(149, int(draw.expovariate(0.06)))] for _ in range(n))
    docs = [(i, pick(draw.randrange(1, 120))) for i in range(260)]
    docs += [(1000 + i, docs[7][1]) for i in range(60)] + [(2000, pick(5000)), (2001, None), (2002, ""), (2003, "., !"), (None, docs[9][1]), (5, "w3 W3, w149"), (6, "Ünï 12 w2" + "é" * 40)]
    draw.shuffle(docs)
    items = [(i, pick(draw.randrange(1, 60))) for i in range(12)]
    items += [(20, " ".join(words)), (21, docs[7][1]), (22, "W149 w149 w149"), (23, None), (24, "--"), (None, "w5 w140"), (0, "w77"), (0, "w77"), (25, "nowhere"), (26, "ünï " + "é" * 40), (27, "w3.w4 w3 " * 50)]
    return docs, items


@pytest.mark.parametrize("small", [False, True])
def test_equals_scoring_everything(spark, monkeypatch, small):
    """Also with many blocks, one passage of items after another, and no large first look."""
    prepare(spark)
    docs, items = corpus()
    if small:
        monkeypatch.setattr(M, "BLOCK_DOCS", 16)
        monkeypatch.setattr(M, "BLOCK_POSTINGS", 700)
        monkeypatch.setattr(M, "LOOK", 1)
    assert got(spark, docs, items, 7, entries=200 if small else M.ENTRIES) == plain(docs, items, 7)


def test_ties_beyond_k_go_to_smaller_ids(spark):
    prepare(spark)
    docs = [(i, "same words here") for i in range(50, 0, -1)] + [(None, "same words here")] + [(100 + i, "other text") for i in range(60)]
    assert [r[2] for r in got(spark, docs, [(1, "words")], 5)] == [1, 2, 3, 4, 5]
    assert [r[2] for r in sorted(got(spark, docs, [(1, "words")], 60), key=lambda r: r[1])] == [*range(1, 51), None]


def test_equal_hashes_are_told_apart(spark):
    """Terms are confirmed by their bytes: a hash that cannot tell terms apart changes nothing."""
    import numpy as np
    import pyarrow as pa

    class Blind(M.Words):
        def hashes(self, starts, ends):
            return np.zeros(len(starts), np.uint64)

    original, M.Words = M.Words, Blind
    try:
        names = ["a", "b", "abcdefgh", "abcdefghi", "abcdefghj", "xbcdefghijklmnopq"]
        found = M.Vocabulary(names).find(Blind(pa.array(["b abcdefghj z abcdefgh", None, "a xbcdefghijklmnopq xbcdefghijklmnopr"])))
    finally:
        M.Words = original
    assert found.tolist() == [1, 4, -1, 2, 0, 5, -1]


def test_odd_tables(spark, clashing, none, odd_rows):
    prepare(spark)
    items = [(1, "the wind"), (2, "rivière"), (3, "токен 34"), (4, "ª")]
    asked = spark.createDataFrame(items, "item_id long, text string")
    found = sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in M.search(clashing, asked, 3).collect()), key=repr)
    assert found == plain([(r[0], r[1]) for r in odd_rows], items, 3)
    assert M.search(none, asked).count() == 0 and M.search(clashing, asked.where("false")).count() == 0
