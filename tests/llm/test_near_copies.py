import random

import pytest

from rallyframe.llm import near_copies as N
from rallyframe.llm.common import prepare

from .conftest import prose


def plain_shingles(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def plain_kept(rows):
    """Smallest ids of the groups, by trying all pairs of distinct sets."""
    least = {}
    for i, text in rows:
        s = plain_shingles(text)
        least[s] = min(i, least.get(s, i))
    sets = list(least)
    group = list(range(len(sets)))
    for x, a in enumerate(sets):
        for y in range(x):
            b = sets[y]
            if 5 * min(len(a), len(b)) >= 4 * max(len(a), len(b)) and 5 * len(a & b) >= 4 * len(a | b) and group[x] != group[y]:
                group = [group[y] if g == group[x] else g for g in group]
    return {min(least[s] for s, g in zip(sets, group) if g == one) for one in set(group)}


def changed(draw, text, times):
    words = text.split()
    for _ in range(times):
        words[draw.randrange(len(words))] = f"new{draw.randrange(1000)}"
    return " ".join(words)


def corpus():
    """Copies on both sides of the border, chains, a dense group, common passages and short texts."""
    draw, words = random.Random(3), [f"w{i}" for i in range(300)]
    shared = prose(99, 40, words)
    texts = [prose(i, draw.randrange(20, 150), words) for i in range(60)]
    texts += [f"{t} {shared}" for t in texts[:20]]
    for t in texts[:50]:
        texts += [changed(draw, t, draw.randrange(1, 5)) for _ in range(2)]
    dense = prose(100, 120, words)
    texts += [changed(draw, dense, draw.randrange(4)) for _ in range(60)]
    for _ in range(8):
        texts.append(changed(draw, texts[-1], 2))
    texts += ["", None, " ", "one two", "One  two", "one two three", "a b c d e", "a b c d e f", "a b c d e f g h i j", "a b c d e f g h i j k"]
    draw.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize(("long", "few"), [(N.LONG, N.BROADCAST), (1, 0), (1 << 30, 0)])
def test_stage_equals_trying_all_pairs(spark, monkeypatch, long, few):
    """Whichever shingles come last, and with joins by shuffles alone: the order decides the cost only."""
    prepare(spark)
    monkeypatch.setattr(N, "LONG", long)
    monkeypatch.setattr(N, "BROADCAST", few)
    rows = corpus()
    kept = N.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.doc_id for r in kept) == sorted(plain_kept(rows))
    assert all(rows[r.doc_id][1] == r.text for r in kept)


def test_pipeline_stage_on_the_given_table(spark):
    """Document pairs such as 2 and 547 differ in more than three bits of their fingerprints."""
    import corpus_pipeline as P

    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert sorted(r.doc_id for r in P.deduplicate(spark, docs, sf).select("doc_id").collect()) == sorted(plain_kept(rows))


def test_odd_texts(spark, clashing, none):
    prepare(spark)
    kept = N.keep_one(clashing)
    assert kept.columns == clashing.columns
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(map(str, [1, 4, None, 5, 7, 8, 9, 10, 11, 12]))
    assert N.keep_one(none).count() == 0


def test_vantage_point_trees_take_part(spark, monkeypatch):
    """The stage's method: links within three bits come from the trees; what they link is confirmed by the texts."""
    made = []
    monkeypatch.setattr(N, "tree_links", lambda classes, real=N.tree_links: made.append(real(classes)) or made[-1])
    line = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join([*line[:i], "x", *line[i + 1:]])) for i in range(0, 40, 4)] + [(100, "other words here"), (101, None)]
    kept = N.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id for r in kept} == {0, 100, 101} and made[0].count() > 0
