import random

import pytest
from pyspark.sql import functions as F

from rallyframe.llm import decontaminate as D
from rallyframe.llm.common import prepare

from .conftest import prose


def plain_words(text):
    words, word = [], ""
    for c in (text or "") + " ":
        c = chr(ord(c) + 32) if "A" <= c <= "Z" else c
        if "0" <= c <= "9" or "a" <= c <= "z" or ord(c) > 0x7F:
            word += c
        elif word:
            words.append(word)
            word = ""
    return words


def plain(docs, items):
    windows = []
    for i, text in items:
        w = plain_words(text)
        windows += [("" if i is None else str(i), w[s:s + 10]) for s in range(max(1, len(w) - 9)) if w]
    out = []
    for d, text in docs:
        w, hit, ids = plain_words(text), set(), set()
        for item, own in windows:
            for s in range(len(w) - len(own) + 1):
                if w[s:s + len(own)] == own:
                    hit.update(range(s, s + len(own)))
                    ids.add(item)
        out.append((d, len(w), len(hit), len(ids), ",".join(sorted(ids)), bool(hit)))
    return sorted(out, key=str)


def found(spark, docs, items, **kw):
    prepare(spark)
    frame = D.find_contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), keep=["doc_id"], **kw)
    return sorted((tuple(r) for r in frame.select("doc_id", "n_words", "n_hit", "n_items", F.array_join("item_ids", ","), "contaminated").collect()), key=str)


ITEMS = [(1, prose(1, 25)), (2, prose(2, 10)), (10, prose(1, 25)), (3, "lone"), (4, "Two words!"), (5, "!!"), (6, None), (None, "a null id"), (7, "la la la la la la la la la la la la"), (8, "Ärger über Öl ÄRGER")]


def planted():
    draw = random.Random(6)
    docs = [(0, None), (1, ""), (2, "la " * 40), (3, "two-words, LONE; a null ID"), (4, "la " * 9), (5, "Ärger über öl ärger über Öl Ärger"), (6, "Ärger über Öl ÄRGER x")]
    for i in range(10, 40):
        words = prose(i + 100, draw.randrange(1, 60)).split()
        at, source = draw.randrange(len(words)), prose(draw.choice((1, 2)), 25 if i % 2 else 10).split()
        a = draw.randrange(len(source))
        words[at:at] = [w.upper() + "," for w in source[a:a + draw.randrange(5, 25)]]
        docs.append((i, " ".join(words)))
    return docs


@pytest.mark.parametrize("patterns", [1_000_000, 7])
def test_equals_plain_search(spark, patterns):
    """Also when the windows need several passes."""
    assert found(spark, planted(), ITEMS, patterns=patterns) == plain(planted(), ITEMS)


@pytest.mark.parametrize("size", [1, 2, 3, 10])
def test_scanner_finds_every_occurrence(size):
    draw = random.Random(size)
    words = [draw.choice([b"a", b"b", b"c"]) for _ in range(3000)]
    windows = {tuple(draw.choice([b"a", b"b", b"c"]) for _ in range(size)): (str(i),) for i in range(40)} | {tuple(words[50:50 + size]): ("own",)}
    got = list(D.Scanner.build(size, windows).search(words))
    assert got == [(s, windows[tuple(words[s:s + size])]) for s in range(len(words) - size + 1) if tuple(words[s:s + size]) in windows]


def test_scanner_moves_on_by_blocks():
    class Counted(list):
        read = 0

        def __getitem__(self, at):
            Counted.read += 1
            return super().__getitem__(at)

    words = Counted(b"w%d" % i for i in range(9000))
    assert list(D.Scanner.build(10, {tuple(b"v%d" % i for i in range(10)): ("1",)}).search(words)) == []
    assert Counted.read <= 1001


def test_odd_texts(spark, odd, odd_rows, clashing, none):
    prepare(spark)
    items = spark.createDataFrame([(1, prose(5)), (2, "xxx"), (3, "wind and the river")], "item_id long, text string")
    want = plain([r[:2] for r in odd_rows], [tuple(r) for r in items.collect()])
    made = ("doc_id", "n_words", "n_hit", "n_items", F.array_join("item_ids", ","), "contaminated")
    for patterns in (1_000_000, 9):
        again = D.find_contamination(clashing, items, patterns=patterns)
        assert sorted((tuple(r) for r in again.select(*made).collect()), key=str) == want
        assert again.columns.count("n_words") == 1 and again.first().hits_0 == "own hits_0"
    assert D.find_contamination(none, items).count() == 0
    assert D.find_contamination(odd, items.where("false")).where("contaminated").count() == 0
