import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rallyframe.llm import language_id as lid
from rallyframe.llm.common import prepare
from rallyframe.llm.queries import QUERIES

from .conftest import FRENCH, WORDS, prose


@pytest.fixture(scope="module")
def model(spark):
    prepare(spark)
    rows = [(i, prose(i, 80, w), lang) for i in range(40) for w, lang in ((WORDS, "en"), (FRENCH, "fr"), ("и в на река камень свет окно сад музыка".split(), "ru"))]
    return lid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def best_by_trying(scores, switch):
    paths = itertools.product(range(scores.shape[1]), repeat=len(scores))
    return max(sum(scores[t, k] for t, k in enumerate(p)) - switch * sum(a != b for a, b in zip(p, p[1:])) for p in paths)


@pytest.mark.parametrize("n", [1, 2, 7, 9])
def test_viterbi_is_the_best_path(n):
    rng = np.random.default_rng(n)
    scores = rng.normal(0, 3, (n, 3)).astype(np.float32)
    path = lid.viterbi(scores, np.zeros(n, int), 1, 2.0)
    got = scores[np.arange(n), path].sum() - 2.0 * np.count_nonzero(np.diff(path))
    assert got == pytest.approx(best_by_trying(scores, 2.0), abs=1e-4)


@pytest.mark.parametrize(("languages", "table"), [(4, lid.TABLE), (4, 0), (300, lid.TABLE), (300, 0)])
def test_viterbi_over_blocks_and_texts_equals_word_by_word(monkeypatch, languages, table):
    """Both ways, and with more languages than a byte numbers."""
    monkeypatch.setattr(lid, "TABLE", table)
    rng = np.random.default_rng(3)
    sizes = [0, 1, 31, 32, 33, 200, 0, 5]
    doc = np.repeat(np.arange(len(sizes)), sizes)
    scores = rng.normal(0, 2, (len(doc), languages)).astype(np.float32)
    path = lid.viterbi(scores, doc, len(sizes), 3.0)
    for d in range(len(sizes)):
        own, got = scores[doc == d].astype(float), path[doc == d]
        value = None
        for x in own:
            value = x if value is None else x + np.maximum(value, value.max() - 3.0)
        if len(own):
            total = own[np.arange(len(own)), got].sum() - 3.0 * np.count_nonzero(np.diff(got))
            assert total == pytest.approx(value.max(), abs=1e-3)


def test_mixed_text_gives_spans(spark, model):
    a, b, c = prose(100, 40, FRENCH), prose(101, 25), prose(102, 12, "река камень свет окно музыка".split())
    text = f"{a} {b}. {c}"
    row = lid.label_languages(spark.createDataFrame([(text,)], "text string"), model).first()
    assert [s.lang for s in row.spans] == ["fr", "en", "ru"] and row.lang_pred == "fr"
    assert row.spans[0].start == 0 and row.spans[-1].end == len(text)
    assert text[row.spans[2].start:row.spans[2].end] == c
    letters = [sum(ch.isalpha() for ch in x) for x in (a, b, c)]
    assert row.score == pytest.approx(letters[0] / sum(letters))


def test_script_excludes_languages(spark, model):
    row = lid.label_languages(spark.createDataFrame([("зззщщ " * 3 + "und",)], "text string"), model).first()
    assert row.lang_pred == "ru"


def test_odd_texts(odd, clashing, none, model):
    rows = lid.label_languages(odd, model).collect()
    got = {(r.doc_id, r.source): (r.lang_pred, r.score, len(r.spans)) for r in rows}
    assert len(rows) == odd.count()
    assert got[(1, None)] == got[(2, "s")] == got[(3, "s")] == got[(4, "s")] == got[(None, None)] == ("und", 0.0, 0)
    assert got[(5, "s")][0] == "en" and got[(7, "s")][0] == "en" and got[(9, "s")][0] == "fr"
    assert got[(11, "s")][0] in model.languages and got[(11, "s")][1] == 0.0     # a letter of no known script
    again = lid.label_languages(clashing, model)
    assert sorted(map(str, again.select("doc_id", "lang_pred", "score").collect())) == sorted(map(str, lid.label_languages(odd, model).select("doc_id", "lang_pred", "score").collect()))
    assert again.columns.count("score") == 1 and again.first().blob == "own blob"
    assert lid.label_languages(none, model).count() == 0
    kept = lid.keep_identified(clashing, model)
    assert kept.columns == clashing.columns and {r.doc_id for r in kept.collect()} == {None, 5, 6, 7, 8, 9, 10, 12}
    assert kept.where("doc_id IS NULL").count() == 1


def test_nothing_to_learn(odd, none):
    empty = lid.fit(none)
    assert {r.lang_pred for r in lid.label_languages(odd, empty).collect()} == {"und"}


def test_a_text_is_labelled_alike_in_any_batch(spark, model):
    texts = [prose(i, random.Random(i).randrange(1, 90), random.Random(i).choice([WORDS, FRENCH])) for i in range(60)]
    together = lid.label_languages(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string").coalesce(1), model)
    alone = lid.label_languages(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string").repartition(60, "i"), model)
    assert sorted(together.drop("text").collect()) == sorted(alone.drop("text").collect())


def test_held_out_accuracy(spark, sf):
    found = QUERIES["op1_language_id"](spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    assert found.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.95
    assert found.where("score < 0 OR score > 1 OR score IS NULL").count() == 0
