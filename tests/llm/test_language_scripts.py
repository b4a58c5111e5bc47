import unicodedata

import pyarrow as pa
import pytest

from rallyframe.llm import language_id as lid
from rallyframe.llm.common import Words, prepare

from .conftest import WORDS, prose

GEORGIAN = "მდინარე ქვა სინათლე ფანჯარა ბაღი მუსიკა ქარი მწვანე".split()
LAO = "ແມ່ນ້ຳ ຫີນ ແສງ ປ່ອງຢ້ຽມ ສວນ ດົນຕີ".split()


@pytest.fixture(scope="module")
def model(spark):
    prepare(spark)
    rows = [(i, prose(i, 80, w), lang) for i in range(30) for w, lang in ((WORDS, "en"), (GEORGIAN, "ka"), (LAO, "lo"))]
    return lid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


@pytest.mark.parametrize("letter", "aéαжմאعनกგကກབខአᠮ한かカ漢𠀀々𐌰Ꭰꦏｱ")
def test_every_letter_has_a_script(letter):
    assert unicodedata.category(letter)[0] == "L"
    assert lid._word_scripts(Words(pa.array([f"12 {letter}"]))).astype(bool).tolist() == [False, True]


@pytest.mark.parametrize("sign", ["12", "٣٤", "१२", "😀", "×", "。", "ª"])
def test_signs_have_none(sign):
    assert not lid._word_scripts(Words(pa.array([sign]))).any()


def test_code_points_share_no_script_by_their_first_bytes():
    """Georgian and Burmese letters lie side by side."""
    a, b = lid._word_scripts(Words(pa.array(["ა ႎ"])))
    assert a and not b & a


@pytest.mark.parametrize("lang, words", [("ka", GEORGIAN), ("lo", LAO)])
def test_languages_of_further_scripts(spark, model, lang, words):
    text = prose(500, 20, words)
    rows = spark.createDataFrame([(1, text), (2, f"river {text}")], "doc_id long, text string")
    for r in lid.label_languages(rows, model).collect():
        assert r.lang_pred == lang and r.score > 0.9 and r.spans[-1].lang == lang
    assert lid.keep_identified(rows, model).count() == 2


def test_texts_of_three_languages_stay(spark, model):
    """No language has half of the letters, but every span has one."""
    mixed = " ".join([prose(1, 26), prose(2, 18, GEORGIAN), prose(3, 18, LAO)])
    rows = spark.createDataFrame([(1, mixed), (2, "12 ª 34"), (3, "12 34")], "doc_id long, text string")
    marked = lid.label_languages(rows, model).where("doc_id = 1").first()
    assert marked.score < 0.5 and len(marked.spans) == 3
    assert [r.doc_id for r in lid.keep_identified(rows, model).collect()] == [1]
