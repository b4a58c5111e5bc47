import random
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from rallyframe.llm import bpe, token_counts
from rallyframe.llm.common import prepare
from rallyframe.llm.queries import QUERIES, vocabulary

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def library():
    import public_tokenizers

    return tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(vocabulary())


SAID = ["", "  ", "<|startoftext|>hi<|endoftext|> x<|endoftext|", "'S it's 'LL don’t they'd", "٣٤٥ 一二三漢字 ﬀ ½ Ⅷ", "é ä", "​x y　z﻿",
        "日本語テキスト" * 50, "a" * 5000, "ab" * 3000, "😀👍🏽 !!", "x\x00y\x1fz", "ΑΣ ΣΑΣ.", "a\x1cb a\x85b", "İstanbul ǅ ẞ"]


@pytest.mark.parametrize("text", SAID)
def test_ids_equal_the_library(library, encoder, text):
    ids = encoder.encode(text)
    assert ids == library.encode(text, add_special_tokens=False).ids
    assert encoder.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_random_texts_equal_the_library(library, encoder):
    import unicodedata

    draw = random.Random(8)
    points = [chr(p) for p in (*range(1, 0x250), *range(0x370, 0x530), *range(0x4E00, 0x4E40), *range(0x1F600, 0x1F640)) if unicodedata.category(chr(p)) != "Cn"]
    for _ in range(400):
        text = "".join(draw.choice(points) for _ in range(draw.randrange(60)))
        assert encoder.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_cuts_are_certain(encoder):
    """Merging a word whole and merging its fragments give the same tokens."""
    v, draw = encoder.vocabulary, random.Random(2)
    cut = 0
    for _ in range(300):
        word = "".join(draw.choice("abcçéèñqxzwkü7") for _ in range(draw.randrange(2, 14)))
        symbols = v.symbols("".join(v.letters[b] for b in word.encode()), True)
        cut += any(pair not in v.joined for pair in zip(symbols, symbols[1:]))
        assert bpe.Encoder(v)._word(word) == encoder._merge(list(symbols)) == tuple(v.ids[s] for s in encoder._merge_long(list(symbols)))
    assert cut > 50


def test_forgetting_changes_nothing(encoder, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    small, text = bpe.Encoder(encoder.vocabulary), "one two three four five six seven one two three"
    assert small.encode(text) == encoder.encode(text)


def test_query_equals_the_library(spark, sf, library):
    texts = dict(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    for r in QUERIES["op4_bpe"](spark, sf).collect():
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_odd_texts(spark, odd, odd_rows, clashing, none, library):
    prepare(spark)
    want = sorted(str((r[0], library.encode(r[1] or "", add_special_tokens=False).ids)) for r in odd_rows)
    assert sorted(str((r.doc_id, r.ids)) for r in bpe.round_trip(odd, vocabulary(), with_ids=True).collect()) == want
    again = bpe.round_trip(clashing, vocabulary(), with_ids=True)
    assert again.columns.count("ids") == 1 and sorted(str((r.doc_id, r.ids)) for r in again.collect()) == want
    assert bpe.round_trip(none, vocabulary()).count() == 0


# token counts

def test_histogram_equals_counting(spark, sf, library):
    texts = [r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    lengths = [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    rows = QUERIES["op10_token_counts"](spark, sf).collect()
    assert sorted(r.length for r in rows) == sorted(set(lengths))
    for r in rows:
        assert r.docs == lengths.count(r.length) and r.docs_upto == sum(n <= r.length for n in lengths)
        assert r.tokens_upto == sum(n for n in lengths if n <= r.length) and r.docs_beyond == sum(n > r.length for n in lengths)
        assert r.tokens_beyond == sum(n for n in lengths if n > r.length)
        assert r.truncated_total == sum(min(n, r.length) for n in lengths)
        assert r.share_upto == pytest.approx(sum(n <= r.length for n in lengths) / len(lengths))


def test_any_limit_and_quantile(spark):
    lengths = [0, 0, 3, 3, 3, 1024, 1025, 5000, None]
    known = [n or 0 for n in lengths]
    sums = token_counts.running_sums(token_counts.histogram(spark.createDataFrame([(n,) for n in lengths], "n_tokens int")))
    limits = [0, 1, 3, 4, 1023, 1024, 4999, 5000, 10**9]
    got = {r.context_limit: r for r in token_counts.at_limits(sums, limits).collect()}
    for limit in limits:
        r, fit = got[limit], sum(n <= limit for n in known)
        assert (r.fitting, r.cut, r.truncated_total) == (fit, len(known) - fit, sum(min(n, limit) for n in known))
        assert r.share == pytest.approx(fit / len(known))
    assert token_counts.quantile(sums, 0.5) == 3 and token_counts.quantile(sums, 1.0) == 5000
    empty = token_counts.running_sums(token_counts.histogram(spark.createDataFrame([], "n_tokens int")))
    assert empty.count() == 0 and token_counts.quantile(empty, 0.5) is None
    row = token_counts.at_limits(empty, [7]).first()
    assert (row.fitting, row.cut, row.truncated_total, row.share) == (0, 0, 0, None)


def test_counts_of_odd_texts(odd, odd_rows, clashing, none, library):
    want = sorted(str((r[0], len(library.encode(r[1] or "", add_special_tokens=False).ids))) for r in odd_rows)
    assert sorted(str((r.doc_id, r.n_tokens)) for r in bpe.count_tokens(clashing, vocabulary()).collect()) == want
    hist = token_counts.histogram(bpe.count_tokens(odd, vocabulary(), keep=["doc_id"]))
    assert hist.agg(F.sum("docs")).first()[0] == len(odd_rows)
    assert token_counts.histogram(bpe.count_tokens(none, vocabulary())).count() == 0
