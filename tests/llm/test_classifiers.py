import random

from pyspark.sql import functions as F

from rallyframe.llm import quality_rules, toxicity
from rallyframe.llm.common import bounded_labels, prepare
from rallyframe.llm.queries import QUERIES

from .conftest import prose

LABELS = "doc_id long, toxic int, quality int"


def test_labels_are_bounded_and_unique(spark):
    rows = [(i % 50, i % 2, 1) for i in range(200)] + [(None, 1, 1), (60, None, None)]
    taken = bounded_labels(spark.createDataFrame(rows, LABELS), "toxic", F.lit(True), 30).collect()
    assert len({r.doc_id for r in taken}) == len(taken) == 30


def test_pairs_of_harmless_words_are_learnt(spark):
    """An insult or a group alone is harmless; both together are toxic: no sum of single weights tells that."""
    prepare(spark)
    draw, rows, labels = random.Random(4), [], []
    for i in range(600):
        a, b = i % 2, i // 2 % 2
        words = prose(i, 12).split() + ["rotten"] * a + ["islanders"] * b
        draw.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, float(a and b)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    machine = toxicity.fit(docs.where("doc_id < 400"), spark.createDataFrame(labels, "doc_id long, label double").where("doc_id < 400"))
    scored = toxicity.score_toxicity(docs.where("doc_id >= 400"), machine).collect()
    wrong = sum((r.score >= 0.5) != (r.doc_id % 4 == 3) for r in scored)
    assert wrong <= 4


def test_exclusive_or_of_two_words_is_learnt(spark):
    """Neither word goes with the label alone; only one of them without the other is toxic."""
    prepare(spark)
    draw, rows, labels = random.Random(4), [], []
    for i in range(2400):
        a, b = i % 2, i // 2 % 2
        words = prose(i, 30).split() + ["rotten"] * a + ["islanders"] * b
        draw.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, float(a != b)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    machine = toxicity.fit(docs.where("doc_id < 2000"), spark.createDataFrame(labels, "doc_id long, label double").where("doc_id < 2000"))
    scored = toxicity.score_toxicity(docs.where("doc_id >= 2000"), machine).collect()
    assert sum((r.score >= 0.5) == (r.doc_id % 4 in (1, 2)) for r in scored) > 0.95 * len(scored)


def test_score_is_the_plain_sum_over_pairs():
    import math

    import numpy as np
    import pyarrow as pa

    from rallyframe.llm.common import Words

    rng, texts = np.random.default_rng(5), [prose(i, 8) for i in range(5)] + ["", None, "one one two"]
    place = np.full(1 << toxicity.BITS, -1, np.int32)
    codes = np.unique(toxicity._terms(Words(pa.array(texts)))[1])[::2]      # every other term is known
    place[codes] = np.arange(len(codes))
    machine = toxicity.Machine(place, rng.random(len(codes)) < 0.3, -0.4, rng.normal(0, 1, len(codes)).astype(np.float32), rng.normal(0, 1, (len(codes), 4)).astype(np.float32))
    got = toxicity._scorer(machine)(pa.array(texts))[0].to_pylist()
    for text, score in zip(texts, got):
        at = sorted({place[c] for c in toxicity._terms(Words(pa.array([text])))[1]} - {-1})
        others = sum(not machine.full[i] for i in at)
        x = {i: 1.0 if machine.full[i] else 1 / math.sqrt(others) for i in at}
        z = machine.w0 + sum(float(machine.w[i]) * x[i] for i in at)
        z += sum(float(np.dot(machine.v[i].astype(float), machine.v[j])) * x[i] * x[j] for i in at for j in at if i < j)
        assert abs(score - 1 / (1 + math.exp(-z))) < 1e-6


def test_toxicity_of_odd_texts(spark, odd, clashing, none):
    labels = spark.createDataFrame([(5, 1.0), (7, 0.0), (9, 0.0), (1, 0.0)], "doc_id long, label double")
    machine = toxicity.fit(odd, labels)
    rows = toxicity.score_toxicity(odd, machine).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if not (r.text or "").strip()}) == 1
    again = toxicity.score_toxicity(clashing, machine)
    assert again.columns.count("score") == 1 and again.count() == odd.count()
    assert toxicity.score_toxicity(none, machine).count() == 0
    nothing = toxicity.fit(none, labels)
    assert {r.score for r in toxicity.score_toxicity(odd, nothing).collect()} == {0.0}


def test_toxicity_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    found = QUERIES["op2_toxicity"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").toPandas()
    toxic, clean = found[found.toxic == 1].score, found[found.toxic == 0].score
    assert (toxic.values[:, None] > clean.values[None, :]).mean() > 0.95


def test_statistics_of_a_text(spark):
    frame = spark.createDataFrame([("One one 22!\nTWO == x.",), ("",), (None,)], "text string")
    rows = frame.select(*(c.alias(n) for n, c in quality_rules.statistics(F.col("text")).items())).collect()
    assert tuple(rows[0]) == (21.0, 6.0, 21 / 6, 1.0, 1.0, 21 / 2, 2 / 21, 1 / 21, 2 / 21, 1 / 21, 1 / 21)
    assert set(rows[1]) == set(rows[2]) == {0.0, 1.0}    # one empty line is distinct; all else is 0


def test_rules_keep_one_bound_a_side():
    c = quality_rules.Condition
    assert quality_rules.tightened((c("a", True, 1.0), c("a", True, 2.0), c("a", False, 5.0))) == (c("a", False, 5.0), c("a", True, 2.0))


def test_ensemble_column_equals_its_rules(spark):
    c = quality_rules.Condition
    model = quality_rules.Ensemble(0.5, [((c("words", True, 3.0),), 1.25), ((c("words", True, 1.0), c("digits", False, 0.1)), -2.0)])
    frame = spark.createDataFrame([(2.0, 0.0), (5.0, 0.0), (5.0, 0.5), (0.0, 0.0)], "words double, digits double")
    want = [1 / (1 + 2.718281828459045 ** -z) for z in (-1.5, -0.25, 1.75, 0.5)]
    assert all(abs(r[0] - w) < 1e-12 for r, w in zip(frame.select(model.score()).collect(), want))


def test_quality_of_odd_texts(spark, odd, clashing, none):
    prepare(spark)
    some = spark.createDataFrame([(5, 1.0), (7, 1.0)], "doc_id long, label double")
    assert {r.score for r in quality_rules.score_quality(odd, quality_rules.fit(odd, some)).collect()} == {1.0}
    assert {r.score for r in quality_rules.score_quality(odd, quality_rules.fit(none, some)).collect()} == {0.5}
    model = quality_rules.Ensemble(0.0, [((quality_rules.Condition("chars", False, 0.0),), -1.0)])
    rows = quality_rules.score_quality(clashing, model)
    assert rows.columns.count("score") == 1 and rows.count() == odd.count()
    assert {round(r.score, 6) for r in rows.where("text = '' OR text IS NULL").collect()} == {0.268941}
    assert quality_rules.score_quality(none, model).count() == 0


def test_quality_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    found = QUERIES["op5_quality"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out")
    assert found.agg(F.avg((F.col("quality") == F.col("predicted")).cast("int"))).first()[0] > 0.93
