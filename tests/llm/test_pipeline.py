import pytest

import corpus_pipeline as P
from __spark_entry__ import oracle_sql, queries
from check_queries import compare, connect
from rallyframe.llm.queries import CHECKS

from .test_decontaminate import plain
from .test_near_copies import plain_kept
from .test_secret_ledger import plain as plain_spans


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_agrees_with_sql(spark, sf, name):
    text, ok = compare(spark, connect(sf), sf, queries()[name], oracle_sql()[name])
    assert ok, text


def test_all_operators_and_the_pipeline_are_registered():
    names = queries()
    assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 14)) and "pipeline" in names
    assert [n for n, _ in P.STAGES] == ["language", "near_duplicates", "decontamination", "secrets", "tokens"]


@pytest.fixture(scope="module")
def steps(spark, sf):
    """Every stage's input, and the last one's result."""
    from rallyframe.workspace import materialise

    found = [spark.read.parquet(f"{sf}/documents.parquet")]
    for name, stage in P.STAGES:
        found.append(materialise(stage(spark, found[-1], sf), f"test-{name}"))
    return found


def rows(frame):
    return {r.doc_id: r for r in frame.collect()}


def test_columns(steps):
    assert all(s.columns == steps[0].columns for s in steps[:5])
    assert {"doc_id", "ids", "n_tokens", "ids_sha256", "decoded_sha256"} == set(steps[5].columns)


def test_language_stage_keeps_nearly_all(steps):
    assert steps[1].count() >= 0.98 * steps[0].count()


def test_one_document_of_each_group_stays(steps):
    """Groups by five-word shingles and a similarity of 4/5, by trying all pairs."""
    assert set(rows(steps[2])) == plain_kept([(r.doc_id, r.text) for r in steps[1].collect()])
    assert all(rows(steps[1])[i] == r for i, r in rows(steps[2]).items())


def test_contaminated_documents_go(spark, sf, steps):
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    clean = {d for d, *_, hit in plain([(r.doc_id, r.text) for r in steps[2].collect()], items) if not hit}
    assert set(rows(steps[3])) == clean and len(clean) < steps[2].count()


def test_secrets_are_masked(steps):
    before, after = rows(steps[3]), rows(steps[4])
    assert set(before) == set(after)
    for i, r in after.items():
        said = plain_spans(before[i].text)
        assert (r == before[i]) == (not said)
        if said:
            kind, start, end = said.split(",")[0].split(":")
            assert r.text[:int(start)] == before[i].text[:int(start)] and r.text[int(start):].startswith("[SECRET]")
            assert r.n_chars == len(r.text) and "[SECRET]" in r.text


def test_tokens_cover_all(steps):
    assert set(rows(steps[5])) == set(rows(steps[4])) and steps[5].where("n_tokens <> size(ids)").count() == 0


def test_stages_on_odd_tables(spark, sf, clashing, none):
    for docs in (clashing, none):
        for name, stage in P.STAGES[:4]:
            made = stage(spark, docs, sf)
            assert made.columns == docs.columns and made.count() <= docs.count(), name
        assert P.encode(spark, docs, sf).count() == docs.count()
