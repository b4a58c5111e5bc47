"""Registered queries of the subpackage, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rallyframe.workspace import materialise, new_path

from . import bpe, decontaminate, language_id, mask_search, mixing, quality_rules, secret_ledger, simhash_vp, token_counts, toxicity, va_topk, warc_revisit, whitening
from .common import bounded_labels, prepare, remainder, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents").withColumn("held_out", remainder(F.col("doc_id"), 4) == 2)
    model = language_id.fit(docs.where(~F.col("held_out")))
    found = language_id.label_languages(docs, model, keep=["doc_id", "held_out"])
    return found.select("doc_id", "held_out", "lang_pred", "score", F.size("spans").alias("n_spans"))


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents").withColumn("held_out", remainder(F.col("doc_id"), 4) == 2)
    labels = bounded_labels(table(spark, sf_dir, "labels"), "toxic", remainder(F.col("doc_id"), 4) != 2, toxicity.TRAIN_DOCS)
    scored = toxicity.score_toxicity(docs, toxicity.fit(docs, labels), keep=["doc_id", "held_out"])
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    found = secret_ledger.scan_texts(docs, new_path(spark, "secret-ledger"), keep=["doc_id"])
    digest = F.sha2(secret_ledger.span_text(F.col("found")), 256)
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, ("assign", "access", "hex")), digest.alias("base_sha256"),
                        secret_ledger.span_text(F.col("found")).alias("spans"))


CHECKS["op3_secret_scans"] = r"""
    WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    cut AS (
        SELECT doc_id, 'assign' AS kind, 0 AS rank, 8 AS least, regexp_split_to_array(t, p) AS gaps, regexp_extract_all(t, p, 0) AS whole, regexp_extract_all(t, p, 2) AS val
        FROM texts, (SELECT '([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)' AS p)
        UNION ALL SELECT doc_id, 'access', 1, 16, regexp_split_to_array(t, 'AKIA[A-Z0-9]+'), regexp_extract_all(t, 'AKIA[A-Z0-9]+', 0), regexp_extract_all(t, 'AKIA[A-Z0-9]+', 0) FROM texts
        UNION ALL SELECT doc_id, 'hex', 2, 32, regexp_split_to_array(t, '[0-9a-f]{32,}'), regexp_extract_all(t, '[0-9a-f]{32,}', 0), regexp_extract_all(t, '[0-9a-f]{32,}', 0) FROM texts),
    hits AS (
        SELECT doc_id, kind, rank, least, unnest(range(1, len(whole) + 1)) AS i, gaps, whole, val FROM cut),
    spans AS (
        SELECT doc_id, kind, rank, least, length(val[i]) AS n,
               list_sum(list_transform(gaps[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(whole[1:i - 1], lambda g: length(g))), 0) AS start, length(whole[i]) AS size
        FROM hits),
    said AS (
        SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
               string_agg(kind || ':' || start::BIGINT || ':' || (start + size)::BIGINT, ',' ORDER BY start, rank) AS spans
        FROM spans WHERE n >= least GROUP BY doc_id)
    SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
           sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM documents LEFT JOIN said USING (doc_id)"""


def vocabulary(path: str | None = None) -> bpe.Vocabulary:
    """The vocabulary file that the contract names, or another one."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.Vocabulary.read(path)


@query
def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(prepare(spark), sf_dir, "documents"), vocabulary(), keep=["doc_id"])


@query
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents").withColumn("held_out", remainder(F.col("doc_id"), 3) == 1)
    labels = bounded_labels(table(spark, sf_dir, "labels"), "quality", remainder(F.col("doc_id"), 3) != 1, quality_rules.TRAIN_DOCS)
    scored = quality_rules.score_quality(docs, quality_rules.fit(docs, labels), keep=["doc_id", "held_out"])
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_vp.near_duplicates(table(prepare(spark), sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(prepare(spark), sf_dir, "embeddings")
    found = va_topk.top_k(vectors, F.col("vec_id") % 20 == 0, 20, value=lambda x: va_topk.whole_part(x.cast("double") * 64))
    return found.withColumn("score", F.col("score").try_cast("long"))  # null where no long holds a score


CHECKS["op7_top_k"] = """
    WITH whole AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (
        SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
        FROM whole q JOIN whole c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score
    FROM scored QUALIFY rank <= 20"""


@query
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(prepare(spark), "warc")
    archive = warc_revisit.write_archive(table(spark, sf_dir, "pages"), path, "page_id", "url", "html")
    facts = warc_revisit.resolved(warc_revisit.read_archive(spark, path, archive))
    return facts.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


CHECKS["op8_warc"] = """
    WITH pay AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
    last AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS original FROM pay)
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN payload_bytes >= 1000 AND page_id <> original THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN payload_bytes >= 1000 AND page_id <> original THEN original END AS refers_to
    FROM last"""


@query
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(prepare(spark), sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = decontaminate.find_contamination(docs, benchmark, keep=["doc_id"])
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
CHECKS["op9_decontamination"] = f"""
    WITH docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
    items AS (SELECT item_id::VARCHAR AS item, {_WORDS} AS w FROM benchmark),
    windows AS (
        SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS words
        FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
    places AS (
        SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS words
        FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
    hits AS (SELECT doc_id, item, i, n FROM places JOIN windows USING (n, words)),
    hit_words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
    hit_items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
    SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM docs LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)"""


@query
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = bpe.count_tokens(table(prepare(spark), sf_dir, "documents"), vocabulary(), keep=["doc_id"])
    return token_counts.running_sums(materialise(token_counts.histogram(counted), "histogram"))


@query
def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mask_search.search(table(prepare(spark), sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 20)


_TERMS = _WORDS.replace(r"\x3A-\x60", r"\x3A-\x40\x5B-\x60")
CHECKS["op11_ranked_search"] = f"""
    WITH docs AS (SELECT doc_id, {_TERMS} AS w FROM documents),
    items AS (SELECT item_id, {_TERMS} AS w FROM benchmark),
    facts AS (SELECT count(*) FILTER (len(w) > 0) AS n_docs, sum(len(w))::BIGINT AS n_terms FROM docs),
    asked AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest(w) AS term FROM items) GROUP BY ALL),
    held AS (SELECT doc_id, len(w)::BIGINT AS n, unnest(w) AS term FROM docs),
    post AS (SELECT doc_id, n, term, count(*) AS tf FROM held WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
    weights AS (SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM post, facts GROUP BY term),
    scored AS (
        SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms))))::BIGINT AS score
        FROM asked JOIN weights USING (term) JOIN post USING (term), facts GROUP BY item_id, doc_id)
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score
    FROM scored WHERE score > 0 QUALIFY rank <= 20"""


@query
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(prepare(spark), sf_dir, "embeddings")
    return whitening.whiten(vectors, whitening.fit(whitening.distinct_vectors(vectors, "embedding")))


@query
def op13_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, (key, size, where) = mixing.measure(table(prepare(spark), sf_dir, "documents"))
    rows = materialise(rows.select("doc_id", F.col(key).alias("key"), F.col(size).alias("size"), F.col(where).alias("place")), "mix-rows")
    found = rows.join(mixing.plan(rows.drop("doc_id")), "key")
    goal = F.col("goals")[0]
    return found.select("doc_id", "size", F.col("words").alias("source_size"), goal["target"].alias("target"),
                        (F.col("size") * mixing.copies(goal, F.col("place"))).alias("taken"))


CHECKS["op13_source_mix"] = r"""
    WITH docs AS (
        SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
               ('0x' || md5(concat_ws(' ', doc_id::VARCHAR, text))[1:15])::BIGINT AS place FROM documents),
    sources AS (SELECT source, sum(size)::BIGINT AS words, [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight FROM docs GROUP BY source),
    levels AS (
        SELECT *, sum(3 * words) OVER w AS most_upto, sum(weight) OVER w AS weight_upto, sum(weight) OVER () AS all_weight, sum(words) OVER () AS total
        FROM sources WINDOW w AS (ORDER BY words / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
    full_ones AS (SELECT *, most_upto::DOUBLE + 3.0 * words / weight * (all_weight - weight_upto) <= total AS is_full FROM levels),
    rise AS (SELECT (any_value(total) - coalesce(sum(3 * words) FILTER (is_full), 0))::DOUBLE / nullif(any_value(all_weight) - coalesce(sum(weight) FILTER (is_full), 0), 0) AS rise FROM full_ones),
    dealt AS (SELECT source, words, least(3.0 * words, coalesce(rise * weight, 3.0 * words))::DOUBLE AS target FROM sources, rise),
    goals AS (SELECT *, CASE WHEN words > 0 THEN least(3, floor(target / words)) ELSE 0 END::BIGINT AS whole FROM dealt),
    places AS (SELECT source, place, sum(size)::BIGINT AS here FROM docs GROUP BY source, place),
    sums AS (SELECT *, sum(here) OVER (PARTITION BY source ORDER BY place) AS upto FROM places),
    ends AS (
        SELECT g.source, CASE WHEN 2 * (target - whole * words - (upto - here)) > here THEN place + 1 ELSE place END AS until
        FROM goals g JOIN sums s ON g.source IS NOT DISTINCT FROM s.source
        WHERE whole < 3 AND upto - here < target - whole * words AND target - whole * words <= upto)
    SELECT doc_id, size, words AS source_size, target, (size * (whole + CASE WHEN place < coalesce(until, 0) THEN 1 ELSE 0 END))::BIGINT AS taken
    FROM docs JOIN goals g ON docs.source IS NOT DISTINCT FROM g.source LEFT JOIN ends e ON e.source IS NOT DISTINCT FROM g.source"""
