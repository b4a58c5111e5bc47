"""The corpus pipeline: from raw documents to token ids, each stage written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rallyframe.llm import bpe, decontaminate, language_id, near_copies, secret_ledger
from rallyframe.llm.common import fresh, prepare, table
from rallyframe.llm.queries import vocabulary
from rallyframe.workspace import materialise, new_path


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in which any span has a language; the model is fitted on this stage's own rows."""
    prepare(spark)
    return language_id.keep_identified(docs, language_id.fit(docs))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document of smallest id of each group of near-duplicates (five-word shingles, similarity 4/5)."""
    prepare(spark)
    return near_copies.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents in which a window of a benchmark item occurs."""
    benchmark = table(prepare(spark), sf_dir, "benchmark")
    found = decontaminate.find_contamination(docs, benchmark)
    return found.where(~F.col("contaminated")).select(*docs.columns)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets in the texts; n_chars follows the text."""
    found = secret_ledger.scan_texts(docs, new_path(prepare(spark), "secret-ledger"))
    clean, counted = fresh(found.columns, "clean"), [c for c in docs.columns if c == "n_chars"]
    marked = found.withColumn(clean, secret_ledger.redacted(F.col("text"), F.col("found")))
    size = F.when(F.size("found") > 0, F.length(clean).cast("long")).otherwise(F.col("n_chars")).alias("n_chars") if counted else None
    return marked.select(*(F.col(clean).alias("text") if c == "text" else size if c == "n_chars" else F.col(c) for c in docs.columns))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, their number, and the digest of the ids decoded again."""
    prepare(spark)
    return bpe.round_trip(docs, vocabulary(), keep=["doc_id"], with_ids=True)


STAGES = [("language", identify), ("near_duplicates", deduplicate), ("decontamination", decontaminated), ("secrets", redact), ("tokens", encode)]

#: Language models, XXH64 and byte-pair merges are beyond SQL; tests hold each stage against a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
