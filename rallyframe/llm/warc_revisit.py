"""WARC archives in which repeated payloads are revisit records.

Headers are shuffled by payload digest; of the records of one digest the one of largest id is the
original and the others become revisits that refer to it. Archives are written and read with
Spark's text source: every record opens with the same two lines, the version and the id of its
warcinfo record, which is drawn anew for each archive, so no payload can hold it; they delimit the
records for the reader, which splits files among tasks, and Content-Length confirms each payload.

Cases: a null payload is empty; payloads below LEAST_BYTES are always responses; a record without
id or URI is written without that header and read back as null; equal ids share one original
among themselves; extra columns are left out; a long payload is one record.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LEAST_BYTES = 1000
_URN = "urn:record:"
_CRLF = "\r\n"


def payload_digest(payload: Column) -> Column:
    return F.sha1(payload.cast("binary"))


def resolve(headers: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """(digest, original) of the digests that several headers (id, digest, bytes) of ``least`` bytes share."""
    return (headers.where(F.col("bytes") >= least).groupBy("digest")
            .agg(F.max("id").alias("original"), F.count("*").alias("n")).where("n > 1").select("digest", "original"))


def opening(archive: str) -> str:
    return f"WARC/1.1{_CRLF}WARC-Warcinfo-ID: <urn:uuid:{archive}>{_CRLF}"


def _header(name: str, value: Column) -> Column:
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(_CRLF)), F.lit(""))


def write_archive(records: DataFrame, path: str, record_id: str, uri: str, payload: str) -> str:
    """Write a record per row, revisits without payload; returns the archive's id."""
    archive = str(uuid.uuid4())
    body = F.coalesce(F.col(payload).cast("string"), F.lit(""))
    rows = records.select(F.col(record_id).cast("long").alias("id"), F.col(uri).cast("string").alias("uri"), body.alias("payload"))
    rows = rows.select("*", payload_digest(F.col("payload")).alias("digest"), F.octet_length("payload").alias("bytes"))
    shared = resolve(rows.select("id", "digest", "bytes"))
    rows = rows.join(shared, "digest", "left")
    revisit = F.col("original").isNotNull() & ~F.col("id").eqNullSafe(F.col("original"))
    kept = F.when(revisit, "").otherwise(F.col("payload"))
    head = F.concat(
        F.lit(opening(archive)),
        _header("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _header("WARC-Record-ID", F.concat(F.lit(f"<{_URN}"), F.col("id").cast("string"), F.lit(">"))),
        _header("WARC-Date", F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        _header("WARC-Target-URI", F.regexp_replace("uri", r"[\r\n]", "")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(revisit, F.concat(_header("WARC-Refers-To", F.concat(F.lit(f"<{_URN}"), F.col("original").cast("string"), F.lit(">"))),
                                 F.lit(f"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest{_CRLF}"))).otherwise(""),
        _header("Content-Type", F.lit("text/html; charset=utf-8")),
        _header("Content-Length", F.octet_length(kept).cast("string")))
    rows.select(F.concat(head, F.lit(_CRLF), kept, F.lit(_CRLF)).alias("value")).write.option("lineSep", _CRLF).option("compression", "gzip").text(path)
    return archive


def read_archive(spark: SparkSession, path: str, archive: str) -> DataFrame:
    """(id, uri, record_type, digest, refers_to, payload) of every record; fails where a length is wrong."""
    raw = spark.read.option("lineSep", opening(archive)).text(path).where("value <> ''")
    cut = F.locate(_CRLF * 2, F.col("value"))
    parts = raw.select("value", cut.alias("cut"), F.concat(F.lit(_CRLF), F.col("value").substr(F.lit(1), cut + 1)).alias("head"))
    field = lambda name: F.nullif(F.regexp_extract("head", rf"\r\n{name}: ([^\r]*)\r\n", 1), F.lit(""))
    number = lambda name: F.nullif(F.regexp_extract("head", rf"\r\n{name}: <{_URN}(-?\d+)>\r\n", 1), F.lit("")).cast("long")
    length = field("Content-Length").cast("int")
    payload = F.expr("substr(value, cut + 4)")
    found = parts.select(number("WARC-Record-ID").alias("id"), field("WARC-Target-URI").alias("uri"), field("WARC-Type").alias("record_type"),
                         F.regexp_extract("head", r"\r\nWARC-Payload-Digest: sha1:(\w+)\r\n", 1).alias("digest"),
                         number("WARC-Refers-To").alias("refers_to"), payload.alias("rest"), length.alias("length"))
    exact = F.octet_length("rest") == F.col("length") + 4
    body = F.expr("substr(rest, 1, length(rest) - 4)")
    return found.select("id", "uri", "record_type", "digest", "refers_to",
                        F.when(exact, body).otherwise(F.raise_error(F.concat(F.lit("wrong length of record "), F.col("id").cast("string")))).alias("payload"))


def resolved(records: DataFrame) -> DataFrame:
    """(id, payload_bytes, digest, record_type, refers_to): revisits take the payload's facts from their original."""
    facts = records.select("id", "record_type", "refers_to", F.col("digest").alias("told"),
                           F.octet_length("payload").cast("long").alias("own_bytes"), payload_digest(F.col("payload")).alias("own_digest"))
    originals = facts.where("record_type = 'response'").groupBy(F.col("id").alias("refers_to"), F.col("own_digest").alias("told")).agg(
        F.max("own_bytes").alias("original_bytes"))
    joined = facts.join(originals, ["refers_to", "told"], "left")
    whole = F.col("record_type") == "response"
    return joined.select("id", F.when(whole, F.col("own_bytes")).otherwise(F.col("original_bytes")).alias("payload_bytes"),
                         F.when(whole, F.col("own_digest")).otherwise(F.col("told")).alias("payload_digest"), "record_type", "refers_to")
