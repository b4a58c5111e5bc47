"""Secret scans with an incremental ledger of text blobs, in DataFrame functions only.

Every version of a text is addressed by its SHA-256. A run scans only the pairs of blob and rule
version that the ledger does not hold, appends one ledger row per pair (with its hits, clean ones
too), and joins the findings back to every path that holds the blob, now or in earlier versions.

A run appends by one Parquet commit, so a run that dies leaves the ledger as it was and is repeated.
Hits are stored as the gap before each match and its length; positions are running sums.

Cases: a null text is the empty text; copies share one scan and all get its findings; a rule with
a new version is scanned again and only its newest version counts; extra columns pass through. A long text is one
row, scanned whole; its masked form is joined once.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import fresh


@dataclass(frozen=True)
class Rule:
    """Leftmost matches of ``pattern`` that do not overlap; kept if ``group`` has ``least`` characters."""

    kind: str
    version: int
    pattern: str
    group: int
    least: int
    words: tuple[str, ...] = ()     # lower-cased texts without any of them are clean
    hint: str | None = None         # texts without this pattern are clean


# The kinds in their order, and their patterns.
RULES = (
    Rule("assign", 1, r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8,
         words=("password", "passwd", "secret", "token", "apikey", "api_key")),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 16, words=("akia",)),
    Rule("hex", 1, r"[0-9a-f]+", 0, 32, hint=r"[0-9a-f]{32}"),
)
LEDGER = "blob binary, kind string, version int, hits array<struct<gap: int, size: int, kept: boolean>>, run string"


def address(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def _hits(rule: Rule, text: Column) -> Column:
    """Gap and size of every match, and whether it counts."""
    pattern = F.lit(rule.pattern)
    gaps, whole = F.split(text, rule.pattern, -1), F.regexp_extract_all(text, pattern, F.lit(0))
    value = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else whole
    return F.transform(F.arrays_zip(F.slice(gaps, 1, F.size(whole)).alias("g"), whole.alias("w"), value.alias("v")), lambda m: F.struct(
        F.length(m["g"]).alias("gap"), F.length(m["w"]).alias("size"), (F.length(m["v"]) >= rule.least).alias("kept")))


def _may_match(rule: Rule, text: Column, lowered: Column) -> Column:
    test = F.lit(not rule.words and not rule.hint)
    for word in rule.words:
        test = test | lowered.contains(word)
    return test | text.rlike(rule.hint) if rule.hint else test


def scan_unseen(versions: DataFrame, text: str, ledger: str, rules: tuple[Rule, ...] = RULES) -> None:
    """Scan what the ledger lacks of ``versions`` and append it."""
    spark = versions.sparkSession
    pair = lambda r: F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"))
    blobs = (versions.select(address(F.col(text)).alias("blob"), F.coalesce(F.col(text), F.lit("")).alias("text"))
             .groupBy("blob").agg(F.first("text").alias("text")))  # copies combine before the shuffle
    seen = read_ledger(spark, ledger).groupBy("blob").agg(F.collect_set(F.struct("kind", "version")).alias("seen"))  # rules x versions at most
    unseen = (blobs.join(seen, "blob", "left").withColumn("lowered", F.lower("text"))
              .withColumn("due", F.filter(F.array(*(pair(r) for r in rules)),
                                          lambda p: ~F.coalesce(F.array_contains(F.col("seen"), p), F.lit(False))))
              .where(F.size("due") > 0))
    none = F.array().cast("array<struct<gap: int, size: int, kept: boolean>>")
    for rule in rules:
        due = F.array_contains("due", pair(rule)) & _may_match(rule, F.col("text"), F.col("lowered"))
        unseen = unseen.withColumn(f"hits_{rule.kind}", F.when(due, _hits(rule, F.col("text"))).otherwise(none))
    hits = F.coalesce(*(F.when(F.col("p.kind") == r.kind, F.col(f"hits_{r.kind}")) for r in rules))
    (unseen.select("blob", F.explode("due").alias("p"), *(f"hits_{r.kind}" for r in rules))
     .select("blob", F.col("p.kind").alias("kind"), F.col("p.version").alias("version"), hits.alias("hits"))
     .write.mode("error").parquet(f"{ledger}/run={uuid.uuid4().hex}"))


def findings(spark: SparkSession, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per blob with findings: ``found``, its spans (kind, start, end) by start, then kind as listed."""
    order = F.create_map(*(x for i, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(i))))
    known = F.array(*(F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules))
    hits = (read_ledger(spark, ledger).where(F.array_contains(known, F.struct("kind", "version")) & F.exists("hits", lambda h: h["kept"]))
            .groupBy("blob", "kind").agg(F.first("hits").alias("hits"))  # two runs at once may have scanned the same pair
            .select("blob", "kind", F.posexplode("hits").alias("seq", "h")))
    upto = Window.partitionBy("blob", "kind").orderBy("seq")  # the matches of one text
    placed = hits.withColumn("end", F.sum(F.col("h.gap") + F.col("h.size")).over(upto)).where("h.kept")
    span = F.struct((F.col("end") - F.col("h.size")).alias("start"), order[F.col("kind")].alias("rank"), F.col("end"), F.col("kind"))
    return placed.groupBy("blob").agg(F.array_sort(F.collect_list(span)).alias("found"))


def scan_texts(docs: DataFrame, ledger: str, text: str = "text", keep: list[str] | None = None,
               rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``keep`` (all columns by default) and ``found``, the spans of the text; empty where it is clean."""
    scan_unseen(docs, text, ledger, rules)
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() != "found"]
    blob = fresh(keep, "blob")
    paths = docs.select(*keep, address(F.col(text)).alias(blob))
    found = findings(docs.sparkSession, ledger, rules).withColumnRenamed("blob", blob)
    empty = F.array().cast(found.schema["found"].dataType)
    return paths.join(found, blob, "left").select(*keep, F.coalesce("found", empty).alias("found"))


def span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column, mask: str = "[SECRET]") -> Column:
    """The text with each run of overlapping spans (sorted by start) replaced by ``mask``.

    How far the spans up to each one reach is a prefix maximum in doubling steps; the pieces between runs are
    cut from four bytes a character, so that a cut does not walk the text, and joined once.
    """
    ends = F.transform(spans, lambda s: s["end"])
    steps = F.filter(F.array(*(F.lit(1 << i) for i in range(30))), lambda d: d < F.size(spans))
    reach = F.aggregate(steps, ends, lambda upto, d: F.transform(upto, lambda e, i: F.greatest(e, F.when(i >= d, F.get(upto, i - d)))))

    def joined(b: Column) -> Column:
        cut = lambda start, end: F.decode(F.substring(b["wide"], (4 * start + 1).cast("int"), (4 * (end - start)).cast("int")), "UTF-32")
        gaps = F.transform(spans, lambda s, i: F.struct(F.when(i > 0, F.get(b["reach"], i - 1)).otherwise(F.lit(0).cast("long")).alias("start"), s["start"].alias("end")))
        between = F.transform(F.filter(gaps, lambda g: g["end"] >= g["start"]), lambda g: cut(g["start"], g["end"]))
        return F.array_join(F.concat(between, F.array(cut(F.element_at(b["reach"], -1), F.length(text)))), mask)

    bound = F.array(F.struct(F.encode(text, "UTF-32").alias("wide"), reach.alias("reach")))  # made once, not in each step
    return F.when(F.size(spans) > 0, F.transform(bound, joined)[0]).otherwise(text)
