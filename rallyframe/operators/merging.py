"""Canonical match table: dedupe, feed mapping, cross-feed merge, prioritised joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from rallyframe import constants as K
from rallyframe.functions import text as T
from rallyframe.functions.values import pair_key
from rallyframe.operators.aliases import resolve_column
from rallyframe.workspace import materialise

DEDUPE_KEY = ("match_date", "gender", "level", "surface", "tourney_id", "tourney_name", "round", "winner_key",
              "loser_key", "score")
GROUP = ("match_date", "gender", "pair")
STRICT = (*GROUP, "level", "surface", "round_norm")


def canonical_dedupe(matches: DataFrame, order: str = "seq") -> DataFrame:
    """First row per key in source order; self matches and missing keys are dropped.

    Everything but the key is folded with the order in a minimum, so copies combine before
    the shuffle.
    """
    usable = matches.where((F.coalesce("winner_key", F.lit("")) != "") & (F.coalesce("loser_key", F.lit("")) != "")
                           & (F.col("winner_key") != F.col("loser_key")))
    rest = [c for c in matches.columns if c not in DEDUPE_KEY and c != order]
    first = F.min(F.struct(order, *rest)).alias("f")
    return usable.groupBy(*DEDUPE_KEY).agg(first).select(*DEDUPE_KEY, f"f.{order}", *[f"f.{c}" for c in rest])


def map_sides(feed: DataFrame, mapping: DataFrame, closure: DataFrame) -> DataFrame:
    """Canonical keys of both feed sides and the coverage class of the match."""
    accepted = F.col("status").isin(*K.MAPPED_STATUSES) & (F.coalesce("target_key", F.lit("")) != "")
    # resolve the small mapping once instead of the two sides of every match
    resolved = resolve_column(mapping.select("api_key", "status", "target_key"), "target_key", closure).select(
        "api_key", "status", F.when(accepted, F.col("target_key")).alias("target"))
    out = feed
    for side in ("winner", "loser"):
        hit = resolved.select(F.col("api_key").alias(f"{side}_api_key"), F.col("target").alias(f"{side}_key"),
                              F.col("status").alias(f"_{side}_status"))
        out = out.join(hit, f"{side}_api_key", "left").withColumn(
            f"{side}_status", F.coalesce(f"_{side}_status", F.lit("missing_mapping_entry"))).drop(f"_{side}_status")
    w, l = F.col("winner_key").isNotNull(), F.col("loser_key").isNotNull()
    coverage = (F.when(~w & ~l, "none_mapped").when(~w | ~l, "one_mapped")
                .when(F.col("winner_key") == F.col("loser_key"), "mapped_winner_loser_same_player").otherwise("both_mapped"))
    return out.withColumn("coverage", coverage)


def with_merge_keys(matches: DataFrame) -> DataFrame:
    return matches.withColumn("pair", pair_key(F.col("winner_key"), F.col("loser_key"))).withColumn(
        "round_norm", T.normalize_event_name(F.col("round")))


def cross_source_merge(primary: DataFrame, feed: DataFrame, order: str = "seq") -> DataFrame:
    """Decide every mapped feed row against the primary table.

    ``outcome`` is added, duplicate, conflict or ambiguous, with the strategy and the primary
    (or earlier feed) match it met. Primary copies collapse to one row per strict key before
    anything is grouped, so the candidates of one date and pair are at most its distinct
    level, surface and round combinations. Feed rows of a group without primary rows: the
    first is added, the later ones are compared with it.
    """
    p = with_merge_keys(primary)
    kept = p.groupBy(*STRICT).agg(F.min(F.struct(order, "winner_key")).alias("f")).select(
        *STRICT, F.col(f"f.{order}").alias("cand_id"), F.col("f.winner_key").alias("cand_winner"))
    entry = F.struct("cand_id", "cand_winner", "level", "surface", "round_norm")
    candidates = kept.groupBy(*GROUP).agg(F.array_sort(F.collect_list(entry)).alias("cands"))
    f = materialise(with_merge_keys(feed.where(F.col("coverage") == "both_mapped")).select(
        order, *STRICT, "winner_key", "loser_key"), "feed-mapped")
    first = f.groupBy(*GROUP).agg(F.min(F.struct(
        F.col(order).alias("cand_id"), F.col("winner_key").alias("cand_winner"), "level", "surface", "round_norm"))
        .alias("first_row"))
    joined = f.join(candidates, list(GROUP), "left").join(first, list(GROUP))

    same_round = lambda c: c["round_norm"] == F.col("round_norm")
    same_court = lambda c: (c["level"] == F.col("level")) & (c["surface"] == F.col("surface"))
    strict = F.filter("cands", lambda c: same_round(c) & same_court(c))
    by_round, by_court = F.filter("cands", same_round), F.filter("cands", same_court)
    head = lambda a: F.try_element_at(a, F.lit(1))
    own = F.col("first_row")
    is_first = own["cand_id"] == F.col(order)
    no_primary = F.col("cands").isNull()
    strategy = (
        F.when(no_primary & is_first, F.lit(None).cast("string"))
        .when(no_primary, F.when(same_round(own) & same_court(own), "strict").otherwise("date_gender_players"))
        .when(F.size(strict) > 0, "strict").when(F.size("cands") == 1, "date_gender_players")
        .when(F.size(by_round) == 1, "round_refined").when(F.size(by_court) == 1, "level_surface_refined")
        .otherwise("ambiguous"))
    met = (F.when(no_primary, own).when(F.size(strict) > 0, head(strict)).when(F.size("cands") == 1, head(F.col("cands")))
           .when(F.size(by_round) == 1, head(by_round)).when(F.size(by_court) == 1, head(by_court)))
    return (joined.select(order, *STRICT, "winner_key", "loser_key", strategy.alias("strategy"),
                          F.when(strategy.isNotNull(), met).alias("met"))
            .select(order, "match_date", "gender", "level", "surface", "winner_key", "loser_key", "strategy",
                    F.col("met.cand_id").alias("met_id"),
                    F.when(F.col("strategy").isNull(), "added").when(F.col("strategy") == "ambiguous", "ambiguous")
                    .when(F.col("met.cand_winner") == F.col("winner_key"), "duplicate").otherwise("conflict")
                    .alias("outcome")))


def merged_table(primary: DataFrame, decisions: DataFrame, order: str = "seq") -> DataFrame:
    """Primary rows, first per strict key, and the added feed rows, with a canonical id."""
    p = with_merge_keys(primary).groupBy(*STRICT).agg(
        F.min(F.struct(order, "winner_key", "loser_key")).alias("f")).select(
        "match_date", "gender", "level", "surface", f"f.{order}", "f.winner_key", "f.loser_key",
        F.lit("history").alias("source"))
    added = decisions.where(F.col("outcome") == "added").select(
        "match_date", "gender", "level", "surface", order, "winner_key", "loser_key", F.lit("feed").alias("source"))
    return p.unionByName(added).withColumn("canonical_id", F.concat(F.lit("m:"), T.sha_id(
        24, F.col("source"), F.col(order).cast("string"), F.date_format("match_date", "yyyy-MM-dd"),
        F.col("gender"), F.col("winner_key"), F.col("loser_key"))))


def overlap_candidates(feed: DataFrame, primary: DataFrame, per_row: int = 3) -> DataFrame:
    """Heuristic overlaps on gender, date and family names.

    Only the first ``per_row`` primary rows of a key can be candidates, so they are picked
    before the join and a crowded key fans out by ``per_row`` at most.
    """
    def keyed(df: DataFrame) -> DataFrame:
        return (df.withColumn("w_family", T.family_name(F.col("winner_name")))
                .withColumn("l_family", T.family_name(F.col("loser_name"))).where("l_family <> ''"))

    key = ["gender", "match_date", "w_family", "l_family"]
    words = lambda c: T.tokens(T.normalize_name(c))
    order = Window.partitionBy(*key).orderBy("seq")
    top = (keyed(primary).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= per_row)
           .select(*key, "rank", F.col("seq").alias("primary_seq"), words(F.col("tourney_name")).alias("p_words")))
    return keyed(feed).join(top, key).select(
        "seq", "primary_seq", F.col("rank").cast("bigint").alias("rank"),
        F.when(F.arrays_overlap(words(F.col("tourney_name")), F.col("p_words")), "medium").otherwise("low")
        .alias("confidence"))


def pick_to_prediction(picks: DataFrame, predictions: DataFrame) -> DataFrame:
    """Prediction of each pick: by feed id, refined by the pair, then by date and pair.

    ``picks``: pick_id, date, gender, digits, pair (NULL when a side is unmapped).
    ``predictions``: date, gender, digits, pair, seq. Each lookup is an aggregate with a count
    and the lowest match order, so a crowded key costs one row in the join.
    """
    one = [F.count("*").alias("n"), F.min("seq").alias("first_seq")]
    by_id = predictions.where("digits <> ''").groupBy("date", "gender", "digits").agg(*one)
    by_id_pair = predictions.where("digits <> ''").groupBy("date", "gender", "digits", "pair").agg(*one)
    by_pair = predictions.groupBy("date", "gender", "pair").agg(*one)
    named = lambda df, p: df.withColumnsRenamed({"n": f"{p}_n", "first_seq": f"{p}_seq"})
    j = (picks.join(named(by_id, "id"), ["date", "gender", "digits"], "left")
         .join(named(by_id_pair, "idp"), ["date", "gender", "digits", "pair"], "left")
         .join(named(by_pair, "pr"), ["date", "gender", "pair"], "left"))
    known = F.col("pair").isNotNull()
    rules = [("matched_by_match_id", F.col("id_n") == 1, "id_seq"),
             ("matched_by_match_id_pair", (F.col("id_n") > 1) & known & (F.col("idp_n") == 1), "idp_seq"),
             ("matched_by_match_id_ambiguous", (F.col("id_n") > 1) & known, "id_seq"),
             ("matched_by_date_gender_pair", F.col("pr_n") == 1, "pr_seq"),
             ("matched_by_date_gender_pair_ambiguous", F.col("pr_n") > 1, "pr_seq")]
    status, seq = F.lit("no_prediction_match"), F.lit(None).cast("bigint")
    for name, test, column in reversed(rules):
        status, seq = F.when(test, name).otherwise(status), F.when(test, F.col(column)).otherwise(seq)
    return j.select(*picks.columns, status.alias("match_status"), seq.alias("prediction_seq"))


# --- lookup by several keys ------------------------------------------------
def key_variants(df: DataFrame) -> Column:
    """Prefixed keys in order of priority; blank ones left out."""
    text = lambda c: F.nullif(F.trim(F.col(c).cast("string")), F.lit(""))
    combo = F.concat_ws("|", *[F.coalesce(text(c), F.lit("")) for c in ("date", "player_key", "opponent_key", "side")])
    keys = [F.concat(F.lit(f"{c}:"), text(c)) for c in ("pick_id", "event_key", "fixture_id")]
    keys.append(F.when(combo != "|||", F.concat(F.lit("combo:"), combo)))
    return F.filter(F.transform(F.array(*keys), lambda k, i: F.struct(i.alias("priority"), k.alias("key"))),
                    lambda e: e["key"].isNotNull())


def settle_by_key_variants(active: DataFrame, source: DataFrame, order: str, payload: list[str]) -> DataFrame:
    """Best settled source row of each active row: first key that hits, last row of that key.

    Source rows whose ``result`` is not final are not looked at; results come out in lower case.
    """
    source = source.withColumn("result", F.lower(F.trim("result"))).where(F.col("result").isin(*K.SETTLED))
    last = (source.select(order, *payload, F.explode(key_variants(source)).alias("e"))
            .groupBy(F.col("e.key").alias("key")).agg(F.max(F.struct(order, *payload)).alias("src")))
    hits = (active.select("pick_id", F.explode(key_variants(active)).alias("e"))
            .select("pick_id", "e.priority", "e.key").join(last, "key")
            .groupBy("pick_id").agg(F.min(F.struct("priority", "src")).alias("b")))
    return active.join(hits, "pick_id", "left").select(
        *active.columns, F.col("b.priority").alias("matched_priority"),
        *[F.col(f"b.src.{c}").alias(f"source_{c}") for c in payload])


ANCHOR = 4   # characters of the piece that stands for a map key
FEW_ANCHORS = 1 << 16   # map keys that are sent to all executors, at most


def surface_text_lookup(texts: DataFrame, surface_map: DataFrame, longest: bool = True) -> DataFrame:
    """Surface of the map key contained in a text: the longest key, or the first of the map.

    A substring test against every key would be a cross join. Instead each distinct text is cut into
    pieces of one length (``ANCHOR``, or the shortest key's), and each key is represented by the one of its pieces that the
    fewest texts have. Texts and keys meet on that piece, and ``contains`` confirms the hit. A key
    with a piece that no text has meets nothing. ``texts``: text. ``surface_map``: map_key, map_value, position;
    an empty key is none.
    """
    keys = surface_map.where("map_key <> ''")
    shortest = keys.agg(F.min(F.length("map_key"))).first()[0]
    size = min(ANCHOR, shortest or ANCHOR)

    def pieces(column: str) -> Column:
        starts = F.sequence(F.lit(1), F.length(column) - (size - 1))
        return F.when(F.length(column) >= size, F.array_distinct(F.transform(starts, lambda i: F.substr(F.col(column), i, F.lit(size)))))

    cut = materialise(texts.select("text").distinct().select("text", F.explode(pieces("text")).alias("piece")), "pieces")
    common = cut.groupBy("piece").agg(F.count("*").alias("texts"))
    own = keys.select("map_key").distinct().select("map_key", F.explode(pieces("map_key")).alias("piece"))
    rarest = F.min(F.struct(F.coalesce("texts", F.lit(0)).alias("texts"), "piece")).alias("best")
    # pieces are many rows in small files, so their size on disk must not make them the side that is sent around
    anchors = own.join(common.hint("merge"), "piece", "left").groupBy("map_key").agg(rarest).where("best.texts > 0").select("map_key", "best.piece")
    anchors = materialise(anchors, "anchors")
    anchors = F.broadcast(anchors) if anchors.count() <= FEW_ANCHORS else anchors.hint("merge")
    hits = cut.join(anchors, "piece").where(F.contains("text", "map_key")).select("text", "map_key")
    rank = F.struct((-F.length("map_key")).alias("len"), "map_key", "map_value") if longest else F.struct(
        "position", "map_key", "map_value")
    return (hits.join(keys, "map_key").groupBy("text").agg(F.min(rank).alias("b"))
            .select("text", F.col("b.map_key").alias("map_key"), F.col("b.map_value").alias("surface")))


def _traced(queries: DataFrame) -> DataFrame:
    """(query, kind, value) of the keys and exact names that are looked for."""
    return queries.select("query", F.explode(F.array(
        F.struct(F.lit("key").alias("kind"), F.col("player_key").alias("value")),
        F.struct(F.lit("name").alias("kind"), T.normalize_name(F.col("name")).alias("value")))).alias("q")).select(
        "query", "q.kind", "q.value").where("value <> ''")


def trace_rows(sides: DataFrame, queries: DataFrame) -> DataFrame:
    """Every appearance (all columns of ``sides``) of a queried key or name, once per query.

    A side is matched by its key, else by its name; adaptive execution splits a player with many rows.
    """
    q = _traced(queries)
    by = lambda kind, value: sides.withColumn("value", value).join(
        q.where(F.col("kind") == kind).select("query", "value").distinct(), "value").drop("value")
    keyed = by("key", F.col("player_key")).withColumn("matched_by", F.lit("key"))
    named = by("name", T.normalize_name(F.col("name"))).withColumn("matched_by", F.lit("name"))
    own_keys = q.where(F.col("kind") == "key").select("query", F.col("value").alias("player_key")).distinct()
    return keyed.unionByName(named.join(own_keys, ["query", "player_key"], "left_anti"))


FEW_IDS = 50           # so many ids are looked up in the files of the index; more are joined
ROW_GROUP = 1 << 20    # bytes of a row group of the index: what one lookup reads at least
INDEX_KEYS = {"by_key": "player_key", "by_name": "name_norm"}


def index_sides(sides: DataFrame, path: str, order: list[str]) -> None:
    """Write the side table twice, sorted by key and by normalised name, with a Bloom filter of that column in each row group.

    ``order`` ends in a unique column, so that a player with many rows is spread over files like any other.
    """
    named = sides.withColumn("name_norm", T.normalize_name(F.col("name")))
    for table, column in INDEX_KEYS.items():
        keyed = named.repartitionByRange(column, *order).sortWithinPartitions(column, *order)
        (keyed.write.option(f"parquet.bloom.filter.enabled#{column}", "true").option("parquet.block.size", str(ROW_GROUP))
         .parquet(f"{path}/{table}"))


def trace_few(spark, path: str, queries: DataFrame) -> DataFrame:
    """``trace_rows`` over an index: with few ids only row groups that may hold one are read.

    The ids reach the scan as equality tests, which smallest and largest values and Bloom filters answer
    without reading rows.
    """
    def held(table: str, kind: str, q: DataFrame) -> DataFrame:
        column, rows = INDEX_KEYS[table], spark.read.parquet(f"{path}/{table}")
        asked = q.where(F.col("kind") == kind).select("query", F.col("value").alias(column)).distinct()
        values = [r[0] for r in asked.select(column).distinct().limit(FEW_IDS + 1).collect()]  # FEW_IDS values and one
        if len(values) <= FEW_IDS:
            test = F.lit(False)
            for value in sorted(values):
                test = test | (F.col(column) == value)
            rows = rows.where(test)
        return rows.join(asked, column)

    q = _traced(queries)
    own_keys = q.where("kind = 'key'").select("query", F.col("value").alias("player_key")).distinct()
    keyed = held("by_key", "key", q).withColumn("matched_by", F.lit("key"))
    named = held("by_name", "name", q).withColumn("matched_by", F.lit("name"))
    return keyed.unionByName(named.join(own_keys, ["query", "player_key"], "left_anti")).drop("name_norm")


def trace_ids(sides: DataFrame, queries: DataFrame) -> DataFrame:
    """Appearances of queried keys or exact names, counted per key and source."""
    q = _traced(queries)
    wanted = sides.select("source", "player_key", F.explode(F.array(
        F.struct(F.lit("key").alias("kind"), F.col("player_key").alias("value")),
        F.struct(F.lit("name").alias("kind"), T.normalize_name(F.col("name")).alias("value")))).alias("s")).select(
        "source", "s.kind", "s.value")
    # count before joining: a player that holds many rows reaches the join as one
    counted = wanted.groupBy("source", "kind", "value").agg(F.count("*").alias("appearances"))
    return counted.join(q, ["kind", "value"]).groupBy("query", "kind", "source").agg(
        F.sum("appearances").alias("appearances"))


def many_to_one(mapping: DataFrame, at_least: int = 4) -> DataFrame:
    """Targets that more than three feed keys map to."""
    return (mapping.where(F.col("target_key").isNotNull()).groupBy("target_key")
            .agg(F.countDistinct("api_key").alias("feed_keys"), F.min("api_key").alias("first_key"),
                 F.max("api_key").alias("last_key")).where(F.col("feed_keys") >= at_least))
