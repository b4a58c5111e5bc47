"""Review loops around the mapping: duplicates, metadata, verdicts, coverage, daily audit, queue."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rallyframe import constants as K
from rallyframe.functions import text as T
from rallyframe.functions.values import api_key_variants, rounded, share
from rallyframe.operators.audits import findings
from rallyframe.operators.cuts import grouped_cuts
from rallyframe.operators.sides import explode_sides, most_common, top_values
from rallyframe.workspace import materialise


def _mapped(status: str, target: str) -> Column:
    return F.coalesce(F.col(status).isin(*K.MAPPED_STATUSES) & (F.coalesce(target, F.lit("")) != ""), F.lit(False))


# --- duplicates ------------------------------------------------------------
def duplicate_groups(players: DataFrame) -> DataFrame:
    """Players that share gender and normalised name, with risk and the key to keep.

    Everything about a group is an aggregate; the keys of a group are its rows, never a list.
    ``players``: player_key, gender, name, country, birth_year, matches.
    """
    p = players.withColumn("norm", T.normalize_name(F.col("name"))).where("norm <> ''").dropDuplicates(["player_key"])
    tail = F.coalesce(F.nullif(F.regexp_extract("player_key", r":(\d+)$", 1), F.lit("")).cast("bigint"), F.lit(0))
    groups = p.groupBy("gender", "norm").agg(
        F.count("*").alias("keys"), F.countDistinct("country").alias("countries"), F.countDistinct("birth_year").alias("years"),
        F.min("matches").alias("low"), F.max("matches").alias("high"),
        F.max(F.struct("matches", tail.alias("tail"), "player_key"))["player_key"].alias("recommended_key")).where("keys >= 2")
    one_country, one_year = F.col("countries") <= 1, F.col("years") <= 1
    risk = (F.when(one_country & one_year, F.when((F.col("low") <= 2) & (F.col("high") >= 10), "LOW").otherwise("MEDIUM"))
            .when(~one_country & ~one_year, "HIGH").otherwise("CHECK"))
    return p.join(groups.withColumn("risk_level", risk), ["gender", "norm"]).select(
        "risk_level", "gender", "norm", "player_key", "matches", "country", "birth_year", F.col("keys").alias("keys_in_group"), "recommended_key")


def alias_template(groups: DataFrame) -> DataFrame:
    return groups.where(F.col("risk_level").isin("LOW", "MEDIUM", "CHECK") & (F.col("player_key") != F.col("recommended_key"))).select(
        F.col("player_key").alias("alias_key"), F.col("recommended_key").alias("canonical_key"))


# --- metadata --------------------------------------------------------------
def player_metadata(history: DataFrame, master: DataFrame) -> DataFrame:
    """Master values, else the most common value of the history lines; top five variants of each."""
    def side(s: str) -> Column:
        year = F.substring("tourney_date", 1, 4).try_cast("int")
        age = F.col(f"{s}_age").try_cast("double")
        born = F.when((age > 0) & F.col("tourney_date").rlike("^[0-9]{8}$"), F.rint(year - age).cast("int").cast("string"))
        blank = lambda c: F.nullif(F.trim(F.col(f"{s}_{c}")), F.lit(""))
        return F.struct(blank("id").alias("player_id"), blank("name").alias("name"), F.upper(blank("ioc")).alias("country"),
                        blank("hand").alias("hand"), blank("ht").alias("height"), born.alias("approx_birth_year"))

    rows = history.select("gender", F.explode(F.array(side("winner"), side("loser"))).alias("s")).select("gender", "s.*").where(
        "player_id IS NOT NULL AND name IS NOT NULL").withColumn("player_key", F.concat_ws(":", "gender", F.lit(K.HISTORY_FEED), "player_id"))
    rows = materialise(rows, "metadata-sides")
    out = rows.groupBy("player_key").agg(F.min("name").alias("name"), F.count("*").alias("sides"))
    for value in ("country", "hand", "height", "approx_birth_year"):
        known = rows.where(F.col(value).isNotNull())
        out = out.join(most_common(known, ["player_key"], value), "player_key", "left").join(
            top_values(known, "player_key", value, 5), "player_key", "left")
    m = master.select("player_key", F.col("name").alias("m_name"), F.col("country").alias("m_country"), F.col("hand").alias("m_hand"),
                      F.col("height").alias("m_height"), "first_name", "last_name", "birth_date")
    return out.join(m, "player_key", "full_outer").select(
        "player_key", F.coalesce("m_name", "name").alias("name"), F.coalesce("m_country", "country").alias("country"),
        F.coalesce("m_hand", "hand").alias("hand"), F.coalesce("m_height", "height").alias("height"), "approx_birth_year", "birth_date",
        "first_name", "last_name", "top_country", "top_hand", "top_height", "top_approx_birth_year",
        F.coalesce("sides", F.lit(0)).alias("sides"))


def metadata_coverage(metadata: DataFrame, rating_keys: DataFrame) -> DataFrame:
    both = metadata.select("player_key", F.lit(True).alias("m")).join(
        rating_keys.select("player_key", F.lit(True).alias("r")).distinct(), "player_key", "full_outer")
    return both.agg(F.count_if("m").alias("metadata_players"), F.count_if("r").alias("rating_players"),
                    F.count_if(F.col("m") & F.col("r")).alias("rating_players_with_metadata"),
                    F.count_if(F.col("m").isNull()).alias("rating_players_missing_metadata"),
                    F.count_if(F.col("r").isNull()).alias("metadata_players_not_in_ratings"))


# --- override verdicts -----------------------------------------------------
def name_class(feed: Column, own: Column) -> Column:
    a, b = T.tokens(T.normalize_name(feed)), T.tokens(T.normalize_name(own))
    joined = lambda t: F.array_join(t, "")
    ordered = lambda t: F.array_join(F.array_sort(t), " ")
    last = lambda t: F.try_element_at(t, F.lit(-1))
    first = lambda t: F.try_element_at(t, F.lit(1))
    initial = (F.size(a) == 2) & (F.length(first(a)) == 1) & (F.size(b) >= 2) & (first(a) == F.substring(first(b), 1, 1)) & (last(a) == last(b))
    return (F.when((F.size(a) == 0) | (F.size(b) == 0), "missing_name").when(F.array_join(a, " ") == F.array_join(b, " "), "exact")
            .when(ordered(a) == ordered(b), "token_set_exact").when(joined(a) == joined(b), "compact_exact")
            .when(initial, "initial_surname").when(last(a) == last(b), "same_surname")
            .when(F.arrays_overlap(a, b), "partial_token_overlap").otherwise("weak"))


def override_verdicts(overrides: DataFrame) -> DataFrame:
    """SAFE, LIKELY_OK, CHECK or RISKY from name class, country and birth year.

    ``overrides``: api_key, feed_name, own_name, feed_country, own_country, feed_year, own_year.
    """
    o = overrides.withColumn("name_class", name_class(F.col("feed_name"), F.col("own_name")))
    both = F.col("feed_country").isNotNull() & F.col("own_country").isNotNull()
    country = F.when(~both, "unknown").when(F.col("feed_country") == F.col("own_country"), "match").otherwise("mismatch")
    gap = F.abs(F.col("feed_year") - F.col("own_year"))
    year = F.when(gap.isNull(), "unknown").when(gap == 0, "match").when(gap == 1, "near").otherwise("mismatch")
    o = o.withColumn("country_class", country).withColumn("year_class", year)
    exact = F.col("name_class").isin("exact", "token_set_exact", "compact_exact")
    partial = F.col("name_class").isin("same_surname", "partial_token_overlap")
    c_ok, y_ok = F.col("country_class") == "match", F.col("year_class").isin("match", "near")
    clash = (F.col("country_class") == "mismatch") | (F.col("year_class") == "mismatch")
    verdict = (F.when(exact, F.when(clash, "CHECK").otherwise("SAFE")).when(clash, "RISKY")
               .when(F.col("name_class") == "initial_surname", F.when(c_ok | y_ok, "LIKELY_OK").otherwise("CHECK"))
               .when(partial, F.when(c_ok & y_ok, "LIKELY_OK").when(c_ok | y_ok, "CHECK").otherwise("RISKY")).otherwise("RISKY"))
    return o.select("api_key", "name_class", "country_class", "year_class", verdict.alias("verdict"),
                    F.concat_ws(" ", "name_class", F.concat(F.lit("country:"), "country_class"), F.concat(F.lit("year:"), "year_class")).alias("reasons"))


# --- coverage --------------------------------------------------------------
def side_status(feed: DataFrame, mapping: DataFrame) -> DataFrame:
    """Feed matches with the mapping state of both sides."""
    out = feed
    for side in ("winner", "loser"):
        m = mapping.select(F.col("api_key").alias(f"{side}_api_key"), F.col("status").alias("_s"), F.col("target_key").alias("_t"))
        out = out.join(m, f"{side}_api_key", "left").withColumn(f"{side}_mapped", _mapped("_s", "_t")).withColumn(
            f"{side}_status", F.coalesce("_s", F.lit("missing_mapping_entry"))).drop("_s", "_t")
    both, one = F.col("winner_mapped") & F.col("loser_mapped"), F.col("winner_mapped") | F.col("loser_mapped")
    return out.withColumn("coverage", F.when(both, "both_mapped").when(one, "one_mapped").otherwise("none_mapped"))


def mapping_coverage(status: DataFrame) -> DataFrame:
    cells = status.groupBy("coverage", "level").agg(F.count("*").alias("n"))
    total = cells.agg(F.sum("n").alias("total"))
    rows = grouped_cuts(cells, {"coverage": ["coverage"], "coverage_level": ["coverage", "level"]}, [F.sum("n").alias("matches")]).select(
        "cut", F.concat_ws("|", "coverage", "level").alias("value"), "matches")
    return rows.crossJoin(F.broadcast(total)).select("cut", "value", "matches", share(F.col("matches") * 100, F.col("total"), 3).alias("pct"))  # one row


def unmapped_impact(status: DataFrame) -> DataFrame:
    """Matches each unmapped player holds back."""
    side = lambda s: F.struct(F.col(f"{s}_api_key").alias("api_key"), F.col(f"{s}_status").alias("status"), F.col(f"{s}_mapped").alias("mapped"))
    rows = materialise(status.select("level", "surface", "tourney_name", F.explode(F.array(side("winner"), side("loser"))).alias("s")).where(
        "NOT s.mapped").select("s.api_key", "s.status", "level", "surface", "tourney_name"), "unmapped-sides")
    out = rows.groupBy("api_key").agg(F.min("status").alias("mapping_status"), F.count("*").alias("matches"),
                                      *[F.count_if(F.col("level") == lv).alias(f"{lv}_matches") for lv in K.LEVELS])
    return out.join(top_values(rows, "api_key", "surface", 5), "api_key").join(top_values(rows, "api_key", "tourney_name", 5), "api_key")


def mapping_issues(mapping: DataFrame, feed_keys: DataFrame) -> DataFrame:
    """Row checks of the mapping, and feed players it lacks."""
    accepted = F.col("status").isin(*K.MAPPED_STATUSES)
    target = F.coalesce("target_key", F.lit(""))
    target_gender = F.nullif(F.regexp_extract(target, "^([a-z]+):", 1), F.lit(""))
    rows = findings(mapping, ["api_key"], {
        "invalid_status": ~F.col("status").isin(*K.MAPPING_STATUSES), "invalid_gender": ~F.col("gender").isin(*K.GENDERS),
        "accepted_mapping_without_target": accepted & (target == ""), "nonaccepted_mapping_has_target": ~accepted & (target != ""),
        "target_gender_mismatch": target_gender.isNotNull() & (target_gender != F.col("gender"))})
    absent = feed_keys.select("api_key").distinct().join(mapping, "api_key", "left_anti")
    return rows.unionByName(absent.select("api_key", F.lit("source_player_missing_mapping_entry").alias("issue")))


# --- daily audit -----------------------------------------------------------
def daily_players(fixtures: DataFrame, mapping: DataFrame, overrides: DataFrame) -> DataFrame:
    """Singles players of a day with the entry that maps them: overrides first, then the mapping, any key spelling.

    ``fixtures``: seq, gender, event_type_type, tournament_name, first/second player key and name.
    """
    side = lambda a, b: F.struct(F.col(f"{a}_player_key").alias("raw_key"), F.col(f"event_{a}_player").alias("name"),
                                 F.col(f"event_{b}_player").alias("opponent"))
    sides = fixtures.select("seq", "gender", "tournament_name", F.explode(F.array(side("first", "second"), side("second", "first"))).alias("s")).select(
        "seq", "gender", "tournament_name", "s.*").withColumn("api_key", F.concat_ws(":", "gender", F.lit(K.FIXTURE_FEED), "raw_key"))
    keys = sides.select("api_key", "gender").distinct().select("api_key", F.posexplode(api_key_variants(F.col("api_key"), F.col("gender"))).alias("pos", "key"))
    entry = lambda df, rank, name: df.select(F.col("api_key").alias("key"), "status", "target_key", F.lit(rank).alias("rank"), F.lit(name).alias("source"))
    entries = entry(overrides, 0, "override").unionByName(entry(mapping, 1, "mapping"))
    found = keys.join(entries, "key").groupBy("api_key").agg(F.min_by(F.struct("status", "target_key", "source"), F.struct("rank", "pos")).alias("e"))
    return sides.join(found, "api_key", "left").select(*sides.columns, F.coalesce("e.status", F.lit("missing_mapping_entry")).alias("status"),
                                                       F.col("e.target_key").alias("target_key"), F.coalesce("e.source", F.lit("")).alias("source"))


def daily_coverage(players: DataFrame) -> DataFrame:
    """Match coverage, blocked matches, and whether the scan can run."""
    per_match = players.groupBy("seq").agg(F.count_if(_mapped("status", "target_key")).alias("mapped"))
    per_player = players.groupBy("api_key").agg(F.max(_mapped("status", "target_key")).alias("mapped"))
    m = per_match.agg(F.count("*").alias("matches"), F.count_if(F.col("mapped") == 2).alias("both_mapped"), F.count_if(F.col("mapped") == 1).alias("one_mapped"),
                      F.count_if(F.col("mapped") == 0).alias("none_mapped"))
    p = per_player.agg(F.count("*").alias("players"), F.count_if("mapped").alias("mapped_players"))
    blocked = F.col("one_mapped") + F.col("none_mapped")
    return m.crossJoin(p).select("*", blocked.alias("blocked_matches"), ((blocked == 0) & (F.col("matches") > 0)).alias("scanner_ready"))  # one row each


def daily_review(players: DataFrame, candidates: DataFrame) -> DataFrame:
    """Unmapped players of the day with their first three candidates side by side.

    ``candidates``: api_key, cand_key, score, method.
    """
    open_players = players.where(~_mapped("status", "target_key")).groupBy("api_key").agg(
        F.min("status").alias("mapping_status"), F.countDistinct("seq").alias("match_count"))
    order = Window.partitionBy("api_key").orderBy(F.desc("score"), "cand_key")
    count = candidates.groupBy("api_key").agg(F.count("*").alias("candidate_count"))
    top = candidates.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= 3)
    pick = lambda i, c: F.max(F.when(F.col("rank") == i, F.col(c)))
    wide = top.groupBy("api_key").agg(*[pick(i, c).alias(f"candidate_{i}_{n}") for i in (1, 2, 3)
                                        for n, c in (("key", "cand_key"), ("score", "score"), ("method", "method"))])
    margin = rounded(F.col("candidate_1_score") - F.col("candidate_2_score"), 6)
    initial = ("exact_initial_form", "initial_surname", "initial_surname+country")
    close = F.when(F.col("candidate_1_method").isin(*initial) & F.col("candidate_2_method").isin(*initial), 0.025).otherwise(0.010)
    j = open_players.join(wide, "api_key", "left").join(count, "api_key", "left")
    j = j.withColumn("candidate_margin", margin).withColumn("ambiguous", F.coalesce(margin < close, F.lit(False)))
    return j.select("api_key", "mapping_status", "match_count", F.coalesce("candidate_count", F.lit(0)).alias("candidate_count"),
                    *[f"candidate_{i}_{n}" for i in (1, 2, 3) for n in ("key", "score")], "candidate_margin", "ambiguous",
                    F.when(F.col("candidate_count").isNull(), "no_candidate").otherwise("review").alias("outcome"),
                    F.when(F.col("candidate_count").isNotNull() & ~F.col("ambiguous"), F.col("candidate_1_key")).alias("suggested_target"))


# --- applying a review -----------------------------------------------------
def review_outcomes(review: DataFrame) -> DataFrame:
    """Action of every reviewed row: reject, a manual key, an accepted rank, or why it is skipped."""
    api = F.trim(F.coalesce("api_key", F.lit("")))
    rejected = F.lower(F.trim(F.coalesce("reject", F.lit("")))).isin("1", "true", "yes", "y", "x", "reject", "manual_unmapped", "unmapped")
    manual = F.nullif(F.trim(F.coalesce("manual_key", F.lit(""))), F.lit(""))
    number = F.trim(F.coalesce("accept_rank", F.lit(""))).try_cast("int")
    chosen = F.coalesce(manual, F.when(number == 1, F.col("candidate_1_key")).when(number == 2, F.col("candidate_2_key"))
                        .when(number == 3, F.col("candidate_3_key")))
    chosen = F.nullif(F.trim(F.coalesce(chosen, F.lit(""))), F.lit(""))
    reason = (F.when(api == "", "missing_api_player_key").when(~api.rlike(f"^(men|women):{K.FIXTURE_FEED}:"), "invalid_api_player_key")
              .when(rejected, None).when(chosen.isNull(), "no_accepted_candidate")
              .when(~chosen.rlike(f"^(men|women):{K.HISTORY_FEED}:"), "invalid_target_key"))
    return review.select("row_no", api.alias("api_key"), reason.alias("skip_reason"),
                         F.when(reason.isNull(), F.when(rejected, "manual_unmapped").otherwise("manual_mapped")).alias("action"),
                         F.when(reason.isNull() & ~rejected, chosen).alias("target_key"))


def apply_review(overrides: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Overrides after the review; of several rows for one key the later one wins."""
    last = outcomes.where("skip_reason IS NULL").groupBy("api_key").agg(F.max(F.struct("row_no", "target_key")).alias("n"))
    both = overrides.select("api_key", F.col("target_key").alias("old"), F.lit(True).alias("had")).join(last, "api_key", "full_outer")
    new = F.col("n").isNotNull()
    return both.select("api_key", F.when(new, F.col("n.target_key")).otherwise(F.col("old")).alias("target_key"),
                       F.when(~new, "kept").when(F.col("had"), "replaced").otherwise("added").alias("change"))


# --- verification queue ----------------------------------------------------
def verification_queue(open_players: DataFrame, candidates: DataFrame, feed: DataFrame, mapping: DataFrame, examples: int = 3,
                       listed_candidates: int = 5) -> DataFrame:
    """Unresolved players with priority, their latest distinct matches, and a compact candidate list.

    ``feed``: feed matches with flat keys; ``candidates``: api_key, rank, cand_key, score, action.
    """
    sides = explode_sides(feed, ["seq", "match_date", "level", "surface", "tourney_name", "round"]).withColumnRenamed("player_key", "api_key")
    same = ["api_key", "seq", "match_date", "opponent_key"]   # one example, however often the feed has it
    mine = sides.join(open_players.select("api_key"), "api_key", "left_semi").groupBy(*same).agg(
        F.max(F.struct("won", "level", "surface", "tourney_name", "round")).alias("m")).select(*same, "m.*")
    counts = mine.groupBy("api_key").agg(F.count("*").alias("matches"), F.count_if(F.col("level").isin("atp_wta", "grand_slam")).alias("high"),
                                         F.count_if(F.col("level") == "challenger").alias("challenger"))
    top = F.when(F.col("rank") <= listed_candidates, F.struct("rank", F.concat_ws(" | ", "cand_key", F.col("score").cast("string")).alias("t")))
    listed = candidates.groupBy("api_key").agg(
        F.max(F.when(F.col("rank") == 1, F.col("action"))).alias("action"), F.count("*").alias("candidate_count"),
        F.array_join(F.transform(F.array_sort(F.collect_list(top)), lambda x: x["t"]), " ; ").alias("top_candidates"))
    order = Window.partitionBy("api_key").orderBy(F.desc("match_date"), F.desc("level"), F.desc("tourney_name"), F.desc("seq"), F.desc("won"))
    shown = mine.withColumn("example_index", F.row_number().over(order)).where(F.col("example_index") <= examples)
    m = mapping.select(F.col("api_key").alias("opponent_key"), _mapped("status", "target_key").alias("opponent_mapped"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    label = (F.when(F.col("action") == "safe_override", "safe_candidate").when(zero("high") > 0, "high_level")
             .when(zero("challenger") > 0, "challenger").when(zero("matches") >= 5, "many_matches").otherwise("low_priority"))
    return (open_players.join(counts, "api_key", "left").join(listed, "api_key", "left").join(shown, "api_key", "left").join(m, "opponent_key", "left")
            .select("api_key", label.alias("priority"), zero("matches").alias("match_count"), zero("example_index").cast("bigint").alias("example_index"),
                    "match_date", "level", "surface", "tourney_name", "round", "won", "opponent_key",
                    F.when(F.col("opponent_key").isNotNull(), F.coalesce("opponent_mapped", F.lit(False))).alias("opponent_mapped"),
                    zero("candidate_count").cast("bigint").alias("candidate_count"), "top_candidates"))


# --- seen ------------------------------------------------------------------
def first_last_seen(frames: list[tuple[str, DataFrame]]) -> DataFrame:
    """Per player over several sources: first and last day, appearances per source and distinct matches.

    Frames hold seq, match_date, player_key, name, tourney_name.
    """
    rows = materialise(reduce(DataFrame.unionByName, [
        f.select("seq", "match_date", "player_key", "name", "tourney_name").withColumn("source", F.lit(s)) for s, f in frames]), "seen")
    out = rows.groupBy("player_key").agg(
        F.min("match_date").alias("first_seen"), F.max("match_date").alias("last_seen"), F.count("*").alias("appearances"),
        F.countDistinct("seq").alias("distinct_matches"), *[F.count_if(F.col("source") == s).alias(f"{s}_rows") for s, _ in frames])
    return out.join(most_common(rows, ["player_key"], "name"), "player_key").join(
        most_common(rows, ["player_key"], "tourney_name").withColumnRenamed("tourney_name", "example_tournament"), "player_key")
