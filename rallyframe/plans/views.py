"""The engine's input shapes, derived from the given tables.

No row of a table is left out: feeds differ by rewriting columns, never by filtering. (An event without
its partner alone makes no match.)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rallyframe.functions.classify import first_match


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def matches(spark: SparkSession, sf: str) -> DataFrame:
    """Two consecutive events make one match: the even one is the winner."""
    even = F.col("event_id") % 2 == 0
    win = lambda c: F.max(F.when(even, c))
    lose = lambda c: F.max(F.when(~even, c))
    pairs = (
        table(spark, sf, "events")
        .select("event_id", "ts", "user_id", "event_type", "value",
                F.get_json_object("props", "$.k").cast("bigint").alias("k"))
        .groupBy(F.expr("event_id div 2").alias("seq"))
        .agg(win(F.col("ts")).alias("ts"), win(F.col("event_type")).alias("event_type"),
             win(F.col("user_id")).alias("winner_id"), lose(F.col("user_id")).alias("loser_id"),
             win(F.col("value")).alias("winner_value"), lose(F.col("value")).alias("loser_value"),
             win(F.col("k")).alias("k"), lose(F.col("k")).alias("loser_k"))
        .where(F.col("winner_id").isNotNull() & F.col("loser_id").isNotNull())
    )
    code = F.col("k") % 8
    gender = F.when(F.col("seq") % 2 == 0, "men").otherwise("women")
    level = first_match([(lv, F.col("event_type") == ev) for ev, lv in (
        ("view", "itf"), ("click", "challenger"), ("purchase", "atp_wta"), ("signup", "qualifying"))],
        "grand_slam")
    surface = first_match([("grass", code == 0), ("carpet", code == 1), ("unknown", code == 2),
                           ("clay", code <= 4)], "hard")
    d = F.to_date("ts")
    return pairs.select(
        "seq", d.alias("match_date"), F.year(d).cast("bigint").alias("year"), gender.alias("gender"),
        level.alias("level"), surface.alias("surface"), "winner_id", "loser_id",
        F.concat_ws(":", gender, F.lit("history"), "winner_id").alias("winner_key"),
        F.concat_ws(":", gender, F.lit("history"), "loser_id").alias("loser_key"),
        F.concat(F.lit("Player "), "winner_id").alias("winner_name"),
        F.concat(F.lit("Player "), "loser_id").alias("loser_name"),
        F.concat(F.lit("R"), F.col("seq") % 6).alias("round"),
        F.date_format(d, "yyyy-MM-dd").alias("tourney_id"),
        F.concat_ws(" ", F.lit("Open"), F.date_format(d, "MMdd"), "event_type").alias("tourney_name"),
        (F.floor("winner_value") % 8).alias("w1"), (F.floor("loser_value") % 8).alias("l1"),
        (F.col("k") % 8).alias("w2"), (F.col("loser_k") % 8).alias("l2"),
        "k", "loser_k", "event_type", "winner_value", "loser_value",
    )


def valid_matches(spark: SparkSession, sf: str) -> DataFrame:
    return matches(spark, sf).where("winner_key <> loser_key")


def fixture_matches(spark: SparkSession, sf: str) -> DataFrame:
    """The second feed: same matches under its own ids, some moved, swapped or renamed."""
    m = matches(spark, sf)
    swap = F.col("seq") % 30 == 0
    d = F.when(F.col("seq") % 5 == 3, F.date_add("match_date", 60)).otherwise(F.col("match_date"))
    api_key = lambda c: F.concat_ws(":", "gender", F.lit("api"), c + 100000)
    w, l = F.col("winner_id"), F.col("loser_id")
    return m.select(
        "seq", d.alias("match_date"), "gender", "level", "surface",
        F.when(F.col("seq") % 4 == 0, "R9").otherwise(F.col("round")).alias("round"),
        "tourney_id", "tourney_name",
        api_key(F.when(swap, l).otherwise(w)).alias("winner_api_key"),
        api_key(F.when(swap, w).otherwise(l)).alias("loser_api_key"),
        F.concat(F.lit("P. "), F.when(swap, l).otherwise(w)).alias("winner_name"),
        F.concat(F.lit("P. "), F.when(swap, w).otherwise(l)).alias("loser_name"),
    )


def mapping(spark: SparkSession, sf: str) -> DataFrame:
    """Feed key to history key with a status, for every user and gender."""
    u = F.col("user_id")
    status = first_match([("unmapped", u % 11 == 0), ("ambiguous", u % 13 == 0),
                          ("manual_mapped", u % 7 == 0)], "auto_mapped")
    return (
        table(spark, sf, "events").select("user_id").distinct()
        .select("user_id", F.explode(F.array(F.lit("men"), F.lit("women"))).alias("gender"))
        .select(F.concat_ws(":", "gender", F.lit("api"), u + 100000).alias("api_key"), "gender",
                status.alias("status"),
                F.when(status.isin("auto_mapped", "manual_mapped"),
                       F.concat_ws(":", "gender", F.lit("history"), u)).alias("target_key"),
                "user_id")
    )


def raw_aliases(spark: SparkSession, sf: str) -> DataFrame:
    """One alias line per customer and gender; many of them invalid."""
    u = F.col("c_custkey")
    own = lambda i: F.concat_ws(":", "gender", F.lit("history"), i)
    other = F.when(F.col("gender") == "men", "women").otherwise("men")
    target = (F.when(F.col("c_mktsegment") == "BUILDING", own(u - 1))
              .when(F.col("c_mktsegment") == "FURNITURE", own(u + 1 - 2 * (u % 2)))
              .when(F.col("c_mktsegment") == "AUTOMOBILE", F.concat_ws(":", other, F.lit("history"), u))
              .when(F.col("c_mktsegment") == "MACHINERY", F.concat_ws(":", "gender", F.lit("name"), u))
              .otherwise(own(u)))
    return (table(spark, sf, "customer")
            .select("c_custkey", "c_mktsegment",
                    F.explode(F.array(F.lit("men"), F.lit("women"))).alias("gender"))
            .select(own(u).alias("alias_key"), target.alias("canonical_key")))


def quotes(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("event_key"),
        F.when((F.col("l_partkey") + F.col("l_linenumber")) % 2 == 0, "home").otherwise("away").alias("side"),
        F.concat(F.lit("bk"), "l_suppkey").alias("bookmaker"),
        ((F.floor(F.col("l_discount") * 100 + 0.5) * 4 + 150 + F.floor(F.col("l_quantity")))
         .cast("double") / 100).alias("odds"),
    )


def picks(spark: SparkSession, sf: str) -> DataFrame:
    low = F.col("o_orderpriority") == "5-LOW"
    status = (F.when(F.col("o_orderstatus") == "F", "win").when(F.col("o_orderstatus") == "O", "loss")
              .when(low, "void").otherwise("pending"))
    odds = (F.floor("o_totalprice") % 320 + 130).cast("decimal(10,2)") / F.lit(100).cast("decimal(3,0)")
    stake = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(1.25)).otherwise(F.lit(1.0))
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("pick_id"), F.col("o_custkey").alias("player_id"),
        F.to_date("o_orderdate").alias("pick_date"),
        F.concat(F.lpad((F.col("o_orderkey") % 24).cast("string"), 2, "0"), F.lit(":30")).alias("pick_time"),
        F.concat(F.lit("Open "), F.col("o_custkey") % 20).alias("tournament"),
        F.concat(F.lit("Match "), F.col("o_custkey")).alias("match_name"),
        F.when(F.col("o_orderkey") % 2 == 0, "home").otherwise("away").alias("side"),
        status.alias("status"), stake.cast("decimal(18,6)").alias("stake"),
        odds.cast("decimal(18,6)").alias("odds"),
        ((F.col("o_orderkey") * 37 % 500 + 300).cast("double") / 1000).alias("model_prob"),
    )


def settle_picks(spark: SparkSession, sf: str) -> DataFrame:
    """Picks as a ledger holds them: sides in any spelling, stakes and odds that may be missing."""
    p = F.col("pick_id")
    spelt = F.array(*[F.lit(x) for x in ("home", "first", "First Player", "1", "away", "second", "Second Player", "2")])
    at = (F.floor(p / 2) % 4 + F.when(F.col("side") == "home", 1).otherwise(5)).cast("int")
    return picks(spark, sf).select(
        "pick_id", p.alias("event_key"), "pick_date", F.when(p % 41 == 0, "both").otherwise(F.element_at(spelt, at)).alias("side"),
        F.when(p % 13 != 0, F.col("stake")).alias("stake"), F.when(p % 19 != 0, F.col("odds")).alias("odds"),
        F.when(p % 38 != 0, (F.col("odds") + F.lit(0.1).cast("decimal(18,6)")).cast("decimal(18,6)")).alias("avg_odds"))


def results(spark: SparkSession, sf: str) -> DataFrame:
    """Result feed of the picks: older rows of an event, winners by label, id or name, events nobody picked."""
    p = picks(spark, sf)
    i, done = F.col("pick_id"), F.col("status").isin("win", "loss")
    home_won = (F.col("side") == "home") == (F.col("status") == "win")
    won = done & (i % 17 != 0)
    name = lambda side: F.concat(F.lit("Player "), i, F.lit(side))
    rows = p.withColumn("row_order", F.explode(F.when(i % 5 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(1)))))
    last = F.col("row_order") == 1
    return rows.select(
        F.when(i % 29 == 0, -i).otherwise(i).alias("event_key"), "row_order",
        F.when(~last, "Scheduled").when(done, F.when((i % 7 != 0) & (i % 11 != 0), "Finished")).when(F.col("status") == "void", "Cancelled")
        .otherwise(F.when(i % 3 == 0, "Not Started").otherwise("")).alias("event_status"),
        F.when(last & done & (i % 7 == 0), "Retired").alias("event_status_info"),
        F.when(last & done & (i % 11 == 0) & (i % 7 != 0), "Match ended").alias("event_status_type"),
        F.when(last & won & (i % 4 <= 1), F.when(home_won, "First Player").otherwise("2")).alias("event_winner"),
        F.when(last & won & (i % 4 == 2), i * 10 + F.when(home_won, 1).otherwise(2)).alias("winner_key"),
        F.when(last & won & (i % 4 == 3), F.upper(F.when(home_won, name("a")).otherwise(name("b")))).alias("winner_name"),
        (i * 10 + 1).alias("first_player_key"), (i * 10 + 2).alias("second_player_key"), name("a").alias("event_first_player"),
        name("b").alias("event_second_player"), F.when(i % 31 == 0, F.date_add("pick_date", 10)).otherwise(F.col("pick_date")).alias("event_date"))


def names(spark: SparkSession, sf: str) -> DataFrame:
    """Two names per document, built from the longest words of its whole text."""
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"([\p{L}]{3,})"), F.lit(1)))
    ranked = F.sort_array(F.transform(words, lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))), asc=False)
    d = (table(spark, sf, "documents")
         .select("doc_id", "lang", "n_chars", ranked.alias("r"))
         .select("doc_id", "lang", "n_chars",
                 F.coalesce(F.try_element_at("r", F.lit(1))["w"], F.lit("")).alias("surname"),
                 F.coalesce(F.try_element_at("r", F.lit(2))["w"], F.lit("")).alias("given"),
                 F.coalesce(F.try_element_at("r", F.lit(3))["w"], F.lit("")).alias("middle")))
    full = F.trim(F.concat_ws(" ", "given", "surname"))
    form = F.col("n_chars") % 5
    feed_name = (F.when(form == 0, F.concat(F.substring("given", 1, 1), F.lit(". "), "surname"))
                 .when(form == 1, F.concat_ws(" ", "surname", "given"))
                 .when(form == 2, F.concat_ws(" ", "given", F.expr("substr(surname, 2)")))
                 .when(form == 3, F.concat(F.substring("given", 1, 1), F.lit(". "),
                                           F.substring("middle", 1, 1), F.lit(". "), "surname"))
                 .otherwise(full))
    gender = F.when(F.col("doc_id") % 2 == 0, "men").otherwise("women")
    return d.select(
        "doc_id", gender.alias("gender"), F.col("lang").alias("country"),
        F.when(form == 3, F.concat_ws(" ", "given", "middle", "surname")).otherwise(full).alias("name"),
        feed_name.alias("feed_name"),
        (F.lit(1980) + F.col("n_chars") % 30).cast("bigint").alias("birth_year"),
        (F.col("n_chars") % 50).alias("matches"),
    )


def fixtures(spark: SparkSession, sf: str) -> DataFrame:
    """Raw daily fixtures: every match with the defects a live feed shows."""
    m = matches(spark, sf)
    seq, k = F.col("seq"), F.col("k")
    men = F.col("gender") == "men"
    first_won = k % 2 == 0
    side = F.when(men, "Men").otherwise("Women")
    city = F.concat(F.lit("City"), F.col("winner_id") % 40)
    blank = (seq % 19 == 0) | (seq % 29 == 0)
    first_id = F.when(first_won, F.col("winner_id")).otherwise(F.col("loser_id"))
    second_id = F.when(first_won, F.col("loser_id")).otherwise(F.col("winner_id"))
    return m.select(
        "seq", "k", F.col("level").alias("true_level"), F.col("surface").alias("true_surface"), "match_date",
        F.when(seq % 41 == 0, "").otherwise((seq - F.when(seq % 53 == 0, 1).otherwise(0)).cast("string"))
        .alias("event_key"),
        F.when(seq % 86 == 0, "").when(seq % 43 == 0, "n/a").otherwise(F.col("tourney_id")).alias("event_date"),
        F.concat(F.lpad((seq % 24).cast("string"), 2, "0"), F.lit(":30")).alias("event_time"),
        F.when(seq % 17 == 0, "Atp Doubles").when(seq % 31 == 0, "Exhibition")
        .when(F.col("level") == "challenger", F.concat_ws(" ", F.lit("Challenger"), side, F.lit("Singles")))
        .when(F.col("level") == "itf", F.concat_ws(" ", F.lit("Itf"), side, F.lit("Singles")))
        .otherwise(F.concat(F.when(men, "Atp").otherwise("Wta"), F.lit(" Singles"))).alias("event_type_type"),
        F.when(F.col("level") == "grand_slam", F.when(k % 4 == 0, "Australian Open")
               .when(k % 4 == 1, "Roland Garros").when(k % 4 == 2, "Wimbledon").otherwise("US Open"))
        .when(F.col("level") == "qualifying", F.concat(city, F.lit(" Qualification")))
        .when(F.col("level") == "itf", F.concat(F.when(men, "M15 ").otherwise("W15 "), city))
        .otherwise(city).alias("tournament_name"),
        k.cast("string").alias("tournament_key"), F.col("round").alias("tournament_round"),
        F.when(seq % 19 == 0, "Not Started").when(seq % 23 == 0, "Retired").when(seq % 29 == 0, "Cancelled")
        .otherwise("Finished").alias("event_status"),
        F.when((seq % 19 == 0) & (seq % 2 == 0), "1").otherwise("0").alias("event_live"),
        F.when(blank | (seq % 37 == 0), "").when(first_won, "First Player").otherwise("Second Player")
        .alias("event_winner"),
        F.when(blank, "").otherwise(F.concat_ws(" - ", F.col("w1").cast("string"), F.col("l1").cast("string")))
        .alias("event_final_result"),
        F.when(seq % 47 == 0, "").otherwise(F.concat(F.lit("P. "), first_id)).alias("event_first_player"),
        F.concat(F.lit("P. "), second_id).alias("event_second_player"),
        (first_id + 100000).cast("string").alias("first_player_key"),
        (second_id + 100000).cast("string").alias("second_player_key"),
        F.when((k % 3 == 0) | (F.col("surface") == "unknown"), "")
        .when(F.col("surface") == "hard", "Hard (Indoor)").otherwise(F.initcap("surface")).alias("event_surface"),
        F.when(((k % 3 == 0) | (F.col("surface") == "unknown")) & (seq % 7 == 5), "Clay Court").otherwise("").alias("court_type"),
        F.concat(F.lit("day_"), "tourney_id", F.lit(".json")).alias("source_file"),
        "w1", "l1", "w2", "l2", F.col("gender").alias("true_gender"),
    )


def tournaments(spark: SparkSession, sf: str) -> DataFrame:
    surface = F.col("p_size") % 6
    return table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("tournament_key"),
        F.concat(F.col("p_name"), F.when(F.col("p_size") % 9 == 0, " - Qualifying").otherwise(""))
        .alias("tournament_name"),
        first_match([("Hard", surface == 0), ("Clay", surface == 1), ("Grass", surface == 2),
                     ("Carpet", surface == 3), ("Hard (Indoor)", surface == 4)], "").alias("tournament_sourface"),
        F.col("p_type").alias("event_type_type"))


def player_cache(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col("c_custkey")
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    return table(spark, sf, "customer").select(
        F.concat(F.when(F.col("c_mktsegment") == "HOUSEHOLD", "other-").otherwise(""), c + 100000).alias("player_key"),  # rows of players nobody asks for
        F.concat(F.lit("P. "), c).alias("player_name"),
        F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise(F.concat(F.lit("Player "), c))
        .alias("player_full_name"),
        F.concat(F.lit("NATION_"), F.col("c_nationkey")).alias("player_country"),
        F.concat_ws(".", two(1 + c % 28), two(1 + c % 12), (1980 + c % 25).cast("string")).alias("player_bday"))


def history_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Raw history lines as the yearly files hold them."""
    m = matches(spark, sf)
    seq, level = F.col("seq"), F.col("level")
    pick = lambda values, i: F.element_at(F.array(*map(F.lit, values)), (i + 1).cast("int"))
    tour = level.isin("grand_slam", "atp_wta")
    stem = (F.when(F.col("gender") == "men", F.when(level == "itf", "atp_matches_futures_")
                   .when(tour, "atp_matches_").otherwise("atp_matches_qual_chall_"))
            .otherwise(F.when(tour, "wta_matches_").otherwise("wta_matches_qual_itf_")))
    side = lambda s, k: [
        pick(("SLO", "USA", "FRA", ""), F.col(f"{s}_id") % 4).alias(f"{s}_ioc"),
        pick(("R", "L", "U"), F.col(k) % 3).alias(f"{s}_hand"),
        (170 + F.col(f"{s}_id") % 30).cast("string").alias(f"{s}_ht"),
        F.concat((18 + (F.col(f"{s}_id") * 7 + F.col(k)) % 20).cast("string"), F.lit(".3")).alias(f"{s}_age")]
    return m.select(
        "seq", F.concat(stem, "year", F.lit(".csv")).alias("source_file"), "tourney_id", "tourney_name",
        F.when(F.col("surface") == "unknown", "").otherwise(F.initcap("surface")).alias("surface"),
        F.when(level == "grand_slam", "G").when(level == "atp_wta", pick(("M", "A", "F"), seq % 3))
        .when(level == "challenger", "C").when((level == "qualifying") & (seq % 2 == 0), "Q").otherwise("")
        .alias("tourney_level"),
        F.when(seq % 37 == 0, "n/a").otherwise(F.replace("tourney_id", F.lit("-"), F.lit(""))).alias("tourney_date"),
        seq.cast("string").alias("match_num"),
        F.when((level == "qualifying") & (F.col("k") % 2 == 0), "Q").otherwise(F.col("round")).alias("round"),
        F.lit("3").alias("best_of"),
        F.when(seq % 31 == 0, "").otherwise(F.col("winner_id").cast("string")).alias("winner_id"),
        F.when(seq % 29 == 0, "").otherwise(F.col("winner_name")).alias("winner_name"), *side("winner", "k"),
        F.col("loser_id").cast("string").alias("loser_id"), "loser_name", *side("loser", "loser_k"))


def external_picks(spark: SparkSession, sf: str) -> DataFrame:
    """Picks of another model on the second feed's matches."""
    f = fixture_matches(spark, sf)
    m = matches(spark, sf).select("seq", "k", "loser_k")
    seq, k, lk = F.col("seq"), F.col("k"), F.col("loser_k")
    first = k % 2 == 0
    pick = lambda a, b: F.when(first, F.col(a)).otherwise(F.col(b))
    number = match_number()
    return f.join(m, "seq").select(
        F.concat(F.lit("x"), seq).alias("pick_id"), "seq", F.date_format("match_date", "yyyy-MM-dd").alias("date"),
        "gender",
        F.when(F.col("level") == "atp_wta", F.when(seq % 2 == 0, "main-tour").otherwise("ATP"))
        .when(F.col("level") == "grand_slam", "Slam").otherwise(F.col("level")).alias("tour_level"),
        F.when(seq % 3 == 0, F.concat(F.lit("ev-"), number)).when(seq % 3 == 1, "")
        .otherwise(F.concat(F.lit("ev-"), seq + 900000000)).alias("fixture_id"),
        F.concat(F.lit("Open "), seq % 25).alias("tournament"), F.concat(F.lit("Match "), seq).alias("match_name"),
        pick("winner_api_key", "loser_api_key").alias("player_api_key"),
        pick("loser_api_key", "winner_api_key").alias("opponent_api_key"),
        pick("winner_name", "loser_name").alias("player_name"), pick("loser_name", "winner_name").alias("opponent_name"),
        F.when(seq % 50 == 0, "void").when(first, "win").otherwise("loss").alias("result"),
        F.when(k % 5 == 0, 1.25).otherwise(1.0).alias("stake"), ((130 + k * 7 % 320).cast("double") / 100).alias("odds"),
        ((300 + seq * 37 % 500).cast("double") / 1000).alias("model_prob"),
        F.when(seq % 2 == 0, (200 + seq * 13 % 600).cast("double") / 1000).alias("implied_prob"),
        F.when(seq % 12 == 1, (seq % 7).cast("double") / 4).alias("profit"), F.when(seq % 9 == 2, (seq % 11).cast("double") / 100).alias("edge"),
        F.when(seq % 14 == 3, "Wta Qualification").otherwise("Singles").alias("event_type"), F.when(seq % 28 == 4, "True").alias("qualification"),
        F.to_json(F.struct(F.struct(((k % 11).cast("double") / 10).alias("win_rate")).alias("last_10"))).alias("player_form"),
        F.to_json(F.struct(F.struct(F.when(lk % 7 != 0, (lk % 11).cast("double") / 10).alias("win_rate")).alias("last_10")))
        .alias("opponent_form"),
        F.to_json(F.struct((k % 4).alias("first_wins"), (lk % 4).alias("second_wins"))).alias("h2h"))


def match_number():
    """Feed number of a match; later matches of a gender share theirs."""
    seq = F.col("seq")
    return F.when(seq % 10 < 5, seq).otherwise(F.expr("1000000 + seq div 4")).cast("string")


def source_results(spark: SparkSession, sf: str) -> DataFrame:
    """Results of another tracker, each known under one of four kinds of key; some rows are written again, still pending."""
    o, day = F.col("o_orderkey"), F.date_format("o_orderdate", "yyyy-MM-dd")
    rows = table(spark, sf, "orders").withColumn("again", F.explode(F.when(o % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    result = F.when(F.col("o_orderstatus") == "F", "win").when(F.col("o_orderstatus") == "O", "loss").otherwise("void")
    return rows.select(
        (o * 2 + F.col("again")).alias("row_no"), F.when(o % 4 == 0, o.cast("string")).alias("pick_id"),
        F.when(o % 4 == 1, F.concat(F.lit("e"), o)).alias("event_key"),
        F.when(o % 4 == 2, F.concat(F.lit("f"), o - o % 8)).alias("fixture_id"), day.alias("date"),
        F.col("o_custkey").cast("string").alias("player_key"), (F.col("o_custkey") % 10).cast("string").alias("opponent_key"),
        F.when(o % 2 == 0, "home").otherwise("away").alias("side"),
        F.when(F.col("again") == 1, "Pending").when(o % 9 == 0, F.upper(result)).when(o % 21 == 0, "open").otherwise(result).alias("result"),
        F.when(o % 3 == 0, (F.floor("o_totalprice") % 50).cast("double")).alias("profit"))


def active_picks(spark: SparkSession, sf: str) -> DataFrame:
    p = F.col("pick_id")
    return picks(spark, sf).select(
        p.cast("string").alias("pick_id"), F.concat(F.lit("e"), p).alias("event_key"),
        F.concat(F.lit("f"), p - p % 8).alias("fixture_id"), F.date_format("pick_date", "yyyy-MM-dd").alias("date"),
        F.col("player_id").cast("string").alias("player_key"), (F.col("player_id") % 10).cast("string").alias("opponent_key"),
        "side", F.col("stake").cast("double").alias("stake"), F.col("odds").cast("double").alias("odds"))


def scan_fixtures(spark: SparkSession, sf: str) -> DataFrame:
    """Upcoming fixtures for the scan, with the raw record as JSON."""
    seq, k = F.col("seq"), F.col("k")
    f = fixtures(spark, sf).withColumns({
        "event_status": F.when(seq % 11 == 0, "Finished").when(seq % 13 == 0, "Postponed").otherwise(""),
        "event_live": F.when(seq % 23 == 0, "1").otherwise("0"), "event_date": F.date_format("match_date", "yyyy-MM-dd"),
        "event_qualification": F.when(k % 10 == 0, "1").otherwise("0")})
    court = F.struct(F.struct(F.lit("Clay").alias("type")).alias("court"))
    deep = F.lit("Clay").alias("surface")
    for name in ("e", "d", "c", "b", "a"):
        deep = F.struct(deep).alias(name)
    deep = F.struct(deep)
    raw = F.struct("event_key", "event_type_type", "tournament_name", "event_surface",
                   F.when(seq % 9 == 0, court).alias("venue"), F.when(seq % 9 == 1, F.array(F.lit("played on grass"))).alias("notes"),
                   F.when(seq % 9 == 2, deep).alias("meta"), F.when(seq % 9 == 3, F.concat(F.repeat(F.lit("x"), 200), seq % 2)).alias("remark"),
                   F.when(seq % 9 == 4, F.struct(F.lit("clay").alias("type"))).alias("ground"),
                   F.when(seq % 9 == 4, "Grass Court").alias("court_surface"))
    return f.withColumn("raw", F.to_json(raw))
