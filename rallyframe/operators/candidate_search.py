"""Wider candidate searches for the players automatic mapping left open.

Both searches score far more loosely than the mapping, so words in common are not enough to
find every candidate. Names without a common word can still be near as strings; those pairs
come from ``near_names``: blocks of one initial compared by their letters, or whole pieces that near names must share.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rallyframe import constants as K
from rallyframe.functions import text as T
from rallyframe.functions.similarity import near_pairs, seq_ratio_above
from rallyframe.functions.values import computed_once, rounded
from rallyframe.operators.identity import PAIR, _after, _in_order
from rallyframe.operators.sides import explode_sides, most_common, top_values
from rallyframe.workspace import materialise

BLOCK = 4000             # names that meet as many others in one task, about
GLOBAL_MIN, GLOBAL_TOP = 0.70, 5
DEEP_MIN, DEEP_TOP = 0.70, 8
INITIAL_FORM = 0.975     # what an equal last word and initial score at least

# fixed values: spellings of one given name
TRANSLITERATIONS = {
    "nikita": ("mykyta", "nikyta"), "mykyta": ("nikita", "nikyta"), "faris": ("fares",), "fares": ("faris",),
    "zakaria": ("zakaryia", "zakariya", "zakaria"), "zakaryia": ("zakaria", "zakariya"),
    "alexander": ("alexandr", "aleksandar", "aleksandr"), "alexandr": ("alexander", "aleksandar", "aleksandr"),
    "andrey": ("andrei", "andriy"), "andrei": ("andrey", "andriy"), "sergey": ("sergei",), "sergei": ("sergey",),
    "ilya": ("ilia",), "ilia": ("ilya",),
}


def feed_parts(name: Column) -> dict[str, Column]:
    """Parts of a feed name; visible initials are single letters followed by a dot."""
    norm = T.normalize_name(name)
    ts = T.tokens(norm)
    n = F.size(ts)
    visible = F.transform(F.regexp_extract_all(T.strip_accents(name), F.lit(r"(?:^|\s),?([A-Za-z])\.(?=[\s,]|$)"), F.lit(1)),
                          lambda x: F.lower(x))
    long_words = F.filter(ts, lambda t: F.length(t) > 1)
    before = F.try_element_at(ts, F.lit(-2))
    trailing_initial = (n >= 2) & (F.length(F.try_element_at(ts, F.lit(-1))) == 1) & (F.length(before) > 1)
    last = F.when(trailing_initial, before).otherwise(
        F.coalesce(F.try_element_at(long_words, F.lit(-1)), F.try_element_at(ts, F.lit(-1)), F.lit("")))
    return {"norm": norm, "visible": F.array_join(visible, " "), "last": last,
            "initial": F.coalesce(F.try_element_at(visible, F.lit(1)), F.substring(norm, 1, 1))}


def feed_names(players: DataFrame) -> DataFrame:
    """Distinct feed names with the parts the scorers read."""
    p = feed_parts(F.col("name"))
    return players.select("gender", *[c.alias(k) for k, c in p.items()]).where("norm <> ''").distinct()


def candidate_names(players: DataFrame) -> DataFrame:
    return players.select("gender", T.normalize_name(F.col("name")).alias("norm"), "player_key").where("norm <> ''").groupBy(
        "gender", "norm").agg(F.count("*").alias("players"))


# --- near strings ----------------------------------------------------------
def near_names(a: DataFrame, b: DataFrame, min_ratio: float, same_initial: bool) -> DataFrame:
    """Pairs of one gender whose similarity can reach ``min_ratio``, of equal initials by ``near_of_initial``.

    Two names of total length L with similarity r leave at most (1 - r)L letters unmatched. A candidate cut into one piece more
    than that has a piece that no such letter breaks: it stands whole in the other name, moved by the unmatched letters before it
    at most. Names meet on pieces of that length, number and place.
    """
    if same_initial:
        return near_of_initial(a, b, min_ratio)
    size, number = F.length("norm"), lambda x: F.floor(x).cast("int")
    left_over = lambda total: number((1.0 - min_ratio) * total + 1e-9)
    longest = number((2.0 - min_ratio) / min_ratio * size + 1e-9)  # names longer than this are too long to be near
    shortest = F.ceil(min_ratio / (2.0 - min_ratio) * size - 1e-9).cast("int")
    upto = lambda low, high: F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))
    cuts = lambda n: left_over(n + number((2.0 - min_ratio) / min_ratio * n + 1e-9)) + 1
    start = lambda k, n: number(k * n / cuts(n))

    def entry(n: Column, k: Column, piece: Column) -> Column:
        return F.struct(n.alias("n"), k.alias("k"), piece.alias("piece"))

    def own(k: Column) -> Column:
        low = start(k, size)
        return entry(size, k, F.substr(F.col("norm"), low + 1, start(k + 1, size) - low))

    def asked(n: Column) -> Column:
        open_ = left_over(size + n)
        open_ = open_ - F.pmod(open_ + size + n, F.lit(2))  # what is unmatched is the total less pairs
        extra, missing = number((open_ + size - n) / 2), number((open_ - size + n) / 2)  # unmatched here, and in the candidate

        def moved(k: Column) -> Column:
            low, width = start(k, n), start(k + 1, n) - start(k, n)
            places = upto(F.greatest(F.lit(0), low - missing), F.least(size - width, low + extra))
            return F.transform(places, lambda at: entry(n, k, F.substr(F.col("norm"), at + 1, width)))

        return F.when((extra >= 0) & (missing >= 0), F.flatten(F.transform(upto(F.lit(0), cuts(n) - 1), moved)))

    long = lambda df: df.where(size > 1).select("gender", "norm").distinct()
    key = ["gender", "n", "k", "piece"]
    feed = long(a).select("gender", F.col("norm").alias("feed_norm"), F.explode(F.array_distinct(F.flatten(F.filter(
        F.transform(upto(shortest, longest), asked), lambda x: x.isNotNull())))).alias("e")).select("gender", "feed_norm", "e.*")
    cand = long(b).select("gender", F.col("norm").alias("cand_norm"), F.explode(F.transform(upto(F.lit(0), cuts(size) - 1), own)).alias("e")).select(
        "gender", "cand_norm", "e.*")
    return feed.join(cand, key).where(_few_edits(min_ratio)).select(*PAIR).distinct()


def _few_edits(min_ratio: float) -> Column:
    """M letters in common order leave at most L - 2M edits; the bounded distance is tested before pairs are shuffled."""
    edits = f"CAST(floor({1.0 - min_ratio!r}D * (length(feed_norm) + length(cand_norm)) + 1e-9D) AS INT)"
    return F.expr(f"levenshtein(feed_norm, cand_norm, {edits}) >= 0")


def near_of_initial(a: DataFrame, b: DataFrame, min_ratio: float) -> DataFrame:
    """Pairs of one gender and initial whose letters in common, in any order and in theirs, allow ``min_ratio``.

    At these ratios most letter pairs of a name would have to be met, so nearly all names of an initial meet, each pair many
    times. Here a block of names meets a block of names in a task, each pair once, and what the letters rule out is not handed on.
    """
    key = ["gender", "initial"]
    x = a.where(F.length("norm") > 1).select(*key, "norm").distinct()
    y = b.where(F.length("norm") > 1).select("gender", F.substring("norm", 1, 1).alias("initial"), "norm").distinct()
    blocks = lambda df, n: df.groupBy(*key).agg(F.ceil(F.count("*") / F.lit(BLOCK)).alias(n))
    counts = materialise(blocks(x, "nx").join(blocks(y, "ny"), key), "near-blocks")
    own = lambda n: F.pmod(F.xxhash64("norm"), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    place = [*key, "i", "j"]
    left = x.join(counts, key).select(*key, own("nx").alias("i"), every("ny").alias("j"), "norm")
    right = y.join(counts, key).select(*key, every("nx").alias("i"), own("ny").alias("j"), "norm")
    right = right.toDF(*right.columns)  # columns of its own, for the cogroup

    def meet(group: tuple[pa.Scalar, ...], feed: pa.Table, cand: pa.Table) -> pa.Table:
        i, j = near_pairs(*(t.column("norm").to_pylist() for t in (feed, cand)), min_ratio)
        found = (t.column("norm").take(pa.array(at)) for t, at in zip((feed, cand), (i, j)))
        return pa.table([pa.array([group[0].as_py()] * len(i), pa.string()), *found], names=list(PAIR))

    pairs = left.groupBy(*place).cogroup(right.groupBy(*place)).applyInArrow(meet, "gender string, feed_norm string, cand_norm string")
    return pairs.where(_few_edits(min_ratio)).distinct()


def _on_last(feed: DataFrame, cand: DataFrame, anywhere: bool) -> DataFrame:
    words = F.array_distinct(T.tokens(F.col("norm")))
    word = F.explode(words) if anywhere else F.try_element_at(T.tokens(F.col("norm")), F.lit(-1))
    c = cand.select("gender", F.col("norm").alias("cand_norm"), word.alias("last"))
    return feed.where("last <> ''").select("gender", F.col("norm").alias("feed_norm"), "last").join(c, ["gender", "last"]).select(*PAIR).distinct()


def _scored_frame(pairs: DataFrame, feed: DataFrame, weight: float, extra: float, last: float, inside: float, initial: float,
                  fixed: Column) -> DataFrame:
    """Pairs with the parts of the feed name, the candidate's words, and the ratio where it can lift a pair over the limit or its fixed score.

    ``weight`` is the scorer's factor of the ratio, the others what it adds for common words,
    the last word, the last word elsewhere, and the initial. ``fixed`` holds for all pairs that may have a score without the ratio;
    pairs that can reach the limit neither way are left out before anything costly.
    """
    f = feed.withColumnsRenamed({"norm": "feed_norm", "last": "a_last", "initial": "a_initial"})
    j = computed_once(pairs.join(f, ["gender", "feed_norm"]), {"a_toks": T.tokens(F.col("feed_norm")), "b_toks": T.tokens(F.col("cand_norm"))})
    la, lb = F.length("feed_norm"), F.length("cand_norm")
    b_last, b_initial = F.element_at("b_toks", -1), F.substring("cand_norm", 1, 1)
    j = computed_once(j, {"b_last": b_last, "same_last": (F.col("a_last") != "") & (F.col("a_last") == b_last),
                          "last_inside": F.array_contains("b_toks", F.col("a_last")),
                          "same_initial": (F.col("a_initial") != "") & (F.col("a_initial") == b_initial),
                          "jaccard": T.token_jaccard(F.col("a_toks"), F.col("b_toks"))})
    added = (F.when(F.col("same_last"), last).when(F.col("last_inside"), inside).otherwise(0.0)
             + F.when(F.col("same_initial"), initial).otherwise(0.0))
    j = j.withColumn("added", added)
    limit = F.when(F.col("same_last") & F.col("same_initial"), INITIAL_FORM).otherwise(GLOBAL_MIN)  # both searches have one limit
    j = j.withColumn("floor", (limit - F.lit(1e-6) - F.col("added") - extra * F.col("jaccard")) / F.lit(weight))
    worth = F.col("floor") <= 2 * F.least(la, lb) / (la + lb)
    may_be_fixed = (F.col("same_last") & (F.col("same_initial") | _several())) | fixed
    ratio = seq_ratio_above(F.when(worth, F.col("feed_norm")), F.when(worth, F.col("cand_norm")), F.col("floor"))
    j = j.where(worth | may_be_fixed).withColumn("ratio", F.coalesce(ratio, F.lit(0.0)))
    return j.where((F.col("ratio") > 0) | may_be_fixed)  # a ratio below its floor is 0


def _several() -> Column:
    """More than one visible initial: they are single letters with a space between."""
    return F.length("visible") >= 3


def _place() -> tuple[Column, Column, Column]:
    return F.filter(F.split("visible", " "), lambda x: x != ""), _several(), F.col("same_last") & F.col("same_initial")


# --- global search ---------------------------------------------------------
def global_pairs(feed: DataFrame, cand: DataFrame) -> DataFrame:
    """Same last word; for names with fewer than three such players, everything that can score."""
    own = materialise(_on_last(feed, cand, anywhere=False), "search-own")
    pool = own.join(cand.withColumnRenamed("norm", "cand_norm"), ["gender", "cand_norm"]).groupBy("gender", "feed_norm").agg(
        F.sum("players").alias("pool"))
    full = pool.where("pool >= 3").select("gender", F.col("feed_norm").alias("norm"))
    few = materialise(feed.join(full, ["gender", "norm"], "left_anti"), "search-few")
    wide = (_on_last(few, cand, anywhere=True)
            .unionByName(near_names(few, cand, (GLOBAL_MIN - 0.12) / 0.72, same_initial=True))
            .unionByName(near_names(few, cand, GLOBAL_MIN / 0.72, same_initial=False)))
    return own.unionByName(wide).distinct()


def global_score(pairs: DataFrame, feed: DataFrame) -> DataFrame:
    s = _scored_frame(pairs, feed, 0.72, 0.0, 0.16, 0.11, 0.12, F.lit(False))
    visible, several, initial_form = _place()
    given = F.transform(F.slice("b_toks", F.lit(1), F.greatest(F.size("b_toks") - 1, F.lit(0))), lambda t: F.substring(t, 1, 1))
    s = computed_once(s, {"multi": _after(F.col("same_last") & several, F.slice(given, F.lit(1), F.size(visible)) == visible)})
    multi = F.col("multi")
    exact = F.col("feed_norm") == F.col("cand_norm")
    best = F.greatest(0.72 * F.col("ratio") + F.col("added"), F.when(initial_form, INITIAL_FORM), F.when(multi, 0.955), F.when(exact, 0.995))
    inside = F.col("same_last") | F.col("last_inside")
    method = (F.when(exact, "exact_full_name").when(multi, "multi_initial_surname").when(initial_form, "exact_initial_form")
              .when(F.col("same_initial"), F.when(inside, "initial_surname").otherwise("same_initial"))
              .when(F.col("same_last"), "same_last").when(F.col("last_inside"), "last_inside_name").otherwise("fuzzy"))
    return s.select(*PAIR, "visible", rounded(F.least(best, F.lit(0.999)), 6).alias("score"), method.alias("method")).where(F.col("score") >= GLOBAL_MIN)


def global_action(best: Column, margin: Column) -> Column:
    return (F.when((best >= 0.975) & (margin >= 0.015), "safe_override").when((best >= 0.955) & (margin >= 0.030), "review_likely")
            .when(best >= 0.94, "manual_review").otherwise("weak_candidate"))


# --- deep search -----------------------------------------------------------
def name_variants(norm: Column) -> Column:
    """Known spellings and reorderings of a normalised name."""
    ts = T.tokens(norm)
    n = F.size(ts)
    table = F.create_map(*[x for word, others in TRANSLITERATIONS.items() for x in (F.lit(word), F.array(*map(F.lit, others)))])
    positions = F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)))
    spelled = F.flatten(F.transform(positions, lambda i: F.transform(
        F.coalesce(F.element_at(table, F.get(ts, i)), F.array().cast("array<string>")),
        lambda other: F.array_join(F.transform(ts, lambda t, j: F.when(j == i, other).otherwise(t)), " "))))
    part = lambda start, length: F.slice(ts, F.lit(start), F.greatest(length, F.lit(0)))
    last, before = F.try_element_at(ts, F.lit(-1)), F.try_element_at(ts, F.lit(-2))
    moved = F.filter(F.array(
        F.array_join(ts, " "), F.when(n >= 2, F.array_join(F.reverse(ts), " ")),
        F.when(n >= 3, F.array_join(F.concat(F.array(last), part(1, n - 1)), " ")),
        F.when(n >= 3, F.array_join(F.concat(F.array(last, before), part(1, n - 2)), " "))), lambda x: x.isNotNull())
    return F.array_distinct(F.concat(moved, spelled))


def _sorted_words(norm: Column) -> Column:
    return F.array_join(F.sort_array(T.tokens(norm)), " ")


def deep_pairs(feed: DataFrame, cand: DataFrame) -> DataFrame:
    """Any word in common, a variant with the same words, or a near string of the same initial."""
    words = lambda df, n: df.select("gender", F.col("norm").alias(n), F.explode(F.array_distinct(T.tokens(F.col("norm")))).alias("key"))
    variants = feed.select("gender", F.col("norm").alias("feed_norm"), F.explode(name_variants(F.col("norm"))).alias("v")).select(
        "gender", "feed_norm", _sorted_words(F.col("v")).alias("key"))
    sorted_names = cand.select("gender", F.col("norm").alias("cand_norm"), _sorted_words(F.col("norm")).alias("key"))
    return (words(feed, "feed_norm").join(words(cand, "cand_norm"), ["gender", "key"]).select(*PAIR)
            .unionByName(variants.join(sorted_names, ["gender", "key"]).select(*PAIR))
            .unionByName(near_names(feed, cand, (DEEP_MIN - 0.10) / 0.66, same_initial=True)).distinct())


def deep_score(pairs: DataFrame, feed: DataFrame) -> DataFrame:
    # what a tier needs and is cheap to test; without a word of the table all variants have the words of the name itself
    equal_size = F.length("feed_norm") == F.length("cand_norm")
    spelled = F.arrays_overlap("a_toks", F.array(*map(F.lit, TRANSLITERATIONS)))
    longer = (F.size("a_toks") >= 3) & (F.size("b_toks") >= 2) & F.col("last_inside")
    short_word = F.array_contains("a_toks", F.col("b_last")) & F.rlike("cand_norm", F.lit("(^| )[a-z]( |$)"))
    s = _scored_frame(pairs, feed, 0.66, 0.12, 0.15, 0.11, 0.10, equal_size | spelled | longer | short_word)
    visible, several, initial_form = _place()
    tests = {"same_words": _after(equal_size, _sorted_words(F.col("feed_norm")) == _sorted_words(F.col("cand_norm"))),
             "subset": _after(longer, F.size(F.array_except("b_toks", "a_toks")) == 0)}
    variants = name_variants(F.col("feed_norm"))
    tests["variant_name"] = _after(spelled, F.array_contains(variants, F.col("cand_norm")))
    tests["variant_words"] = _after(spelled, F.exists(variants, lambda v: _sorted_words(v) == _sorted_words(F.col("cand_norm"))))
    head = F.slice("b_toks", F.lit(1), F.greatest(F.size("b_toks") - 1, F.lit(0)))
    letters_of = lambda a: F.array_join(F.transform(a, lambda t: F.substring(t, 1, 1)), "")
    tests["multi"] = _after(F.col("same_last") & several, _in_order(F.col("visible"), letters_of(head)))
    singles = F.filter("b_toks", lambda t: t.rlike("^[a-z]$"))
    full_words = F.filter("a_toks", lambda t: (t != F.col("b_last")) & (F.length(t) > 1))
    tests["expanded"] = _after(short_word, _in_order(F.array_join(singles, " "), letters_of(full_words)))
    s = computed_once(s, tests)
    same_words, subset, variant_name, variant_words, multi, expanded = (F.col(c) for c in tests)
    inside = F.col("same_last") | F.col("last_inside")
    loose = F.greatest(0.66 * F.col("ratio") + 0.12 * F.col("jaccard") + F.col("added"), F.when(initial_form, INITIAL_FORM), F.when(multi, 0.955),
                       F.when(expanded, 0.925))
    tiers = [("exact_normalized", F.col("feed_norm") == F.col("cand_norm"), 1.0), ("exact_token_set", same_words, 0.995),
             ("subset_reordered_name", subset, 0.965), ("transliteration_exact_variant", variant_name, 0.960),
             ("transliteration_token_variant", variant_words, 0.955)]
    method = (F.when(expanded, "expanded_vs_initials").when(multi, "multi_initial_surname").when(initial_form, "exact_initial_form")
              .when(F.col("same_initial"), F.when(inside, "initial_surname").otherwise("same_initial"))
              .when(F.col("same_last"), "same_last").when(F.col("last_inside"), "last_inside_name").otherwise("fuzzy"))
    score = rounded(F.least(loose, F.lit(0.999)), 6)
    for name, test, value in reversed(tiers):
        method, score = F.when(test, name).otherwise(method), F.when(test, F.lit(value)).otherwise(score)
    return s.select(*PAIR, "visible", score.alias("score"), method.alias("method")).where(F.col("score") >= DEEP_MIN)


def deep_action(best: Column, margin: Column, method: Column) -> Column:
    strong = method.isin("exact_initial_form", "exact_normalized", "exact_token_set")
    return (F.when((best >= 0.985) & (margin >= 0.030), "safe_override").when((best >= 0.970) & (margin >= 0.050) & strong, "safe_override")
            .when((best >= 0.955) & (margin >= 0.030), "review_likely").when(best >= 0.930, "manual_review")
            .when(best >= 0.850, "weak_candidate").otherwise("very_weak_candidate"))


# --- ranking ---------------------------------------------------------------
def ranked_search(scored: DataFrame, canonical: DataFrame, top: int, deep: bool) -> DataFrame:
    """Top candidates per feed name: score, then matches, then key; the first carries margin and action."""
    named = canonical.withColumn("cand_norm", T.normalize_name(F.col("name")))
    bearer = Window.partitionBy("gender", "cand_norm").orderBy(F.desc("matches"), "player_key")
    best = named.withColumn("r", F.row_number().over(bearer)).where(F.col("r") <= top).select(
        "gender", "cand_norm", F.col("player_key").alias("cand_key"), F.col("matches").alias("cand_matches"))
    name = Window.partitionBy("gender", "feed_norm", "visible")
    order = name.orderBy(F.desc("score"), F.desc("cand_matches"), "cand_key")
    kept = scored.join(best, ["gender", "cand_norm"]).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    runner_up = F.coalesce(F.lead("score").over(name.orderBy("rank")), F.lit(0.0))
    first = F.col("rank") == 1
    kept = kept.withColumn("margin", F.when(first, rounded(F.col("score") - runner_up, 6)))
    action = deep_action(F.col("score"), F.col("margin"), F.col("method")) if deep else global_action(F.col("score"), F.col("margin"))
    return kept.withColumn("action", F.when(first, action).otherwise("candidate")).withColumn("rank", F.col("rank").cast("long"))


def _with_players(ranked: DataFrame, feed: DataFrame) -> DataFrame:
    p = feed_parts(F.col("name"))
    named = feed.select("player_key", "gender", "name", p["norm"].alias("feed_norm"), p["visible"].alias("visible"))
    return named.join(ranked, ["gender", "feed_norm", "visible"], "left").select(
        F.col("player_key").alias("api_key"), "name", "rank", "cand_key", "cand_matches", "score", "margin", "method",
        F.coalesce("action", F.lit("no_candidate")).alias("action"))


def search_global(feed: DataFrame, canonical: DataFrame) -> DataFrame:
    """Second scorer over the review list: top five candidates and what to do with the best."""
    names = materialise(feed_names(feed), "search-names")
    scored = global_score(global_pairs(names, candidate_names(canonical)), names)
    return _with_players(ranked_search(scored, canonical, GLOBAL_TOP, deep=False), feed)


def search_deep(feed: DataFrame, canonical: DataFrame) -> DataFrame:
    """Third scorer with spellings and reorderings: top eight candidates."""
    names = materialise(feed_names(feed), "search-names")
    scored = deep_score(deep_pairs(names, candidate_names(canonical)), names)
    return _with_players(ranked_search(scored, canonical, DEEP_TOP, deep=True), feed)


# --- the pool of the deep search -------------------------------------------
def candidate_pool(tables: dict[str, DataFrame], feed: str = "history") -> DataFrame:
    """Players of several match tables: most common name, appearances per table and in all, distinct matches, first and last day, tournaments.

    A table has match_id, match_date, gender, tourney_name and the keys and names of both sides; where it also has a
    ``feed``, rows of other feeds do not count. Sides without key or name, pairs of players and unknown
    genders are left out. A match that several tables hold is an appearance in each and one match. Counts combine
    before any shuffle, so a player with many rows is one row per task.
    """
    sides = None
    for name, table in tables.items():
        own = table.where(F.coalesce(F.trim("feed"), F.lit("")).isin("", feed)) if "feed" in table.columns else table
        part = explode_sides(own, ["match_id", "match_date", "gender", "tourney_name"]).withColumn("table", F.lit(name))
        sides = part if sides is None else sides.unionByName(part)
    filled = lambda c: F.coalesce(F.trim(c), F.lit("")) != ""
    sides = sides.where(filled("player_key") & filled("name") & ~F.contains("name", F.lit("/")) & F.col("gender").isin(*K.GENDERS))
    sides = sides.select("player_key", "gender", F.trim("name").alias("name"), "table", "match_id", "match_date", F.nullif(F.trim("tourney_name"), F.lit("")).alias("tourney_name"))
    sides = materialise(sides, "pool-sides")
    per = sides.groupBy("player_key", "table").agg(F.count("*").alias("n"), F.min("match_date").alias("low"), F.max("match_date").alias("high"), F.min("gender").alias("gender"))
    shown = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("table", "n"))), lambda t: F.concat_ws("=", t["table"], t["n"].cast("string"))), ",")
    players = per.groupBy("player_key").agg(F.min("gender").alias("gender"), F.sum("n").alias("appearances"), shown.alias("tables"),
                                            F.min("low").alias("first_day"), F.max("high").alias("last_day"))
    distinct = sides.groupBy("player_key", "match_id").agg(F.lit(1).alias("one")).groupBy("player_key").agg(F.count("*").alias("matches"))
    return (players.join(distinct, "player_key").join(most_common(sides, ["player_key"], "name"), "player_key")
            .join(top_values(sides.where("tourney_name IS NOT NULL"), "player_key", "tourney_name", 3), "player_key", "left"))


def search_pool(feed: DataFrame, pool: DataFrame) -> DataFrame:
    """The deep search over a pool, each candidate with what the pool knows of it."""
    found = search_deep(feed, pool.select("player_key", "gender", "name", "matches"))
    facts = pool.select(F.col("player_key").alias("cand_key"), F.col("name").alias("cand_name"), "appearances", "tables", "first_day", "last_day")
    return found.join(facts, "cand_key", "left")


def priority(atp: Column, slam: Column, challenger: Column, total: Column) -> Column:
    return F.when((atp > 0) | (slam > 0), "high").when((challenger >= 3) | (total >= 8), "medium").otherwise("low")
