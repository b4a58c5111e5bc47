import math
import random
from collections import Counter
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from rallyframe.functions import similarity
from rallyframe.operators import candidate_search as S
from rallyframe.operators import identity as E
from rallyframe.operators import review as R

WORDS = ["anna", "ilvana", "mirabela", "mirbela", "tornavik", "nora", "john", "jon", "falke", "merrick", "j", "v", "n", "brundelli", "de", "la",
         "cruz", "maria", "nikita", "mykyta"]


def ratio(a, b):
    return SequenceMatcher(None, a, b).ratio()


def plain_score(a, b):
    """All tiers for two normalised names, written from the rules."""
    ta, tb = a.split(), b.split()
    sur = lambda t: " ".join(t[-2:]) if len(t) > 1 and " ".join(t[-2:]) == "de la" else t[-1]
    compact = lambda t: t[0] if len(t) == 1 else f"{t[0][0]} {' '.join(t[1:])}"
    jac = len(set(ta) & set(tb)) / len(set(ta) | set(tb))
    if a == b:
        return 1.0, "exact_normalized"
    if sorted(ta) == sorted(tb):
        return 0.995, "exact_token_set"
    if compact(ta) == compact(tb):
        return 0.97, "exact_initial_form"
    if sur(ta) == sur(tb) and a[0] == b[0]:
        return max(0.9, min(0.97, 0.84 + 0.1 * ratio(a, b) + 0.06 * jac)), "initial_surname"
    singles = [t for t in ta if len(t) == 1]
    letters = iter("".join(t[0] for t in tb))
    if sur(ta) == sur(tb) and len(singles) >= 2 and all(s in letters for s in singles) and {t for t in ta if len(t) > 1} & set(tb):
        return 0.92, "multi_initial_surname"
    singles_b, parts = [t for t in tb if len(t) == 1], sur(tb).split()
    given = [t[0] for t in ta if t not in parts and len(t) > 1]
    if len(singles_b) >= 2 and set(parts) <= set(ta) and all(singles_b.count(s) <= given.count(s) for s in singles_b):
        return 0.925, "expanded_initials_surname"
    if len(ta) >= 3 and len(ta) == len(tb):
        odd, left = Counter(ta) - Counter(tb), Counter(tb) - Counter(ta)
        ok = len(ta) - odd.total() >= 2
        for t in odd.elements():
            best = max(left.elements(), key=lambda u: ratio(t, u))
            ok, left = ok and ratio(t, best) >= 0.84, left - Counter([best])
        if ok:
            return 0.915, "near_token_set_typo"
    last, ini = ta[-1] == tb[-1], a[0] == b[0]
    s = min(0.999, 0.72 * ratio(a, b) + 0.18 * jac + (0.06 if last else 0) + (0.03 if ini else 0))
    return s, "fuzzy_same_last" if last else "fuzzy"


@pytest.fixture(scope="module")
def names():
    rnd = random.Random(7)
    make = lambda: " ".join(rnd.choice(WORDS) for _ in range(rnd.choice([1, 2, 3, 3])))
    return sorted({make() for _ in range(70)}), sorted({make() for _ in range(70)})


def players(spark, names, feed):
    rows = [(f"men:{feed}:{i}", "men", n, i % 40) for i, n in enumerate(names)]
    return spark.createDataFrame(rows, "player_key string, gender string, name string, matches bigint")


def test_scores_equal_plain_python(spark, names):
    pairs = [("men", a, b) for a in names[0][:45] for b in names[1][:45]]
    got = E.score_pairs(spark.createDataFrame(pairs, "gender string, feed_norm string, cand_norm string"))
    bad = []
    for r in got.collect():
        want, method = plain_score(r["feed_norm"], r["cand_norm"])
        kept = want >= 0.76
        if kept and (abs(r["base_score"] - want) > 1e-9 or r["method"] != method) or (not kept and r["base_score"] >= 0.76):
            bad.append((r, want, method))
    assert not bad, bad[:3]


def test_blocking_finds_every_pair_that_can_be_kept(spark, names):
    feed, own = players(spark, names[0], "api"), players(spark, names[1], "history")
    got = {(r["feed_norm"], r["cand_norm"], r["stage"]) for r in E.candidate_pairs(E.distinct_names(feed), E.distinct_names(own)).collect()}
    sur = lambda n: " ".join(n.split()[-2:]) if n.endswith("de la") and len(n.split()) > 1 else n.split()[-1]
    for a in names[0]:
        near = [b for b in names[1] if b.split()[-1] == a.split()[-1] or sur(b) == sur(a) or sorted(b.split()) == sorted(a.split())]
        pool = list(near)
        if len(pool) < 4:
            pool += [b for b in names[1] if b not in pool and b[0] == a[0] and (set(a.split()) & set(b.split()) or ratio(a, b) >= 0.55)]
        least = 0.76
        if not pool:
            pool, least = names[1], 0.78
        assert {b for b in pool if plain_score(a, b)[0] >= least} == {
            b for f, b, stage in got if f == a and plain_score(a, b)[0] >= (0.78 if stage == 3 else 0.76)}


def test_pairs_are_found_once_without_remembering_them(spark, names):
    """Neither search groups pairs to drop repeats: a task's memory would grow with them."""
    feed, own = (E.distinct_names(players(spark, n, f)) for n, f in zip(names, ("api", "history")))
    pairs = E.equal_key_pairs(feed, own)
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in plan and "Aggregate" not in plan[:plan.index("Join")]
    rows = E.candidate_pairs(feed, own).collect()
    assert len(rows) == len({(r["feed_norm"], r["cand_norm"]) for r in rows})
    keys = {(r["feed_norm"], r["cand_norm"]) for r in rows if r["stage"] == 1}
    assert keys == {(r["feed_norm"], r["cand_norm"]) for r in pairs.collect()}


def test_exact_tiers_need_no_other_pairs(spark, names):
    feed, own = (E.distinct_names(players(spark, n, f)) for n, f in zip(names, ("api", "history")))
    exact = E.score_pairs(E.equal_key_pairs(feed, own, E.EXACT_KINDS), exact=True)
    every = E.score_pairs(E.equal_key_pairs(feed, own)).where(F.col("method").isin(*E.EXACT_METHODS))
    assert "PythonUDF" not in exact._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, exact.collect())) == sorted(map(tuple, every.collect())) != []


def test_mapping_decisions(spark):
    own = spark.createDataFrame([
        ("men:history:1", "men", "Ilvana Mirabela Tornavik", 10), ("men:history:2", "men", "John Falke", 5),
        ("men:history:3", "men", "Jon Falke", 5), ("women:history:4", "women", "Anna Cruz", 1)],
        "player_key string, gender string, name string, matches bigint")
    feed = spark.createDataFrame([
        ("men:api:1", "men", "Tornavik Ilvana Mirabela"), ("men:api:2", "men", "J. Falke"), ("women:api:3", "women", "A. Cruz"),
        ("men:api:4", "men", "Mirbela Tornavik Ilvana"), ("men:api:5", "men", "Qqq Zzz")], "player_key string, gender string, name string")
    got = {r["api_key"]: (r["status"], r["target_key"], r["method"]) for r in E.build_mapping(feed, own).collect()}
    assert got["men:api:1"] == ("auto_mapped", "men:history:1", "exact_token_set")
    assert got["men:api:2"][0] == "ambiguous"  # two players with that initial and surname
    assert got["women:api:3"] == ("auto_mapped", "women:history:4", "exact_initial_form")
    assert got["men:api:4"] == ("ambiguous", None, "near_token_set_typo")
    assert got["men:api:5"] == ("unmapped", None, "no_candidate")


def test_fallback_waits_for_an_empty_pool(spark):
    """A near string of the same initial fills the pool although it shares no word, so the better name of another initial is not reached."""
    columns = "player_key string, gender string, name string, matches bigint"
    other = ("men:history:1", "men", "ilvana mirabela tornavik", 10)
    near = ("men:history:2", "men", "mirabele tornaviko ilvano", 10)
    feed = spark.createDataFrame([("men:api:1", "men", "mirbela tornavik ilvana")], "player_key string, gender string, name string")
    alone = E.build_mapping(feed, spark.createDataFrame([other], columns)).first()
    assert alone["method"] == "near_token_set_typo"
    assert ratio("mirbela tornavik ilvana", near[2]) >= 0.55
    assert E.build_mapping(feed, spark.createDataFrame([other, near], columns)).first()["method"] == "no_candidate"


@pytest.mark.parametrize("floor,same_initial", [(0.58 / 0.72, True), (0.60 / 0.66, True), (0.70 / 0.72, False), (0.58 / 0.72, False)])
def test_near_names_misses_nothing(spark, floor, same_initial):
    rnd = random.Random(11)
    base = ["".join(rnd.choice("abcde ") for _ in range(rnd.randint(2, 16))).strip() or "ab" for _ in range(40)]
    base = [" ".join(b.split()) for b in base]
    twisted = []
    for b in base:
        i = rnd.randrange(len(b))
        twisted += [b[:i] + rnd.choice("abc") + b[i:], b[:i] + b[i + 1:] or "a", b[::-1]]
    frame = lambda xs: spark.createDataFrame([("men", x, x[:1]) for x in set(xs) if x], "gender string, norm string, initial string")
    got = {(r["feed_norm"], r["cand_norm"]) for r in S.near_names(frame(base), frame(twisted), floor, same_initial).collect()}
    want = {(a, b) for a in set(base) for b in set(twisted) if len(a) > 1 and len(b) > 1 and ratio(a, b) >= floor and (not same_initial or a[0] == b[0])}
    assert want <= got


def test_names_of_one_initial_meet_block_by_block(spark, monkeypatch):
    """Each pair is met once, by letters and not by letter pairs; cuts between blocks lose nothing, and long names do not overflow."""
    monkeypatch.setattr(S, "BLOCK", 3)
    draw = random.Random(8)
    names = sorted({"a" + "".join(draw.choice("abcde ") for _ in range(draw.randrange(1, 9))).strip() for _ in range(40)} | {"a" * 300, "a" * 290 + "b"})
    frame = spark.createDataFrame([("men", n, n[0]) for n in names], "gender string, norm string, initial string")
    found = S.near_names(frame, frame, 0.8, same_initial=True)
    assert "FlatMapCoGroupsInArrow" in found._jdf.queryExecution().toString()
    got = {(r["feed_norm"], r["cand_norm"]) for r in found.collect()}
    want = {(x, y) for x in names for y in names if len(x) > 1 and len(y) > 1 and SequenceMatcher(None, x, y).ratio() >= 0.8}
    assert want <= got and ("a" * 300, "a" * 290 + "b") in got



def common_in_order(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last, row = row, [0]
        for k, y in enumerate(b):
            row.append(last[k] + 1 if x == y else max(last[k + 1], row[k]))
    return row[-1]


def test_letters_are_compared_in_their_order():
    """Letters in common are not enough, nor few edits: what cannot be near in order is not handed on, and nothing else is lost."""
    draw = random.Random(5)
    name = lambda: "".join(draw.choice("abcdeé ") for _ in range(draw.randrange(1, 14)))
    left, right = [name() for _ in range(70)] + ["abcdefghij", "ab" * 32], [name() for _ in range(50)] + ["adcbehgfij", "ab" * 40]
    for floor in (0.5, 0.8, 0.97):
        i, j = similarity.near_pairs(left, right, floor)
        got = list(zip(i.tolist(), j.tolist()))
        want = {(k, n) for k, a in enumerate(left) for n, b in enumerate(right) if 2 * common_in_order(a, b) >= floor * (len(a) + len(b)) - 1e-9}
        assert len(got) == len(set(got)) and set(got) == want
    assert [len(x) for x in similarity.near_pairs([], left, 0.8)] == [0, 0]
    assert similarity._ratios_above(["abcdefghij", None, "", "a" * 90], ["adcbehgfij", "a", "a", "a" * 80 + "b"], [0.8] * 4) == [
        0.0, None, 0.0, SequenceMatcher(None, "a" * 90, "a" * 80 + "b").ratio()]


def test_names_of_any_initial_meet_on_whole_pieces(spark):
    """Names with all letter pairs in common do not meet for that."""
    names = ["ka" * 10 + "lo" * n + "ka" * (10 - n) + "tu" * (n % 3) for n in range(11)] + ["xka" * 9, "ka" * 20, "ka" * 20 + "l"]
    frame = spark.createDataFrame([("men", n, n[0]) for n in names], "gender string, norm string, initial string")
    found = S.near_names(frame, frame, 0.70 / 0.72, same_initial=False)
    assert "Window" not in found._jdf.queryExecution().optimizedPlan().toString()
    got = {(r["feed_norm"], r["cand_norm"]) for r in found.collect()}
    assert {(a, b) for a in names for b in names if ratio(a, b) >= 0.70 / 0.72} <= got


def test_deep_search_scores_costly_tests_on_few_pairs(spark):
    """A pair that can reach the limit neither by its ratio nor by a fixed score is left out before the tiers."""
    pairs = [("men", "tobias lindqvor", "mu lindqvor"), ("men", "tobias lindqvor", "lindqvor tobias"), ("men", "nikita petrov", "mykyta petrov"),
             ("men", "tobias lindqvor", "tobias quxon")]
    feed = S.feed_names(spark.createDataFrame([("men", n.title()) for n in {p[1] for p in pairs}], "gender string, name string"))
    frame = spark.createDataFrame(pairs, "gender string, feed_norm string, cand_norm string")
    scored = S.deep_score(frame, feed)
    assert {(r["cand_norm"], r["method"], r["score"]) for r in scored.collect()} == {
        ("lindqvor tobias", "exact_token_set", 0.995), ("mykyta petrov", "transliteration_exact_variant", 0.96)}
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate inline") == 3 and "array_union" not in plan[:plan.index("ArrowEvalPython")]


def plain_global(name, initials, last, cand):
    tb = cand.split()
    score, method = ratio(name, cand) * 0.72, "fuzzy"
    if last == tb[-1]:
        score, method = score + 0.16, "same_last"
    elif last in tb:
        score, method = score + 0.11, "last_inside_name"
    first = initials[0] if initials else name[0]
    if first == cand[0]:
        score, method = score + 0.12, "initial_surname" if method != "fuzzy" else "same_initial"
    if last == tb[-1] and first == cand[0]:
        score, method = max(score, 0.975), "exact_initial_form"
    if len(initials) >= 2 and last == tb[-1] and [t[0] for t in tb[:-1]][:len(initials)] == initials:
        score, method = max(score, 0.955), "multi_initial_surname"
    if name == cand:
        score, method = max(score, 0.995), "exact_full_name"
    return min(score, 0.999), method


def test_global_search_equals_plain_python(spark, names):
    raw = [n.title() for n in names[0] if not any(len(t) == 1 for t in n.split())][:25] + ["V. N. Brundelli", "J. Falke", "M. Cruz"]
    feed = spark.createDataFrame([(f"men:api:{i}", "men", n) for i, n in enumerate(raw)], "player_key string, gender string, name string")
    own = players(spark, names[1], "history")
    got = {(r["name"], r["rank"]): (r["cand_key"], r["score"], r["method"]) for r in S.search_global(feed, own).collect() if r["rank"]}
    for n in raw:
        norm = " ".join(n.lower().replace(".", " ").split())
        initials = [p[0].lower() for p in n.split() if len(p) == 2 and p[1] == "."]
        long_words = [t for t in norm.split() if len(t) > 1]
        last = long_words[-1] if long_words else norm.split()[-1]
        same_last = [b for b in names[1] if b.split()[-1] == last]
        pool = same_last if len(same_last) >= 3 else names[1]
        scored = []
        for i, b in enumerate(names[1]):
            if b in pool:
                s, m = plain_global(norm, initials, last, b)
                s = math.floor(s * 1e6 + 0.5) / 1e6
                if s >= 0.70:
                    scored.append((-s, -(i % 40), f"men:history:{i}", m))
        for rank, (s, _, key, m) in enumerate(sorted(scored)[:5], 1):
            assert got.get((n, rank)) == (key, -s, m), (n, rank)


def test_deep_search_uses_known_spellings(spark):
    own = spark.createDataFrame([("men:history:1", "men", "Mykyta Petrov", 4), ("men:history:2", "men", "Tobias Lindqvor", 9)],
                                "player_key string, gender string, name string, matches bigint")
    feed = spark.createDataFrame([("men:api:1", "men", "Nikita Petrov"), ("men:api:2", "men", "John Lindqvor Tobias")],
                                 "player_key string, gender string, name string")
    got = {r["api_key"]: (r["cand_key"], r["method"], r["score"]) for r in S.search_deep(feed, own).collect()}
    assert got["men:api:1"] == ("men:history:1", "transliteration_exact_variant", 0.96)
    assert got["men:api:2"][:2] == ("men:history:2", "subset_reordered_name") or got["men:api:2"][0] == "men:history:2"


def test_duplicate_risk_levels(spark):
    rows = [("men:history:1", "A B", "X", 1990, 1), ("men:history:2", "a b", "X", 1990, 20), ("men:history:3", "C D", "X", 1990, 5),
            ("men:history:4", "c d", "Y", 1991, 5), ("men:history:5", "E F", "X", 1990, 5), ("men:history:6", "e f", "X", 1991, 5),
            ("men:history:7", "G H", "X", 1990, 5), ("men:history:8", "g h", "X", 1990, 5), ("men:history:9", "solo", "X", 1990, 5)]
    df = spark.createDataFrame([(k, "men", n, c, y, m) for k, n, c, y, m in rows],
                               "player_key string, gender string, name string, country string, birth_year int, matches bigint")
    got = R.duplicate_groups(df)
    assert {r["player_key"]: (r["risk_level"], r["recommended_key"]) for r in got.collect()} == {
        "men:history:1": ("LOW", "men:history:2"), "men:history:2": ("LOW", "men:history:2"), "men:history:3": ("HIGH", "men:history:4"),
        "men:history:4": ("HIGH", "men:history:4"), "men:history:5": ("CHECK", "men:history:6"), "men:history:6": ("CHECK", "men:history:6"),
        "men:history:7": ("MEDIUM", "men:history:8"), "men:history:8": ("MEDIUM", "men:history:8")}
    assert R.alias_template(got).count() == 3
    assert got.where(F.col("keys_in_group") == 2).count() == 8


def test_near_strings_in_rounds_equal_trying_all(spark, monkeypatch):
    """Bands that end after the first hit find the same names as comparing each with every candidate."""
    import random
    from difflib import SequenceMatcher

    monkeypatch.setattr(E, "FIRST_BAND", 1)
    monkeypatch.setattr(E, "BAND_GROWTH", 2)
    draw = random.Random(9)
    name = lambda: "".join(draw.choice("abcde ") for _ in range(draw.randrange(1, 12))).strip() or "a"
    names, cand = [(draw.choice(["men", "women"]), name()) for _ in range(60)], sorted({(draw.choice(["men", "women"]), name()) for _ in range(150)})
    want = {(g, n) for g, n in names if any(g == h and n[0] == c[0] and SequenceMatcher(None, n, c).ratio() >= 0.8 for h, c in cand)}
    frame = lambda rows: spark.createDataFrame(rows, "gender string, norm string").distinct()
    found = E.with_near_string(frame(names), frame(cand), 0.8)
    assert {tuple(r) for r in found.collect()} == want and 0 < len(want) < len(set(names))
    assert E.with_near_string(frame(names), frame(cand).where("false")).count() == 0
