import hashlib
import random
import re

import pytest

from rallyframe.llm import mixing as X
from rallyframe.workspace import materialise

from .conftest import prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_targets(words, share=1.0):
    """Deal again and again until no source is above three times its words."""
    names = sorted((s for s in words if s is not None)) + [None] * (None in words)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    full, target = {s for s in words if not words[s]}, {s: 0.0 for s in words}
    while True:
        left = share * sum(words.values()) - sum(3 * words[s] for s in full)
        open_ones = [s for s in names if s not in full]
        target |= {s: 3.0 * words[s] for s in full} | {s: left * weight[s] / sum(weight[t] for t in open_ones) for s in open_ones}
        above = {s for s in open_ones if target[s] > 3 * words[s]}
        if not above:
            return target
        full |= above


def place(i, text):
    line = " ".join(str(x) for x in (i, text) if x is not None)
    return int(hashlib.md5(line.encode()).hexdigest()[:15], 16)


def plain_taken(rows, share=1.0):
    """{source: (target, {place: times})} with thresholds found by sorting."""
    words = {}
    for _, text, source in rows:
        words[source] = words.get(source, 0) + len(WORD.findall(text or ""))
    out = {}
    for source, target in plain_targets(words, share).items():
        whole = min(3, int(target // words[source])) if words[source] else 0
        left, at, sums = target - whole * words[source], 0, {}
        for i, text, own in rows:
            if own == source:
                sums[place(i, text)] = sums.get(place(i, text), 0) + len(WORD.findall(text or ""))
        times = {p: whole for p in sums}
        for p in sorted(sums):
            if whole < 3 and left > 0 and 2 * (left - at) > sums[p]:
                times[p] += 1
                at += sums[p]
            else:
                break
        out[source] = target, times
    return out


def corpus():
    draw = random.Random(8)
    sources = ["hot"] * 300 + [f"s{draw.randrange(12)}" for _ in range(250)] + [None] * 15 + ["one"] + ["é", "Z", "\U0001F600"] * 4
    rows = [(i, prose(i, draw.randrange(0, 90)), s) for i, s in enumerate(sources)]
    return rows + [(9000, prose(1, 4000), "s3"), (9001, None, "s4"), (9002, "", "empty"), (9003, " \n\t", "empty"), (None, "null id here", "s5"), (None, "null id here", "s5"), (9004, "a\x0bb\x0cc\x1cd e f", "s6")]


def measured(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    found, (key, size, where) = X.measure(frame)
    return materialise(found.select("doc_id", "source", found[key].alias("key"), found[size].alias("size"), found[where].alias("place")), "test-mix")


@pytest.mark.parametrize("step", [X.STEP, 4])
def test_equals_sorting(spark, monkeypatch, step):
    """Also with so few buckets that boundaries are refined many times."""
    monkeypatch.setattr(X, "STEP", step)
    rows = corpus()
    found = measured(spark, rows)
    joined = found.join(X.plan(found.drop("doc_id", "source"), (0.3, 1.0, 2.5)), "key").collect()
    assert len(joined) == len(rows)
    for n, share in enumerate((0.3, 1.0, 2.5)):
        want = plain_taken(rows, share)
        for r in joined:
            target, times = want[r.source]
            assert r.goals[n].target == pytest.approx(target, rel=1e-12)
            assert r.goals[n].whole + (r.place < r.goals[n].until) == times[r.place] or r.size == 0
    for r in joined:  # a larger share includes a smaller one
        counts = [g.whole + (r.place < g.until) for g in r.goals]
        assert counts == sorted(counts) and counts[-1] <= 3


def test_words_come_near_targets(spark):
    """Within half of the largest document of a source."""
    found = measured(spark, corpus())
    largest, taken, target = {}, {}, {}
    for r in found.join(X.plan(found.drop("doc_id", "source")), "key").collect():
        largest[r.key] = max(largest.get(r.key, 0), 2 * r.size)  # one row is there twice
        taken[r.key] = taken.get(r.key, 0) + r.size * (r.goals[0].whole + (r.place < r.goals[0].until))
        target[r.key] = r.goals[0].target
    assert all(abs(taken[k] - target[k]) <= largest[k] / 2 for k in taken)


def test_reruns_agree_and_mix_repeats_documents(spark, clashing, none):
    one, two = (sorted(map(str, X.mixed(clashing.repartition(n), 1.0).collect())) for n in (2, 5))
    assert one == two and len(one) > 0
    assert X.mixed(clashing).columns == clashing.columns and X.mixed(none).count() == 0
    rows = measured(spark, corpus())
    assert X.plan(rows.where("false").drop("doc_id", "source")).count() == 0
