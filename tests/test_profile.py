import json

from rallyframe.functions.json_tree import _BROKEN, _deep, leaves
from rallyframe.operators import profile as J


def test_leaves_at_any_depth():
    assert leaves('{"a":{"b":{"c":{"d":{"e":{"surface":"Clay"}}}}}}') == [("a.b.c.d.e.surface", "Clay")]
    deep = {"x": 1.50}
    for _ in range(200):
        deep = {"k": [deep]}
    assert leaves(json.dumps(deep)) == [(".".join(["k[0]"] * 200) + ".x", "1.5")]
    assert leaves('{"n": 1e3, "b": true, "z": null, "l": [1, {"q": ""}], "e": {}, "f": []}') == [
        ("n", "1e3"), ("b", "true"), ("z", None), ("l[0]", "1"), ("l[1].q", "")]
    assert leaves(None) == [("", None)] and leaves(" plain ") == [("", " plain ")] and leaves("{broken") == []


def test_leaves_of_a_record_deeper_than_the_parser_goes():
    deep = '{"k": [' * 20_000 + '{"x": 1.50, "y": null}' + "]}" * 20_000
    path = ".".join(["k[0]"] * 20_000)
    assert leaves(deep) == [(f"{path}.x", "1.50"), (f"{path}.y", None)]
    assert leaves(deep[:-1]) == [] and leaves(deep + "]") == []


def test_parsing_with_a_stack_equals_the_parser():
    import random

    draw = random.Random(3)
    make = lambda n: draw.choice([1, -2.5, "a,\"b\\", "é", True, None, [], {}, 1e30]) if n == 0 else draw.choice([
        [make(n - 1) for _ in range(draw.randrange(3))], {draw.choice("abc"): make(n - 1) for _ in range(draw.randrange(3))}])
    own = lambda text: json.loads(text, parse_int=str, parse_float=str, parse_constant=str)
    broken = 0
    for i in range(2000):
        text = json.dumps(make(draw.randrange(1, 5)), indent=draw.choice([None, 1]))
        if i % 2:  # cut out or double a character
            at = draw.randrange(len(text))
            text = text[:at] + text[at + 1:] if i % 4 == 1 else text[:at] + text[at] + text[at:]
        if text.strip()[:1] not in ("{", "["):
            continue
        try:
            want = own(text)
        except ValueError:
            want, broken = _BROKEN, broken + 1
        assert _deep(text) == want, text
    assert broken > 100


def test_long_values_stay_apart(spark):
    a, b = "x" * 250 + "1", "x" * 250 + "2"
    rows = spark.createDataFrame([(1, json.dumps({"v": a})), (2, json.dumps({"v": b})), (3, json.dumps({"v": a}))], "record int, raw string")
    got = J.json_field_profile(rows).first()
    assert got["presence"] == 3 and got["top_values"] == f"{'x' * 200}=2,{'x' * 200}=1"
