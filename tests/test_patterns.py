"""Tables of patterns against a plain count, and the literals that patterns require."""

import random
import re

import pytest

from reviewloom.functions.patterns import required_literals
from reviewloom.operators import joins as C

LITERALS = [
    ("abc", ["abc"]), ("ABC", ["abc"]), ("ab|cd", ["ab", "cd"]), ("ab|", None), ("a?bc", ["bc"]), ("ab*c", ["a"]), ("ab+c", ["ab"]), ("a.bcd", ["bcd"]),
    (r"\bthe\b", ["the"]), (r"a\.b", ["a.b"]), (r"\d+", None), ("[abc]", None), ("[abc]de[^x]", ["de"]), ("(abc)d", ["d"]), ("(abc)", None), ("(?:abc)?xy", ["xy"]),
    ("(?i)abc", None), ("(?=abc)x", None), (r"\x41bc", None), (r"\p{L}bc", None), (r"\Qa.b\E", None), ("x{3}yz", ["yz"]), ("[a[b]]c", None), ("", None), ("(a|b)c|de", ["c", "de"]),
    ("éab", ["ab"]), ("^start", ["start"]), ("a|b|a", ["a", "b"]), (r"(\)x)y", ["y"]), ("ab??c", ["a"]),
]


@pytest.mark.parametrize(("pattern", "want"), LITERALS)
def test_required_literals(pattern, want):
    assert required_literals(pattern) == want


def random_pattern(rng):
    part = lambda: rng.choice(["a", "b", "ca", "abc", ".", "[ab]", "[^c]", r"\w", r"\b", "a+", "b*", "c?", "(ab)+", "(a|c)b", r"\.", "B", "b{2}", "^", "$"])
    return "|".join("".join(part() for _ in range(rng.randrange(1, 6))) for _ in range(rng.choice([1, 1, 2, 3])))


def test_literals_are_in_every_match():
    rng = random.Random(1)
    known = 0
    for _ in range(4000):
        pattern = random_pattern(rng)
        try:
            compiled = re.compile(pattern, re.IGNORECASE)
        except re.error:
            continue
        literals = required_literals(pattern)
        text = "".join(rng.choice("abcABC. ") for _ in range(rng.randrange(0, 12)))
        if literals is not None and compiled.search(text):
            known += 1
            assert any(x in text.lower() for x in literals), (pattern, text)
    assert known > 100


@pytest.mark.parametrize("block", [200, 7])
def test_many_patterns(spark, monkeypatch, block):
    monkeypatch.setattr(C, "PATTERN_BLOCK", block)
    rng = random.Random(2)
    patterns = set()
    while len(patterns) < 1500:
        pattern = random_pattern(rng) if len(patterns) < 300 else "".join(rng.choice("abcde") for _ in range(rng.randrange(2, 7))) + rng.choice(["", "x?", "[de]", "|dd", ".", r"\b"])
        try:
            re.compile(pattern)
        except re.error:
            continue
        patterns.add(pattern)
    texts = ["".join(rng.choice("abcde .") for _ in range(rng.randrange(0, 60))) for _ in range(40)] + ["", "ABC B.", texts_repeat := "abc abc", texts_repeat]
    df = spark.createDataFrame([*enumerate(texts), (100, None)], "review_id long, cleaned_text string").selectExpr("*", "1 AS topic", "2 AS piece").repartition(3)
    table = spark.createDataFrame([(p,) for p in [*patterns, "", None, "abc"]], "topic string")
    got = sorted((r.review_id, r.topic) for r in C.topic_mentions(df, table, regex=True).select("review_id", "topic").collect())
    compiled = {p: re.compile(p, re.IGNORECASE) for p in [*patterns, "abc"]}
    want = sorted((k, p) for k, text in [*enumerate(texts), (100, "")] for p, c in compiled.items() if c.search(text.lower()))
    assert got == want
    assert {p for p in patterns if required_literals(p) is None} & {p for _, p in got}


def test_patterns_without_literals_only_and_none(spark):
    df = spark.createDataFrame([(1, "a1"), (2, "zz")], "review_id long, cleaned_text string")
    table = lambda *p: spark.createDataFrame([(x,) for x in p], "topic string")
    found = lambda *p: sorted((r.review_id, r.topic) for r in C.topic_mentions(df, table(*p), regex=True).collect())
    assert found(r"\d", "^.$") == [(1, r"\d")]
    assert found("") == [] and found("q") == []
    assert found("zz", r"[a]\d") == [(1, r"[a]\d"), (2, "zz")]


@pytest.mark.parametrize("regex", [False, True])
def test_a_short_table_is_tested_in_the_rows(spark, monkeypatch, regex):
    """Texts are not cut into pieces for a few topics; the answers are those of the candidates."""
    rows = [(1, "The battery and the BATTERY"), (2, "no screen"), (2, "no screen"), (3, None), (4, ""), (None, "Screen, battery")]
    df = spark.createDataFrame(rows, "review_id long, cleaned_text string")
    topics = spark.createDataFrame([("Battery",), ("screen",), ("battery",), ("",), (None,), ("absent",)], "topic string")
    found = lambda: sorted(map(str, C.topic_mentions(df, topics, regex=regex).collect()))
    monkeypatch.setattr(C, "PATTERN_BLOCK", 1)
    by_candidates = found()
    monkeypatch.undo()

    def cut(*_):
        raise AssertionError("texts are cut into pieces")

    monkeypatch.setattr(C, "_candidates", cut)
    assert found() == by_candidates and len(by_candidates) == 7
