"""The valence rules, case by case, in the row form and the table form."""

import math

import pytest
from pyspark.sql import functions as F

from reviewloom.functions import valence as V
from reviewloom.operators import text as H

LEXICON = {"good": (1.0, 1.0), "great": (1.5, 1.0), "bad": (-1.0, 1.0), "least": (-0.1, 0.0), "incredible": (1.0, 1.0), "kind": (0.9, 1.0)}
PLAIN = {k: p for k, (p, _) in LEXICON.items()}
MORE, LESS = {"very", "so", "really", "incredible", "most"}, {"slightly", "hardly", "barely"}
NEGATES = {"not", "never", "without", "isn't", "cannot"}
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def plain_valence(text):
    """(positive, negative, neutral, compound) with loops over the words."""
    raw = text.split()
    w = [x if len(x.strip(PUNCTUATION)) <= 2 else x.strip(PUNCTUATION) for x in raw]
    low = [x.lower() for x in w]
    loud = [x.upper() == x and x != y for x, y in zip(w, low)]
    some = 0 < sum(loud) < len(w)
    but = low.index("but") if "but" in low else None
    scores = []
    for i, x in enumerate(low):
        v = PLAIN.get(x, 0.0) * 1.9
        if x not in PLAIN or x in MORE | LESS or (x == "kind" and low[i + 1 : i + 2] == ["of"]):
            scores.append(0.0)
            continue
        if loud[i] and some:
            v += math.copysign(0.733, v)
        for d in (1, 2, 3):
            if i < d or low[i - d] in PLAIN:
                continue
            p = low[i - d]
            s = (0.293 if p in MORE else -0.293 if p in LESS else 0.0) * (-1 if v < 0 else 1)
            if s and loud[i - d] and some:
                s += 0.733 if v > 0 else -0.733
            v += s * (1, 0.95, 0.9)[d - 1]
            between = low[i - d + 1 : i]
            if d > 1 and p == "never" and {"so", "this"} & set(between):
                v *= 1.25
            elif d > 1 and p == "without" and "doubt" in between:
                pass
            elif p in NEGATES or "n't" in p:
                v *= -0.74
        if i and low[i - 1] == "least" and "least" not in PLAIN and not (i > 1 and low[i - 2] in ("at", "very")):
            v *= -0.74
        if but is not None:
            v *= 0.5 if i < but else 1.5 if i > but else 1.0
        scores.append(v)
    mark = min(text.count("!"), 4) * 0.292
    q = text.count("?")
    mark += 0 if q <= 1 else q * 0.18 if q <= 3 else 0.96
    total = sum(scores)
    up, down = sum(v + 1 for v in scores if v > 0), sum(v - 1 for v in scores if v < 0)
    total += math.copysign(mark, total) if total else 0
    up, down = up + (mark if up > -down else 0), down - (mark if up < -down else 0)
    whole = up - down + sum(v == 0 for v in scores)
    shares = (up / whole, -down / whole, sum(v == 0 for v in scores) / whole) if whole else (0.0, 0.0, 0.0)
    return (*shares, total / math.sqrt(total * total + 15))


TEXTS = [
    "good", "very good", "so very really good", "slightly good", "hardly very bad", "it is not good", "not very good", "not so very good",
    "never so good", "never this very good", "without a doubt good", "without doubt good", "isn't it good", "VERY GOOD stuff", "VERY good", "SO GOOD", "GOOD", "BAD thing",
    "good but bad", "bad, but very good!", "but good but bad", "good!!!", "bad!!!!!!", "good? really?", "good????? bad", "incredible", "incredible good", "kind of good", "a kind man",
    "good good bad great", "not bad great", "(good), 'bad'", "!good! :) ok", "", " \n", "nothing here", "at least good", "least good", "very least good", "isn't good, it's BAD!!",
    "good " * 500 + "not bad",
]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame([(k, t) for k, t in enumerate(TEXTS)] + [(len(TEXTS), None)], "review_id long, review_text string").repartition(3)


def scores(df):
    names = [f"sent_vader_{x}" for x in ("positive", "negative", "neutral", "compound")]
    return {r[0]: tuple(r[1:]) for r in df.select("review_id", *names).collect()}


@pytest.mark.parametrize("least_known", [True, False])
def test_rows_and_table_follow_the_rules(spark, texts, monkeypatch, least_known):
    lexicon = dict(LEXICON)
    if not least_known:
        del lexicon["least"]
        monkeypatch.delitem(PLAIN, "least")
    table = spark.createDataFrame([(t, p, s) for t, (p, s) in lexicon.items()], "term string, polarity double, subjectivity double")
    by_row, by_table = scores(H.row_polarity(texts, lexicon=lexicon)), scores(H.lexicon_polarity(texts, table))
    assert by_row.keys() == by_table.keys() and len(by_row) == len(TEXTS) + 1
    for k, text in enumerate([*TEXTS, ""]):
        want = plain_valence(text)
        for got in (by_row[k], by_table[k]):
            assert got == pytest.approx(want, abs=1e-9), text


def test_directions(spark):
    rows = ["good", "very good", "VERY good thing", "not good", "good!!", "bad", "bad but good", "good but bad"]
    df = spark.createDataFrame(list(enumerate(rows)), "review_id long, review_text string")
    got = {rows[k]: v[3] for k, v in scores(H.row_polarity(df, lexicon=LEXICON)).items()}
    assert got["not good"] < 0 < got["good"] < got["very good"] < got["VERY good thing"] and got["good"] < got["good!!"]
    assert got["bad"] < 0 and got["good but bad"] < 0 < got["bad but good"]


def test_marked_words_are_worked_out_once(spark):
    text = F.col("t")
    hits = F.array().cast("array<struct<pos:int,v:double>>")
    df = spark.createDataFrame([("not good",)], "t string").select(V.valence(text, V.marked_words(F.split(text, " ")), hits))
    assert df._jdf.queryExecution().analyzed().toString().count("Contains(") == 1
