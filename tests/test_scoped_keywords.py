"""Keywords of scopes: texts stay where they are, and scopes are spread after counting."""

import math
import re
from collections import Counter

from pyspark.sql import functions as F

from reviewloom.functions import text as X
from reviewloom.operators import keywords as M


def test_categories_do_not_move_texts(spark):
    rows = [(i, "hot" if i % 10 else "cold", "positive", f"word{i % 7} more words") for i in range(200)]
    df = spark.createDataFrame(rows, "review_id long, category string, predicted_sentiment string, cleaned_text string")
    scoped = M._category_scopes(df, 10, 5, "cleaned_text")
    plan = scoped._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    assert scoped.count() == 200 and M._category_scopes(df, 50, 5, "cleaned_text").count() == 180


def test_terms_of_a_review_in_several_rows_are_added_up(spark):
    """Rows of one review may be in different scopes."""
    rows = [(1, ["all", "x"], "aa bb aa"), (1, ["all"], "bb cc"), (2, ["all", "x"], "aa cc"), (None, ["x"], "bb bb"), (3, [], "dd"), (4, None, "dd")]
    df = spark.createDataFrame(rows, "review_id long, scope array<string>, cleaned_text string")
    got = {(r.scope, r.term): r.score for r in M.scoped_keywords(df, ["scope"], 50, vocab=50, ngram_range=(1, 2), stop_words=()).collect()}
    want = {}
    for scope in ("all", "x"):
        texts, docs = {}, 0
        for key, scopes, text in rows:
            if scope in (scopes or []):
                docs += 1
                words = text.split()
                texts.setdefault(key, Counter()).update(words + [f"{a} {b}" for a, b in zip(words, words[1:])])
        df_counts = Counter(t for c in texts.values() for t in c)
        for c in texts.values():
            w = {t: n * (math.log((1 + docs) / (1 + df_counts[t])) + 1) for t, n in c.items()}
            norm = math.sqrt(sum(x * x for x in w.values()))
            for t, x in w.items():
                want[scope, t] = want.get((scope, t), 0) + x / norm / docs
    assert got.keys() == want.keys() and all(abs(got[k] - v) < 1e-9 for k, v in want.items())


def test_a_frequent_word_of_one_scope_only_brings_no_term_to_another(spark):
    rows = [(1, "a", "aa bb aa bb aa bb cc dd"), (2, "b", "cc dd cc dd cc dd aa bb")]
    df = spark.createDataFrame(rows, "review_id long, scope string, cleaned_text string")
    kept = M.scoped_keywords(df, ["scope"], 9, vocab=3, ngram_range=(1, 2), stop_words=())
    assert {(r.scope, r.term) for r in kept.collect()} == {(s, t) for s, p in (("a", "aa bb"), ("b", "cc dd")) for t in [*p.split(), p]}


def test_special_characters_by_the_published_pattern(spark):
    points = [*range(0x3000), *range(0xD7F0, 0xD800), *range(0xE000, 0xE010), *range(0xFFF0, 0x10010), 0x1F600, 0x10FFFF]
    df = spark.createDataFrame([(c, f"a{chr(c)}{chr(c)}b") for c in points], "c int, t string")
    expected = re.compile(X.SPECIAL.replace(r"\s", r"\t-\r "))
    for c, t, got in df.select("c", "t", X.strip_special(F.col("t"))).collect():
        assert got == expected.sub(" ", t), hex(c)


def test_addresses_go_where_there_is_an_at_sign(spark):
    df = spark.createDataFrame([("Write to a.b@c.de now",), ("see https://x.y/@z and www.q",), ("can't @ all",), (None,)], "t string")
    assert [r[0] for r in df.select(X.clean_text(F.col("t"))).collect()] == ["write to now", "see and", "cannot @ all".replace("@ ", ""), ""]
