import datetime as dt

import pytest
from pyspark.sql import functions as F

from reviewloom.functions import text as X
from reviewloom.operators import filters, text


def one(spark, value, fn):
    df = spark.createDataFrame([(value,)], "t string")
    return df.select(fn(F.col("t")).alias("o")).first()["o"]


@pytest.mark.parametrize(
    "given, wanted",
    [
        ("this is not good at all. but never again", "this is not good_NOT at_NOT all. but never again_NOT"),
        ("no, thanks", "no, thanks"),
        ("not never good", "not never good_NOT"),
        ("a not", "a not"),
        ("not x. y no z w, v", "not x. y no z_NOT w, v"),
        ("", ""),
    ],
)
def test_handle_negations(spark, given, wanted):
    assert one(spark, given, X.handle_negations) == wanted


def test_many_negations_do_not_overflow(spark):
    assert one(spark, "no " * 20000 + "x", X.handle_negations).endswith("no x_NOT")


@pytest.mark.parametrize(
    "fn, given, wanted",
    [
        (X.strip_phones, "call 555-123-4567 now", "call   now"),
        (X.strip_urls, "see https://a.b/c and www.x.y", "see   and  "),
        (X.strip_emails, "to a.b@c.d @x y@", "to   @x y@"),
        (X.expand_contractions, "I can't, it's fine", "i cannot, it is fine"),
        (X.clean_text, None, ""),
        (X.clean_text, "  Café  WON'T\topen: 100% ", "caf will not open 100"),
        (X.singularize, "boxes horses cities bus class dogs this good_NOT", "box hors city bus class dog this good_NOT"),
    ],
)
def test_cleaning(spark, fn, given, wanted):
    assert one(spark, given, fn) == wanted


def test_ngrams(spark):
    df = spark.createDataFrame([(1, "Red big red fox"), (2, ""), (3, None)], "review_id int, cleaned_text string")
    rows = {}
    for r in text.ngrams(df).collect():
        rows.setdefault(r.review_id, []).append(r.term)
    assert sorted(rows[1]) == sorted(
        ["red", "big", "red", "fox", "red big", "big red", "red fox", "red big red", "big red fox"]
    )
    assert set(rows) == {1}


def test_patterns(spark):
    df = spark.createDataFrame([("soooo goood #a @b AB hi 😊😍 x 🔥",), (None,)], "review_text string")
    first, empty = text.special_patterns(df).collect()
    assert (first.pattern_repeated_char_count, first.pattern_emoji_count) == (2, 2)
    assert (first.pattern_hashtag_count, first.pattern_mention_count, first.pattern_all_caps_word_count) == (1, 1, 1)
    assert sum(empty[1:]) == 0


def test_temporal_features(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 7, 10),), (None,)], "review_date timestamp_ntz")
    sunday, missing = text.temporal_features(df).collect()
    assert (sunday.temp_review_dayofweek, sunday.temp_is_weekend, sunday.temp_is_holiday_season) == (6, 1, 1)
    assert list(missing[1:]) == [12, 3, 15, 6, 0, 0, 0]


def test_empty_text_scores_zero(spark):
    df = spark.createDataFrame([("",), (None,)], "review_text string")
    for row in text.punctuation_features(text.text_stats(df)).collect():
        assert sum(v for v in row[1:]) == 0
    for row in text.row_polarity(df).collect():
        assert sum(abs(v) for v in row[1:]) == 0
    for row in text.readability(df).collect():
        assert sum(v for v in row[1:]) == 0


def test_polarity_sign(spark):
    df = spark.createDataFrame(
        [(1, "Great phone, I love it"), (2, "Terrible. The worst!"), (3, "not great")],
        "review_id int, review_text string",
    )
    good, bad, negated = text.row_polarity(df).orderBy("review_id").collect()
    assert good.sent_textblob_polarity == 1.0 and good.sent_vader_compound > 0.6
    assert bad.sent_textblob_polarity == -1.0 and bad.sent_vader_compound < -0.6
    assert negated.sent_textblob_polarity == -0.5


def test_length_filter(spark):
    df = spark.createDataFrame([(n,) for n in (4, 5, 1500, 1501)], "word_count int")
    assert [r[0] for r in filters.length_filter(df).collect()] == [5, 1500]


def test_band_excludes_one(spark):
    df = spark.createDataFrame([(1.0,), (0.85,)], "confidence_score double")
    assert filters.confidence_band(df, 0.8, 1.0).count() == 1
