"""Queries of section H: text and scalar functions."""

from pyspark.sql import functions as F

from ..functions import labels as L
from ..functions import text as X
from ..functions.wordlists import (
    LESS_WORDS,
    MORE_WORDS,
    NEGATIONS,
    NEGATIVE_CLEANED,
    NEGATIVE_RAW,
    POSITIVE_CLEANED,
    POSITIVE_RAW,
    PUNCTUATION,
    VALENCE_NEGATIONS,
)
from ..operators import aggregates as A
from ..operators import text as H
from ..plans import stages
from ..plans.parts import together
from ..plans.scratch import scratch_path
from ..schema import SENTIMENTS
from .base import (
    ORACLES,
    query,
    sql_clean,
    sql_expand,
    sql_gram_tokens,
    sql_grams,
    sql_list,
    sql_replace_all,
    sql_string,
    sql_words,
)
from .joins import NEGATIVE, POSITIVE

DOCS = "review_docs"


def _strip(key, operator, sql):
    @query(key, f"SELECT review_id, {sql} AS review_text FROM review_docs", DOCS)
    def _(v):
        return operator(v.docs.select("review_id", "review_text"))


_strip("expand_contractions", H.expand_contractions, sql_expand("review_text"))
_strip("strip_urls", H.strip_urls, sql_replace_all("review_text", X.URL))
_strip("strip_emails", H.strip_emails, sql_replace_all("review_text", X.EMAIL))
_strip("strip_phones", H.strip_phones, sql_replace_all("review_text", X.PHONE))
_strip("strip_special", H.strip_special, sql_replace_all("review_text", X.SPECIAL))
_strip("clean_text", H.clean_text, sql_clean("review_text"))

# The words of each text in order, with the last event before each: a negation word
# opens the scope, a token with punctuation closes it.
NEGATED = f"""
k0 AS (SELECT review_id, {sql_words("cleaned_text")} AS t FROM cleaned),
k1 AS (SELECT review_id, unnest(t) AS w, unnest(range(len(t))) AS pos FROM k0),
k2 AS (SELECT *, CASE WHEN w IN {sql_list(NEGATIONS)} THEN 1 WHEN regexp_matches(w, '[.,!?;:]') THEN 0 END AS ev FROM k1),
k3 AS (SELECT *, last_value(ev IGNORE NULLS) OVER (PARTITION BY review_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS st FROM k2),
k4 AS (SELECT review_id, pos, CASE WHEN ev IS NULL AND st = 1 THEN w || '_NOT' ELSE w END AS w FROM k3),
negated AS (SELECT c.review_id, coalesce(string_agg(w, ' ' ORDER BY pos), '') AS negated_text FROM cleaned c LEFT JOIN k4 USING (review_id) GROUP BY 1)
"""


@query("handle_negations", f"WITH {NEGATED} SELECT * FROM negated", "cleaned")
def _(v):
    df = v.cleaned.select("review_id", F.col("cleaned_text").alias("negated_text"))
    return H.handle_negations(df, "negated_text")


STOP_LIST = "[" + sql_list(X.CLEAN_STOP_WORDS)[1:-1] + "]"
STOPPED = f"""array_to_string(list_filter(regexp_extract_all(negated_text, '[{X.WORD}]+|[^{X.WORD}{X.SPACE}]'),
 lambda x: NOT list_contains({STOP_LIST}, lower(x)) OR contains(x, '_NOT')), ' ')"""
PLURAL_Y = r"regexp_replace({}, '\b([a-z]{{2,}})ies\b', '\1y', 'g')"
PLURAL_S = r"regexp_replace({}, '\b(?:([a-z]+(?:s|x|ch|sh))es|([a-z]+[a-hj-rtv-z])s)\b', '\1\2', 'g')"


def singular_sql(column):
    return PLURAL_S.format(PLURAL_Y.format(column))


@query("remove_stopwords", f"WITH {NEGATED} SELECT review_id, {STOPPED} AS negated_text FROM negated", "cleaned")
def _(v):
    df = v.cleaned.select("review_id", F.col("cleaned_text").alias("negated_text"))
    return H.remove_stopwords(H.handle_negations(df, "negated_text"), "negated_text")


@query("lemmatize", f"SELECT review_id, {singular_sql('cleaned_text')} AS cleaned_text FROM cleaned", "cleaned")
def _(v):
    return H.lemmatize(v.cleaned.select("review_id", "cleaned_text"))


@query(
    "lemmatize_table",
    f"""WITH t AS (SELECT review_id, regexp_extract_all(cleaned_text, '[{X.WORD}]+|[^{X.WORD}{X.SPACE}]') AS t FROM cleaned)
    SELECT review_id, array_to_string(list_transform(t, lambda x: CASE x WHEN 'the' THEN 'T1' WHEN 'los' THEN 'L1' ELSE {singular_sql("x")} END), ' ') AS cleaned_text FROM t""",
    "cleaned",
)
def _(v):
    lemmas = v.spark.createDataFrame([("the", "T1"), ("los", "L1")], "form string, lemma string")
    return H.lemmatize(v.stage.select("review_id", "cleaned_text"), lemma_table=lemmas)


def _endings_sql(form):
    cut = ", ".join(
        f"CASE WHEN ends_with({form}, '{old}') THEN left({form}, length({form}) - {len(old)}) || '{new}' END" for old, new in H.NOUN_ENDINGS
    )
    return f"list_filter([{cut}], lambda e: e IS NOT NULL)"


# Irregular forms, as an exception list has them; some lemmas are words of the corpus, some are not.
IRREGULAR = (("los", "the"), ("des", "de"), ("des", "den"), ("les", "nowhere"), ("mice", "mouse"))


@query(
    "lemmatize_forms",
    f"""WITH t AS (SELECT review_id, regexp_extract_all(cleaned_text, '[{X.WORD}]+|[^{X.WORD}{X.SPACE}]') AS t FROM cleaned),
    w AS (SELECT review_id, unnest(t) AS form, unnest(range(len(t))) AS pos FROM t),
    k AS (SELECT form AS lemma FROM w WHERE length(form) >= 2 GROUP BY 1 HAVING count(DISTINCT review_id) >= 20),
    x AS (SELECT form, list(DISTINCT lemma) AS listed FROM (VALUES {", ".join(f"('{f}', '{b}')" for f, b in IRREGULAR)}) v(form, lemma) GROUP BY 1),
    f AS (SELECT DISTINCT form FROM w),
    a AS (SELECT f.form, listed IS NOT NULL AS excepted, list_concat([f.form], coalesce(listed, {_endings_sql("f.form")})) AS c FROM f LEFT JOIN x USING (form)),
    b AS (SELECT form, unnest(c) AS lemma, unnest(range(len(c))) AS place FROM a),
    o AS (SELECT form, arg_min(lemma, {{'n': length(lemma), 'p': place}}) AS lemma FROM b JOIN k USING (lemma) GROUP BY 1),
    r AS (WITH RECURSIVE q AS (SELECT form, 1 AS round, unnest(c[2:]) AS lemma FROM a WHERE NOT excepted AND form NOT IN (SELECT form FROM o)
     UNION SELECT form, round + 1, e FROM (SELECT form, round, unnest({_endings_sql("lemma")}) AS e FROM q)) SELECT * FROM q),
    l AS (SELECT * FROM o UNION ALL SELECT form, arg_min(lemma, {{'r': round, 'n': length(lemma), 'l': lemma}}) FROM r JOIN k USING (lemma) WHERE round > 1 GROUP BY 1),
    j AS (SELECT review_id, string_agg(coalesce(lemma, form), ' ' ORDER BY pos) AS s FROM w LEFT JOIN l USING (form) GROUP BY 1)
    SELECT review_id, coalesce(s, '') AS cleaned_text FROM cleaned LEFT JOIN j USING (review_id)""",
    "cleaned",
)
def _(v):
    """The words of twenty reviews or more are taken as the base forms."""
    df = v.stage.select("review_id", "cleaned_text")
    words = df.select("review_id", F.explode(X.word_and_mark_tokens(F.col("cleaned_text"))).alias("form")).where(F.length("form") >= 2)
    base = words.distinct().groupBy("form").agg(F.count(F.lit(1)).alias("n")).where("n >= 20").select("form")
    return H.lemmatize(df, lemma_table=v.spark.createDataFrame(list(IRREGULAR), "form string, lemma string"), base_forms=base)


@query(
    "preprocess",
    f"""WITH {NEGATED}, s AS (SELECT review_id, {STOPPED} AS s FROM negated)
    SELECT c.review_id, {singular_sql("s")} AS cleaned_text, length(review_text)::INT AS char_count, len({sql_words("review_text")})::INT AS word_count
    FROM cleaned c JOIN s ON c.review_id = s.review_id WHERE len({sql_words("review_text")}) BETWEEN 5 AND 1500""",
    "cleaned",
)
def _(v):
    return H.preprocess(v.docs).select("review_id", "cleaned_text", "char_count", "word_count")


def count_char(c, column="review_text"):
    return f"length({column}) - length(replace({column}, {sql_string(c)}, ''))"


ENDS = f"({count_char('.')} + {count_char('!')} + {count_char('?')})"


@query(
    "text_stats",
    f"""WITH d AS (SELECT review_id, review_text, {sql_words("review_text")} AS t FROM review_docs)
    SELECT review_id, length(review_text)::INT AS text_char_count, len(t)::INT AS text_word_count,
     CASE WHEN length(review_text) > 0 THEN greatest(1, {ENDS}) ELSE 0 END::INT AS text_sentence_count,
     round(coalesce(length({sql_replace_all("review_text", f"[{X.SPACE}]+", "")}) / nullif(len(t), 0)::DOUBLE, 0), 6) AS text_avg_word_length,
     round(coalesce(len(t) / greatest(1, {ENDS})::DOUBLE, 0), 6) AS text_avg_sentence_length,
     round(coalesce(len(list_distinct(t)) / nullif(len(t), 0)::DOUBLE, 0), 6) AS text_unique_word_ratio,
     round(coalesce(len(regexp_extract_all(review_text, '\\p{{Lu}}')) / nullif(length(review_text), 0)::DOUBLE, 0), 6) AS text_capital_ratio,
     round(coalesce(len(regexp_extract_all(review_text, '\\p{{Nd}}')) / nullif(length(review_text), 0)::DOUBLE, 0), 6) AS text_digit_ratio,
     round(coalesce(len(regexp_extract_all(review_text, '[{X.SPACE}]')) / nullif(length(review_text), 0)::DOUBLE, 0), 6) AS text_whitespace_ratio
    FROM d""",
    DOCS,
)
def _(v):
    return H.text_stats(v.docs.select("review_id", "review_text")).drop("review_text")


PUNCT_CLASS = "[!-/:-@\\[-`{-~]"


@query(
    "punctuation_features",
    f"""SELECT review_id, ({count_char('!')})::INT AS punct_exclamation_count, ({count_char('?')})::INT AS punct_question_count,
     len(regexp_extract_all(review_text, '\\.\\.\\.'))::INT AS punct_ellipsis_count, ({count_char(',')})::INT AS punct_comma_count,
     ({count_char('.')})::INT AS punct_period_count, len(regexp_extract_all(review_text, {sql_string(PUNCT_CLASS)}))::INT AS punct_total_punctuation,
     len(list_distinct(regexp_extract_all(review_text, {sql_string(PUNCT_CLASS)})))::INT AS punct_punctuation_diversity FROM review_docs""",
    DOCS,
)
def _(v):
    assert len(PUNCTUATION) == 32
    return H.punctuation_features(v.docs.select("review_id", "review_text")).drop("review_text")


def lexicon_sql(pos, neg, source, column):
    return f"""WITH d AS (SELECT review_id, {sql_words(f"lower({column})")} AS t FROM {source}),
    c AS (SELECT review_id, len(t) AS n, len(list_filter(t, lambda x: x IN {sql_list(pos)})) AS p, len(list_filter(t, lambda x: x IN {sql_list(neg)})) AS m FROM d)
    SELECT review_id, p::INT AS positive_word_count, m::INT AS negative_word_count, round(coalesce((p + m) / nullif(n, 0)::DOUBLE, 0), 6) AS sentiment_word_ratio FROM c"""


@query("lexicon_counts", lexicon_sql(POSITIVE, NEGATIVE, "cleaned", "cleaned_text"), "cleaned")
def _(v):
    return H.lexicon_counts(v.cleaned.select("review_id", "cleaned_text"), "cleaned_text", POSITIVE, NEGATIVE).drop("cleaned_text")


@query("lexicon_counts_raw", lexicon_sql(POSITIVE_RAW, NEGATIVE_RAW, DOCS, "review_text"), DOCS)
def _(v):
    return H.lexicon_counts(v.docs.select("review_id", "review_text"), "review_text", POSITIVE_RAW, NEGATIVE_RAW).drop("review_text")


# A weighted lexicon of frequent corpus words, negation words among their neighbours.
WEIGHTS = (("the", 0.5, 0.4), ("los", -0.8, 0.9), ("und", 0.2, 0.1), ("eau", -0.3, 0.6), ("and", -0.1, 0.2), ("good", 0.7, 0.6), ("bad", -0.7, 0.7))


def polarity_sql(weights) -> str:
    """Mean polarity with negation, and valence by the published rules, place by place."""
    values = ", ".join(f"({sql_string(t)}, {p}::DOUBLE, {s}::DOUBLE)" for t, p, s in weights)
    edges = r"^[!-/:-@\[-`{-~]+|[!-/:-@\[-`{-~]+$"
    bare = f"regexp_replace(w, '{edges}', '', 'g')"
    before = lambda d: f"t[i - {d} + 1]"
    step = lambda v, d: (
        f"CASE WHEN i < {d} OR list_contains(places, i - {d}) THEN {v} ELSE ({v} + (CASE WHEN {v} < 0 THEN -degree{d} ELSE degree{d} END"
        f" + CASE WHEN degree{d} <> 0 AND loud{d} AND some_loud THEN CASE WHEN {v} > 0 THEN 0.733 ELSE -0.733 END ELSE 0 END) * {(1.0, 0.95, 0.9)[d - 1]}) * factor{d} END"
    )
    degree = lambda w: f"CASE WHEN {w} IN {sql_list(MORE_WORDS)} THEN 0.293 WHEN {w} IN {sql_list(LESS_WORDS)} THEN -0.293 ELSE 0 END::DOUBLE"
    negates = lambda w: f"({w} IN {sql_list(VALENCE_NEGATIONS)} OR contains({w}, 'n''t'))"
    so = lambda w: f"{w} IN ('so', 'this')"
    loud = lambda w: f"(upper({w}) = {w} AND lower({w}) <> {w})"
    return f"""
lex AS (SELECT * FROM (VALUES {values}) l(term, polarity, subjectivity)),
p0 AS (SELECT review_id, regexp_extract_all(lower(review_text), '[{X.WORD}'']+') AS t FROM review_docs),
p1 AS (SELECT review_id, unnest(t) AS term, unnest(list_transform(range(len(t)), lambda i: CASE WHEN i = 0 THEN '' ELSE t[i] END)) AS prev FROM p0),
p2 AS (SELECT review_id, polarity, subjectivity, prev IN {sql_list(NEGATIONS)} AS neg FROM p1 JOIN lex USING (term)),
p4 AS (SELECT review_id, count(polarity) AS hits, coalesce(sum(polarity * CASE WHEN neg THEN -0.5 ELSE 1 END), 0) AS ps, coalesce(sum(subjectivity), 0) AS ss FROM p2 GROUP BY 1),
v0 AS (SELECT review_id, review_text, list_transform({sql_words("review_text")}, lambda w: CASE WHEN length({bare}) <= 2 THEN w ELSE {bare} END) AS t FROM review_docs),
v1 AS (SELECT *, list_transform(t, lambda w: lower(w)) AS l, len(list_filter(t, lambda w: {loud("w")})) AS n_loud FROM v0),
v2 AS (SELECT *, n_loud > 0 AND n_loud < len(t) AS some_loud, list_position(l, 'but') - 1 AS but FROM v1),
h0 AS (SELECT review_id, unnest(range(len(t))) AS i, unnest(l) AS term FROM v2),
h1 AS (SELECT review_id, i, polarity * 1.9 AS v FROM h0 JOIN lex USING (term)),
h2 AS (SELECT review_id, list(i) AS places FROM h1 GROUP BY 1),
h3 AS (SELECT h1.review_id, i, v, t, l, some_loud, but, places,
  {", ".join(f"coalesce({degree(f'l[i - {d} + 1]')}, 0) AS degree{d}, coalesce({loud(before(d))}, false) AS loud{d}" for d in (1, 2, 3))},
  CASE WHEN {negates("l[i]")} THEN -0.74 ELSE 1 END::DOUBLE AS factor1,
  CASE WHEN l[i - 1] = 'never' AND {so("l[i]")} THEN 1.25 WHEN l[i - 1] = 'without' AND l[i] = 'doubt' THEN 1 WHEN {negates("l[i - 1]")} THEN -0.74 ELSE 1 END::DOUBLE AS factor2,
  CASE WHEN l[i - 2] = 'never' AND ({so("l[i - 1]")} OR {so("l[i]")}) THEN 1.25 WHEN l[i - 2] = 'without' AND (l[i - 1] = 'doubt' OR l[i] = 'doubt') THEN 1 WHEN {negates("l[i - 2]")} THEN -0.74 ELSE 1 END::DOUBLE AS factor3
  FROM h1 JOIN v2 USING (review_id) JOIN h2 USING (review_id)),
s0 AS (SELECT *, v + CASE WHEN some_loud AND {loud("t[i + 1]")} THEN sign(v) * 0.733 ELSE 0 END AS x0 FROM h3),
s1 AS (SELECT *, {step("x0", 1)} AS x1 FROM s0), s2 AS (SELECT *, {step("x1", 2)} AS x2 FROM s1), s3 AS (SELECT *, {step("x2", 3)} AS x3 FROM s2),
s4 AS (SELECT review_id, CASE WHEN {degree("l[i + 1]")} <> 0 OR coalesce(l[i + 1] = 'kind' AND l[i + 2] = 'of', false) THEN 0 ELSE
  x3 * CASE WHEN i > 0 AND NOT list_contains(places, i - 1) AND l[i] = 'least' AND NOT coalesce(i > 1 AND l[i - 1] IN ('at', 'very'), false) THEN -0.74 ELSE 1 END
  * CASE WHEN but IS NULL OR but < 0 THEN 1 WHEN i < but THEN 0.5 WHEN i > but THEN 1.5 ELSE 1 END END AS x FROM s3),
s5 AS (SELECT review_id, sum(x) AS vs, coalesce(sum(x + 1) FILTER (WHERE x > 0), 0) AS up, coalesce(sum(x - 1) FILTER (WHERE x < 0), 0) AS down, count(*) FILTER (WHERE x <> 0) AS felt FROM s4 GROUP BY 1),
s6 AS (SELECT v2.review_id, coalesce(vs, 0) AS vs, coalesce(up, 0) AS up, coalesce(down, 0) AS down, len(t) - coalesce(felt, 0) AS n,
  least({count_char('!')}, 4) * 0.292 + CASE WHEN {count_char('?')} <= 1 THEN 0 WHEN {count_char('?')} <= 3 THEN ({count_char('?')}) * 0.18 ELSE 0.96 END AS amp
  FROM v2 LEFT JOIN s5 USING (review_id)),
s7 AS (SELECT review_id, n, vs + sign(vs) * amp AS vs, up + CASE WHEN up > -down THEN amp ELSE 0 END AS up, down - CASE WHEN up < -down THEN amp ELSE 0 END AS down FROM s6)
SELECT r.review_id, round(coalesce(ps / nullif(hits, 0), 0), 6) AS sent_textblob_polarity, round(coalesce(ss / nullif(hits, 0), 0), 6) AS sent_textblob_subjectivity,
 round(coalesce(up / nullif(up - down + n, 0), 0), 6) AS sent_vader_positive, round(coalesce(-down / nullif(up - down + n, 0), 0), 6) + 0.0::DOUBLE AS sent_vader_negative,
 round(coalesce(n / nullif(up - down + n, 0), 0), 6) AS sent_vader_neutral, round(coalesce(vs / sqrt(vs * vs + 15), 0), 6) AS sent_vader_compound
FROM review_docs r LEFT JOIN p4 USING (review_id) LEFT JOIN s7 USING (review_id)"""


POLARITY = polarity_sql(WEIGHTS)


@query("lexicon_polarity", f"WITH {POLARITY.strip()}", DOCS)
def _(v):
    lexicon = v.spark.createDataFrame(list(WEIGHTS), "term string, polarity double, subjectivity double")
    return H.lexicon_polarity(v.docs.select("review_id", "review_text"), lexicon).drop("review_text")


@query("lexicon_polarity_row", f"WITH {POLARITY.strip()}", DOCS)
def _(v):
    lexicon = {t: (p, s) for t, p, s in WEIGHTS}
    return H.row_polarity(v.docs.select("review_id", "review_text"), lexicon=lexicon).drop("review_text")


READ = f"""
b AS (SELECT review_id, regexp_extract_all(lower(review_text), '[{X.WORD}'']+') AS t, len({sql_words("review_text")}) AS ws,
  greatest(1, {ENDS})::DOUBLE AS s, len(regexp_extract_all(lower(review_text), '[{X.WORD}]'))::DOUBLE AS l FROM review_docs),
y AS (SELECT *, len(t)::DOUBLE AS w, list_transform(t, lambda x: greatest(len(regexp_extract_all(x, '[aeiouy]+')) - len(regexp_extract_all(x, '[^aeiouy]e$')), 1)) AS sy FROM b),
z AS (SELECT *, coalesce(list_sum(sy), 0)::DOUBLE AS y, len(list_filter(sy, lambda x: x >= 3))::DOUBLE AS p FROM y),
f AS (SELECT review_id, ws >= 5 AND w > 0 AS ok, 206.835 - 1.015 * w / s - 84.6 * y / w AS fre, 0.39 * w / s + 11.8 * y / w - 15.59 AS fk, 0.4 * (w / s + 100 * p / w) AS fog,
  4.71 * l / w + 0.5 * w / s - 21.43 AS ari, 5.88 * l / w - 29.6 * s / w - 15.8 AS cli, (w - p + p * 3) / s AS li,
  15.79 * p / w + 0.0496 * w / s + CASE WHEN p / w > 0.05 THEN 3.6365 ELSE 0 END AS dc FROM z),
g AS (SELECT *, CASE WHEN li > 20 THEN li / 2 ELSE (li - 2) / 2 END AS lin FROM f)
SELECT review_id, round(CASE WHEN ok THEN fre ELSE 0 END, 6) AS read_flesch_reading_ease, round(CASE WHEN ok THEN fk ELSE 0 END, 6) AS read_flesch_kincaid_grade,
 round(CASE WHEN ok THEN fog ELSE 0 END, 6) AS read_gunning_fog, round(CASE WHEN ok THEN ari ELSE 0 END, 6) AS read_automated_readability_index,
 round(CASE WHEN ok THEN cli ELSE 0 END, 6) AS read_coleman_liau_index, round(CASE WHEN ok THEN lin ELSE 0 END, 6) AS read_linsear_write_formula,
 round(CASE WHEN ok THEN dc ELSE 0 END, 6) AS read_dale_chall_readability,
 round_even(CASE WHEN ok THEN (fk + fog + ari + cli + lin + dc) / 6 ELSE 0 END, 0) AS read_text_standard FROM g"""


@query("readability", f"WITH {READ.strip()}", DOCS)
def _(v):
    return H.readability(v.docs.select("review_id", "review_text")).drop("review_text")


@query(
    "special_patterns",
    f"""SELECT review_id, len(regexp_extract_all(review_text, '{X.URL}'))::INT AS pattern_url_count, len(regexp_extract_all(review_text, '{X.EMAIL}'))::INT AS pattern_email_count,
     len(regexp_extract_all(review_text, '{X.HASHTAG}'))::INT AS pattern_hashtag_count, len(regexp_extract_all(review_text, '{X.MENTION}'))::INT AS pattern_mention_count,
     len(regexp_extract_all(review_text, '{X.EMOJI}'))::INT AS pattern_emoji_count,
     len(list_filter({sql_words("review_text")}, lambda x: length(x) > 1 AND regexp_matches(x, '\\p{{Lu}}') AND NOT regexp_matches(x, '\\p{{Ll}}')))::INT AS pattern_all_caps_word_count
    FROM review_docs""",
    DOCS,
)
def _(v):
    # Repeated characters need a back reference, which DuckDB lacks: see the unit tests.
    df = H.special_patterns(v.docs.select("review_id", "review_text"))
    return df.drop("review_text", "pattern_repeated_char_count")


@query(
    "temporal_features",
    """SELECT review_id, hour(review_date)::INT AS temp_review_hour, (isodow(review_date) - 1)::INT AS temp_review_dayofweek, day(review_date)::INT AS temp_review_day,
     month(review_date)::INT AS temp_review_month, (isodow(review_date) >= 6)::INT AS temp_is_weekend, (month(review_date) IN (11, 12, 1))::INT AS temp_is_holiday_season,
     date_diff('day', DATE '2020-01-01', CAST(review_date AS DATE))::INT AS temp_days_since_epoch FROM review_events""",
    "review_events",
)
def _(v):
    return H.temporal_features(v.events.select("review_id", "review_date")).drop("review_date")


def _derived(df):
    return H.special_patterns(H.punctuation_features(df))


@query(
    "review_quality_score",
    f"""WITH d AS (SELECT review_id, {sql_words("review_text")} AS t, len(regexp_extract_all(review_text, '\\p{{Lu}}')) / nullif(length(review_text), 0)::DOUBLE AS caps FROM review_docs)
    SELECT review_id, round((len(t) * 0.3 + coalesce(len(list_distinct(t)) / nullif(len(t), 0)::DOUBLE, 0) * 50 + 0.5 * 20 + (1 - coalesce(caps, 0)) * 30) / 100, 6) AS review_quality_score FROM d""",
    DOCS,
)
def _(v):
    df = H.text_stats(v.docs.select("review_id", "review_text"))
    df = df.withColumn("sent_textblob_subjectivity", F.lit(0.5))
    return H.review_quality_score(df).select("review_id", "review_quality_score")


@query(
    "engagement_potential",
    f"""SELECT review_id, round(({count_char('!')}) * 2 + ({count_char('?')}) * 3 + len(regexp_extract_all(review_text, '{X.EMOJI}')) * 2 + helpful_count * 0.5, 6)::DOUBLE AS engagement_potential
    FROM review_docs""",
    DOCS,
)
def _(v):
    return H.engagement_potential(_derived(v.docs)).select("review_id", "engagement_potential")


DEFAULT_WEIGHTS = [(t, p, s) for t, (p, s) in H.default_lexicon().items()]
FEATURES = f"""SELECT r.review_id, category, rating, predicted_sentiment, confidence_score, verified_purchase, helpful_count, strftime(review_date, '%Y-%m-%d %H:%M:%S') AS review_date,
 a.* EXCLUDE (review_id), b.* EXCLUDE (review_id), c.* EXCLUDE (review_id), l.positive_word_count AS sent_positive_word_count, l.negative_word_count AS sent_negative_word_count,
 l.sentiment_word_ratio AS sent_sentiment_word_ratio, e.* EXCLUDE (review_id), f.* EXCLUDE (review_id),
 len(list_filter(range(1, len(k.ch) - 1), lambda i: k.ch[i] = k.ch[i + 1] AND k.ch[i] = k.ch[i + 2] AND (i = 1 OR k.ch[i - 1] <> k.ch[i]) AND k.ch[i] <> chr(10)))::INT AS pattern_repeated_char_count,
 0::INT AS temp_review_hour, (isodow(review_date) - 1)::INT AS temp_review_dayofweek, day(review_date)::INT AS temp_review_day, month(review_date)::INT AS temp_review_month,
 (isodow(review_date) >= 6)::INT AS temp_is_weekend, (month(review_date) IN (11, 12, 1))::INT AS temp_is_holiday_season, date_diff('day', DATE '2020-01-01', review_date)::INT AS temp_days_since_epoch,
 coalesce((rating >= 4 AND predicted_sentiment = 'positive') OR (rating <= 2 AND predicted_sentiment = 'negative') OR (rating = 3 AND predicted_sentiment = 'neutral'), false)::INT AS rating_sentiment_aligned,
 round((len(k.t) * 0.3 + coalesce(len(list_distinct(k.t)) / nullif(len(k.t), 0)::DOUBLE, 0) * 50 + c.sent_textblob_subjectivity * 20 + (1 - coalesce(k.caps, 0)) * 30) / 100, 6) AS review_quality_score,
 g.engagement_potential
FROM review_docs r JOIN ({ORACLES["text_stats"]}) a ON a.review_id = r.review_id JOIN ({ORACLES["punctuation_features"]}) b ON b.review_id = r.review_id
JOIN (WITH {polarity_sql(DEFAULT_WEIGHTS).strip()}) c ON c.review_id = r.review_id JOIN ({ORACLES["lexicon_counts_raw"]}) l ON l.review_id = r.review_id
JOIN ({ORACLES["readability"]}) e ON e.review_id = r.review_id JOIN ({ORACLES["special_patterns"]}) f ON f.review_id = r.review_id
JOIN ({ORACLES["engagement_potential"]}) g ON g.review_id = r.review_id
JOIN (SELECT review_id, {sql_words("review_text")} AS t, string_split(review_text, '') AS ch,
  len(regexp_extract_all(review_text, '\\p{{Lu}}')) / nullif(length(review_text), 0)::DOUBLE AS caps FROM review_docs) k ON k.review_id = r.review_id"""


@query("all_features", FEATURES, DOCS)
def _(v):
    return H.all_features(v.docs).drop("review_text", "product_id", "true_sentiment")


@query(
    "ngrams",
    f"""SELECT review_id, count(*) AS n, count(DISTINCT term) AS terms, min(term) AS first_term, max(term) AS last_term
    FROM {sql_grams("cleaned", "review_id", sql_gram_tokens("cleaned_text", False))} GROUP BY 1""",
    "cleaned",
)
def _(v):
    # Texts move once, before they are n-grams; the aggregates then stay inside their tasks.
    texts = together(v.docs, "review_id", "review_text")
    grams = H.ngrams(texts.withColumn("cleaned_text", X.clean_text(F.col("review_text"))))
    return grams.groupBy("review_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("term").alias("terms"),
        F.min("term").alias("first_term"), F.max("term").alias("last_term"),
    )


@query(
    "format_kpi",
    """SELECT category, format('{:.1f}', round_even(100.0::DOUBLE * avg(CASE WHEN predicted_sentiment = 'positive' THEN 1.0::DOUBLE ELSE 0 END), 1)) || '%' AS pct,
     '$' || format('{:,}', CAST(round_even(count(*) * 75.3::DOUBLE, 0) AS BIGINT)) AS money, format('{:,}', count(*)) AS n, upper(category) AS name FROM reviews GROUP BY category""",
)
def _(v):
    p = v.reviews.groupBy("category").agg(L.share(L.sentiment_is("positive")).alias("p"), F.count(F.lit(1)).alias("c"))
    return p.select(
        "category",
        H.format_kpi(F.col("p") * 100, "percent").alias("pct"),
        H.format_kpi(F.col("c") * 75.3, "dollars").alias("money"),
        H.format_kpi(F.col("c"), "thousands").alias("n"),
        H.format_kpi(F.col("category"), "upper").alias("name"),
    )


@query(
    "review_titles",
    """SELECT review_id, repeat('⭐', rating) || ' | ' || product_name || ' | ' || upper(predicted_sentiment) || ' ('
      || CAST(CAST(round_even(confidence_score * 100, 0) AS BIGINT) AS VARCHAR) || '% confidence)' AS title, strftime(review_date, '%Y-%m-%d') AS day FROM reviews""",
)
def _(v):
    return H.review_titles(v.reviews)


@query(
    "bands",
    """WITH m AS (SELECT product_id, avg((rating - 1) / 4.0::DOUBLE * 0.3 + CASE predicted_sentiment WHEN 'positive' THEN 1.0::DOUBLE WHEN 'neutral' THEN 0.5 ELSE 0 END * 0.7) * 100 AS c,
      avg(rating) AS r FROM reviews GROUP BY 1)
    SELECT product_id, CASE WHEN c < 70 THEN 'critical' WHEN c > 85 THEN 'strong' ELSE 'normal' END AS csi_band,
     CASE WHEN c >= 80 THEN '✅' WHEN c >= 70 THEN '⚠️' ELSE '❌' END AS kpi, CASE WHEN r >= 4 THEN '✅' WHEN r >= 3.5 THEN '⚠️' ELSE '❌' END AS rating_band,
     CASE WHEN c < 50 THEN 'red' WHEN c < 75 THEN 'amber' ELSE 'green' END AS gauge FROM m""",
)
def _(v):
    m = v.reviews.groupBy("product_id").agg(A.csi_value().alias("c"), F.avg("rating").alias("r"))
    return m.select(
        "product_id",
        L.csi_band(F.col("c")).alias("csi_band"),
        L.kpi_status(F.col("c"), 80, 70).alias("kpi"),
        L.kpi_status(F.col("r"), 4, 3.5).alias("rating_band"),
        L.gauge_band(F.col("c"), 50, 75).alias("gauge"),
    )


@query("json_props", """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, '{"k":' || CAST(json_extract(props, '$.k') AS BIGINT) || '}' AS encoded FROM events""", "")
def _(v):
    return H.json_props(v.table("events").select("event_id", "props")).drop("props")


# What the report is made of: the processed reviews of 5 to 1500 words.
REPORT = f"""WITH x AS (
  SELECT r.review_id, c.cleaned_text, c.char_count, c.word_count, {count_char("!")} AS ex, {count_char("?")} AS qu, isodow(review_date) >= 6 AS weekend,
    coalesce(length({sql_replace_all("review_text", f"[{X.SPACE}]+", "")}) / nullif(c.word_count, 0)::DOUBLE, 0) AS awl, p.sent_textblob_polarity AS pol,
    len(list_filter({sql_words("lower(c.cleaned_text)")}, lambda y: y IN {sql_list(POSITIVE_CLEANED)})) AS pos,
    len(list_filter({sql_words("lower(c.cleaned_text)")}, lambda y: y IN {sql_list(NEGATIVE_CLEANED)})) AS neg
  FROM review_docs r JOIN ({ORACLES["preprocess"]}) c ON c.review_id = r.review_id JOIN (WITH {polarity_sql(DEFAULT_WEIGHTS).strip()}) p ON p.review_id = r.review_id)
SELECT count(*) AS total_reviews, round(avg(word_count), 6) AS avg_word_count, round(avg(char_count), 6) AS avg_char_count, round(avg(awl), 6) AS avg_word_length,
  count(*) FILTER (WHERE pos > 0) AS with_positive_words, count(*) FILTER (WHERE neg > 0) AS with_negative_words, round(avg(pol), 6) + 0.0::DOUBLE AS avg_polarity,
  count(*) FILTER (WHERE ex > 0) AS with_exclamations, count(*) FILTER (WHERE qu > 0) AS with_questions, count(*) FILTER (WHERE weekend) AS weekend_reviews,
  round(avg(weekend::INT) * 100, 6) AS weekend_pct FROM x"""


@query("preprocessing_report", REPORT, DOCS)
def _(v):
    return A.preprocessing_report(H.preprocess(v.docs))


@query(
    "pipeline_predictions",
    f"SELECT *, true AS valid FROM ({ORACLES['preprocess']})",
    DOCS,
)
def _(v):
    """Raw to processed to predictions: one scored row for each processed review."""
    root = scratch_path(v.spark, "flow")
    processed = stages.build_processed(v.spark, v.docs, root)
    scored = stages.build_predictions(v.spark, processed, root)
    known = F.col("predicted_sentiment").isin(*SENTIMENTS) & F.col("confidence_score").between(1 / 3 - 1e-9, 1.0)
    return scored.select("review_id", "cleaned_text", "char_count", "word_count", known.alias("valid"))
