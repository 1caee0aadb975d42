"""Text operators: each adds columns to the review table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import labels as L
from ..functions import text as X
from ..functions import valence as V
from ..functions.wordlists import (
    NEGATIONS,
    NEGATIVE_CLEANED,
    NEGATIVE_RAW,
    POSITIVE_CLEANED,
    POSITIVE_RAW,
)
from ..plans.parts import parts_by_text, together
from ..plans.scratch import materialize
from ..schema import DEFAULTS, Settings
from .filters import length_filter


def _apply(function):
    def operator(df: DataFrame, col: str = "review_text", out: str | None = None, **kw) -> DataFrame:
        return df.withColumn(out or col, function(F.col(col), **kw))

    operator.__name__ = function.__name__
    operator.__doc__ = function.__doc__
    return operator


expand_contractions = _apply(X.expand_contractions)
strip_urls = _apply(X.strip_urls)
strip_emails = _apply(X.strip_emails)
strip_phones = _apply(X.strip_phones)
strip_special = _apply(X.strip_special)
clean_text = _apply(X.clean_text)
handle_negations = _apply(X.handle_negations)
remove_stopwords = _apply(X.remove_stopwords)


# The published endings of English nouns and what they are replaced by.
NOUN_ENDINGS = (
    ("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"), ("ches", "ch"), ("shes", "sh"), ("men", "man"), ("ies", "y"),
)


def _detached(form: Column) -> Column:
    """What is left of a form by each ending that it has, in their order."""
    cut = [
        F.when(F.endswith(form, F.lit(old)), F.concat(F.substring(form, F.lit(1), F.length(form) - len(old)), F.lit(new)))
        for old, new in NOUN_ENDINGS
    ]
    return F.array_compact(F.array(*cut))


def noun_lemmas(forms: DataFrame, base_forms: DataFrame, exceptions: DataFrame | None = None) -> DataFrame:
    """(form, lemma) for distinct forms (form), those that have a lemma among the base forms (form).

    Candidates are the form, with its lemmas in the exceptions (form, lemma) if it is there, else with the form less an ending.
    The shortest that is a base form is the lemma, the form itself before others. Where none is, and the form is no
    exception, endings are taken off again and again, and the first round with a base form counts.
    """
    known = base_forms.select(F.col("form").alias("lemma")).where(F.col("lemma").isNotNull()).distinct()
    if exceptions is None:
        listed = forms.withColumn("listed", F.lit(None).cast("array<string>"))
    else:
        given = exceptions.groupBy("form").agg(F.sort_array(F.collect_set("lemma")).alias("listed"))
        listed = forms.join(given, "form", "left")
    first = listed.withColumn("round", F.coalesce("listed", _detached(F.col("form"))))
    first = first.select("form", F.col("listed").isNotNull().alias("excepted"), F.concat(F.array("form"), "round").alias("round"))
    found = first.select("form", F.posexplode("round").alias("at", "lemma")).join(known, "lemma")
    best = F.min(F.struct(F.length("lemma").alias("n"), "at", "lemma"))["lemma"].alias("lemma")
    once = materialize(found.groupBy("form").agg(best), "lemmas")

    def again(state: Column, number: Column) -> Column:
        last = F.array_distinct(F.flatten(F.transform(state["last"], _detached)))
        new = F.transform(last, lambda c: F.struct(number.alias("round"), c.alias("lemma")))
        return F.struct(last.alias("last"), F.concat(state["all"], new).alias("all"))

    rest = first.where(~F.col("excepted") & (F.size("round") > 1)).join(once, "form", "left_anti")
    start = F.struct(F.slice("round", 2, F.size("round") - 1).alias("last"), F.array().cast("array<struct<round:int,lemma:string>>").alias("all"))
    deeper = rest.select("form", F.inline(F.aggregate(F.sequence(F.lit(2), F.length("form")), start, again, lambda state: state["all"])))
    later = deeper.join(known, "lemma").groupBy("form").agg(F.min(F.struct("round", F.length("lemma").alias("n"), "lemma"))["lemma"].alias("lemma"))
    return once.unionByName(later)


def lemmatize(
    df: DataFrame, col: str = "cleaned_text", out: str | None = None,
    lemma_table: DataFrame | None = None, key: str = "review_id", base_forms: DataFrame | None = None,
) -> DataFrame:
    """Noun lemmas: regular plural rules, a (form, lemma) table first where given.

    With a table of base forms (form), endings are taken off only where that leads to one of them, and
    the given table holds the exceptions; every distinct form is looked up once. The planner broadcasts tables
    when their size allows.
    """
    out = out or col
    if lemma_table is None and base_forms is None:
        return df.withColumn(out, X.singularize(F.col(col)))
    # Texts move once; words are looked up and put together again inside their tasks, where the table is broadcast.
    df = together(df, key, col)
    tokens = df.where(F.col(key).isNotNull()).select(key, F.posexplode(X.word_and_mark_tokens(F.col(col))).alias("pos", "form"))
    lemma = F.coalesce("lemma", X.singularize(F.col("form")))
    if base_forms is not None:
        found = noun_lemmas(tokens.select("form").distinct(), base_forms, lemma_table)
        lemma_table = materialize(found.where(F.col("lemma") != F.col("form")), "lemmas")
        lemma = F.coalesce("lemma", "form")
    else:
        # Written, it has a size by which the planner can broadcast it; local rows have none.
        lemma_table = materialize(lemma_table, "lemmas")
    lemmas = (
        tokens.join(lemma_table, "form", "left")
        .groupBy(key)
        .agg(F.sort_array(F.collect_list(F.struct("pos", lemma.alias("w")))).alias("t"))
        .select(key, F.array_join(F.col("t.w"), " ").alias("__lemmas"))
    )
    return (
        df.join(lemmas, key, "left")
        .withColumn(out, F.coalesce("__lemmas", F.lit("")))
        .drop("__lemmas")
    )


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole), F.lit(0.0))


def text_stats(df: DataFrame, col: str = "review_text", prefix: str = "text_") -> DataFrame:
    text = X.text_or_empty(F.col(col))
    tokens = X.words(text)
    chars, count = F.length(text), F.size(tokens)
    letters = F.length(F.regexp_replace(text, f"[{X.SPACE}]+", ""))
    ends = X.count_char(text, ".") + X.count_char(text, "!") + X.count_char(text, "?")
    sentences = F.when(chars > 0, F.greatest(F.lit(1), ends)).otherwise(0)
    columns = {
        "char_count": chars,
        "word_count": count,
        "sentence_count": sentences,
        "avg_word_length": _ratio(letters, count),
        "avg_sentence_length": _ratio(count, sentences),
        "unique_word_ratio": _ratio(F.size(F.array_distinct(tokens)), count),
        "capital_ratio": _ratio(X.count_pattern(text, r"\p{Lu}"), chars),
        "digit_ratio": _ratio(X.count_pattern(text, r"\p{Nd}"), chars),
        "whitespace_ratio": _ratio(X.count_pattern(text, f"[{X.SPACE}]"), chars),
    }
    return df.withColumns({prefix + k: v for k, v in columns.items()})


def punctuation_features(df: DataFrame, col: str = "review_text", prefix: str = "punct_") -> DataFrame:
    text = X.text_or_empty(F.col(col))
    ellipsis = F.length(text) - F.length(F.replace(text, F.lit("..."), F.lit("")))
    columns = {
        "exclamation_count": X.count_char(text, "!"),
        "question_count": X.count_char(text, "?"),
        "ellipsis_count": F.floor(ellipsis / 3).cast("int"),
        "comma_count": X.count_char(text, ","),
        "period_count": X.count_char(text, "."),
        "total_punctuation": X.punctuation_count(text),
        "punctuation_diversity": X.punctuation_kinds(text),
    }
    return df.withColumns({prefix + k: v for k, v in columns.items()})


def lexicon_counts(
    df: DataFrame,
    col: str = "cleaned_text",
    positive: Sequence[str] = POSITIVE_CLEANED,
    negative: Sequence[str] = NEGATIVE_CLEANED,
    prefix: str = "",
) -> DataFrame:
    """Whitespace tokens that are sentiment words, and their share of all tokens."""
    tokens = X.words(F.lower(X.text_or_empty(F.col(col))))
    pos, neg = X.count_in(tokens, positive), X.count_in(tokens, negative)
    return df.withColumns(
        {
            f"{prefix}positive_word_count": pos,
            f"{prefix}negative_word_count": neg,
            f"{prefix}sentiment_word_ratio": _ratio(pos + neg, F.size(tokens)),
        }
    )


# Published damping of a negated word in mean polarity; valence of a word of polarity 1.
NEGATED_POLARITY = -0.5
VALENCE_WORD = 1.9


def default_lexicon() -> dict[str, tuple[float, float]]:
    """term -> (polarity, subjectivity), from the word lists."""
    terms = {w: (1.0, 1.0) for w in POSITIVE_RAW + POSITIVE_CLEANED}
    terms.update({w: (-1.0, 1.0) for w in NEGATIVE_RAW + NEGATIVE_CLEANED})
    return terms


_SUMS = ("hits", "polarity_sum", "subjectivity_sum")


def _polarity_totals(polarity: Column, subjectivity: Column, negated: Column, count) -> dict:
    return {
        "hits": count,
        "polarity_sum": polarity * F.when(negated, NEGATED_POLARITY).otherwise(1.0),
        "subjectivity_sum": subjectivity,
    }


def _polarity_columns(get, prefix: str) -> dict[str, Column]:
    return {
        f"{prefix}textblob_polarity": _ratio(get("polarity_sum"), get("hits")),
        f"{prefix}textblob_subjectivity": _ratio(get("subjectivity_sum"), get("hits")),
    }


def _score_tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(rf"[{X.WORD}']+"), 0)


def polarity_totals(text: Column, lexicon: Mapping[str, tuple[float, float]]) -> Column:
    """Sums over the sentiment words of a text, for a lexicon small enough to be part of the plan.

    The text is cut down to its sentiment words and the word before each, so only
    those few are weighed.
    """
    alternatives = "|".join(sorted(lexicon, key=len, reverse=True))
    lowered = F.lower(text)
    edge = rf"(?<![{X.WORD}'])"
    hits = F.regexp_extract_all(
        lowered,
        F.lit(rf"(?:{edge}(?:{'|'.join(NEGATIONS)})[^{X.WORD}']+)?{edge}(?:{alternatives})(?![{X.WORD}'])"),
        0,
    )
    groups: dict[tuple[float, float], list[str]] = {}
    for term, weights in lexicon.items():
        groups.setdefault(weights, []).append(term)

    def weigh(hit: Column, index: int) -> Column:
        word = F.regexp_extract(hit, rf"([{X.WORD}']+)$", 1)
        expr = F.lit(0.0)
        for weights, terms in groups.items():
            expr = F.when(word.isin(terms), weights[index]).otherwise(expr)
        return expr

    def row(hit: Column) -> Column:
        negated = F.rlike(hit, F.lit(rf"^(?:{'|'.join(NEGATIONS)})[^{X.WORD}']"))
        parts = _polarity_totals(weigh(hit, 0), weigh(hit, 1), negated, F.lit(1.0))
        return F.struct(*[v.alias(k) for k, v in parts.items()])

    zero = F.struct(*[F.lit(0.0).alias(n) for n in _SUMS])
    return F.aggregate(
        F.transform(hits, row),
        zero,
        lambda acc, r: F.struct(*[(acc[n] + r[n]).alias(n) for n in _SUMS]),
    )


def _listed_hits(tokens: Column, lexicon: Mapping[str, tuple[float, float]]) -> Column:
    """(pos, v) of the tokens in the lexicon."""
    groups: dict[float, list[str]] = {}
    for term, (polarity, _) in lexicon.items():
        groups.setdefault(polarity * VALENCE_WORD, []).append(term)

    def weigh(w: Column, at: Column) -> Column:
        v = F.lit(None).cast("double")
        for value, terms in groups.items():
            v = F.when(F.lower(w).isin(terms), value).otherwise(v)
        return F.struct(at.alias("pos"), v.alias("v"))

    return F.filter(F.transform(tokens, weigh), lambda x: x["v"].isNotNull())


def row_polarity(
    df: DataFrame, col: str = "review_text",
    lexicon: Mapping[str, tuple[float, float]] | None = None, prefix: str = "sent_", keep=None,
) -> DataFrame:
    """Add the polarity and valence scores of a text column; ``keep`` names those wanted, else all.

    For valence the texts are dealt over tasks by their amount first: it costs much for each character, so a task of a
    large file would take very long.
    """
    if keep is None or any("vader" in k for k in keep):
        df = df.repartition(parts_by_text(df, col))
    return _row_polarity(df, col, lexicon, prefix, keep)


def _row_polarity(df: DataFrame, col: str, lexicon: Mapping[str, tuple[float, float]] | None, prefix: str, keep=None) -> DataFrame:
    text, lexicon = X.text_or_empty(F.col(col)), lexicon or default_lexicon()
    df = df.withColumn("__p", polarity_totals(text, lexicon))
    columns = _polarity_columns(lambda n: F.col(f"__p.{n}"), prefix)
    if keep is None or any("vader" in k for k in keep):
        df = df.withColumn("__w", V.valence_words(text))
        df = df.withColumn("__v", V.valence(text, V.marked_words(F.col("__w")), _listed_hits(F.col("__w"), lexicon)))
        columns |= V.valence_columns(F.col("__v"), prefix)
    wanted = {k: v for k, v in columns.items() if keep is None or k in keep}
    return df.withColumns(wanted).drop("__p", "__w", "__v")


def lexicon_polarity(
    df: DataFrame, lexicon: DataFrame, col: str = "review_text", key: str = "review_id",
    prefix: str = "sent_",
) -> DataFrame:
    """Polarity and valence scores per review from a (term, polarity, subjectivity) table of any size.

    For polarity a word right after a negation counts as negated. Only tokens that the table holds are
    kept, by an inner join, which Spark can split where a frequent word is a hot key. Polarities are summed per task before the
    shuffle; valences come back to the review as (place, valence), where the rules are applied to its text.
    """
    text = X.text_or_empty(F.col(col))
    negated = F.coalesce(F.col("b1").isin(list(NEGATIONS)), F.lit(False))
    exploded = X.neighbours(df, _score_tokens(text), key, before=1).select(
        key, F.col("w0").alias("term"), negated.alias("negated")
    )
    parts = _polarity_totals(F.col("polarity"), F.col("subjectivity"), F.col("negated"), F.lit(1.0))
    sums = (
        exploded.join(lexicon, "term")
        .groupBy(key)
        .agg(*[F.coalesce(F.sum(v), F.lit(0.0)).alias(f"__{k}") for k, v in parts.items()])
    )
    places = df.select(key, F.posexplode(V.valence_words(text)).alias("pos", "w")).select(key, "pos", F.lower("w").alias("term"))
    weighed = places.join(lexicon.where(F.col("polarity").isNotNull()), "term")
    hits = weighed.groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct("pos", (F.col("polarity") * VALENCE_WORD).alias("v")))).alias("__h")
    )
    joined = df.join(sums, key, "left").join(hits, key, "left").na.fill({f"__{k}": 0.0 for k in parts})
    none = F.array().cast("array<struct<pos:int,v:double>>")
    sums = V.valence(text, V.marked_words(V.valence_words(text)), F.coalesce("__h", none))
    columns = _polarity_columns(lambda n: F.col(f"__{n}"), prefix) | V.valence_columns(F.col("__v"), prefix)
    return joined.withColumn("__v", sums).withColumns(columns).drop("__h", "__v", *[f"__{k}" for k in parts])


def readability(
    df: DataFrame, col: str = "review_text", easy_words: Sequence[str] | None = None,
    prefix: str = "read_",
) -> DataFrame:
    """Published readability formulas on words, sentences, letters and syllables.

    Dale-Chall counts the words outside ``easy_words`` as difficult; without the list
    those of three or more syllables. Texts of fewer than five words score 0.
    """
    text = F.lower(X.text_or_empty(F.col(col)))
    tokens = F.regexp_extract_all(text, F.lit(rf"[{X.WORD}']+"), 0)
    ends = X.count_char(text, ".") + X.count_char(text, "!") + X.count_char(text, "?")
    base = {
        "__w": F.size(tokens).cast("double"),
        "__ws": F.size(X.words(text)),
        "__s": F.greatest(F.lit(1), ends).cast("double"),
        "__l": X.count_pattern(text, rf"[{X.WORD}]").cast("double"),
        "__syl": F.transform(tokens, X.syllables),
        "__hard": (
            F.lit(None).cast("double")
            if easy_words is None
            else F.size(F.filter(tokens, lambda w: ~w.isin(list(easy_words)))).cast("double")
        ),
    }
    staged = df.withColumns(base).withColumns(
        {
            "__y": F.aggregate("__syl", F.lit(0), lambda a, x: a + x).cast("double"),
            "__p": F.size(F.filter("__syl", lambda x: x >= 3)).cast("double"),
        }
    )
    w, s, l, y, p = (F.col(c) for c in ("__w", "__s", "__l", "__y", "__p"))
    hard = F.coalesce("__hard", p)
    linsear = ((w - p) + p * 3) / s
    scores = {
        "flesch_reading_ease": 206.835 - 1.015 * w / s - 84.6 * y / w,
        "flesch_kincaid_grade": 0.39 * w / s + 11.8 * y / w - 15.59,
        "gunning_fog": 0.4 * (w / s + 100 * p / w),
        "automated_readability_index": 4.71 * l / w + 0.5 * w / s - 21.43,
        "coleman_liau_index": 5.88 * l / w - 29.6 * s / w - 15.8,
        "linsear_write_formula": F.when(linsear > 20, linsear / 2).otherwise((linsear - 2) / 2),
        "dale_chall_readability": 15.79 * hard / w
        + 0.0496 * w / s
        + F.when(hard / w > 0.05, 3.6365).otherwise(0.0),
    }
    grades = [k for k in scores if k != "flesch_reading_ease"]
    enough = F.col("__ws") >= 5
    guarded = {
        prefix + k: F.when(enough & (w > 0), v).otherwise(0.0) for k, v in scores.items()
    }
    mean = reduce(lambda a, b: a + b, [F.col(prefix + g) for g in grades]) / len(grades)
    return (
        staged.withColumns(guarded)
        .withColumn(f"{prefix}text_standard", F.bround(mean, 0))
        .drop(*base, "__y", "__p")
    )


def special_patterns(df: DataFrame, col: str = "review_text", prefix: str = "pattern_") -> DataFrame:
    text = X.text_or_empty(F.col(col))
    caps = F.filter(
        X.words(text),
        lambda w: (F.length(w) > 1)
        & F.rlike(w, F.lit(r"\p{Lu}"))
        & ~F.rlike(w, F.lit(r"\p{Ll}")),
    )
    columns = {
        "url_count": X.count_pattern(text, X.URL),
        "email_count": X.count_pattern(text, rf"(?<![^{X.SPACE}]){X.EMAIL}"),
        "hashtag_count": X.count_pattern(text, X.HASHTAG),
        "mention_count": X.count_pattern(text, X.MENTION),
        "emoji_count": X.count_pattern(text, X.EMOJI),
        "repeated_char_count": X.count_pattern(text, X.REPEATED),
        "all_caps_word_count": F.size(caps),
    }
    return df.withColumns({prefix + k: v for k, v in columns.items()})


def temporal_features(df: DataFrame, date_col: str = "review_date", prefix: str = "temp_") -> DataFrame:
    ts = F.col(date_col)
    # What a missing date counts as.
    columns = {
        "review_hour": (F.hour(ts.cast("timestamp_ntz")), 12),
        "review_dayofweek": (F.weekday(ts), 3),
        "review_day": (F.day(ts), 15),
        "review_month": (F.month(ts), 6),
        "is_weekend": (D.is_weekend(ts), 0),
        "is_holiday_season": (D.is_holiday_season(ts), 0),
        "days_since_epoch": (D.days_since_2020(ts), 0),
    }
    return df.withColumns(
        {prefix + k: F.coalesce(v, F.lit(default)) for k, (v, default) in columns.items()}
    )


def review_quality_score(df: DataFrame) -> DataFrame:
    score = (
        F.col("text_word_count") * 0.3
        + F.col("text_unique_word_ratio") * 50
        + F.col("sent_textblob_subjectivity") * 20
        + (1 - F.col("text_capital_ratio")) * 30
    ) / 100
    return df.withColumn("review_quality_score", score)


def engagement_potential(df: DataFrame) -> DataFrame:
    helpful = F.col("helpful_count") if "helpful_count" in df.columns else F.lit(0)
    return df.withColumn(
        "engagement_potential",
        F.col("punct_exclamation_count") * 2
        + F.col("punct_question_count") * 3
        + F.col("pattern_emoji_count") * 2
        + helpful * 0.5,
    )


def all_features(df: DataFrame, col: str = "review_text") -> DataFrame:
    """The wide feature table. Texts are dealt over tasks by their amount once; the rest is one projection."""
    df = df.repartition(parts_by_text(df, col))
    df = punctuation_features(text_stats(df, col), col)
    df = _row_polarity(df, col, None, "sent_")
    df = lexicon_counts(df, col, POSITIVE_RAW, NEGATIVE_RAW, "sent_")
    df = special_patterns(readability(df, col), col)
    if "review_date" in df.columns:
        df = temporal_features(df)
    label = F.col("predicted_sentiment") if "predicted_sentiment" in df.columns else F.lit("")
    df = df.withColumn("rating_sentiment_aligned", L.aligned(F.col("rating"), label).cast("int"))
    return engagement_potential(review_quality_score(df))


def ngrams(df: DataFrame, col: str = "cleaned_text", lo: int = 1, hi: int = 3, stop_words=()) -> DataFrame:
    """One row per n-gram of each review."""
    grams = X.with_grams(df.select("review_id", col), col, lo, hi, stop_words)
    return X.exploded(grams, F.col("grams"), "review_id")


def processed_features(df: DataFrame) -> DataFrame:
    """The columns of the processed stage, from raw and cleaned text."""
    raw = F.col("review_text")
    tokens = X.words(X.text_or_empty(raw))
    count = F.size(tokens)
    letters = F.length(F.regexp_replace(X.text_or_empty(raw), f"[{X.SPACE}]+", ""))
    scores = ("textblob_polarity", "textblob_subjectivity")
    cleaned = X.words(F.lower(F.col("cleaned_text")))
    df = row_polarity(df, prefix="", keep=scores)
    return df.withColumns(
        {
            "char_count": F.length(raw),
            "word_count": F.when(raw.isNotNull(), count),
            "avg_word_length": _ratio(letters, count),
            "exclamation_count": X.count_char(raw, "!"),
            "question_count": X.count_char(raw, "?"),
            "caps_ratio": _ratio(
                X.count_pattern(X.text_or_empty(raw), r"\p{Lu}"),
                F.greatest(F.length(X.text_or_empty(raw)), F.lit(1)),
            ),
            "positive_word_count": X.count_in(cleaned, POSITIVE_CLEANED),
            "negative_word_count": X.count_in(cleaned, NEGATIVE_CLEANED),
            "review_hour": F.hour(F.col("review_date").cast("timestamp_ntz")),
            "review_dayofweek": F.weekday("review_date"),
            "review_month": F.month("review_date"),
            "is_weekend": D.is_weekend(F.col("review_date")),
        }
    )


def preprocess(df: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """Raw to processed stage: clean, mark negations, drop stop words, lemmatize, describe, filter."""
    cleaned = X.singularize(
        X.remove_stopwords(X.handle_negations(X.clean_text(F.col("review_text"))))
    )
    df = processed_features(df.withColumn("cleaned_text", cleaned))
    return length_filter(df, cfg.min_words, cfg.max_words)


def format_kpi(value: Column, style: str) -> Column:
    """A KPI as text. Ties round to even, as the usual format strings do."""
    if style == "percent":
        return F.format_string("%.1f%%", F.bround(value.cast("double"), 1))
    if style == "dollars":
        return F.concat(F.lit("$"), F.format_number(F.bround(value.cast("double"), 0), 0))
    if style == "thousands":
        return F.format_number(value, 0)
    if style == "stars":
        return F.repeat(F.lit("⭐"), value.cast("int"))
    if style == "upper":
        return F.upper(value)
    if style == "date":
        return F.date_format(value, "yyyy-MM-dd")
    raise ValueError(f"unknown style {style}")


def review_titles(df: DataFrame) -> DataFrame:
    """The heading of each review: stars, product, sentiment and confidence."""
    return df.select(
        "review_id",
        F.concat_ws(
            " | ",
            format_kpi(F.col("rating"), "stars"),
            F.col("product_name"),
            F.format_string(
                "%s (%.0f%% confidence)",
                F.upper("predicted_sentiment"),
                F.bround(F.col("confidence_score") * 100, 0),
            ),
        ).alias("title"),
        format_kpi(F.col("review_date"), "date").alias("day"),
    )


def json_props(df: DataFrame, col: str = "props", field: str = "k") -> DataFrame:
    """Decode a JSON column, read one field, and encode it again."""
    parsed = F.from_json(F.col(col), f"{field} bigint")
    return df.withColumns({field: parsed[field], "encoded": F.to_json(parsed)})
