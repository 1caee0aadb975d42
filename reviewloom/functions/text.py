"""Text as column expressions: every function takes and returns a Column.

All of it stays inside the JVM and is linear in the length of the text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .wordlists import (
    CONTRACTIONS,
    ENGLISH_STOP_WORDS,
    KEPT_STOP_WORDS,
    NEGATIONS,
    PUNCTUATION,
)

# Character classes spelt out so that Java and RE2 agree on them.
SPACE = r"\t-\r\x1c-\x20\x85\p{Z}"
WORD = r"\p{L}\p{N}_"

# The patterns removed from or counted in a review.
URL = rf"https?://[^{SPACE}]+|www\.[^{SPACE}]+"
EMAIL = rf"[^{SPACE}]+@[^{SPACE}]+"
PHONE = r"\b\d{3}[-.]?\d{3}[-.]?\d{4}\b"
SPECIAL = r"[^a-zA-Z0-9\s'\-.,!?]"
# The same characters as SPECIAL, listed: Java finds those of a positive class several times faster than those of a negated one.
_SPECIAL_LISTED = r"[\x00-\x08\x0e-\x1f\"#$%&()*+/:;<=>@\[\\\]^_`{|}~\x7f-\x{10ffff}]"
HASHTAG = rf"#[{WORD}]+"
MENTION = rf"@[{WORD}]+"
EMOJI = r"[\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}\x{1F1E0}-\x{1F1FF}]+"
REPEATED = r"(.)\1{2,}"
GRAM_TOKEN = rf"[{WORD}]{{2,}}"

_NEGATION = "(?:" + "|".join(NEGATIONS) + r")(?![^\s])"
_MARK = "\ue000"
CLEAN_STOP_WORDS = tuple(w for w in ENGLISH_STOP_WORDS if w not in KEPT_STOP_WORDS)


def bind(value: Column, use) -> Column:
    """``use(value)`` with the value computed once for a row.

    Inside a lambda a plain expression would be computed for every element.
    """
    return F.element_at(F.transform(F.array(value), use), 1)


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def squeeze(text: Column) -> Column:
    """Collapse every whitespace run to one space and trim."""
    return F.trim(F.regexp_replace(text, f"[{SPACE}]+", " "))


def words(text: Column) -> Column:
    """Whitespace tokens; an empty text has none."""
    flat = squeeze(text)
    return F.when(flat == "", F.array().cast("array<string>")).otherwise(F.split(flat, " "))


def expand_contractions(text: Column) -> Column:
    lowered = F.lower(text)
    expanded = reduce(
        lambda acc, pair: F.replace(acc, F.lit(pair[0]), F.lit(pair[1])),
        CONTRACTIONS.items(),
        lowered,
    )
    # Every contraction holds an apostrophe, so most texts skip the replacements.
    return F.when(F.contains(lowered, F.lit("'")), expanded).otherwise(lowered)


def strip_urls(text: Column) -> Column:
    return F.regexp_replace(text, URL, " ")


def strip_emails(text: Column) -> Column:
    # A match always covers its whole token, so only token starts need to be tried.
    return F.regexp_replace(text, rf"(?<![^{SPACE}]){EMAIL}", " ")


def strip_phones(text: Column) -> Column:
    return F.regexp_replace(text, PHONE, " ")


def strip_special(text: Column) -> Column:
    return F.regexp_replace(text, _SPECIAL_LISTED, " ")


def clean_text(text: Column) -> Column:
    text = text_or_empty(text)
    bare = strip_urls(expand_contractions(text))
    # Most texts have no address; nothing done before this puts an @ into one.
    bare = F.when(F.contains(text, F.lit("@")), strip_emails(bare)).otherwise(bare)
    return F.lower(squeeze(strip_special(strip_phones(bare))))


def handle_negations(text: Column) -> Column:
    """Suffix ``_NOT`` to the words in the scope of a negation.

    The scope runs from a negation word to the next token with punctuation in it.
    ``\\G`` continues a match where the last one stopped, so one pass marks the
    negation words and all they cover; a second one unmarks the negation words.
    """
    covered = rf"((?<![^\s]){_NEGATION}|(?!^)\G [^\s.,!?;:]+(?![^\s]))"
    marked = F.regexp_replace(squeeze(text), covered, f"$1{_MARK}")
    unmarked = F.regexp_replace(
        marked, rf"(?<![^\s])((?:{'|'.join(NEGATIONS)})){_MARK}", "$1"
    )
    return F.replace(unmarked, F.lit(_MARK), F.lit("_NOT"))


def word_and_mark_tokens(text: Column) -> Column:
    """Words and single punctuation marks, in order."""
    return F.regexp_extract_all(text, F.lit(rf"[{WORD}]+|[^{WORD}{SPACE}]"), 0)


def remove_stopwords(text: Column, stop_words=CLEAN_STOP_WORDS) -> Column:
    kept = F.filter(
        word_and_mark_tokens(text),
        lambda w: ~F.lower(w).isin(list(stop_words)) | F.contains(w, F.lit("_NOT")),
    )
    return F.array_join(kept, " ")


def singularize(text: Column) -> Column:
    """Regular plural rules; irregular nouns need a lemma table."""
    text = F.regexp_replace(text, r"\b([a-z]{2,})ies\b", "$1y")
    return F.regexp_replace(
        text, r"\b(?:([a-z]+(?:s|x|ch|sh))es|([a-z]+[a-hj-rtv-z])s)\b", "$1$2"
    )


def count_char(text: Column, char: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


def count_pattern(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def punctuation_count(text: Column) -> Column:
    return F.length(text) - F.length(F.translate(text, PUNCTUATION, ""))


def punctuation_kinds(text: Column) -> Column:
    """Distinct punctuation characters: one containment test for each of the 32."""
    return reduce(
        lambda acc, char: acc + F.contains(text, F.lit(char)).cast("int"),
        PUNCTUATION,
        F.lit(0),
    )


def count_in(tokens: Column, vocabulary) -> Column:
    return F.size(F.filter(tokens, lambda w: w.isin(list(vocabulary))))


def gram_tokens(text: Column, stop_words=()) -> Column:
    """Lower-cased words of two or more characters, stop words dropped."""
    tokens = F.regexp_extract_all(F.lower(text_or_empty(text)), F.lit(GRAM_TOKEN), 0)
    if stop_words:
        tokens = F.filter(tokens, lambda w: ~w.isin(list(stop_words)))
    return tokens


def ngrams(tokens: Column, lo: int = 1, hi: int = 3) -> Column:
    """All n-grams of lo..hi tokens, joined by one space.

    Shifted slices are zipped, so the work is linear in the number of tokens even
    where the optimizer puts the token expression in place of its column.
    """

    def of(n: int) -> Column:
        count = F.greatest(F.size(tokens) - (n - 1), F.lit(0))
        grams = F.slice(tokens, 1, count) if n > 1 else tokens
        for start in range(2, n + 1):
            grams = F.zip_with(
                grams, F.slice(tokens, start, count), lambda a, b: F.concat_ws(" ", a, b)
            )
        return grams

    return F.concat(*[of(n) for n in range(lo, hi + 1)]) if hi > lo else of(lo)


def exploded(df: DataFrame, array: Column, *keep: str, out: str = "term") -> DataFrame:
    """One row per element of an array of non-null values.

    For a plain ``explode`` the optimizer adds a filter on the array's size, pushes
    it below the projections and so computes the array twice; the outer form is
    exempt, and its row for an empty array is dropped here.
    """
    return df.select(*keep, F.explode_outer(array).alias(out)).where(F.col(out).isNotNull())


def neighbours(
    df: DataFrame, tokens: Column, *keep: str, before: int = 0, after: int = 0
) -> DataFrame:
    """One row per token, ``w0``, with the tokens around it as ``b1``.. and ``a1``..

    Shifted copies of the token array are zipped and exploded together, so a row
    carries a few words and never the whole array.
    """
    none = F.lit(None).cast("string")
    shifted = {"w0": F.col("__tokens")}
    for i in range(1, before + 1):
        shifted[f"b{i}"] = F.concat(F.array(*[none] * i), F.col("__tokens"))
    for i in range(1, after + 1):
        shifted[f"a{i}"] = F.slice("__tokens", i + 1, F.greatest(F.size("__tokens"), F.lit(1)))
    staged = df.select(*keep, tokens.alias("__tokens")).select(
        *keep, *[v.alias(k) for k, v in shifted.items()]
    )
    rows = staged.select(*keep, F.posexplode_outer(F.arrays_zip(*shifted)).alias("pos", "__z"))
    return rows.where(F.col("__z.w0").isNotNull()).select(*keep, "pos", "__z.*")


def with_grams(
    df: DataFrame, text_col: str, lo: int = 1, hi: int = 3, stop_words=(), out: str = "grams"
) -> DataFrame:
    """Add the n-grams of a text column, its tokens computed once."""
    tokens = df.withColumn("__tokens", gram_tokens(F.col(text_col), stop_words))
    return tokens.withColumn(out, ngrams(F.col("__tokens"), lo, hi)).drop("__tokens")


def syllables(word: Column) -> Column:
    """Vowel groups less a silent final e, at least one."""
    groups = F.regexp_count(word, F.lit("[aeiouy]+"))
    silent = F.regexp_count(word, F.lit("[^aeiouy]e$"))
    return F.greatest(groups - silent, F.lit(1))
