"""Noun lemmas against a version with loops."""

import pytest

from reviewloom.operators import text as H

BASE = {"cat", "bus", "box", "wolf", "church", "man", "woman", "city", "mouse", "news", "axis", "ax", "axe", "s", "glass", "men", "dish", "quiz", "leave", "leaf", "dog"}
EXCEPTIONS = {"mice": ["mouse"], "axes": ["ax", "axis"], "geese": ["goose"], "men": ["man"], "leaves": ["leaf", "leave"]}
FORMS = [
    "cats", "cat", "buses", "boxes", "wolves", "churches", "women", "men", "cities", "mice", "news", "axes", "geese", "glasses", "glass", "dishes", "quizzes",
    "leaves", "dogss", "dogsss", "catses", "xyz", "xyzs", "s", "ss", "sss", "", "ies", "manmen", "é", "buss", "churchess", "ses", "quizes",
]


def plain_lemma(form, base=BASE, exceptions=EXCEPTIONS):
    def cut(forms):
        return list(dict.fromkeys(f[: len(f) - len(old)] + new for f in forms for old, new in H.NOUN_ENDINGS if f.endswith(old)))

    if form in exceptions:
        known = [f for f in [form, *sorted(exceptions[form])] if f in base]
        return min(known, key=len) if known else form
    forms = cut([form])
    known = [f for f in [form, *forms] if f in base]
    while forms and not known:
        forms = cut(forms)
        known = sorted(f for f in forms if f in base)
    return min(known, key=len) if known else form


@pytest.fixture(scope="module")
def tables(spark):
    base = spark.createDataFrame([(b,) for b in BASE] + [(None,), ("cat",)], "form string")
    exceptions = spark.createDataFrame([(f, x) for f, known in EXCEPTIONS.items() for x in known], "form string, lemma string")
    return base, exceptions


def test_forms(spark, tables):
    forms = spark.createDataFrame([(f,) for f in dict.fromkeys(FORMS)], "form string")
    got = {r.form: r.lemma for r in H.noun_lemmas(forms, *tables).collect()}
    for form in FORMS:
        assert got.get(form, form) == plain_lemma(form), form
    assert got["dogsss"] == "dog" and got["axes"] == "ax" and got["men"] == "men" and got["women"] == "woman"
    rules = {r.form: r.lemma for r in H.noun_lemmas(forms, tables[0]).collect()}
    assert all(rules.get(f, f) == plain_lemma(f, exceptions={}) for f in FORMS)


def test_texts(spark, tables):
    texts = ["the cats, wolves", "mice mice mice", "", None, "geese - xyzs", "cats " * 3000]
    df = spark.createDataFrame(list(enumerate(texts)), "review_id long, cleaned_text string")
    got = {r.review_id: r.cleaned_text for r in H.lemmatize(df, base_forms=tables[0], lemma_table=tables[1]).collect()}
    assert got == {0: "the cat , wolf", 1: "mouse mouse mouse", 2: "", 3: "", 4: "geese - xyzs", 5: " ".join(["cat"] * 3000)}


def test_each_form_is_looked_up_once(spark, tables, monkeypatch):
    seen = []
    original = H.noun_lemmas
    monkeypatch.setattr(H, "noun_lemmas", lambda forms, *rest: seen.append(forms.count()) or original(forms, *rest))
    df = spark.createDataFrame([(k, "cats dogs cats") for k in range(50)], "review_id long, cleaned_text string")
    H.lemmatize(df, base_forms=tables[0]).collect()
    assert seen == [2]
