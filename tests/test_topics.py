import random
from collections import Counter

from reviewloom.operators import joins, topics
from reviewloom.operators.ml import ensemble_vote
from reviewloom.sources.writers import write_stage


def make(spark, n_topics):
    rng = random.Random(n_topics)
    letters = "abcdeé "
    names = {"".join(rng.choice(letters) for _ in range(rng.randrange(1, 6))) for _ in range(3 * n_topics)}
    names = sorted(x for x in names if x.strip())[: n_topics - 1] + ["AB"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(0, 60))) for _ in range(60)]
    rows = list(enumerate([*texts, texts[0], "", None, "ab", "AB"]))
    docs = spark.createDataFrame(rows, "review_id long, cleaned_text string")
    table = spark.createDataFrame([(x,) for x in [*names, "", None, names[0]]], "topic string")
    return rows, names, docs, table


def test_any_number_of_topics(spark):
    for n in (1, 7, 1500):
        rows, names, docs, table = make(spark, n)
        want = Counter((k, t) for k, x in rows for t in names if t.lower() in (x or "").lower())
        got = joins.topic_mentions(docs, table)
        assert got.columns == ["review_id", "cleaned_text", "topic"]
        assert Counter((r.review_id, r.topic) for r in got.collect()) == want


def test_a_list_gives_the_same_as_a_table(spark):
    _, names, docs, table = make(spark, 40)
    listed = joins.topic_mentions(docs, names).select("review_id", "topic")
    joined = joins.topic_mentions(docs, table).select("review_id", "topic")
    assert listed.exceptAll(joined).count() == 0 == joined.exceptAll(listed).count()


def test_cooccurrence_counts_reviews(spark):
    rows, names, docs, table = make(spark, 25)
    together = Counter()
    for _, x in rows:
        found = [t for t in names if t.lower() in (x or "").lower()]
        together.update((a, b) for a in found for b in found)
    got = {(r.topic_a, r.topic_b): r.together for r in topics.topic_cooccurrence(docs, table).collect()}
    assert got == dict(together)


def test_soft_vote(spark):
    rows = [(1, "a", "x", 0.5), (1, "a", "y", 0.5), (1, "b", "y", 0.9), (2, "a", "x", 0.5), (3, "c", "x", 1.0)]
    scores = spark.createDataFrame(rows, "review_id long, model string, label string, probability double")
    got = {r.review_id: r for r in ensemble_vote(scores, {"a": 0.2, "b": 0.6}).collect()}
    assert set(got) == {1, 2}
    assert got[1].label == "y" and abs(got[1].probability - (0.2 * 0.5 + 0.6 * 0.9) / 0.8) < 1e-9 and got[1].disagreement
    assert got[2].label == "x" and got[2].probability == 0.5 and not got[2].disagreement
    # A model that leaves the winner out gives it 0.
    only = spark.createDataFrame([(1, "a", "x", 1.0), (1, "b", "y", 0.2)], scores.schema)
    row = ensemble_vote(only, {"a": 0.5, "b": 0.5}).first()
    assert (row.label, row.probability, row.disagreement) == ("x", 0.5, True)


def test_stage_has_few_files(spark, tmp_path):
    df = spark.range(1000).selectExpr("id", "id % 3 AS category").repartition(8)
    write_stage(df, str(tmp_path / "stage"))
    assert len(list(tmp_path.glob("stage/*/*.parquet"))) <= 6
    assert spark.read.parquet(str(tmp_path / "stage")).count() == 1000


def test_terms_of_clusters_are_counted_in_parts_by_text(spark, monkeypatch):
    rows = [(i, i % 3, f"aa{i % 3} bb{i} cc") for i in range(240)]
    df = spark.createDataFrame(rows, "review_id long, cluster int, cleaned_text string")
    plain = sorted(map(str, topics.cluster_words(df, 50, 3).collect()))
    monkeypatch.setattr(topics, "parts_by_text", lambda *_: 37)
    dealt = topics.cluster_words(df, 50, 3)
    # Rows by term are one exchange, which Spark uses for the sums and for the join.
    assert "hashpartitioning(term" in (plan := dealt._jdf.queryExecution().executedPlan().toString()) and ", 37)" in plan
    assert "hashpartitioning(cluster" not in plan  # a cluster's terms are not in one task
    assert sorted(map(str, dealt.collect())) == plain
