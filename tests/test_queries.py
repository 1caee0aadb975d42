import pytest
from compare import compare, connect
from sessions import SF

from reviewloom.catalog import ORACLES, QUERIES

# The whole flow with two models and all trees: run through tests/compare.py.
SLOW = {"pipeline_predictions"}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("key", [k for k in ORACLES if k not in SLOW])
def test_query_matches_sql(spark, con, key):
    assert compare(QUERIES[key](spark, SF), con, ORACLES[key]) is None


def test_filters_reach_the_scan(spark):
    df = QUERIES["urgent_reviews"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "l_extendedprice" not in plan


def test_one_text_shuffle_for_keywords(spark):
    from reviewloom.catalog.base import Views
    from reviewloom.operators.keywords import corpus_keywords

    df = corpus_keywords(Views(spark, SF).cleaned)
    df.collect()
    assert "ReusedExchange" in df._jdf.queryExecution().executedPlan().toString()


def test_tfidf_rows_have_unit_norm(spark):
    rows = QUERIES["tfidf_vectorize"](spark, SF).collect()
    assert rows and all(abs(r.norm - 1) < 1e-9 or r.norm == 0 for r in rows)


def test_saved_model_predicts_alike(spark):
    assert all(r.same for r in QUERIES["save_load_model"](spark, SF).collect())
