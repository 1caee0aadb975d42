"""The pipeline, stage by stage, against plain versions."""

import sys
from pathlib import Path

import pytest
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).parent))

import corpus_pipeline  # noqa: E402
from test_near_duplicates import brute_kept  # noqa: E402
from test_other_operators import brute_contamination, brute_quality, brute_secrets, check_packing  # noqa: E402

from reviewloom.llm import near_duplicates, quality  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_names_and_order():
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "near-duplicates", "benchmark decontamination", "secret scans", "packing"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Every stage's input and output, written and read again as a driver does."""
    root = tmp_path_factory.mktemp("pipeline")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{root}/{k}")
        docs = spark.read.parquet(f"{root}/{k}")
        out.append(docs)
    return out


def rows(df):
    return sorted((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())


def test_stages(spark, stages):
    raw, good, single, clean, masked, packed = stages
    for df in (good, single, clean, masked):
        assert df.columns == raw.columns
    verdict = {r.doc_id: r for r in quality.digest(raw).collect()}
    assert rows(good) == [(d, t) for d, t in rows(raw) if verdict[d].kept]
    assert all(verdict[d].base_failed == brute_quality(t)[-1] for d, t in rows(raw))

    assert rows(single) == sorted(brute_kept(rows(good), near_duplicates.idf_table(good)).elements())

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    bad = {d for d, n, hit, _ in brute_contamination(rows(single), items) if hit and 20 * hit >= n}
    assert bad and rows(clean) == [(d, t) for d, t in rows(single) if d not in bad]

    before, after = dict(rows(clean)), dict(rows(masked))
    assert before.keys() == after.keys()
    for d, t in before.items():
        assert brute_secrets(after[d]) == "" and (brute_secrets(t) == "") == (after[d] == t)

    import public_tokenizers

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    check_packing(packed.collect(), rows(masked), tokenizer, 2048)


def test_run_equals_the_stages(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == stages[-1].columns and got.count() == stages[-1].count()


def test_odd_rows_and_empty_tables(spark, odd, none):
    for docs in (odd, none):
        for name, stage in corpus_pipeline.STAGES:
            result = stage(spark, docs, SF)
            if name == "packing":
                assert (result.count() == 0) == (docs.count() == 0)
            else:
                assert result.columns == docs.columns and result.count() <= docs.count()
