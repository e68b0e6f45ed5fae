"""The stages against plain versions, each on what its predecessor kept."""

from collections import defaultdict

import corpus_pipeline
import pytest

from tarnbeck.llm import toxicity

from .test_exact_dedup import brute as exact
from .test_ngram_join import brute as near


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stage(spark, out[-1], sf_dir).persist())
    return out


def test_columns(stages):
    assert all(s.columns == stages[0].columns for s in stages[:-1])


def test_toxic_go_and_clean_stay(spark, sf_dir, stages):
    machine = toxicity.train(stages[0], spark.read.parquet(f"{sf_dir}/labels.parquet"))
    bad = {r["doc_id"] for r in toxicity.score(stages[0], machine).where("predicted = 1").collect()}
    assert {r["doc_id"] for r in stages[1].collect()} == {r["doc_id"] for r in stages[0].collect()} - bad


def test_exact_copies_go(stages):
    rows = [(r["doc_id"], r["text"]) for r in stages[1].collect()]
    assert {r["doc_id"] for r in stages[2].collect()} == {b[2] for b, _ in exact(rows).values()}


def test_near_copies_go(stages):
    rows = [(r["doc_id"], r["text"]) for r in stages[2].collect()]
    kept = {i for i, _, c in near(rows) if i == c}
    assert {str(r["doc_id"]) for r in stages[3].collect()} == kept


def test_all_the_rest_is_packed(stages):
    by = defaultdict(int)
    for r in stages[4].collect():
        by[r["doc_id"]] += r["length"]
    assert set(by) == {r["doc_id"] for r in stages[3].collect()} and min(by.values()) >= 1


def test_run(spark, sf_dir, stages):
    key = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert sorted(tuple(r[k] for k in key) for r in corpus_pipeline.run(spark, sf_dir).collect()) == sorted(tuple(r[k] for k in key) for r in stages[4].collect())


def test_edge_documents(spark, edge_docs, no_docs, sf_dir):
    for docs in (edge_docs, no_docs):
        own = docs
        for _, stage in corpus_pipeline.STAGES:
            own = stage(spark, own, sf_dir)
        assert own.count() >= 0
