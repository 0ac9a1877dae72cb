"""Queries against their SQL, and the pipeline's stages, on the smallest tables."""

import hashlib

import pytest

import corpus_pipeline
from claimtide.llm import queries
from claimtide.plans import check
from claimtide.plans.catalog import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_same_rows(spark, name, monkeypatch):
    monkeypatch.setitem(QUERIES, name, queries.QUERIES[name])
    monkeypatch.setitem(ORACLES, name, queries.ORACLES[name])
    assert check.compare(spark, check.connect(FOLDER), name, FOLDER)["problems"] == []


def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, FOLDER)
        assert after.columns == docs.columns and after.count() > 0
        before = after
    texts = sorted(hashlib.sha256(r.text.encode()).hexdigest() for r in before.collect())
    assert sorted(r.decoded_sha256 for r in corpus_pipeline.run(spark, FOLDER).collect()) == texts


def test_pipeline_takes_out_near_copies_of_081(spark):
    """Pairs that share 400 of 494 shingles, 0.81, and pairs that share 400 of 512, 0.78."""
    rows = []
    for i in range(40):
        own = 47 if i < 20 else 56
        text = [f"p{i // 2}x{j}" for j in range(404)] + [f"d{i}x{j}" for j in range(own)]
        rows.append((i, " ".join(text), "en", "s", 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    left = dict(corpus_pipeline.STAGES)["near copies"](spark, docs, FOLDER)
    assert sorted(r.doc_id for r in left.collect()) == [*range(0, 20, 2), *range(20, 40)]
