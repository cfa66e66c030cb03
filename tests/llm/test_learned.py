"""Weak labels, quality and toxicity: what is planted is found, on rows not learned from."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gradeline.llm import linear, quality, toxicity, weak

SF = "/root/testdata/sf0.1"  # the smaller tables label a few dozen toxic documents only


@pytest.fixture(scope="module")
def labelled(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return docs, spark.read.parquet(f"{SF}/labels.parquet")


def test_votes_recover_labellers():
    make = np.random.default_rng(0)
    truth = make.random(5000) < 0.8
    votes = np.zeros((5000, 3), dtype=np.int64)
    for i, (right, wrong) in enumerate([(0.9, 0.005), (0.6, 0.005), (0.5, 0.02)]):
        votes[:, i] = -1 * (make.random(5000) < np.where(truth, wrong, right))
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = weak.fit_votes(patterns, counts.astype(float))
    assert ((model.posterior(votes) >= 0.5) == truth).mean() > 0.85
    assert model.accuracies()[0] > model.accuracies()[2]
    assert len(weak.fit_votes(np.zeros((0, 3), dtype=np.int64), np.zeros(0)).posterior(votes)) == 5000


def test_quality_keeps_the_clean_and_drops_junk(labelled):
    docs, labels = labelled
    scored = quality.score_quality(docs, quality.fit_quality(docs), keep=["doc_id"])
    rows = scored.join(labels, "doc_id").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1]
    bad = [r["kept"] for r in rows if r["quality"] == 0]
    assert np.mean(good) >= 0.98 and np.mean(bad) <= 0.15


def test_toxicity_on_held_out_documents(labelled):
    docs, labels = labelled
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = toxicity.fit_toxicity(docs, labels, allowed=~held)
    rows = toxicity.score_toxicity(docs, model).join(labels.withColumnRenamed("toxic", "label"), "doc_id").filter(held).collect()
    toxic = np.array([r["score"] for r in rows if r["label"] == 1])
    clean = np.array([r["score"] for r in rows if r["label"] == 0])
    assert (toxic[:, None] > clean[None, :]).mean() >= 0.85
    for row in rows:
        assert (row["score"] >= toxicity.THRESHOLD) == row["toxic"]
        assert all(0 <= s < e <= len(row["text"]) for s, e in zip(row["sentence_starts"], row["sentence_ends"]))


def test_offending_sentences_are_located(spark):
    plain = ["the sun is warm", "we walk home", "bread and salt", "rain falls again"]
    rows = [(i, ". ".join(plain[i % 4 :] + (["you vile oaf"] if i % 2 else []) + plain[: i % 4])) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(None, 1), (5, None)], "doc_id long, toxic int")
    model = toxicity.fit_toxicity(docs, labels)
    for row in toxicity.score_toxicity(docs, model).filter("doc_id >= 200").collect():
        found = [row["text"][s:e].strip() for s, e in zip(row["sentence_starts"], row["sentence_ends"])]
        assert found == (["you vile oaf"] if row["doc_id"] % 2 else [])


def test_a_repeated_id_counts_once_in_the_sample(spark, monkeypatch):
    rows = [(i, f"word{i % 7} rain falls. we walk home" + (". you vile oaf" if i % 2 else "")) for i in range(60)]
    often = [(3, "you vile oaf. bread and salt")] * 300 + [(4, "bread and salt"), (4, "bread and pepper")] * 150
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    added = []
    add = linear.Bags.add
    monkeypatch.setattr(linear.Bags, "add", lambda self, number, *rest: (added.append(number), add(self, number, *rest))[1])
    frames = [spark.createDataFrame(x, "doc_id long, text string").repartition(n) for x, n in ((rows + often, 5), (often + rows, 2))]
    models = [toxicity.fit_toxicity(docs, labels) for docs in frames]
    assert sorted(added) == sorted([*range(60), *range(60)])
    assert np.array_equal(models[0].weights, models[1].weights) and models[0].bias == models[1].bias
    monkeypatch.setattr(linear, "_pieces", lambda sizes, pieces=linear._pieces: pieces(sizes, 10))
    small = toxicity.fit_toxicity(frames[0], labels)
    assert np.allclose(small.weights, models[0].weights) and np.isclose(small.bias, models[0].bias)


def test_odd_and_empty(odd_docs, no_docs, spark):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit_toxicity(odd_docs, labels)
    scored = toxicity.score_toxicity(odd_docs, model).collect()
    assert len(scored) == odd_docs.count() and all(0 <= r["score"] < 0.01 for r in scored)
    assert quality.score_quality(odd_docs, quality.fit_quality(odd_docs)).count() == odd_docs.count()
    assert quality.score_quality(no_docs, quality.fit_quality(no_docs)).count() == 0


def test_pipeline_stages_keep_the_columns_and_take_effect(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, "/root/testdata/sf0.001").cache()
        assert after.columns == docs.columns, name
        assert 0 < after.count() <= before.count()
        assert after.select("doc_id").distinct().count() == after.count()
        before = after
    final = corpus_pipeline.STAGES[-1][1](spark, before, "/root/testdata/sf0.001")
    texts = {r["doc_id"]: r["s"] for r in before.select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("s")).collect()}
    assert {r["doc_id"]: r["decoded_sha256"] for r in final.collect()} == texts
