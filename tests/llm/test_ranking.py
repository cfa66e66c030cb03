"""Ranked search against scoring every document, and blocks that are truly passed over."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from gradeline.llm import ranking


def _terms(text):
    found = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in t) for t in found]


def _brute(docs, items, k):
    docs = [(key, _terms(text)) for key, text in docs]
    n_docs, n_terms = sum(1 for _, t in docs if t), sum(len(t) for _, t in docs)
    df: dict = {}
    for _, terms in docs:
        for term in set(terms):
            df[term] = df.get(term, 0) + 1
    out = []
    for item, text in set(items):
        scored = []
        for key, terms in docs:
            score = 0
            for term in _terms(text):
                tf = terms.count(term)
                if tf:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                    score += w * (1000000000 * tf // (1000 * tf + 12 * (75 + 25 * len(terms) * n_docs // n_terms)))
            if score > 0:
                scored.append((-score, key is None, key))
        scored.sort()
        out += [(item, rank, key, -score) for rank, (score, _, key) in enumerate(scored[:k], 1)]
    return sorted(out, key=str)


def _found(docs, items, **more):
    rows = ranking.rank_documents(docs, items, **more).select("item", "rank", "id", "score").collect()
    return sorted(map(tuple, rows), key=str)


@pytest.fixture
def corpus():
    choose = random.Random(3)
    words = [f"w{i}" for i in range(150)] + ["é", "Ünder", "42", "The"]
    weights = [1 / (i + 1) for i in range(len(words))]
    texts = [" ".join(choose.choices(words, weights, k=choose.randint(0, 60))) for _ in range(500)]
    texts += texts[:40] * 3
    docs = [(i % 520, text) for i, text in enumerate(texts)] + [(None, "w1 w2 w3"), (600, None), (601, "")]
    items = [(i, " ".join(choose.choices(words, k=12)) + (" w0 w0" if i % 2 else "")) for i in range(25)]
    items += [items[0], (None, "w3 w9"), (30, None), (31, "nowhere"), (3, "w7"), (32, texts[5])]
    return docs, items


@pytest.mark.parametrize("shard, block", [(4096, 16), (100, 4), (7, 1)])
def test_equals_scoring_all(spark, corpus, monkeypatch, shard, block):
    monkeypatch.setattr(ranking, "SHARD_DOCS", shard)
    monkeypatch.setattr(ranking, "BLOCK_DOCS", block)
    docs, items = corpus
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert _found(df, asked, k=5) == _brute(docs, items, 5)


def test_several_passes_give_the_same(spark, corpus, monkeypatch):
    monkeypatch.setattr(ranking, "BLOCK_ITEM_TERMS", 500)
    docs, items = corpus
    df, asked = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert _found(df, asked) == _brute(docs, items, 20)


def test_odd_documents(odd_docs, no_docs, spark):
    items = [(1, "one two two"), (2, "ſecret é"), (3, "A x")]
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("a.b", F.lit(1)).withColumn("rank", F.lit(7))
    docs = odd_docs.withColumn("a.b", F.lit(1)).withColumn("`n", F.lit(2))
    assert _found(docs, asked) == _brute([(r["doc_id"], r["text"]) for r in odd_docs.collect()], items, 20)
    assert _found(no_docs, asked) == [] == _found(docs, asked.filter("false"))


def _shard(n_docs=2000, n_terms=400, seed=0):
    """Documents of topics: some common terms and a topic's own."""
    rng = np.random.default_rng(seed)
    rows = []
    for d in range(n_docs):
        topic = d % 20
        own = 20 + topic * 19 + rng.choice(19, 8, replace=False)
        rows.append(np.unique(np.concatenate([rng.choice(20, 6, replace=False), own])))
    sizes = np.array([len(r) for r in rows])
    terms = np.concatenate(rows)
    return ranking.Shard(np.concatenate([[0], np.cumsum(sizes)]), terms, rng.integers(1, 1000, len(terms)), n_terms)


def test_summaries_bound_every_document():
    shard = _shard()
    rng = np.random.default_rng(1)
    weights = rng.integers(0, 50, 400)
    for term in range(0, 400, 7):
        docs, of, starts, columns, most = shard.blocks(term)
        assert sorted(docs) == sorted(shard.docs[shard.lists[term] : shard.lists[term + 1]])
        if len(docs):
            bounds = shard.bounds((starts, columns, most), weights)
            assert (shard.scores(docs, weights) <= bounds[of]).all()
            for block in range(len(bounds)):  # coordinatewise the greatest, not more
                inside = np.zeros(400, dtype=np.int64)
                for d in docs[of == block]:
                    at = slice(shard.starts[d], shard.starts[d + 1])
                    inside[shard.terms[at]] = np.maximum(inside[shard.terms[at]], shard.values[at])
                assert (inside[columns[starts[block] : starts[block + 1]]] == most[starts[block] : starts[block + 1]]).all()


def test_blocks_are_passed_over(monkeypatch):
    """A query of one topic visits a small part of the documents, with the results of all."""
    shard = _shard()
    visited = []
    plain = shard.scores
    monkeypatch.setattr(shard, "scores", lambda docs, weights: visited.append(len(docs)) or plain(docs, weights))
    weights = np.zeros(400, dtype=np.int64)
    terms = np.arange(15, 32)
    weights[terms] = np.where(terms < 20, 1, 30)
    rows, scores = shard.search(terms, weights, 10, 1)
    every = plain(np.arange(2000), weights)
    best = np.lexsort((np.arange(2000), -every))[:10]
    assert rows.tolist() == best.tolist() and scores.tolist() == every[best].tolist()
    assert sum(visited) < 500
