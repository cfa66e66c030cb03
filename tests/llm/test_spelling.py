"""Spelling variants against a brute force over all pairs of words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gradeline.llm import spelling


def _apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def _brute(rows):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{word}".encode())
            if h % 97 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    out = {}
    for w, n in words.items():
        near = [v for v in words if _apart(w, v)]
        form = min(near, key=lambda v: (-words[v], v), default=None)
        form = form if form and words[form] >= 2 * n else None
        out[w] = [form, None, n, len(near), words[form] if form else None]
    for w in out:
        root = w
        while out[root][0]:
            root = out[root][0]
        out[w][1] = root
    return {(w, *rest) for w, rest in out.items()}


def _found(df):
    rows = spelling.spelling_variants(df).select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert len(rows) == len({r["word"] for r in rows})
    return {tuple(r) for r in rows}


@pytest.mark.parametrize("seed", range(2))
def test_equals_brute_force(spark, seed):
    """Few letters, so that words collide, with edits of edits, capitals and letters beyond ASCII."""
    choose = random.Random(seed)
    letters = "abceé×ÀB"
    def edited(word):
        at = choose.randrange(len(word) + 1)
        return word[:at] + choose.choice([*letters, ""]) + word[at + choose.choice([0, 1]) :]

    known, weights = [], []
    for _ in range(60):
        word = "".join(choose.choices(letters, k=choose.randint(4, 9)))
        for weight in (60, 20, 20, 6, 2, 1):
            known.append(word)
            weights.append(weight)
            word = edited(word)
    rows = [(i, choose.choice([" ", "-", "1"]).join(choose.choices(known, weights, k=40))) for i in range(300)]
    want = _brute(rows)
    assert sum(1 for r in want if r[1]) > 20 and any(r[1] != r[2] for r in want if r[1])
    assert _found(spark.createDataFrame(rows, "doc_id long, text string")) == want


def test_odd_rows_and_long_words(spark, odd_docs, no_docs):
    long = "pq" * 1500
    rows = [(8, f"{long} {long[:-1]} {long[:-1]} {long[:-1]}Z"), (9, f"{long} {long} {long[:-1]}")] * 2
    more = spark.createDataFrame(rows, "doc_id long, text string")
    docs = odd_docs.unionByName(more, allowMissingColumns=True).withColumn("a.b", F.lit(1)).withColumn("word", F.lit("x"))
    assert _found(docs) == _brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert spelling.spelling_variants(no_docs).count() == 0


def test_runs_are_not_cut_in_a_long_text(monkeypatch):
    text = "alpha betaé, gammaß delta " * 50
    want = spelling.words_of(3, text)
    monkeypatch.setattr(spelling, "CHUNK_CHARS", 7)
    assert spelling.words_of(3, text) == want


def test_neighbourhoods_meet_every_edit(spark):
    """Each edit of a word is reached from one of the two ends."""
    word = "abcdeé"
    edits = {word[:i] + word[i + 1 :] for i in range(6)}
    edits |= {word[:i] + c + word[i + k :] for i in range(7) for c in "abxyzÿ" for k in (0, 1)} - {word}
    words = [word, *sorted(edits)]
    pairs = spelling.near_words(spark.createDataFrame(list(enumerate(words)), "id long, word string"))
    near = {b for a, b in pairs.collect() if a == 0}
    assert near == set(range(1, len(words)))
