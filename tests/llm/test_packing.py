"""Packing: exact pieces, sound sequences, and no more of them than simpler ways need."""

from __future__ import annotations

import itertools
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gradeline.llm import packing

JSON, RANKS = (public_tokenizers.path(f"byte_bpe_50k.{kind}") for kind in ("json", "tiktoken"))


def _cut(docs, **more):
    return packing.cut_documents(docs, JSON, RANKS, public_tokenizers.PATTERN, 2, **more)


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(JSON)
    tokenizer.encode_special_tokens = True
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def test_pieces_are_those_of_the_library(spark, odd_docs, library):
    long = spark.createDataFrame([(20, " " * 6000 + "word " * 40), (21, "<|endoftext|> a"), (22, "ab" * 9000)], "doc_id long, text string")
    docs = odd_docs.select("doc_id", "text").unionByName(long).withColumn("row", F.monotonically_increasing_id())
    got = _cut(docs, capacity=64, keep=["row", "text"]).collect()
    for key, pieces in itertools.groupby(sorted(got, key=lambda r: (r["row"], r["piece"])), key=lambda r: r["row"]):
        pieces = list(pieces)
        ids = np.frombuffer(b"".join(bytes(p["ids"]) for p in pieces), dtype="<u4").tolist()
        assert ids == library(pieces[0]["text"])
        assert [p["length"] for p in pieces] == [len(p["ids"]) // 4 for p in pieces]
        assert [p["start"] for p in pieces] == [sum(q["length"] for q in pieces[:i]) for i in range(len(pieces))]
        assert all(p["length"] == 64 for p in pieces[1:]) and 1 <= pieces[0]["length"] <= 64
    assert len({r["row"] for r in got}) == docs.count()


def _check(packed, capacity):
    rows = packed.collect()
    by_sequence: dict = {}
    for row in rows:
        by_sequence.setdefault(row["sequence_id"], []).append((row["offset"], row["length"]))
    for places in by_sequence.values():
        places.sort()
        assert [at for at, _ in places] == [0, *itertools.accumulate(n for _, n in places[:-1])]
        assert sum(n for _, n in places) <= capacity
    return rows, len(by_sequence)


def test_whole_documents_come_back_from_the_sequences(odd_docs, library):
    packed = packing.pack(_cut(odd_docs, keep=["doc_id"]))
    rows, n = _check(packed, packing.CAPACITY)
    assert len(rows) == sum(-(-len(library(r["text"])) // 1024) for r in odd_docs.collect())
    joined = {r["sequence_id"]: bytes(r["ids"]) for r in packing.sequences(packed).collect()}
    assert len(joined) == n
    for row in rows:
        assert joined[row["sequence_id"]][4 * row["offset"] :][: 4 * row["length"]] == bytes(row["ids"])
        assert zlib.crc32(bytes(row["ids"])) >= 0


def test_empty_and_columns_of_clashing_names(spark, no_docs):
    assert packing.pack(_cut(no_docs)).count() == 0
    df = spark.createDataFrame([(5, "a", 1, 2), (5, "a", 1, 2)], "length long, `c0.x` string, task int, offset int").withColumn("`tick", F.lit(1))
    packed = packing.pack(df, 8)
    assert packed.columns == ["length", "c0.x", "task", "`tick", "sequence_id", "offset"]
    assert [r["task"] for r in packed.collect()] == [1, 1]


@pytest.mark.parametrize("length", [None, 0, 9])
def test_lengths_that_cannot_be_packed(spark, length):
    with pytest.raises(ValueError, match="between 1 and 8"):
        packing.pack(spark.createDataFrame([(length,), (3,)], "length long"), 8)


def test_hot_lengths_over_several_batches(spark):
    """A third of the rows of one length; batches that are repeated sixteen times."""
    n = 60_000
    length = F.when(F.col("id") % 3 == 0, 600).otherwise(1 + F.pmod(F.xxhash64("id"), F.lit(1024)))
    df = spark.range(0, n, 1, 16).select("id", length.cast("long").alias("length"))
    rows, used = _check(packing.pack(df), 1024)
    assert sorted(r["id"] for r in rows) == list(range(n))
    counts = Counter(r["length"] for r in rows)
    simple = len(packing.fit_best([], sorted((r["length"] for r in rows), reverse=True), 1024))
    assert used <= simple * 1.002
    assert used <= packing.lower_bound(counts, 1024) * 1.01


def _fewest(pieces, capacity):
    """The fewest sequences, by trying all ways to place each piece."""
    best = len(pieces)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(pieces):
            best = len(rooms)
            return
        for room in set(rooms):
            if room >= pieces[i]:
                rest = list(rooms)
                rest.remove(room)
                place(i + 1, [*rest, room - pieces[i]])
        place(i + 1, [*rooms, capacity - pieces[i]])

    place(0, [])
    return best


@pytest.mark.parametrize("seed", range(5))
def test_bounds_and_search_against_all_packings(seed):
    choose = random.Random(seed)
    pieces = sorted((choose.randint(1, 12) for _ in range(9)), reverse=True)
    demand, fewest = Counter(pieces), _fewest(pieces, 16)
    assert packing.lower_bound(demand, 16) <= fewest
    found = packing.evolve(packing.first_population(demand, 16, choose), demand, 16, choose, 0)
    assert len(found[0]) == fewest
    assert all(Counter(x for one in bins for x in one) == demand for bins in found)


def test_crossover_keeps_every_piece_once():
    choose = random.Random(1)
    demand = Counter(choose.randint(1, 100) for _ in range(400))
    a, b = packing.first_population(demand, 128, choose)[:2]
    for _ in range(20):
        child = packing.crossover(a, b, demand, 128, choose)
        assert Counter(x for one in child for x in one) == demand
        assert max(map(sum, child)) <= 128
        a, b = b, child


def test_search_beats_a_best_fit(spark):
    """Pieces of three to a sequence, where fitting the longest first wastes room."""
    demand = {x: 6 for x in (130, 135, 140, 190, 195, 260, 265, 380, 385, 500)}
    simple = packing.fit_best([], sorted(Counter(demand).elements(), reverse=True), 1000)
    assert len(packing.pack_batch(spark, demand, 1000, "test")) <= len(simple)
