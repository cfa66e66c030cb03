"""The encoder against the library, and round trips."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from gradeline.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = ["a", "b", "the", "ing", " ", "\n", "\x1c", " ", "é", "1", "!", "中", "  ", "tion", "😀", "'s", "'", "\t", "Über"]


@pytest.fixture(scope="module")
def encoders():
    with open(PATH, "rb") as file:
        ranks = bpe.load_ranks(file.read())
    own = bpe.Encoder(ranks, public_tokenizers.PATTERN)
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return own, lambda text: np.array(other.encode_ordinary(text), dtype="<u4").tobytes()


@pytest.mark.parametrize("seed", range(3))
def test_equals_the_library(encoders, seed):
    own, library = encoders
    choose = random.Random(seed)
    texts = ["".join(choose.choices(PIECES, k=choose.randint(0, 60))) for _ in range(400)]
    texts += ["", " ", "<|endoftext|>", "a" * 3001, "".join(choose.choices("abcdefgh", k=5000))]
    want = [library(text) for text in texts]
    assert own.encode(texts, bpe.words_apart) == want == own.encode(texts)
    assert [bpe.Decoder(own.ranks).decode(packed) for packed in want] == [text.encode() for text in texts]


def test_a_merge_that_makes_a_lesser_rank_goes_first():
    ranks = {bytes([i]): i + 10 for i in range(256)} | {b"ab": 300, b"abab": 5, b"ababab": 6}
    own = bpe.Encoder(ranks, r"(?s:.+)")
    library = tiktoken.Encoding("x", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={})
    for text in ("abababab", "ababab" * 3 + "a", "abab"):
        assert own.merge([text.encode()])[0].tolist() == library.encode_ordinary(text)


def test_a_very_long_pre_token(encoders):
    own, _ = encoders
    text = "".join(random.Random(1).choices("abcdefgh", k=300_000))
    assert bpe.Decoder(own.ranks).decode(own.encode([text])[0]) == text.encode()


def test_the_memory_of_parts_is_bounded(encoders, monkeypatch):
    own, library = encoders
    monkeypatch.setattr(bpe, "CACHED_BYTES", 20_000)
    monkeypatch.setattr(bpe, "CHUNK_CHARS", 500)
    texts = [f"some w{i} words{i} " + "x" * (i % 90) for i in range(400)]
    assert own.encode(texts, bpe.words_apart) == [library(text) for text in texts]
    assert own.cached < 60_000 and len(own.cache) < 400


def test_frames(odd_docs, no_docs, encoders):
    done = bpe.decode_ids(bpe.encode_texts(odd_docs, PATH, public_tokenizers.PATTERN), PATH).collect()
    at_once = bpe.encode_texts(odd_docs, PATH, public_tokenizers.PATTERN, decode=True).select("ids", "decoded").collect()
    assert [tuple(r) for r in at_once] == [(r["ids"], r["decoded"]) for r in done]
    assert [bytes(r["decoded"]).decode() for r in done] == [r["text"] or "" for r in done]
    assert [bytes(r["ids"]) for r in done] == [encoders[1](r["text"] or "") for r in done]
    assert bpe.encode_texts(no_docs, PATH, public_tokenizers.PATTERN).count() == 0
