"""Spelling variants: words one edit apart, found in a reduced alphabet.

Every letter is hashed to one of a few symbols. An edit of a word is an edit of its reduced word
or leaves that unchanged, so the words near a word are among those whose reduced word is its own
or one edit from it. The neighbourhoods of the reduced words are generated as hashes, each relation
from one of its ends: the longer word's deletions (the other's insertions), and replacements by a
greater symbol (the other's by a lesser). They are joined with the hashes of the reduced
vocabulary, and what meets is verified on the words themselves.
"""

from __future__ import annotations

import re
import string
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructType

from gradeline.llm.common import FIRST_BASE, SECOND_BASE, Stored, mixed, quoted, to_batch

LEAST_LENGTH = 5
LEAST_COUNT = 3
SYMBOLS = 8
DROPPED_ONE_IN = 97
HELD_WORDS = 200_000  # different words that a task holds before it passes their counts on
HELD_KEYS = 1 << 20
CHUNK_CHARS = 1 << 20
_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
_RUN = re.compile(r"[A-Za-zÀ-ÿ]+")
_WORD = StructType().add("word", StringType()).add("n", LongType())
_KEY = StructType().add("key", LongType()).add("id", LongType()).add("own", BooleanType())


def _runs(text: str) -> Counter:
    """Occurrences of each maximal run of letters, only A to Z lower-cased; a very long text in parts."""
    found: Counter = Counter()
    start = 0
    while start < len(text):
        end = start + CHUNK_CHARS
        while end < len(text) and _RUN.match(text[end]):  # a run is not cut
            end += 1
        found.update(_RUN.findall(text[start:end]))
        start = end
    lowered: Counter = Counter()
    for run, n in found.items():
        if len(run) >= LEAST_LENGTH:
            lowered[run.lower() if run.isascii() else run.translate(_LOWER)] += n
    return lowered


def words_of(doc_id: object, text: str | None) -> Counter:
    """Occurrences of each word of a document.

    A run is a word, without one letter if the number of hits of its document's hash on
    ``DROPPED_ONE_IN`` says so. A null id counts as an empty string in that hash.
    """
    out: Counter = Counter()
    begun = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in _runs(text or "").items():
        h = zlib.crc32(run.encode("utf-8"), begun)
        if h % DROPPED_ONE_IN == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < LEAST_LENGTH:
                continue
        out[run] += n
    return out


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, n`` of the words of at least ``LEAST_COUNT`` occurrences in all texts.

    Each task adds up its words before the shuffle, so a common word costs it a row or a few.
    """
    chosen = docs.select(quoted(id_col).cast("string").alias("id"), quoted(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for key, text in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                held.update(words_of(key, text))
            if len(held) >= HELD_WORDS:
                yield to_batch(_WORD, [list(held), list(held.values())])
                held = Counter()
        yield to_batch(_WORD, [list(held), list(held.values())])

    total = chosen.mapInArrow(run, _WORD).groupBy("word").agg(F.sum("n").alias("n"))
    return total.filter(F.col("n") >= LEAST_COUNT)


def reduced(word: str) -> np.ndarray:
    """The symbol, from 1, of each letter."""
    points = np.frombuffer(word.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    return mixed(points + np.uint64(1)) % np.uint64(SYMBOLS) + np.uint64(1)


class _Keys:
    """Hashes of reduced words and of their neighbours, for many words of one length at once."""

    def __init__(self, length: int):
        factors = np.full(length, FIRST_BASE, dtype=np.uint64)
        factors[:1] = 1
        self.power = np.multiply.accumulate(factors)
        self.back = np.uint64(pow(FIRST_BASE, -1, 1 << 64))
        self.length = length

    def _key(self, sums: np.ndarray, length: int) -> np.ndarray:
        return mixed(sums + np.uint64(length * SECOND_BASE % (1 << 64))).view(np.int64)

    def own(self, symbols: np.ndarray) -> np.ndarray:
        return self._key((symbols * self.power).sum(axis=1, dtype=np.uint64), self.length)

    def edited(self, symbols: np.ndarray) -> np.ndarray:
        """A row of keys per word: without each symbol, and each symbol replaced by greater ones.

        A place that a word has no replacement for repeats another key of the word.
        """
        parts = symbols * self.power
        upto = np.cumsum(parts, axis=1, dtype=np.uint64)
        whole = upto[:, -1:]
        dropped = self._key(upto - parts + (whole - upto) * self.back, self.length - 1)
        columns = [dropped]
        for step in range(1, SYMBOLS):
            replaced = self._key(whole + np.uint64(step) * self.power, self.length)
            columns.append(np.where(symbols + np.uint64(step) <= SYMBOLS, replaced, dropped))
        return np.concatenate(columns, axis=1)


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, list[str], np.ndarray]]:
    """Ids, words and reduced words of a batch of ``id, word``, those of one length together."""
    groups: dict[int, tuple[list, list]] = {}
    for key, word in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
        ids, words = groups.setdefault(len(word), ([], []))
        ids.append(key)
        words.append(word)
    for length, (ids, words) in groups.items():
        symbols = reduced("".join(words)).reshape(-1, length)
        step = max(1, HELD_KEYS // (length * SYMBOLS))
        for i in range(0, len(ids), step):
            yield np.array(ids[i : i + step], dtype=np.int64), words[i : i + step], symbols[i : i + step]


def _vocabulary_keys(words: DataFrame) -> DataFrame:
    """``key, other, other_word``: the hash of each word's reduced word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, words, symbols in _by_length(batch):
                keys = _Keys(symbols.shape[1]).own(symbols)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(ids), pa.array(words)], names=["key", "other", "other_word"])

    return words.select("id", "word").mapInArrow(run, "key bigint, other bigint, other_word string")


def _neighbour_keys(words: DataFrame) -> DataFrame:
    """``key, id, own``: the hashes of each word's reduced word (``own``) and of its neighbours, each once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, _, symbols in _by_length(batch):
                keys = _Keys(symbols.shape[1])
                own, edited = keys.own(symbols), np.sort(keys.edited(symbols), axis=1)
                new = np.ones(edited.shape, dtype=bool)
                new[:, 1:] = edited[:, 1:] != edited[:, :-1]
                new &= edited != own[:, None]
                columns = [
                    np.concatenate([own, edited[new]]),
                    np.concatenate([ids, np.repeat(ids, new.sum(axis=1))]),
                    np.arange(len(ids) + int(new.sum())) < len(ids),
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=_KEY.names)

    return words.select("id", "word").mapInArrow(run, _KEY)


def near_words(words: DataFrame) -> DataFrame:
    """``a, b``: the ids of each pair of words exactly one edit apart, ``a`` below ``b``.

    ``words`` has ``id`` and ``word``, both without repeats. Nothing is cut: a reduced word that
    many words share meets each of their neighbours, and a partition of the join that grows beyond
    its share is split by adaptive execution.
    """
    asked, known = _neighbour_keys(words), _vocabulary_keys(words)
    met = asked.join(known, "key").filter(F.when(F.col("own"), F.col("id") < F.col("other")).otherwise(F.col("id") != F.col("other")))
    met = met.select("id", "other", "other_word").join(words.select("id", "word"), "id")
    near = met.filter(F.levenshtein("word", "other_word", 1) == 1)
    return near.select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")).distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root``: the last word that the forms lead to, for each word that has one.

    A form has twice the occurrences of its word at least, so chains are short; each round
    doubles the steps taken and is stored in the shared folder.
    """
    current = Stored(forms.select("word", F.col("form").alias("root")))
    while True:
        step = current.df.select(F.col("word").alias("root"), F.col("root").alias("next"))
        later = current.df.join(step, "root", "left")
        after = Stored(later.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        current.drop()
        moved = not after.df.filter("moved").isEmpty()
        current = after
        if not moved:
            return current.df.select("word", "root")
        current = after


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of ``count_words``.

    ``form`` is the near word of most occurrences, the first in code-point order of several, if it
    has twice the word's occurrences at least, else null; ``root`` is the last word that the forms
    lead to, the word itself if it has none. A null text has no words, and a null id counts as an
    empty string in the choice of the dropped letters. Repeated rows count each. An empty table
    gives an empty result; other columns are not looked at. Texts and words are taken whole.
    """
    words = Stored(count_words(docs, id_col, text_col).withColumn("id", F.monotonically_increasing_id())).df
    pairs = near_words(words)
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    other = words.select(F.col("id").alias("b"), F.struct((-F.col("n")).alias("less"), F.col("word").alias("word")).alias("by"))
    best = both.join(other, "b").groupBy(F.col("a").alias("id")).agg(F.count("*").alias("n_near"), F.min("by").alias("by"))
    found = words.join(best, "id", "left")
    leads = -F.col("by.less") >= 2 * F.col("n")
    found = Stored(
        found.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(leads, F.col("by.word")).alias("form"),
            F.when(leads, -F.col("by.less")).alias("form_n"),
        )
    ).df
    rooted = found.join(_roots(found.filter("form IS NOT NULL")), "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
