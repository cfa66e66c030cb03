"""Removal of long word sequences that occur more than once, by seed and extend.

Seeds: of the word n-grams inside each window the one with the least hash is its anchor
(winnowing), so equal windows have equal anchors wherever they stand. Extend: an anchor
stands for a stretch of consecutive windows, on both sides of it. Stretches are joined on
the anchor. Equal stretches are repeats as a whole; of an anchor with several different
stretches, one of each kind is cut into its windows, and windows that occur in more than one
kind are repeats. Overlapping and adjoining repeats of a document together are its maximal
repeats. No pair of documents is formed: every step is a count of equal keys.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gradeline.llm.chars import Words, chunks, is_blank
from gradeline.llm.common import (
    FIRST_BASE,
    SECOND_BASE,
    Rolling,
    Stored,
    mixed,
    quoted,
    row_key,
    to_batch,
)

LEAST_WORDS = 35
SEED_WORDS = 10
# Fixed value: what separates words; everything else is part of one.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
_CHUNK = 1 << 15
KEY = ["k1", "k2"]


def _anchors(seeds: np.ndarray, per_window: int) -> np.ndarray:
    """For each window the place of its least seed, the last of equal ones."""
    if len(seeds) < per_window:
        return np.zeros(0, dtype=np.int64)
    views = sliding_window_view(seeds, per_window)
    places = np.empty(len(views), dtype=np.int64)
    for at in range(0, len(views), _CHUNK):
        part = views[at : at + _CHUNK, ::-1]
        places[at : at + _CHUNK] = per_window - 1 - part.argmin(axis=1)
    return places + np.arange(len(views))


class _Windows:
    """The stretches of a document and the hashes of their windows."""

    def __init__(self, least_words: int):
        self.least = least_words
        self.seed = min(SEED_WORDS, least_words)
        self.chars, self.first, self.second = Rolling(FIRST_BASE), Rolling(FIRST_BASE), Rolling(SECOND_BASE)

    def words(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The word hashes of each text."""
        for part in chunks(texts):
            words = Words(texts[part], is_blank, self.chars)
            yield from np.split(words.hashes, words.edges[1:-1])

    def stretches(self, hashes: np.ndarray) -> tuple[np.ndarray, ...]:
        """Anchor hash, hash of the whole stretch, first window and number of windows."""
        seeds = self.first.grams(hashes, self.seed)
        places = _anchors(seeds, self.least - self.seed + 1)
        if not len(places):
            none = np.zeros(0, dtype=np.int64)
            return none, none, none, none
        start = np.flatnonzero(np.r_[True, places[1:] != places[:-1]])
        stop = np.r_[start[1:], len(places)]
        prefix = self.second.prefix(hashes)
        whole = self.second.stretches(prefix, start, stop + self.least - 1) ^ mixed((stop - start).astype(np.uint64))
        return seeds[places[start]].view(np.int64), whole.view(np.int64), start, stop - start

    def windows(self, hashes: np.ndarray, starts: list[int], counts: list[int]) -> list[np.ndarray]:
        prefix = self.second.prefix(hashes)
        out = []
        for start, count in zip(starts, counts, strict=True):
            first = np.arange(start, start + count)
            out.append(self.second.stretches(prefix, first, first + self.least).view(np.int64))
        return out


def _stretches(docs: DataFrame, least_words: int) -> DataFrame:
    schema = StructType.fromDDL("k1 bigint, k2 bigint, anchor bigint, whole bigint, start int, n int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = _Windows(least_words)
        for batch in batches:
            k1, k2 = (batch.column(i).to_numpy() for i in (0, 1))
            texts = [text or "" for text in batch.column(2).to_pylist()]
            found = [windows.stretches(hashes) for hashes in windows.words(texts)]
            times = [len(x[0]) for x in found]
            columns = [np.concatenate([x[i] for x in found]) if found else [] for i in range(4)]
            yield to_batch(schema, [np.repeat(k1, times), np.repeat(k2, times), *columns])

    return docs.select(*KEY, "text").mapInArrow(run, schema)


def _windows(reps: DataFrame, least_words: int) -> DataFrame:
    """One row per window of the given stretches, with its place if the stretch is the only one of its kind."""
    schema = StructType.fromDDL("anchor bigint, whole bigint, window bigint, k1 bigint, k2 bigint, start int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = _Windows(least_words)
        for batch in batches:
            rows = batch.to_pylist()
            for row, words in zip(rows, windows.words([row["text"] for row in rows]), strict=True):
                parts = row["parts"]
                hashes = windows.windows(words, [p["start"] for p in parts], [p["n"] for p in parts])
                times = [len(x) for x in hashes]
                each = [np.repeat(np.array([p[c] for p in parts], dtype=np.int64), times) for c in ("anchor", "whole")]
                places = np.concatenate([np.arange(p["start"], p["start"] + p["n"]) for p in parts])
                size = len(places)
                keys = [np.full(size, row[k], dtype=np.int64) for k in KEY]
                mask = ~np.repeat(np.array([p["single"] for p in parts]), times)
                yield pa.RecordBatch.from_arrays(
                    [
                        *map(pa.array, (*each, np.concatenate(hashes))),
                        *[pa.array(k, mask=mask) for k in keys],
                        pa.array(places.astype(np.int32)),
                    ],
                    names=schema.names,
                )

    return reps.select(*KEY, "text", "parts").mapInArrow(run, schema)


def repeated_windows(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """``k1, k2, start, n``: runs of windows that also start elsewhere, for rows ``k1, k2, text``."""
    occurrences = Stored(_stretches(docs, least_words))
    occ = occurrences.df
    kinds = occ.groupBy("anchor", "whole").agg(
        F.count("*").alias("times"), F.min(F.struct(*KEY, "start", "n")).alias("at")
    )
    several = kinds.groupBy("anchor").agg(F.count("*").alias("kinds")).filter("kinds > 1")
    known = kinds.join(several, "anchor", "left").filter("times > 1 OR kinds IS NOT NULL")
    useful = Stored(known)

    equal = useful.df.filter("times > 1").select("anchor", "whole")
    as_a_whole = occ.join(equal, ["anchor", "whole"]).select(*KEY, "start", "n")

    part = F.struct("anchor", "whole", "at.start", "at.n", (F.col("times") == 1).alias("single"))
    reps = useful.df.filter("kinds IS NOT NULL").groupBy("at.k1", "at.k2").agg(F.collect_list(part).alias("parts"))
    cut = Stored(_windows(reps.join(docs, KEY), least_words))
    shared = cut.df.groupBy("anchor", "window").agg(F.min("whole").alias("a"), F.max("whole").alias("b"))
    single = cut.df.filter("k1 IS NOT NULL")
    in_part = single.join(shared.filter("a < b").select("anchor", "window"), ["anchor", "window"])
    return as_a_whole.unionByName(in_part.select(*KEY, "start", F.lit(1).alias("n")))


def _kept(text: str | None, spans: list[dict] | None, least_words: int) -> tuple[int, list[int], list[int], str]:
    words = WORD.findall(text or "")
    if not spans:
        return len(words), [], [], " ".join(words)
    change = np.zeros(len(words) + 1, dtype=np.int64)
    starts = np.array([s["start"] for s in spans])
    ends = starts + np.array([s["n"] for s in spans]) + least_words - 1
    np.add.at(change, starts, 1)
    np.add.at(change, ends, -1)
    gone = np.cumsum(change[:-1]) > 0
    edges = np.flatnonzero(np.diff(np.r_[False, gone, False].astype(np.int8)))
    kept = " ".join([words[i] for i in np.flatnonzero(~gone)])
    return len(words), edges[::2].tolist(), edges[1::2].tolist(), kept


def remove_repeats(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_words: int = LEAST_WORDS,
    keep: list[str] | None = None,
) -> DataFrame:
    """Each row with ``n_words``, ``n_removed``, ``repeat_starts``, ``repeat_ends`` and ``kept_text``.

    A word goes if it is in a window of ``least_words`` words whose words also start anywhere
    else, in another row or at another place of the same row; a row given twice repeats
    itself. ``repeat_starts`` and ``repeat_ends`` (arrays of int, words, end exclusive) are the
    maximal repeats; ``kept_text`` has the kept words joined by one space. A null or empty text
    has no words. Null ids are ids. An empty table gives an empty result. ``keep`` names the
    input columns to carry; one with the name of a result is replaced.

    A row is known by the hashes of id and text. The texts are shuffled once by these, however
    hot a text is; the stretches of equal rows are gathered once and not for every copy. Anchors take about two rows for ``least_words - SEED_WORDS`` words.
    """
    results = StructType.fromDDL(
        "n_words bigint, n_removed bigint, repeat_starts array<int>, repeat_ends array<int>, kept_text string"
    )
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in results.names]
    inner = [f"__{i}" for i in range(len(kept))]
    carried = [quoted(c).alias(place) for c, place in zip(kept, inner, strict=True)]
    rows = df.select(*row_key(id_col, text_col), quoted(text_col).alias("text"), *carried)
    narrow = rows.select(*KEY, "text")
    spans = repeated_windows(narrow, least_words).groupBy(*KEY).agg(F.collect_set(F.struct("start", "n")).alias("spans"))
    joined = rows.join(spans, KEY, "left").select(*inner, "text", "spans")
    schema = StructType(joined.schema.fields[: len(kept)] + results.fields)
    # The text's own column comes after the kept ones, under its place rather than its name.
    at = len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, found = batch.column(at).to_pylist(), batch.column(at + 1).to_pylist()
            made = [_kept(text, spans, least_words) for text, spans in zip(texts, found, strict=True)]
            n_removed = [sum(m[2]) - sum(m[1]) for m in made]
            columns = [[m[0] for m in made], n_removed, *[[m[i] for m in made] for i in (1, 2, 3)]]
            added = to_batch(results, columns)
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], *added.columns], names=schema.names)

    return joined.mapInArrow(run, schema).toDF(*kept, *results.names)
