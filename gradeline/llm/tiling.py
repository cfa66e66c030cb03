"""Benchmark decontamination by greedy string tiling.

Word n-grams shared with a benchmark item are the seeds. Between a document and an item the
seeds on one diagonal form matches; the longest match whose words are still unmarked is marked
as a tile, again and again, down to the least length. The share of the item's words that are in
tiles tells whether the document holds the item, in whatever order its passages stand.
"""

from __future__ import annotations

import heapq
import math
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeline.llm.chars import Words, chunks, grams, is_not_word, lowered
from gradeline.llm.common import FIRST_BASE, SECOND_BASE, Rolling, map_texts, quoted

LEAST_TILE = 5
LEAST_COVERAGE = 0.5
BLOCK_BYTES = 16 << 20
_FILTER_BITS = 22


def greedy_tiles(pairs: Sequence[tuple[int, int]], least: int) -> list[tuple[int, int, int]]:
    """Tiles (document word, item word, length) from the places of equal n-grams of ``least`` words.

    Longest first, then by place in the document and in the item. A match of which part has been
    marked meanwhile is cut to its longest unmarked parts, which wait for their turn.
    """
    diagonals = defaultdict(list)
    for i, j in pairs:
        diagonals[i - j].append(j)
    heap: list[tuple[int, int, int]] = []
    for shift, places in diagonals.items():
        places.sort()
        start = previous = places[0]
        for j in [*places[1:], None]:
            if j is None or j != previous + 1:
                heap.append((start - previous - least, start + shift, start))
                start = j
            previous = j
    heapq.heapify(heap)
    marked_doc: set[int] = set()
    marked_item: set[int] = set()
    tiles = []
    while heap:
        size, i, j = heapq.heappop(heap)
        free = [i + k not in marked_doc and j + k not in marked_item for k in range(-size)]
        if all(free):
            marked_doc.update(range(i, i - size))
            marked_item.update(range(j, j - size))
            tiles.append((i, j, -size))
            continue
        begin = None
        for k, is_free in enumerate([*free, False]):
            if is_free and begin is None:
                begin = k
            elif not is_free and begin is not None:
                if k - begin >= least:
                    heapq.heappush(heap, (begin - k, i + begin, j + begin))
                begin = None
    return tiles


@dataclass(frozen=True)
class ItemIndex:
    """The n-grams of some benchmark items in the order of their hashes."""

    ids: list
    sizes: np.ndarray
    seeds: np.ndarray
    item: np.ndarray
    place: np.ndarray
    maybe: np.ndarray

    @staticmethod
    def of(ids: list, texts: list[str], least: int) -> ItemIndex:
        words = Words([lowered(text) for text in texts], is_not_word)
        hashes, first = grams(words.hashes, words.edges, least, Rolling(SECOND_BASE))
        order = np.argsort(hashes, kind="stable")
        item = words.text_of[first] if len(first) else first
        maybe = np.zeros(1 << _FILTER_BITS, dtype=bool)
        maybe[hashes & np.uint64(len(maybe) - 1)] = True
        place = first - words.edges[item]
        return ItemIndex(ids, np.diff(words.edges), hashes[order], item[order], place[order], maybe)


class Matcher:
    """The best covered item of each text."""

    def __init__(self, index: ItemIndex, least: int):
        self.index, self.least = index, least
        self.chars, self.rolling = Rolling(FIRST_BASE), Rolling(SECOND_BASE)

    def best(self, texts: Sequence[str]) -> list[tuple[float, int | None, list[tuple[int, int, int]]]]:
        """Coverage, item and tiles; of equal coverages the first item of the index."""
        out: list = [(0.0, None, [])] * len(texts)
        for part in chunks(texts):
            words = Words([lowered(text) for text in texts[part]], is_not_word, self.chars)
            hashes, first = grams(words.hashes, words.edges, self.least, self.rolling)
            near = self.index.maybe[hashes & np.uint64(len(self.index.maybe) - 1)]
            hashes, first = hashes[near], first[near]
            low = np.searchsorted(self.index.seeds, hashes, "left")
            times = np.searchsorted(self.index.seeds, hashes, "right") - low
            which = np.repeat(np.arange(len(hashes)), times)
            at = np.repeat(low, times) + np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times)
            text = np.searchsorted(words.edges, first[which], "right") - 1
            found: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)
            places = first[which] - words.edges[text]
            for t, i, p, q in zip(
                text.tolist(), self.index.item[at].tolist(), places.tolist(), self.index.place[at].tolist(), strict=True
            ):
                found[t, i].append((p, q))
            for (t, i), pairs in sorted(found.items()):
                tiles = greedy_tiles(pairs, self.least)
                coverage = sum(size for _, _, size in tiles) / int(self.index.sizes[i])
                if coverage > out[part.start + t][0]:
                    out[part.start + t] = coverage, i, tiles
        return out


def decontaminate(
    df: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    keep: list[str] | None = None,
    least_tile: int = LEAST_TILE,
    least_coverage: float = LEAST_COVERAGE,
) -> DataFrame:
    """Each row with the benchmark item that it covers best.

    Added columns: ``coverage`` (0 to 1, of the item's words), ``item`` (string, null if nothing
    is shared), ``tile_starts``, ``tile_lengths`` (words of the text) and ``contaminated``
    (coverage at or above ``least_coverage``). Words are runs of letters, digits and ``_`` in
    lower case. Of equally covered items the least id counts. Null or empty texts share nothing;
    items with a null id or text, or of less than ``least_tile`` words, are not searched. Rows are
    independent; empty tables give coverage 0 or no rows; an input column of a result's name is
    replaced.

    The texts are not shuffled. The benchmark is dealt into blocks of about ``BLOCK_BYTES`` of
    text, each of which is sent to all tasks, and the blocks are searched one after another in
    one pass over the texts, so neither the driver nor a task holds more than a block at a time.
    """
    kind = benchmark.schema[item_col].dataType.simpleString()
    items = benchmark.select(quoted(item_col).alias("id"), quoted(item_text_col).cast("string").alias("text"))
    items = items.filter("id IS NOT NULL AND text IS NOT NULL").distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / BLOCK_BYTES))
    block = F.pmod(F.xxhash64(F.col("id").cast("string"), "text"), F.lit(blocks))
    names = ["coverage", "item", "tile_starts", "tile_lengths"]
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in (*names, "contaminated")]
    inner = [f"k{i}" for i in range(len(kept))]
    carried = [quoted(c).alias(place) for c, place in zip(kept, inner, strict=True)]
    best = df.select(*carried, quoted(text_col).alias("__searched"))
    for number in range(blocks):
        rows = items.filter(block == number).orderBy("id", "text").collect()
        index = ItemIndex.of([r["id"] for r in rows], [r["text"] for r in rows], least_tile)
        best = _with_best(best, df.sparkSession.sparkContext.broadcast(index), least_tile, inner, kind)
    flag = F.col("coverage") >= least_coverage
    return best.select(*inner, *names, flag.alias("contaminated")).toDF(*kept, *names, "contaminated")


def _with_best(df: DataFrame, sent, least: int, kept: list[str], kind: str) -> DataFrame:
    """Search one block, and keep what an earlier block found if it covers more.

    Ids of equal coverage are compared in their own type, ``kind``.
    """

    def make():
        matcher = Matcher(sent.value, least)

        def work(texts):
            found = matcher.best([text or "" for text in texts])
            ids = matcher.index.ids
            return (
                [f[0] for f in found],
                [None if f[1] is None else str(ids[f[1]]) for f in found],
                [sorted(t[0] for t in f[2]) for f in found],
                [[t[2] for t in sorted(f[2])] for f in found],
            )

        return work

    results = "c double, i string, s array<int>, l array<int>"
    prefixed = ", ".join("__" + part.strip() for part in results.split(", "))
    made = map_texts(df, "__searched", prefixed, make)
    new = {"coverage": "__c", "item": "__i", "tile_starts": "__s", "tile_lengths": "__l"}
    if "coverage" in df.columns:
        better = (F.col("__c") > F.col("coverage")) | (
            (F.col("__c") == F.col("coverage")) & (F.col("__i").cast(kind) < F.col("item").cast(kind))
        )
        columns = [F.when(better, F.col(b)).otherwise(F.col(a)).alias(a) for a, b in new.items()]
    else:
        columns = [F.col(b).alias(a) for a, b in new.items()]
    return made.select(*map(quoted, kept), "__searched", *columns)
