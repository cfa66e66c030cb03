"""Ranked lexical search with posting lists cut into blocks of similar documents.

The documents are indexed in shards of a bounded size. Within a shard every posting list is cut
into blocks of documents that point the same way, and each block has a summary: the greatest
impact of any of its documents, term by term. A query's product with a summary is therefore never
less than its product with a document of the block, and a block is passed over only where that
bound is below the score of the worst result held so far. So the results are those of scoring
every document.

Terms, weights and scores (all integers but for the logarithm): a term is a maximal run of ASCII
letters and digits and of all other characters beyond ASCII, with only A to Z lower-cased. With N
documents that hold a term at all, L terms in them, ``df`` documents with the term, ``n`` terms in
a document and ``tf`` of them this one: the weight is ``floor(1000 * ln((2N + 2) / (2df + 1)))``,
the impact ``1000000000 tf // (1000 tf + 12 (75 + 25 n N // L))``, and the score the sum of weight
times impact over the query's terms, repeats included.
"""

from __future__ import annotations

import math
import re
import string
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gradeline.llm.common import Stored, quoted, to_batch

# What a term is, and the constants of weight and impact.
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
WEIGHT_SCALE, IMPACT_SCALE, TF_SCALE, LENGTH_SCALE = 1000, 1_000_000_000, 1000, 12
LENGTH_SHARE, LENGTH_WHOLE = 25, 100

BLOCK_ITEM_TERMS = 1_000_000  # terms of the queries that are searched in one pass over the documents
SHARD_POSTINGS = 400_000
SHARD_DOCS = 4096
BLOCK_DOCS = 16
SKETCH = 16
VISITED_AT_ONCE = 8
SUMMARY_CELLS = 1 << 21
_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def term_counts(text: str | None) -> Counter:
    """Occurrences of each term of a text; none for null."""
    found = Counter(TERM.findall(text or ""))
    out: Counter = Counter()
    for term, n in found.items():
        out[term.lower() if term.isascii() else term.translate(_LOWER)] += n
    return out


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(WEIGHT_SCALE * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """The impact of each term in a document, from its occurrences and the document's terms."""
    length = LENGTH_WHOLE - LENGTH_SHARE + (LENGTH_SHARE * n.astype(np.int64) * n_docs) // n_terms
    tf = tf.astype(np.int64)
    return (IMPACT_SCALE * tf) // (TF_SCALE * tf + LENGTH_SCALE * length)


def _flat(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of several stretches, one after another."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


class Shard:
    """Documents as rows of term impacts, with their posting lists in blocks.

    Rows are in the order in which equal scores rank. ``n_vocabulary`` is more than any term number.
    The blocks of a list are made when a query first needs them.
    """

    def __init__(self, starts: np.ndarray, terms: np.ndarray, values: np.ndarray, n_vocabulary: int):
        self.starts, self.terms, self.values = starts, terms, values
        self.sizes = np.diff(starts)
        by_term = np.argsort(terms, kind="stable")
        self.docs = np.repeat(np.arange(len(self.sizes)), self.sizes)[by_term]
        self.lists = np.searchsorted(terms[by_term], np.arange(n_vocabulary + 1))
        self.best = np.zeros(n_vocabulary, dtype=np.int64)
        held = np.flatnonzero(np.diff(self.lists))
        if len(held):
            self.best[held] = np.maximum.reduceat(values[by_term], self.lists[held])
        self._sketches: np.ndarray | None = None
        self._blocks: dict[int, tuple] = {}
        self._column = np.zeros(n_vocabulary, dtype=np.int64)
        self._held = np.zeros(n_vocabulary, dtype=bool)

    def sketches(self) -> np.ndarray:
        """A unit vector for each document: its impacts, projected on random directions."""
        if self._sketches is None:
            signs = np.random.default_rng(7).standard_normal((len(self._column), SKETCH)).astype(np.float32)
            parts = signs[self.terms] * self.values[:, None].astype(np.float32)
            sums = np.zeros((len(self.sizes), SKETCH), dtype=np.float32)
            held = np.flatnonzero(self.sizes)
            sums[held] = np.add.reduceat(parts, self.starts[:-1][held], axis=0)
            self._sketches = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
        return self._sketches

    def blocks(self, term: int) -> tuple:
        """The blocks of a posting list and their summaries.

        ``docs, of, starts, columns, most``: the documents in block order and the block of each,
        and per block a stretch of terms with the greatest impact of each. A document goes to the
        most similar of some documents spread over the list, one for each ``BLOCK_DOCS``.
        """
        found = self._blocks.get(term)
        if found is None:
            docs = self.docs[self.lists[term] : self.lists[term + 1]]
            vectors = self.sketches()[docs]
            centres = vectors[:: BLOCK_DOCS]
            nearest = np.argmax(vectors @ centres.T, axis=1)
            used, of = np.unique(nearest, return_inverse=True)
            order = np.argsort(of, kind="stable")
            docs, of = docs[order], of[order]
            found = self._blocks[term] = (docs, of, *self._summaries(docs, of, len(used)))
        return found

    def _summaries(self, docs: np.ndarray, of: np.ndarray, n_blocks: int) -> tuple:
        at = _flat(self.starts[docs], self.sizes[docs])
        of = np.repeat(of, self.sizes[docs])
        terms, values = self.terms[at], self.values[at]
        self._held[terms] = True
        columns = np.flatnonzero(self._held)
        self._held[columns] = False
        self._column[columns] = np.arange(len(columns))
        places = self._column[terms]
        starts, found, most = [0], [], []
        step = max(1, SUMMARY_CELLS // max(1, len(columns)))
        for first in range(0, n_blocks, step):  # some blocks as a table of all columns
            part = slice(*np.searchsorted(of, [first, first + step]))
            table = np.zeros((min(step, n_blocks - first), len(columns)), dtype=np.int64)
            np.maximum.at(table.reshape(-1), (of[part] - first) * len(columns) + places[part], values[part])
            row, column = np.nonzero(table)
            starts += (starts[-1] + np.cumsum(np.bincount(row, minlength=len(table)))).tolist()
            found.append(columns[column])
            most.append(table[row, column])
        return np.array(starts), np.concatenate(found), np.concatenate(most)

    @staticmethod
    def bounds(summaries: tuple, weights: np.ndarray) -> np.ndarray:
        """For each block, what no score of its documents is above."""
        starts, columns, most = summaries
        return np.diff(np.concatenate([[0], np.cumsum(weights[columns] * most)])[starts])

    def scores(self, docs: np.ndarray, weights: np.ndarray) -> np.ndarray:
        at = _flat(self.starts[docs], self.sizes[docs])
        sums = np.concatenate([[0], np.cumsum(weights[self.terms[at]] * self.values[at])])
        ends = np.cumsum(self.sizes[docs])
        return sums[ends] - sums[ends - self.sizes[docs]]

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` best rows with a score of at least ``floor``, which is above 0, and their scores.

        ``terms`` are the query's and ``weights`` says what one unit of impact counts for every
        term, 0 beyond the query.
        """
        found, scored = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        seen = np.zeros(len(self.sizes), dtype=bool)

        def visit(docs: np.ndarray) -> None:
            nonlocal found, scored, floor
            docs = np.unique(docs[~seen[docs]])
            seen[docs] = True
            score = self.scores(docs, weights)
            good = score >= floor
            found, scored = np.concatenate([found, docs[good]]), np.concatenate([scored, score[good]])
            best = np.lexsort((found, -scored))[:k]
            found, scored = found[best], scored[best]
            if len(found) == k:
                floor = max(floor, int(scored[-1]))

        limits = weights[terms] * self.best[terms]
        order = np.argsort(limits, kind="stable")
        terms, below = terms[order], np.cumsum(limits[order])

        # The lists of least bounds that together stay below the floor are not needed.
        sizes = self.lists[terms + 1] - self.lists[terms]
        short = np.flatnonzero((sizes <= BLOCK_DOCS) & (below >= floor))
        if len(short):
            visit(self.docs[_flat(self.lists[terms[short]], sizes[short])])
        for place in np.flatnonzero((sizes > BLOCK_DOCS) & (below >= floor))[::-1].tolist():
            if below[place] < floor:
                break
            docs, of, *summaries = self.blocks(int(terms[place]))
            bound = self.bounds(summaries, weights)
            edges = np.searchsorted(of, np.arange(len(bound) + 1))
            order = np.argsort(-bound, kind="stable")
            for i in range(0, len(order), VISITED_AT_ONCE):
                some = order[i : i + VISITED_AT_ONCE]
                some = some[bound[some] >= floor]
                if not len(some) or below[place] < floor:
                    break
                visit(docs[_flat(edges[some], edges[some + 1] - edges[some])])
        return found, scored


class _Queries:
    """The queries of one pass: numbered terms, and for each query its terms and their counts."""

    def __init__(self, rows: list):
        self.vocabulary: dict[str, int] = {}
        self.keys, self.terms, self.counts = [], [], []
        for row in rows:
            counted = term_counts(row["text"])
            for term in counted:
                self.vocabulary.setdefault(term, len(self.vocabulary))
            self.keys.append(row["item"])
            self.terms.append(np.array([self.vocabulary[t] for t in counted], dtype=np.int64))
            self.counts.append(np.fromiter(counted.values(), dtype=np.int64, count=len(counted)))


def _forward(docs: DataFrame, vocabulary: dict[str, int]) -> DataFrame:
    """``id, n`` and the query terms of each document with their occurrences, one row per document."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    schema = f"id {docs.schema['id'].dataType.simpleString()}, n bigint, terms array<int>, tfs array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.get
        for batch in batches:
            sizes, terms, tfs = [], [], []
            for text in batch.column(1).to_pylist():
                counted = term_counts(text)
                sizes.append(sum(counted.values()))
                mine = [(t, n) for term, n in counted.items() if (t := number(term)) is not None]
                terms.append([t for t, _ in mine])
                tfs.append([n for _, n in mine])
            kind = pa.list_(pa.int32())
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(terms, kind), pa.array(tfs, kind)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n", "terms", "tfs"])

    return docs.mapInArrow(run, schema)


def _shards(batches: Iterator[pa.RecordBatch], n_docs: int, n_terms: int, n_vocabulary: int):
    """Indexes of a bounded size over the rows of a task, each with the ids of its documents."""
    rows: list = []
    held = 0

    def build():
        rows.sort(key=lambda row: (row[0] is None, row[0]))
        sizes = np.array([len(row[2]) for row in rows], dtype=np.int64)
        terms = np.concatenate([row[2] for row in rows]).astype(np.int64)
        n = np.repeat(np.array([row[1] for row in rows], dtype=np.int64), sizes)
        values = impacts(np.concatenate([row[3] for row in rows]), n, n_docs, n_terms)
        return [row[0] for row in rows], Shard(np.concatenate([[0], np.cumsum(sizes)]), terms, values, n_vocabulary)

    for batch in batches:
        ids, n, terms, tfs = (batch.column(i) for i in range(4))
        edges = terms.offsets.to_numpy()
        all_terms, all_tfs = terms.values.to_numpy(), tfs.values.to_numpy()
        tf_edges = tfs.offsets.to_numpy()
        for i, (key, size) in enumerate(zip(ids.to_pylist(), n.to_pylist(), strict=True)):
            rows.append((key, size, all_terms[edges[i] : edges[i + 1]], all_tfs[tf_edges[i] : tf_edges[i + 1]]))
            held += int(edges[i + 1] - edges[i])
            if held >= SHARD_POSTINGS or len(rows) >= SHARD_DOCS:
                yield build()
                rows, held = [], 0
    if rows:
        yield build()


def _best_of_tasks(forward: DataFrame, queries: _Queries, stats: tuple[int, int, dict[int, int]], k: int) -> DataFrame:
    """``item, id, score, task``: the best documents of each query among the rows of each task."""
    n_docs, n_terms, df = stats
    n_vocabulary = len(queries.vocabulary)
    unit = np.array([term_weight(n_docs, df[t]) if t in df else 0 for t in range(n_vocabulary)], dtype=np.int64)
    shared = forward.sparkSession.sparkContext.broadcast((queries.keys, queries.terms, queries.counts, unit))
    out = StructType.fromDDL(f"item bigint, id {forward.schema['id'].dataType.simpleString()}, score bigint, task int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, all_terms, all_counts, unit = shared.value
        best: list[list] = [[] for _ in keys]
        weights = np.zeros(len(unit), dtype=np.int64)
        for ids, shard in _shards(batches, n_docs, n_terms, len(unit)):
            for held, terms, counts in zip(best, all_terms, all_counts, strict=True):
                weights[terms] = counts * unit[terms]
                floor = max(1, -held[-1][0]) if len(held) == k else 1
                rows, scores = shard.search(terms, weights, k, floor)
                weights[terms] = 0
                held += [(-s, ids[r] is None, ids[r]) for r, s in zip(rows.tolist(), scores.tolist(), strict=True)]
                held.sort()  # an equal score goes by id, null last
                del held[k:]
        flat = [(key, row[2], -row[0]) for key, held in zip(keys, best, strict=True) for row in held]
        task = TaskContext.get().partitionId()
        yield to_batch(out, [[row[i] for row in flat] for i in range(3)] + [[task] * len(flat)])

    return forward.select("id", "n", "terms", "tfs").mapInArrow(run, out)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best rows of each item, first within groups of tasks."""
    order = [F.col("score").desc(), F.col("id").asc_nulls_last()]
    group = F.pmod("task", F.lit(64))
    some = found.withColumn("rank", F.row_number().over(Window.partitionBy("item", group).orderBy(*order))).filter(F.col("rank") <= k)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= k)


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    k: int = 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``item, rank, id, score``: the ``k`` documents of the highest score above 0 for each item.

    Equal scores rank by id, null last; equal ids by nothing, for their rows are alike. A null text
    has no terms: such an item finds nothing, such a document is never found. Repeated documents are
    ranked each; a repeated row of ``items`` counts once, and two texts under one item id are two
    items. Empty tables give an empty result. Other columns are not looked at. Texts are read whole.

    Items are searched in passes of about ``BLOCK_ITEM_TERMS`` terms; a pass reads every document,
    stores the terms that its items ask for, and searches them where they lie, so only each task's
    best rows are shuffled. What is broadcast is one pass's items.
    """
    docs = docs.select(quoted(id_col).alias("id"), quoted(text_col).cast("string").alias("text"))
    asked = items.select(quoted(item_col).alias("item_id"), quoted(item_text_col).cast("string").alias("text")).distinct()
    asked = Stored(asked.withColumn("item", F.monotonically_increasing_id())).df
    size = asked.agg(F.sum(F.length("text"))).first()[0] or 0
    n_passes = 1 + size // (2 * BLOCK_ITEM_TERMS)  # a term has a character at least, and one between
    parts = [_search_pass(docs, asked.filter(F.pmod(F.xxhash64("item"), F.lit(n_passes)) == i), k) for i in range(n_passes)]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return asked.select("item", "item_id").join(found, "item").select(F.col("item_id").alias("item"), "rank", "id", "score")


def _search_pass(docs: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    queries = _Queries(asked.orderBy("item").collect())
    forward = Stored(_forward(docs, queries.vocabulary)).df
    totals = forward.agg(F.count(F.when(F.col("n") > 0, 1)).alias("docs"), F.sum("n").alias("terms")).first()
    counted = forward.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    df = {row["term"]: row["df"] for row in counted.collect()}  # at most the terms of one pass
    stats = (totals["docs"], max(1, totals["terms"] or 0), df)
    found = _best_of_tasks(forward.filter(F.size("terms") > 0), queries, stats, k)
    return _ranked(found, k).select("item", "rank", "id", "score")
