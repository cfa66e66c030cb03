"""Similarity join of documents on the Jaccard similarity of word shingles, by chosen paths.

Equal sets are one class. Every class draws paths through its MinHash values: a node of a path
names one coordinate, and the classes that agree there go on together; two classes of
similarity ``s`` agree with chance ``s``. A node of few classes is a leaf; a larger one splits
again, into ``1 / least`` children on average, so that pairs at the threshold neither die out nor
multiply. As many roots are drawn as the target recall needs. Leaves are compared on sketches
with a wide margin, which leaves clusters of classes that may be similar; within a cluster, block
by block, the similarities are exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gradeline.llm.chars import Words, chunks, grams, is_space
from gradeline.llm.common import FIRST_BASE, SECOND_BASE, Rolling, Stored, mixed, quoted, row_key, to_batch
from gradeline.llm.graph import components

SHINGLE_WORDS = 5
LEAST_SIMILARITY = 0.8
RECALL = 0.9999
COORDINATES = 64
LEAF = 64
DEPTH = 4
MARGIN = 0.25
BLOCK = 256
_COLUMNS = 4096
KEY, SET = ["k1", "k2"], ["s1", "s2"]


def roots_for(recall: float, least: float, depth: int = DEPTH) -> int:
    """How many roots give a pair at the threshold that recall if its nodes are all large."""
    more = 1 / least - 1
    reach = 1.0
    for _ in range(depth - 1):
        agree = least * reach
        reach = (1 - more) * agree + more * (1 - (1 - agree) ** 2)
    return math.ceil(math.log(1 - recall) / math.log(1 - least * reach))


class Shingles:
    """The sets of distinct shingle hashes of texts; a shorter text is one shingle."""

    def __init__(self, size: int):
        self.size, self.chars, self.rolling = size, Rolling(FIRST_BASE), Rolling(SECOND_BASE)
        self.factors = mixed(np.arange(1, COORDINATES + 1)) | np.uint64(1)
        self.shifts = mixed(np.arange(1001, COORDINATES + 1001))

    def of(self, texts: Sequence[str]) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        for part in chunks(texts):
            words = Words(texts[part], is_space, self.chars)
            hashes, first = grams(words.hashes, words.edges, self.size, self.rolling)
            edges = np.searchsorted(first, words.edges)
            for i, n in enumerate(np.diff(words.edges).tolist()):
                if n >= self.size:
                    out.append(np.unique(hashes[edges[i] : edges[i + 1]]))
                else:
                    out.append(self.rolling.grams(words.hashes[words.edges[i] : words.edges[i] + n], n) if n else hashes[:0])
        return out

    def signatures(self, sets: Sequence[np.ndarray]) -> np.ndarray:
        """MinHash values, one row per set; sets are not empty."""
        if not sets:
            return np.zeros((0, COORDINATES), dtype=np.int32)
        flat = np.concatenate(sets)
        starts = np.cumsum([0, *map(len, sets[:-1])])
        out = np.empty((len(sets), COORDINATES), dtype=np.int32)
        for c in range(COORDINATES):
            values = (flat * self.factors[c] + self.shifts[c]) >> np.uint64(32)
            out[:, c] = np.minimum.reduceat(values, starts).astype(np.uint32).view(np.int32)
        return out


def _sketched(rows: DataFrame, size: int) -> DataFrame:
    """``id, k1, k2`` with the hashes ``s1, s2`` and the ``signature`` of the set, null without words."""
    added = StructType.fromDDL("s1 bigint, s2 bigint, signature array<int>")
    schema = StructType(rows.select("id", *KEY).schema.fields + added.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(size)
        for batch in batches:
            sets = shingles.of([text or "" for text in batch.column(3).to_pylist()])
            have = [i for i, s in enumerate(sets) if len(s)]
            columns: list[list] = [[None] * len(sets) for _ in range(3)]
            for i, signature in zip(have, shingles.signatures([sets[i] for i in have]), strict=True):
                columns[0][i] = int(mixed(sets[i]).sum().view(np.int64))
                columns[1][i] = int(mixed(sets[i] ^ np.uint64(FIRST_BASE)).sum().view(np.int64))
                columns[2][i] = signature
            new = to_batch(added, columns)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *new.columns], names=schema.names)

    return rows.select("id", *KEY, "text").mapInArrow(run, schema)


def _child(number: int, node: str = "node") -> F.Column:
    """The coordinate that child ``number`` of a node looks at, and its own name."""
    at = F.pmod(F.xxhash64(node, F.lit(number)), F.lit(COORDINATES)).cast("int")
    return F.xxhash64(node, F.lit(number), at, F.get("signature", at))


def _same_leaf(classes: DataFrame, least: float) -> DataFrame:
    """Pairs ``a, b`` of class names that may be similar: stars that span what agrees."""
    roots = roots_for(RECALL, least)
    seeds = F.array(*[F.xxhash64(F.lit("root"), F.lit(r)) for r in range(roots)])
    started = classes.withColumn("node", F.explode(seeds)).select(_child(0).alias("node"), *SET)
    level, leaves, stars = Stored(started), [], []
    for depth in range(1, DEPTH + 1):
        sizes = level.df.groupBy("node").agg(F.count("*").alias("n"), F.min(F.struct(*SET)).alias("least"))
        met = Stored(level.df.join(sizes.filter("n > 1"), "node"))
        level.drop()
        leaves.append(met.df.filter(F.col("n") <= LEAF).select("node", *SET))
        large = met.df.filter(F.col("n") > LEAF)
        if depth == DEPTH or large.isEmpty():
            # What has agreed so often is taken for similar until it is compared exactly.
            stars.append(large.select(_name("s1", "s2").alias("a"), _name("least.s1", "least.s2").alias("b")))
            break
        second = F.pmod(F.xxhash64("node", F.lit("second")), F.lit(1000)) < int(1000 * (1 / least - 1))
        children = F.array_compact(F.array(_child(0), F.when(second, _child(1))))
        split = large.select("node", *SET).join(classes, SET)
        level = Stored(split.withColumn("node", F.explode(children)).select("node", *SET))
    agreed = leaves[0]
    for more in leaves[1:]:
        agreed = agreed.unionByName(more)
    low = F.transform("signature", lambda x: x.bitwiseAND(255))
    member = F.struct(_name("s1", "s2").alias("name"), low.alias("low"))
    groups = agreed.join(classes, SET).groupBy("node").agg(F.collect_list(member).alias("members"))
    edges = groups.mapInArrow(_leaf_edges(least - MARGIN), "a string, b string")
    for star in stars:
        edges = edges.unionByName(star)
    return edges.distinct()


def _name(first: str, second: str) -> F.Column:
    return F.concat(F.hex(first), F.lit("-"), F.hex(second))


def _spanning(near: np.ndarray) -> list[tuple[int, int]]:
    """A star round the first member of each component of a symmetric relation."""
    root = np.arange(len(near))
    while True:
        new = np.where(near, root[None, :], len(near)).min(axis=1)
        new = np.minimum(new, root)
        new = new[new]
        if (new == root).all():
            return [(i, int(r)) for i, r in enumerate(root) if i != r]
        root = new


def _leaf_edges(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for members in batch.column(1).to_pylist():
                low = np.array([m["low"] for m in members], dtype=np.uint8)
                near = (low[:, None, :] == low[None, :, :]).mean(axis=2) >= least
                for i, j in _spanning(near):
                    a.append(members[i]["name"])
                    b.append(members[j]["name"])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(b, pa.string())], names=["a", "b"])

    return run


def similarities(sets: Sequence[np.ndarray]) -> np.ndarray:
    """Jaccard similarities of all pairs; only shingles of two sets or more are multiplied."""
    sizes = np.array(list(map(len, sets)))
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, place, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = times[place] > 1
    owner, place = owner[common], np.unique(place[common], return_inverse=True)[1]
    shared = np.zeros((len(sets), len(sets)))
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    last = int(place[-1]) + 1 if len(place) else 0
    for start in range(0, last, _COLUMNS):
        a, b = np.searchsorted(place, [start, start + _COLUMNS])
        block = np.zeros((len(sets), min(_COLUMNS, last - start)), dtype=np.float32)
        block[owner[a:b], place[a:b] - start] = 1
        shared += block @ block.T
    return shared / np.maximum(sizes[:, None] + sizes[None, :] - shared, 1)


def _compared(tiles: DataFrame, size: int, least: float) -> DataFrame:
    """For each class of a tile its number of links there and a class it is connected with."""
    schema = StructType.fromDDL("name string, links bigint, other string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(size)
        for batch in batches:
            for i in range(batch.num_rows):
                first, last, members = (batch.column(c)[i].as_py() for c in range(3))
                alike = similarities(shingles.of([m["text"] for m in members])) >= least - 1e-12
                block = np.array([m["block"] for m in members])
                np.fill_diagonal(alike, False)
                if first != last:
                    alike &= block[:, None] != block[None, :]
                links = alike @ np.array([m["copies"] for m in members], dtype=np.int64)
                other = dict(_spanning(alike))
                names = [m["name"] for m in members]
                linked = [names[other.get(k, k)] for k in range(len(names))]
                yield to_batch(schema, [names, links, linked])

    return tiles.select("first", "last", "members").mapInArrow(run, schema)


def similar_documents(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: float = LEAST_SIMILARITY,
    shingle_words: int = SHINGLE_WORDS,
) -> DataFrame:
    """``id, k1, k2, class_id, n_links, is_first``: one row for each row of ``df``.

    Words are what white space separates, unchanged. A text of fewer words than a shingle is one
    shingle; a null or empty text, or one without words, is linked with nothing. ``n_links``
    counts the other rows whose set has a similarity of at least ``least``, rows with an equal
    set included. Rows connected by links are a class, and ``class_id`` is its least id, null only
    if all its ids are. ``is_first`` marks the row of the class with the least id and, among
    equal ids, the least hash; equal rows are marked alike. ``k1, k2`` are the row's hashes, by
    which it can be found again (``row_key``). Nulls and repetitions among the ids matter to
    nothing else; an empty table gives no rows; other columns are not looked at.

    A pair at the threshold is missed with a chance of at most ``1 - RECALL``, one of higher
    similarity with less. The links found are exact. Copies, however many, are one class before
    any pair is looked at; leaves have at most ``LEAF`` classes; a cluster of ``m`` classes is
    compared in tiles of two blocks, of which only sums leave the task.
    """
    rows = df.select(quoted(id_col).alias("id"), *row_key(id_col, text_col), quoted(text_col).cast("string").alias("text"))
    sketched = Stored(_sketched(rows, shingle_words))
    sets = sketched.df.filter("s1 IS NOT NULL").groupBy(*SET).agg(
        F.count("*").alias("copies"),
        F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", *KEY)).alias("row"),
        F.min("signature").alias("signature"),
    )
    classes = Stored(sets)
    edges = Stored(_same_leaf(classes.df.select(*SET, "signature"), least))
    clusters = components(edges.df)
    edges.drop()

    named = classes.df.withColumn("name", _name("s1", "s2"))
    members = Stored(named.join(clusters, named["name"] == clusters["node"]).select("name", "root", "copies", "row"))
    sizes = members.df.groupBy("root").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("name"), F.col("blocks")).cast("int")
    dealt = members.df.join(sizes, "root").withColumn("block", block)
    texts = rows.select(*KEY, "text")
    found = dealt.join(texts, (F.col("row.k1") == F.col("k1")) & (F.col("row.k2") == F.col("k2")))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    tiled = found.withColumn("other", other).withColumn("first", F.least("block", "other"))
    tiled = tiled.withColumn("last", F.greatest("block", "other"))
    member = F.struct("name", "copies", "block", "text")
    tiles = tiled.groupBy("root", "first", "last").agg(F.collect_set(member).alias("members"))
    compared = Stored(_compared(tiles, shingle_words, least))

    joined = components(compared.df.filter("other <> name").select(F.col("name").alias("a"), F.col("other").alias("b")))
    links = compared.df.groupBy("name").agg(F.sum("links").alias("links"))
    info = named.join(joined.withColumnRenamed("node", "name"), "name", "left").join(links, "name", "left")
    info = info.withColumn("class", F.coalesce("root", "name"))
    first = info.groupBy("class").agg(F.min("row").alias("first"))
    known = info.join(first, "class").select(
        *SET, "first", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    every = sketched.df.join(known, SET, "left")
    alone = F.col("s1").isNull()
    is_first = (F.col("first.k1") == F.col("k1")) & (F.col("first.k2") == F.col("k2"))
    return every.select(
        "id",
        *KEY,
        F.when(alone, F.col("id")).otherwise(F.col("first.id")).alias("class_id"),
        F.when(alone, F.lit(0)).otherwise(F.col("n_links")).cast("long").alias("n_links"),
        (alone | is_first).alias("is_first"),
    )


def one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST_SIMILARITY) -> DataFrame:
    """The rows of ``df`` that are the first of their class, each once, with all columns."""
    kept = similar_documents(df, id_col, text_col, least).filter("is_first").select(*KEY).distinct()
    keyed = df.select(F.struct("*").alias("row"), *row_key(id_col, text_col))
    once = keyed.join(kept, KEY).groupBy(*KEY).agg(F.first("row").alias("row"))
    return once.select("row.*")
