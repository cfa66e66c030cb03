"""Packing of tokenised documents into sequences by a grouping genetic algorithm.

Pieces of one length are interchangeable, so a packing is found on the counts of lengths, of
which there are at most as many as a sequence has tokens, whatever the number of documents. The
counts are split into a batch of about ``BATCH_PIECES`` pieces to be repeated many times, one
repeated a quarter as often for what is left, and so on to one that stands for itself. Each batch
is packed by a genetic algorithm whose individuals are lists of whole sequences: crossover injects
well-filled sequences of one parent into the other, removes the sequences that then use a piece
twice, and best-fits the displaced pieces. It runs as islands in Spark tasks that pass their best
individuals on round a ring. A batch's worst-filled sequences are taken apart and join the next batch with some of short pieces
that can fill theirs, so little is lost by the split. The pieces are then numbered within their lengths and find
their places by two joins with the plan, whose size does not depend on the data.
"""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructType
from tokenizers import Tokenizer

from gradeline.llm.bpe import load_ranks
from gradeline.llm.common import Stored, quoted, to_batch

CAPACITY = 1024
BATCH_PIECES = 4096
FEWER = 4
TAKEN_APART = 512  # pieces of a batch's worst sequences that go to the next batch
FILLERS = 1024  # pieces of its sequences of the shortest pieces that go there too
ISLANDS = 8
POPULATION = 10
GENERATIONS = 12
EPOCHS = 3
MIGRANTS = 2
# Longer runs of white space overflow the stack of the faster library.
_LONG_SPACE = re.compile(r"\s{5000}")
_CUT = StructType().add("piece", IntegerType()).add("start", LongType()).add("length", LongType()).add("ids", BinaryType())
_POPULATION = "island int, genome binary, bins int, fitness double"

Bins = list[list[int]]


# --- documents as pieces -----------------------------------------------------


def cut_documents(
    docs: DataFrame,
    json_path: str,
    ranks_path: str,
    pattern: str,
    end_id: int,
    capacity: int = CAPACITY,
    text_col: str = "text",
    keep: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """The ``keep`` columns with ``piece, start, length, ids``: a row for each piece of each document.

    A document is the ids of its whole text, a null text being empty, and ``end_id``. Only one
    longer than ``capacity`` is cut, into pieces of that length but for the first, which takes what
    is over. Names of special tokens in a text are ordinary text. ``ids`` are little-endian unsigned
    32-bit integers. ``json_path`` and ``ranks_path`` are the same vocabulary for two libraries, of
    which the faster one encodes all but texts with very long runs of white space. An empty table
    gives an empty result. A kept column may not have the name of a result.
    """
    with open(ranks_path, "rb") as ranks, open(json_path, encoding="utf-8") as whole:
        shared = docs.sparkSession.sparkContext.broadcast((ranks.read(), whole.read()))
    kept = docs.select(*[quoted(c).alias(f"c{i}") for i, c in enumerate(keep)], quoted(text_col).cast("string").alias("text"))
    schema = StructType(kept.schema.fields[:-1] + _CUT.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, whole = shared.value
        encoder = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=load_ranks(ranks), special_tokens={})
        slow: list[Tokenizer] = []

        def encode(text: str) -> list[int]:
            if not _LONG_SPACE.search(text):
                return encoder.encode_ordinary(text)
            if not slow:
                slow.append(Tokenizer.from_str(whole))
                slow[0].encode_special_tokens = True
            return slow[0].encode(text, add_special_tokens=False).ids

        for batch in batches:
            rows, cut = [], []
            for row, text in enumerate(batch.column(len(keep)).to_pylist()):
                ids = np.array([*encode(text or ""), end_id], dtype="<u4")
                start, end = 0, (len(ids) - 1) % capacity + 1
                while start < len(ids):
                    rows.append(row)
                    cut.append((0 if not start else cut[-1][0] + 1, start, end - start, ids[start:end].tobytes()))
                    start, end = end, end + capacity
            done = to_batch(_CUT, list(zip(*cut, strict=True)) or [[]] * 4)
            carried = batch.take(pa.array(rows, pa.int64()))
            columns = [*carried.columns[: len(keep)], *done.columns]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return kept.mapInArrow(run, schema).toDF(*keep, *_CUT.names)


# --- the genetic algorithm ----------------------------------------------------


def lower_bound(counts: Mapping[int, int], capacity: int) -> int:
    """A number of sequences that no packing of these lengths can be below.

    For each ``least``: pieces above ``capacity - least`` take a sequence each and leave no room for
    those of ``least`` or more; those above a half take one each, with room that the rest may use.
    """
    n = np.zeros(capacity + 2, dtype=np.int64)
    for length, count in counts.items():
        n[length] += count
    above = np.concatenate([np.cumsum(n[::-1])[::-1], [0]])  # pieces of this length or more
    room = np.concatenate([np.cumsum((n * np.arange(capacity + 2))[::-1])[::-1], [0]])
    half = capacity // 2
    best = 0
    for least in range(half + 1):
        large = above[capacity - least + 1]
        middle = above[half + 1] - large
        left = (room[least] - room[half + 1]) - (middle * capacity - (room[half + 1] - room[capacity - least + 1]))
        best = max(best, int(large + middle + max(0, -(-int(left) // capacity))))
    return best


def fit_best(bins: Bins, pieces: Sequence[int], capacity: int) -> Bins:
    """Put each piece, in the given order, where it leaves the least room; changes and returns ``bins``."""
    by_room: dict[int, Bins] = defaultdict(list)
    rooms = 0  # a bit for every amount of room that a sequence has
    for one in bins:
        room = capacity - sum(one)
        by_room[room].append(one)
        rooms |= 1 << room
    for piece in pieces:
        enough = rooms >> piece
        if enough:
            room = piece + (enough & -enough).bit_length() - 1
            one = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, one = capacity, []
            bins.append(one)
        one.append(piece)
        by_room[room - piece].append(one)
        rooms |= 1 << (room - piece)
    return bins


def fitness(bins: Bins, capacity: int) -> float:
    """The mean of the squared fill: of as many sequences, those are better that are full or empty."""
    return sum((sum(one) / capacity) ** 2 for one in bins) / max(1, len(bins))


def crossover(into: Bins, source: Bins, demand: Mapping[int, int], capacity: int, choose: random.Random) -> Bins:
    """Well-filled sequences of ``source`` and what of ``into`` does not repeat their pieces.

    The pieces of the sequences that are removed for a repeat are fitted anew, the longest first
    but for some noise, together with those of the worst sequence that stays.
    """
    left = Counter(demand)
    child: Bins = []
    fills = sorted(map(sum, source), reverse=True)
    well = fills[len(fills) // 2] if fills else 0
    for one in source:
        if sum(one) >= well and choose.random() < 0.5:
            left.subtract(one)
            child.append(list(one))
    for one in into:
        for place, piece in enumerate(one):
            if left[piece] <= 0:
                left.update(one[:place])
                break
            left[piece] -= 1
        else:
            child.append(list(one))
    if child:
        worst = min(range(len(child)), key=lambda i: sum(child[i]))
        left.update(child.pop(worst))
    return fit_best(child, _shuffled(left, choose, 0.02), capacity)


def _shuffled(counts: Mapping[int, int], choose: random.Random, noise: float) -> list[int]:
    """The pieces, longest first, with each length taken as longer or shorter by chance."""
    pieces = [length for length, n in counts.items() for _ in range(n)]
    return sorted(pieces, key=lambda x: -x * (1 + choose.uniform(-noise, noise)))


def first_population(demand: Mapping[int, int], capacity: int, choose: random.Random) -> list[Bins]:
    """Best fits of the pieces in decreasing order, disturbed but for the first."""
    return [fit_best([], _shuffled(demand, choose, 0.05 * i / POPULATION), capacity) for i in range(POPULATION)]


def evolve(population: list[Bins], demand: Mapping[int, int], capacity: int, choose: random.Random, enough: int) -> list[Bins]:
    """``POPULATION`` individuals, best first, after ``GENERATIONS``, or once one has ``enough`` sequences."""

    def rank(bins: Bins) -> tuple:
        return len(bins), -fitness(bins, capacity)

    held = sorted(((rank(bins), bins) for bins in population), key=lambda x: x[0])[:POPULATION]
    for _ in range(GENERATIONS):
        if held[0][0][0] <= enough:
            break
        children = []
        for _ in range(POPULATION // 2):
            a, b = (min(choose.sample(range(len(held)), min(2, len(held)))) for _ in range(2))
            child = crossover(held[a][1], held[b][1], demand, capacity, choose)
            children.append((rank(child), child))
        unlike = {key: bins for key, bins in held + children}
        held = sorted(unlike.items(), key=lambda x: x[0])[:POPULATION]
    return [bins for _, bins in held]


def _packed(bins: Bins) -> bytes:
    return np.array([x for one in bins for x in (*one, 0)], dtype="<i4").tobytes()


def _unpacked(genome: bytes) -> Bins:
    values = np.frombuffer(genome, dtype="<i4")
    ends = np.flatnonzero(values == 0)
    return [part[:-1].tolist() for part in np.split(values, ends + 1)[:-1]]


def pack_batch(spark: SparkSession, demand: Mapping[int, int], capacity: int, seed: str) -> Bins:
    """The best packing of one batch that the islands find; the seed fixes all chance.

    Each epoch is one job with a group per island. What it hands on, ``ISLANDS * POPULATION``
    packings of a batch, is bounded and stored in the shared folder. The search ends at the lower
    bound, after ``EPOCHS``, or with an epoch that saves no sequence.
    """
    enough = lower_bound(demand, capacity)
    demand = dict(demand)

    def island(epoch: int):
        def run(rows: pd.DataFrame) -> pd.DataFrame:
            own = int(rows["island"].iloc[0])
            choose = random.Random(f"{seed}-{epoch}-{own}")
            population = [_unpacked(genome) for genome in rows["genome"] if genome] or first_population(demand, capacity, choose)
            done = evolve(population, demand, capacity, choose, enough)
            return pd.DataFrame(
                {
                    "island": own,
                    "genome": [_packed(bins) for bins in done],
                    "bins": [len(bins) for bins in done],
                    "fitness": [fitness(bins, capacity) for bins in done],
                }
            )

        return run

    empty = spark.range(ISLANDS).select(F.col("id").cast("int").alias("island"), F.lit(None).cast("binary").alias("genome"))
    current: Stored | None = None
    fewest = None
    for epoch in range(EPOCHS):
        rows = _migrated(current.df) if current else empty
        after = Stored(rows.repartition(ISLANDS, "island").groupBy("island").applyInPandas(island(epoch), _POPULATION))
        if current:
            current.drop()
        current = after
        best = current.df.orderBy("bins", F.col("fitness").desc(), "genome").first()
        if best["bins"] <= enough or best["bins"] == fewest:
            break
        fewest = best["bins"]
    current.drop()
    return _unpacked(bytes(best["genome"]))


def _migrated(population: DataFrame) -> DataFrame:
    """Every island's population with the best of the island before it."""
    order = Window.partitionBy("island").orderBy("bins", F.col("fitness").desc(), "genome")
    elite = population.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= MIGRANTS)
    moved = elite.select(((F.col("island") + 1) % ISLANDS).alias("island"), "genome")
    return population.select("island", "genome").unionByName(moved)


# --- the plan and the places ----------------------------------------------------


def plan_batches(spark: SparkSession, counts: Mapping[int, int], capacity: int) -> list[tuple[int, Bins]]:
    """How often each batch is repeated, and its sequences; together they hold exactly ``counts``."""
    left = {length: n for length, n in counts.items() if n and length < capacity}
    full = counts.get(capacity, 0)
    plan: list[tuple[int, Bins]] = [(full, [[capacity]])] if full else []
    total = sum(left.values())
    power = max(0, math.ceil(math.log(max(1, total / BATCH_PIECES), FEWER)))
    for step in range(power, -1, -1):
        times = FEWER**step
        demand = {length: n // times for length, n in left.items() if n >= times}
        if not demand:
            continue
        bins = pack_batch(spark, demand, capacity, str(step))
        if step:
            bins = _without_last(sorted(bins, key=sum, reverse=True), TAKEN_APART, lambda one: sum(one) < capacity)
            bins = _without_last(sorted(bins, key=lambda one: sum(one) / len(one), reverse=True), FILLERS, lambda one: True)
        for one in bins:
            for length in one:
                left[length] -= times
        if bins:
            plan.append((times, bins))
    return plan


def _without_last(bins: Bins, pieces: int, when: Callable[[list[int]], bool]) -> Bins:
    """Without sequences from the end on, while the condition holds and they have no more pieces than that."""
    kept = len(bins)
    while kept and when(bins[kept - 1]) and len(bins[kept - 1]) <= pieces:
        kept -= 1
        pieces -= len(bins[kept])
    return bins[:kept]


def _plan_tables(spark: SparkSession, plan: list[tuple[int, Bins]]) -> tuple[DataFrame, DataFrame]:
    """Which numbers of each length go to which batch, and the place of each number in a batch."""
    used: Counter = Counter()
    first_sequence = 0
    spans, places = [], []
    for batch, (times, bins) in enumerate(plan):
        slots: Counter = Counter()
        for number, one in enumerate(bins):
            offset = 0
            for length in one:
                places.append((length, batch, slots[length], number, offset))
                slots[length] += 1
                offset += length
        for length, n in slots.items():
            spans.append((length, batch, used[length], used[length] + n * times, n, first_sequence, len(bins)))
            used[length] += n * times
        first_sequence += times * len(bins)
    spans_schema = "length bigint, batch int, first bigint, until bigint, slots bigint, first_sequence bigint, n_bins bigint"
    return (
        spark.createDataFrame(spans, spans_schema),
        spark.createDataFrame(places, "length bigint, batch int, slot bigint, bin bigint, offset bigint"),
    )


def pack(pieces: DataFrame, capacity: int = CAPACITY, length_col: str = "length") -> DataFrame:
    """Each row with ``sequence_id`` and ``offset``: its place in a sequence of at most ``capacity``.

    Sequences have no gaps. A row of a length that is null, below 1 or above ``capacity`` raises.
    Repeated rows are packed each. An empty table gives an empty result. An input column of a
    result's name is replaced. The rows are stored once in the shared folder, which fixes their
    numbers. They are shuffled once, by length and writing task, so a length that many have is
    spread over as many groups as tasks wrote it; the driver holds the counts of the different
    lengths and the plan, at most some thousand places for each power of ``FEWER`` in the
    number of rows.
    """
    spark = pieces.sparkSession
    names = [c for c in pieces.columns if c.lower() not in ("sequence_id", "offset")]
    inner = [f"c{i}" for i in range(len(names))]
    chosen = pieces.select(*[quoted(c).alias(i) for c, i in zip(names, inner, strict=True)], quoted(length_col).cast("bigint").alias("length"))
    rows = Stored(chosen.withColumn("row", F.monotonically_increasing_id())).df.withColumn("task", F.shiftright("row", 33))
    counted = rows.groupBy("task", "length").agg(F.count("*").alias("n"))
    counts = {r["length"]: r["n"] for r in counted.groupBy("length").agg(F.sum("n").alias("n")).limit(capacity + 2).collect()}
    if any(length is None or not 1 <= length <= capacity for length in counts):
        raise ValueError(f"lengths must be between 1 and {capacity}")
    spans, places = _plan_tables(spark, plan_batches(spark, counts, capacity))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    begun = counted.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begun"))
    place = Window.partitionBy("task", "length").orderBy("row")
    numbered = rows.withColumn("nth", F.row_number().over(place) - 1).join(begun, ["task", "length"])
    numbered = numbered.withColumn("number", F.col("begun") + F.col("nth"))
    inside = (F.col("number") >= F.col("first")) & (F.col("number") < F.col("until"))
    spans = spans.withColumnRenamed("length", "span_length")
    batched = numbered.join(F.broadcast(spans), (F.col("length") == F.col("span_length")) & inside)
    batched = batched.withColumns({"slot": F.expr("(number - first) % slots"), "copy": F.expr("(number - first) div slots")})
    placed = batched.join(F.broadcast(places), ["length", "batch", "slot"])
    sequence = F.col("first_sequence") + F.col("copy") * F.col("n_bins") + F.col("bin")
    result = placed.select(*inner, sequence.alias("sequence_id"), "offset")
    return result.toDF(*names, "sequence_id", "offset")


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids``: the ids of each sequence, its pieces in order; a group is one sequence."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.reduce(parts, F.lit(b""), lambda done, part: F.concat(done, part["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))
