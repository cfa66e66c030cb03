"""Secret scan: patterns, and the cost of guessing values in credential contexts.

A value that stands where a credential is named is cut into the segments that a guesser
would try (words, dates, repeats, keyboard walks, brute force) so that the product of the
guesses is least; the value is a secret when even the cheapest cut costs many guesses.
"""

from __future__ import annotations

import math
import re
from collections import deque
from collections.abc import Collection, Iterable, Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeline.llm.common import FIRST_BASE, Rolling, Stored, map_texts, mixed, quoted

# The patterns of the scan and the least length of what they find.
ASSIGN = re.compile(
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"""
    r"""|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 6, 20, 24
KINDS = ("assign", "access", "hex", "guess")
# Names after which a credential is expected beyond those of the patterns.
CONTEXT = re.compile(
    r"""(?<![A-Za-z])(?:password|passwd|passphrase|passcode|pass|pwd|secret|token|api[ _-]?key|access[ _-]?key"""
    r"""|private[ _-]?key|credential|credentials|login|auth|bearer)["']?(?:\x20*[:=]+>?\x20*|\x20is\x20)["'`]?"""
    r"""([^\s"'`<>]{6,})""",
    re.IGNORECASE | re.ASCII,
)
# Words that guessers try first, in the order they try them.
COMMON_WORDS = tuple(
    "password admin login welcome letmein monkey dragon master hello secret qwerty test user guest root "
    "default changeme example sample required none null true false token access key api pass public private "
    "love summer winter spring autumn monday friday sunshine princess football baseball shadow superman "
    "michael jordan hunter server data system office company internet computer my the your value string".split()
)
LEET = str.maketrans("4@310$5!7", "aaelossit")
# Rows of keys and the two sequences, along which walks go either way.
WALKS = ("qwertyuiop", "asdfghjkl", "zxcvbnm", "1234567890", "abcdefghijklmnopqrstuvwxyz", "qazwsxedcrfvtgbyhnujmikolp")
DATE = re.compile(r"(?:19|20)\d\d(?:[-/._]?\d{1,2}[-/._]?\d{1,2})?|\d{1,2}[-/._]\d{1,2}[-/._](?:\d{4}|\d\d)")
SHORTEST_DATE, LONGEST_DATE = 4, 10
DATE_GUESSES = math.log10(365 * 120)
REPEAT_GUESSES = math.log10(2) + 0.3
SECRET_GUESSES = 8.0
#: Least letters of a word, and most letters of one that is looked for inside longer runs of letters.
LEAST_WORD, LONGEST_PIECE = 3, 24
#: Words whose counts differ by less than a factor of 2 ** (1 / COUNT_STEPS) share a rank.
COUNT_STEPS = 8
#: Parts that a hot word or value is dealt into.
SALTS = 16
#: Pairs of places, and pieces of values, that are held at once.
AT_ONCE = 1 << 18

_NEXT = {(a, b) for row in WALKS for line in (row, row[::-1]) for a, b in zip(line, line[1:], strict=False)}


def _brute(char: str) -> float:
    """Guesses for one character, as a power of ten, by the class it is from."""
    if char.isdigit():
        return 1.0
    if char.isascii() and char.isalpha():
        return math.log10(26)
    return math.log10(33) if char.isascii() else math.log10(100)


def ranked(words: Iterable[str]) -> dict[str, int]:
    """Words with their ranks from 1 in the order given, of equal words the first."""
    return {word: i for i, word in enumerate(dict.fromkeys(words), 1)}


def _rank_table(spark: SparkSession, words: Iterable[str]) -> DataFrame:
    return spark.createDataFrame(list(ranked(words).items()), "word string, rank bigint")


def word_ranks(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``word, rank``: the common words in their order, and after them every word of the texts.

    Words are runs of ``LEAST_WORD`` letters or more, in lower case, that are in two different texts
    at least. Values in credential contexts are left out of the count, so a secret does not become a
    word by standing in many copies of a text. Words are ranked by the number of texts they are in,
    in steps of ``COUNT_STEPS`` to a doubling; the words of a step share the rank after all words of
    higher steps, so only the sizes of the steps, at most 63 * ``COUNT_STEPS``, reach the driver. The
    table is stored in the shared folder. Null texts have no words, repeated rows count each time, and
    an empty table leaves the common words.
    """
    spark = df.sparkSession
    text = quoted(text_col).cast("string")
    for pattern in (ASSIGN, CONTEXT):
        flag = "(?i)" if pattern.flags & re.IGNORECASE else ""
        text = F.regexp_replace(text, flag + pattern.pattern, " ")
    found = F.array_distinct(F.split(F.lower(text), r"[^\p{L}]+"))
    words = df.select(F.xxhash64(quoted(text_col)).alias("of"), F.explode(found).alias("word"))
    counted = words.filter(F.length("word") >= LEAST_WORD).groupBy("word").agg(
        F.count("*").alias("n"), F.min("of").alias("low"), F.max("of").alias("high")
    )
    common = ranked(COMMON_WORDS)
    step = F.floor(F.log2("n") * COUNT_STEPS).cast("int").alias("step")
    other = Stored(counted.filter((F.col("low") != F.col("high")) & ~F.col("word").isin(*common)).select("word", step)).df
    rank, ranks = len(common) + 1, []
    for row in sorted(other.groupBy("step").count().collect(), reverse=True):
        ranks.append((row["step"], rank))
        rank += row["count"]
    by_step = F.broadcast(spark.createDataFrame(ranks, "step int, rank bigint"))
    return _rank_table(spark, common).unionByName(other.join(by_step, "step").select("word", "rank"))


def _alike_ahead(hashed: np.ndarray, rolling: Rolling, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """How many characters from ``a`` on equal those from ``b`` on, ``most`` at most, by halving."""
    low, high = np.zeros_like(most), most.copy()
    while (open_ := low < high).any():
        middle = (low + high + 1) // 2
        same = rolling.stretches(hashed, a, a + middle) == rolling.stretches(hashed, b, b + middle)
        low = np.where(open_ & same, middle, low)
        high = np.where(open_ & ~same, middle - 1, high)
    return low


def periodic_stretches(value: str) -> list[tuple[int, int, int]]:
    """``start, end, period`` of all maximal stretches of at least two periods, with their least periods.

    A stretch of period ``p`` holds a multiple of ``p`` at which a character equals the one ``p`` places
    on. From each such pair the stretch is followed both ways by rolling hashes, and is then compared
    itself. There are about ``n * log(n)`` pairs, of which ``AT_ONCE`` are held at a time.
    """
    n = len(value)
    codes = np.frombuffer(value.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    rolling = Rolling(FIRST_BASE)
    ahead = rolling.prefix(mixed(codes.astype(np.uint64) + np.uint64(1)))
    back = rolling.prefix(mixed(codes[::-1].astype(np.uint64) + np.uint64(1)))
    least: dict[tuple[int, int], int] = {}
    period = 1
    while 2 * period <= n:
        last, total = period, 0
        while 2 * last <= n and (total := total + n // last) <= AT_ONCE:
            last += 1
        periods = np.arange(period, max(last, period + 1))
        times = (n - 1) // periods
        p = np.repeat(periods, times)
        at = (np.arange(len(p)) - np.repeat(np.cumsum(times) - times, times)) * p
        same = codes[at] == codes[at + p]
        p, at = p[same], at[same]
        after = _alike_ahead(ahead, rolling, at, at + p, n - at - p)
        before = _alike_ahead(back, rolling, n - at, n - at - p, at)
        enough = after + before >= p
        rows = np.unique(np.stack([at - before, at + p + after, p], axis=1)[enough], axis=0)
        for start, end, p in rows.tolist():
            if (start, end) not in least and np.array_equal(codes[start : end - p], codes[start + p : end]):
                least[start, end] = p
        period = int(periods[-1]) + 1
    return [(start, end, p) for (start, end), p in least.items()]


class _Repeats:
    """The least cost of a place from which the characters up to ``j`` repeat those before it.

    Within a stretch of period ``p`` from ``s`` these are the places a multiple of ``p`` before ``j`` and
    not before the middle of ``s`` and ``j``. The middle only moves on, so for each remainder the places
    that may still be the least are held in a queue.
    """

    def __init__(self, value: str):
        self.waiting = sorted(((s + 2 * p, s, e, p, {}) for s, e, p in periodic_stretches(value)), key=lambda x: x[:4], reverse=True)
        self.active: list = []

    def least(self, j: int, best: list[float]) -> float:
        while self.waiting and self.waiting[-1][0] == j:
            self.active.append(self.waiting.pop())
        cost, over = math.inf, False
        for _, start, end, period, queues in self.active:
            if j > end:
                over = True
                continue
            queue = queues.setdefault(j % period, deque())
            place = j - period
            while queue and best[queue[-1]] >= best[place]:
                queue.pop()
            queue.append(place)
            while 2 * queue[0] < j + start:
                queue.popleft()
            cost = min(cost, best[queue[0]])
        if over:
            self.active = [a for a in self.active if a[2] >= j]
        return cost


def _folded(value: str) -> tuple[str, str]:
    """In lower case, and so with digits and signs read as the letters they stand for."""
    plain = value.lower()
    if len(plain) != len(value):
        return value, value
    return plain, plain.translate(LEET)


def guess_cost(value: str, words: Mapping[str, int] | Collection[str] = COMMON_WORDS) -> float:
    """The power of ten of the guesses that the cheapest segmentation needs.

    ``words`` has ranks, or is in the order of them. ``best[j]`` is the least cost of the first ``j``
    characters, over all segments that end at ``j``: one character by brute force; a word, also in
    capitals or with signs for letters; a date; a walk of three keys or more; a repeat of what
    stands right before it, of any length. No segment is left out, so the cost is the minimum.
    """
    ranks = words if isinstance(words, Mapping) else ranked(words)
    lengths = sorted({len(word) for word in ranks if len(word) >= LEAST_WORD})
    plain, unleet = _folded(value)
    n = len(value)
    best = [0.0] * (n + 1)
    pair = walk = math.inf  # walks up to here of two keys, and of more
    repeats = _Repeats(value)

    for j in range(1, n + 1):
        cost = best[j - 1] + _brute(value[j - 1])
        for length in lengths:
            if (i := j - length) < 0:
                break
            rank, leet = ranks.get(plain[i:j]), ranks.get(unleet[i:j])
            if rank is not None or leet is not None:
                guesses = min(math.log10(rank) if rank else math.inf, math.log10(leet) + 1.0 if leet else math.inf)
                upper = 0.0 if value[i:j] == plain[i:j] else 1.0
                cost = min(cost, best[i] + guesses + 0.5 + upper)
        if plain[j - 1].isdigit():
            for i in range(max(0, j - LONGEST_DATE), j - SHORTEST_DATE + 1):
                if best[i] + DATE_GUESSES < cost and DATE.fullmatch(plain, i, j):
                    cost = best[i] + DATE_GUESSES
        # A walk starts with any key and then only chooses between going on and turning.
        if j >= 2 and (plain[j - 2], plain[j - 1]) in _NEXT:
            walk = min(walk, pair) + math.log10(2)
            pair = best[j - 2] + math.log10(47) + math.log10(2)
            cost = min(cost, walk)
        else:
            pair = walk = math.inf
        best[j] = min(cost, repeats.least(j, best) + REPEAT_GUESSES)
    return best[n]


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans of the patterns as (start, end, kind), those too short left out."""
    spans = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    spans += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    spans += [(m.start(), m.end(), "hex") for m in HEX.finditer(text) if m.end() - m.start() >= LEAST_HEX]
    return spans


def context_spans(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Values in credential contexts that no assignment covers."""
    if not any(mark in text for mark in "=:") and " is " not in text:
        return []
    covered = [(start, end) for start, end, kind in base if kind == "assign"]
    spans, at = [], 0
    for found in CONTEXT.finditer(text):
        start, end = found.span(1)
        while end > start and text[end - 1] in ".,;:!?)]}":
            end -= 1
        while at < len(covered) and covered[at][1] <= start:
            at += 1
        if end > start and not (at < len(covered) and covered[at][0] < end):
            spans.append((start, end, "guess"))
    return spans


def _in_order(spans: Iterable[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    return sorted(spans, key=lambda span: (span[0], KINDS.index(span[2])))


def scan(text: str, words: Mapping[str, int] | Collection[str] = COMMON_WORDS, least: float = SECRET_GUESSES) -> list[tuple[int, int, str]]:
    """All secrets of a text, by start and then by kind as listed in ``KINDS``."""
    base = base_spans(text)
    hard = [span for span in context_spans(text, base) if guess_cost(text[span[0] : span[1]], words) >= least]
    return _in_order(base + hard)


def pieces(value: str) -> Iterator[str]:
    """What may be words of a value: stretches of letters up to ``LONGEST_PIECE``, and longer runs whole."""
    for form in dict.fromkeys(_folded(value)):
        for run in re.findall(r"[^\W\d_]{%d,}" % LEAST_WORD, form):
            for i in range(len(run) - LEAST_WORD + 1):
                for j in range(i + LEAST_WORD, min(len(run), i + LONGEST_PIECE) + 1):
                    yield run[i:j]
            if len(run) > LONGEST_PIECE:
                yield run


def _pieces_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def batch(k1: int, k2: int, held: set[str]) -> pa.RecordBatch:
        keys = [pa.array([k] * len(held), pa.int64()) for k in (k1, k2)]
        return pa.RecordBatch.from_arrays([*keys, pa.array(list(held), pa.string())], names=["v1", "v2", "word"])

    for whole in batches:
        for row in range(whole.num_rows):
            k1, k2, value = (whole.column(c)[row].as_py() for c in range(3))
            held: set[str] = set()
            for piece in pieces(value):
                held.add(piece)
                if len(held) >= AT_ONCE:
                    yield batch(k1, k2, held)
                    held = set()
            if held:
                yield batch(k1, k2, held)


def _costs_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        costs = []
        for row in range(whole.num_rows):
            known = {k["word"]: k["rank"] for k in whole.column(3)[row].as_py() or ()}
            costs.append(guess_cost(whole.column(2)[row].as_py(), known))
        yield pa.RecordBatch.from_arrays([whole.column(0), whole.column(1), pa.array(costs, pa.float64())], names=["v1", "v2", "cost"])


def value_costs(values: DataFrame, ranks: DataFrame) -> DataFrame:
    """``v1, v2, cost``: the guess cost of each different ``value``, known by its two hashes ``v1, v2``.

    Pieces of the values are joined with the words; a value then has its own words and their ranks, so no
    task holds the vocabulary. A piece that many values share is dealt into ``SALTS`` parts.
    """
    different = Stored(values.dropDuplicates(["v1", "v2"]).select("v1", "v2", "value"))
    found = Stored(different.df.mapInArrow(_pieces_of, "v1 bigint, v2 bigint, word string"))
    known = ranks.join(found.df.select("word").distinct(), "word").withColumn("salt", _each_salt())
    salted = found.df.withColumn("salt", F.pmod("v1", F.lit(SALTS)).cast("int")).join(known, ["word", "salt"])
    per_value = salted.groupBy("v1", "v2").agg(F.collect_set(F.struct("word", "rank")).alias("known"))
    sent = different.df.join(per_value, ["v1", "v2"], "left").select("v1", "v2", "value", "known")
    costs = Stored(sent.mapInArrow(_costs_of, "v1 bigint, v2 bigint, cost double"))
    different.drop()
    found.drop()
    return costs.df


def _each_salt():
    return F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))


def find_secrets(
    df: DataFrame,
    text_col: str = "text",
    keep: list[str] | None = None,
    words: DataFrame | Collection[str] = COMMON_WORDS,
    least_guesses: float = SECRET_GUESSES,
) -> DataFrame:
    """Each row with its secrets.

    Added columns: ``kinds`` (array of string), ``starts``, ``ends`` (arrays of int, code
    points, end exclusive), ``guesses`` (array of double: the power of ten for the value of
    each span, as it was judged). A null or empty text has no spans. Rows are independent,
    so nulls in other columns, repeated rows and ties change nothing; an empty table gives
    an empty result; an input column of a result's name is replaced. ``words`` are what guessers
    try, the likeliest first, or a table ``word, rank`` of any size: ``word_ranks`` counts one.

    The texts are searched in one pass, whose rows are stored in the shared folder with the columns
    carried. Each different value is judged once. Only rows that have spans are joined with the costs,
    on hashes of the values, of which hot ones are dealt into ``SALTS`` parts.
    """
    names = ["kinds", "starts", "ends", "guesses"]
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in names]
    inner = [f"c{i}" for i in range(len(kept))]
    carried = [quoted(c).alias(place) for c, place in zip(kept, inner, strict=True)]
    ranks = words if isinstance(words, DataFrame) else _rank_table(df.sparkSession, words)

    def make():
        def work(texts):
            kinds, starts, ends, values = [], [], [], []
            for text in texts:
                base = base_spans(text) if text else []
                spans = _in_order(base + context_spans(text, base)) if text else []
                kinds.append([kind for _, _, kind in spans])
                starts.append([start for start, _, _ in spans])
                ends.append([end for _, end, _ in spans])
                values.append([value_of(text[s:e], kind) for s, e, kind in spans])
            return kinds, starts, ends, values

        return work

    results = "kinds array<string>, starts array<int>, ends array<int>, values array<string>"
    searched = map_texts(df.select(*carried, quoted(text_col).alias("searched")), "searched", results, make, inner)
    spans = Stored(searched.withColumn("row", F.monotonically_increasing_id())).df
    hashes = F.xxhash64("value").alias("v1"), F.xxhash64(F.lit(2), "value").alias("v2")
    each = spans.select("row", F.posexplode("values").alias("place", "value")).select("row", "place", "value", *hashes)
    costs = value_costs(each, ranks).withColumn("salt", _each_salt())
    met = each.drop("value").withColumn("salt", F.pmod("row", F.lit(SALTS)).cast("int")).join(costs, ["v1", "v2", "salt"])
    costed = F.sort_array(F.collect_list(F.struct("place", "cost")))
    per_row = met.groupBy("row").agg(costed.getField("cost").alias("costs"))

    some = spans.filter(F.size("kinds") > 0).join(per_row, "row")
    none = spans.filter(F.size("kinds") == 0).withColumn("costs", F.array().cast("array<double>"))
    zipped = F.arrays_zip("kinds", "starts", "ends", "costs")
    hard = F.filter(zipped, lambda x: (x["kinds"] != "guess") | (x["costs"] >= least_guesses))
    judged = some.unionByName(none).withColumn("spans", hard)
    return judged.select(*inner, *[F.col("spans").getField(c) for c in ("kinds", "starts", "ends", "costs")]).toDF(*kept, *names)


def value_of(span: str, kind: str) -> str:
    """The credential itself without the name it is assigned to."""
    if kind == "assign":
        return ASSIGN.match(span)[2]
    return span
