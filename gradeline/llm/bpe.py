"""Byte-level BPE with a queue of ranks in a hierarchical bitmap.

Pre-tokens are linked lists of pieces. Every adjacent pair that the vocabulary can merge waits
in the bucket of its rank; a tree of bit words tells which buckets hold anything, so the next
rank is found by a find-first-set per level. An entry whose pair has changed meanwhile is stale
and skipped. All pre-tokens of a batch share one queue, for they do not touch each other, and a
bucket's merges are made together. Each merge costs a fixed number of steps, so a pre-token of a
million bytes takes time in proportion to its length.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from gradeline.llm.chars import chunks
from gradeline.llm.common import map_texts, quoted, to_batch

CACHED_BYTES = 48 << 20  # of the remembered parts and ids, with what the objects take
CACHED_LENGTH = 48
_OBJECTS = 180  # bytes of a remembered part beside its text and ids
CHUNK_CHARS = 1 << 22
_BITS = 64
_NONE = -1


def load_ranks(data: bytes) -> dict[bytes, int]:
    """Ranks by token from a rank file: a line is the token in base64 and its rank."""
    pairs = (line.split() for line in data.splitlines() if line)
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


class RankQueue:
    """Buckets of positions by rank, with a bitmap per level over the buckets in use."""

    def __init__(self, n_ranks: int):
        self.buckets: dict[int, list[np.ndarray]] = {}
        self.levels: list[list[int]] = []
        size = max(1, n_ranks)
        while True:
            size = (size + _BITS - 1) // _BITS
            self.levels.append([0] * size)
            if size == 1:
                break

    def push(self, rank: int, positions: np.ndarray) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            bucket.append(positions)
            return
        self.buckets[rank] = [positions]
        at = rank
        for words in self.levels:
            at, bit = divmod(at, _BITS)
            before = words[at]
            words[at] = before | 1 << bit
            if before:
                break

    def push_all(self, ranks: np.ndarray, positions: np.ndarray) -> None:
        """Positions by their ranks; those without a rank stay out."""
        have = ranks != _NONE
        ranks, positions = ranks[have], positions[have]
        if not len(ranks):
            return
        order = np.argsort(ranks, kind="stable")
        ranks, positions = ranks[order], positions[order]
        edges = np.flatnonzero(np.r_[True, ranks[1:] != ranks[:-1]])
        stops = [*edges[1:].tolist(), len(ranks)]
        for rank, start, stop in zip(ranks[edges].tolist(), edges.tolist(), stops, strict=True):
            self.push(rank, positions[start:stop])

    def pop_bucket(self) -> tuple[int, np.ndarray] | None:
        """The least rank in use with all its positions, in order, taken off."""
        if not self.levels[-1][0]:
            return None
        rank = 0
        for words in reversed(self.levels):
            word = words[rank]
            rank = rank * _BITS + ((word & -word).bit_length() - 1)
        at = rank
        for words in self.levels:
            at, bit = divmod(at, _BITS)
            words[at] &= ~(1 << bit)
            if words[at]:
                break
        found = self.buckets.pop(rank)
        return rank, np.sort(found[0]) if len(found) == 1 else np.unique(np.concatenate(found))


class Decoder:
    """The bytes of ids; holds nothing but the tokens."""

    def __init__(self, ranks: dict[bytes, int]):
        self.tokens = {rank: token for token, rank in ranks.items()}

    def decode(self, packed: bytes) -> bytes:
        tokens = self.tokens
        return b"".join([tokens[i] for i in memoryview(packed).cast("I")])


class Encoder:
    """Encodes with one vocabulary; ``pattern`` cuts a text into pre-tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.split = regex.compile(pattern).findall
        self.queue = RankQueue(max(ranks.values(), default=0) + 1)
        self.bytes = np.array([ranks.get(bytes([i]), _NONE) for i in range(256)], dtype=np.int64)
        self.pairs, self.merged = self._pairs(ranks)
        self.cache: dict[str, bytes] = {}
        self.cached = 0

    @staticmethod
    def _pairs(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
        """Every pair of tokens that together are a token, in order, and the rank of that token."""
        found = [
            (left << 32 | right, rank)
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if (left := ranks.get(token[:cut])) is not None and (right := ranks.get(token[cut:])) is not None
        ]
        found.sort()
        both = np.array(found, dtype=np.int64).reshape(-1, 2)
        return both[:, 0], both[:, 1]

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        if not len(self.pairs):
            return np.full(len(left), _NONE, dtype=np.int64)
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.merged[at], _NONE)

    def merge(self, pre_tokens: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pre-tokens one after another, and where those of each end."""
        sizes = np.fromiter(map(len, pre_tokens), dtype=np.int64, count=len(pre_tokens))
        token = self.bytes[np.frombuffer(b"".join(pre_tokens), dtype=np.uint8)]
        if (token == _NONE).any():
            raise ValueError("the vocabulary lacks a token for a byte")
        n = len(token)
        edges = np.concatenate([[0], np.cumsum(sizes)])
        of = np.repeat(np.arange(len(sizes)), sizes)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[edges[1:][sizes > 0] - 1] = _NONE  # the last piece of a pre-token
        before[edges[:-1][sizes > 0]] = _NONE
        # A pre-token that is a token is that token.
        known = np.array([self.ranks.get(x, _NONE) for x in pre_tokens], dtype=np.int64)
        whole = np.flatnonzero(known != _NONE)
        inside = (known != _NONE)[of]
        token[inside] = after[inside] = before[inside] = _NONE
        token[edges[whole]] = known[whole]

        rank_at = np.full(n, _NONE, dtype=np.int64)  # of the pair that begins here
        first = np.flatnonzero(after != _NONE)
        rank_at[first] = self._ranks(token[first], token[after[first]])
        queue = self.queue
        queue.push_all(rank_at[first], first)
        while (taken := queue.pop_bucket()) is not None:
            rank, at = taken
            at = at[rank_at[at] == rank]  # the rest are stale
            if len(at) > 1:
                at = _apart(at, after)
            if not len(at):
                continue
            found = self._merge_at(rank, at, token, after, before, rank_at)
            if found is None:
                # A new pair would go before the rest of this bucket: only the first of each pre-token now.
                leading = np.unique(of[at], return_index=True)[1]
                queue.push(rank, np.setdiff1d(at, at[leading]))
                found = self._merge_at(rank, at[leading], token, after, before, rank_at, force=True)
            queue.push_all(*found)
        kept = token != _NONE
        return token[kept], np.concatenate([[0], np.cumsum(kept)])[edges[1:]]

    def _merge_at(self, rank, at, token, after, before, rank_at, force=False):
        """Merge the pairs that begin at ``at``; returns the new pairs' ranks and positions.

        None, with nothing changed, if one of several merges makes a pair of a lesser rank.
        """
        joined = after[at]
        stop, previous = after[joined], before[at]
        has_stop, has_left = stop != _NONE, previous != _NONE
        # Of two merges side by side the right one's new token is what follows the left one's.
        next_token = np.where(has_stop, token[stop], 0)
        if len(at) > 1:
            beside = stop[:-1] == at[1:]
            next_token[:-1][beside] = rank
            has_left[1:] &= ~beside
        right = np.where(has_stop, self._ranks(np.int64(rank), next_token), _NONE)
        previous = previous[has_left]
        left = self._ranks(token[previous], np.int64(rank))
        if not force and len(at) > 1 and (_before(right, rank) or _before(left, rank)):
            return None
        token[at], token[joined] = rank, _NONE
        after[at] = stop
        before[stop[has_stop]] = at[has_stop]
        rank_at[joined] = _NONE
        rank_at[at] = right
        rank_at[previous] = left
        return np.concatenate([right, left]), np.concatenate([at, previous])

    def _packed(self, parts: list[str]) -> list[bytes]:
        """The packed ids of each part."""
        tokens = [[p] if p[:1] == " " and p[1:].isalpha() else self.split(p) for p in parts]
        ids, ends = self.merge([t.encode("utf-8", "surrogatepass") for part in tokens for t in part])
        at = np.cumsum(np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens)))
        bounds = (4 * np.concatenate([[0], ends])[at]).tolist()
        packed = ids.astype("<u4").tobytes()
        return [packed[a:b] for a, b in zip([0, *bounds], bounds, strict=False)]

    def encode(self, texts: Sequence[str], parts: Callable[[str], list[str]] | None = None) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers.

        ``parts`` cuts a text before single spaces, which it drops, into parts whose pre-tokens
        are those of the text. The ids of short parts are remembered. A space with letters after
        it is one pre-token.
        """
        out: list[bytes] = []
        for chunk in chunks(texts, CHUNK_CHARS):
            cut = [parts(text) if parts else [text] for text in texts[chunk]]
            heads = [text.pop(0) for text in cut]
            if self.cached >= CACHED_BYTES:
                self.cache.clear()
                self.cached = 0
            first = list(set(heads))
            new = list(set().union(*cut).difference(self.cache))
            packed = self._packed(first + [" " + part for part in new])
            begun = dict(zip(first, packed, strict=False))
            self.cache.update(zip(new, packed[len(first) :], strict=True))
            get = self.cache.__getitem__
            out += [begun[head] + b"".join(map(get, text)) for head, text in zip(heads, cut, strict=True)]
            for part in new:
                if len(part) > CACHED_LENGTH:
                    del self.cache[part]
                else:
                    self.cached += _OBJECTS + len(part) + len(self.cache[part])
        return out


def _before(ranks: np.ndarray, rank: int) -> bool:
    return bool(((ranks != _NONE) & (ranks <= rank)).any())


def _apart(at: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Of pairs that share a piece, as in ``aaa``, every second one from the left."""
    shares = after[at[:-1]] == at[1:]
    if not shares.any():
        return at
    begins = np.r_[True, ~shares]
    place = np.arange(len(at))
    first = np.maximum.accumulate(np.where(begins, place, 0))
    return at[(place - first) % 2 == 0]


_TWO_SPACES = regex.compile(r"\s\s")
_BREAK = regex.compile(r"(?<=\S)(?= \S)")


def words_apart(text: str) -> list[str]:
    """Cut at each single space that stands between two other characters, and drop it.

    A pattern whose matches take at most one leading space, with all letters after it, and
    which looks ahead only from white space for white space, gives the same matches on the
    parts, each but the first after a space, as on the whole.
    """
    if not _TWO_SPACES.search(text):
        return text.split(" ")
    first, *rest = _BREAK.split(text)
    return [first, *[part[1:] for part in rest]]


def encode_texts(
    df: DataFrame,
    ranks_path: str,
    pattern: str,
    text_col: str = "text",
    keep: list[str] | None = None,
    decode: bool = False,
) -> DataFrame:
    """Each row with ``ids`` (binary: little-endian unsigned 32-bit integers) and ``n_tokens``.

    With ``decode`` also ``decoded`` (binary), the bytes that the ids stand for, in the same pass, so
    that a core has one Python worker and not two. A null or empty text has no ids. Rows are independent; an empty table gives an empty
    result; an input column of a result's name is replaced. A very long text, or a text
    that is one very long pre-token, is encoded whole. The vocabulary, of a fixed size, is
    read once by the driver and sent to the executors. Nothing is shuffled.
    """
    vocabulary = _vocabulary(df.sparkSession, ranks_path)

    def make():
        ranks = load_ranks(vocabulary.value)
        encoder, decoder = Encoder(ranks, pattern), Decoder(ranks)

        def work(texts):
            ids = encoder.encode([text or "" for text in texts], words_apart)
            counts = [len(packed) // 4 for packed in ids]
            return (counts, ids, [decoder.decode(packed) for packed in ids]) if decode else (counts, ids)

        return work

    return map_texts(df, text_col, "n_tokens bigint, ids binary" + ", decoded binary" * decode, make, keep)


def decode_ids(df: DataFrame, ranks_path: str, ids_col: str = "ids") -> DataFrame:
    """Each row with ``decoded`` (binary), the bytes its ids stand for; null ids give none."""
    vocabulary = _vocabulary(df.sparkSession, ranks_path)
    added = StructType.fromDDL("decoded binary")
    kept = [c for c in df.columns if c.lower() != "decoded"]
    selected = df.select(*[quoted(c).alias(f"__{i}") for i, c in enumerate(kept)])
    schema = StructType(selected.schema.fields + added.fields)
    at = kept.index(ids_col)

    def run(batches):
        decoder = Decoder(load_ranks(vocabulary.value))
        for batch in batches:
            decoded = to_batch(added, [[decoder.decode(x or b"") for x in batch.column(at).to_pylist()]])
            yield pa.RecordBatch.from_arrays([*batch.columns, decoded.column(0)], names=schema.names)

    return selected.mapInArrow(run, schema).toDF(*kept, "decoded")


def _vocabulary(spark: SparkSession, path: str):
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())
