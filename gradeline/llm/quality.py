"""Quality of documents from weak labels: heuristics vote, their accuracies are estimated, and
the posterior labels train a hashed linear scorer."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeline.llm.chars import Words, chunks, grams, is_space
from gradeline.llm.common import FIRST_BASE, Rolling, Stored, map_texts, mixed, row_key
from gradeline.llm.linear import BUCKETS, bucket, fit_logistic, sigmoid
from gradeline.llm.weak import VoteModel, fit_from

KEEP_SCORE = 0.5
SAMPLE_ROWS = 10_000
# Characters that prose seldom holds.
SYMBOLS = frozenset("#$%&*|~^<>{}[]\\=+_@/`")
LABELLERS = ("symbols", "capitals", "exclamation", "stutter", "recurrence", "wordless", "sentences", "length")
SHAPE_RUNS = 6


def _is_symbol(char: str) -> bool:
    return char in SYMBOLS


def _is_end(char: str) -> bool:
    return char in ".!?"


class Reading:
    """What the votes and the features of some texts are made from, one row per text."""

    def __init__(self, texts: Sequence[str | None], rolling: Rolling):
        words = Words([text or "" for text in texts], is_space, rolling)
        points, self.edges = words.points, words.edges
        starts, ends = words.starts, words.ends
        letter, capital = points.where(str.isalpha), points.where(str.isupper)
        exclaims = points.points == ord("!")
        exclaims = exclaims & np.r_[False, exclaims[:-1]]
        self.text_of = words.text_of
        self.n = np.diff(words.edges)
        self.length = self._sum(ends - starts)
        self.symbols, self.letters, self.capitals, self.exclaims = (
            np.diff(np.r_[0, np.cumsum(flag)][points.edges])
            for flag in (points.where(_is_symbol), letter, capital, exclaims)
        )
        letters = np.r_[0, np.cumsum(letter)]
        self.wordless = self._sum(letters[ends] == letters[starts])
        self.ends = self._sum(points.where(_is_end)[ends - 1])
        same = np.r_[False, words.hashes[1:] == words.hashes[:-1]]
        same[words.edges[:-1][self.n > 0]] = False
        self.stutters = self._sum(same)
        trigrams, first = grams(words.hashes, words.edges, 3, rolling)
        text = self.text_of[first]
        kinds, times = np.unique(trigrams ^ mixed(text + 1), return_inverse=True, return_counts=True)[1:]
        self.recurring = np.bincount(text[times[kinds] > 1], minlength=len(self.n))
        self.shapes = self._shapes(points, letter, capital, starts, ends, rolling)

    def _sum(self, of_words: np.ndarray) -> np.ndarray:
        return np.diff(np.r_[0, np.cumsum(of_words)][self.edges])

    @staticmethod
    def _shapes(points, letter, capital, starts, ends, rolling) -> np.ndarray:
        """Hash of the classes of the first runs of like characters of each word, as in ``Aa.``"""
        code = np.where(letter, np.where(capital, 1, 2), np.where(points.where(str.isdigit), 3, points.points + 8))
        begins = np.r_[True, code[1:] != code[:-1]]
        begins[starts] = True
        at = np.flatnonzero(begins)
        first = np.searchsorted(at, starts)
        last = np.minimum(np.searchsorted(at, ends), first + SHAPE_RUNS)
        return rolling.stretches(rolling.prefix(mixed(code[at])), first, last)

    def votes(self) -> np.ndarray:
        """One vote of each labeller: 1 good, -1 bad, 0 none; no words give only the vote on length."""
        n, one = self.n, np.maximum(self.n, 1)
        capitals = np.where(self.letters > 0, self.capitals / np.maximum(self.letters, 1), 1.0)
        ends = self.ends / one
        votes = np.zeros((len(n), len(LABELLERS)), dtype=np.int64)
        # Less of one defect says nothing of the others: most labellers only vote against.
        votes[self.symbols >= 0.04 * np.maximum(self.length, 1), 0] = -1
        votes[(capitals >= 0.003) & (capitals <= 0.1), 1] = 1
        votes[capitals >= 0.3, 1] = -1
        votes[self.exclaims >= 0.1 * one, 2] = -1
        votes[self.stutters >= 0.15 * one, 3] = -1
        votes[(n >= 20) & (self.recurring >= 0.6 * np.maximum(n - 2, 1)), 4] = -1
        votes[self.wordless >= 0.2 * one, 5] = -1
        votes[n >= 30, 6] = np.where((ends >= 0.01) & (ends <= 0.4), 1, -1)[n >= 30]
        votes[n == 0] = 0
        votes[n <= 2, 7] = -1
        return votes

    def features(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, bucket and value of each feature: shares of word shapes, of pairs of shapes, of
        stutters and of recurring trigrams, and the mark of being empty."""
        pair = self.text_of[1:] == self.text_of[:-1]
        pairs = mixed(self.shapes[:-1] + np.uint64(3) * self.shapes[1:])[pair]
        names = np.r_[self.shapes, pairs] % np.uint64(BUCKETS)
        texts = np.r_[self.text_of, self.text_of[1:][pair]]
        kinds, times = np.unique(texts * BUCKETS + names.astype(np.int64), return_counts=True)
        text, at = np.divmod(kinds, BUCKETS)
        every = np.arange(len(self.n))
        extra = [(bucket("<stutter>"), self.stutters), (bucket("<recurring>"), self.recurring)]
        extra += [(bucket("<empty>"), (self.n == 0).astype(np.int64))]
        text = np.r_[text, np.tile(every, len(extra))]
        at = np.r_[at, np.repeat([b for b, _ in extra], len(every))]
        value = np.sqrt(np.r_[times, np.concatenate([x for _, x in extra])] / np.maximum(self.n, 1)[text])
        order = np.argsort(text, kind="stable")
        return text[order], at[order], value[order]


@dataclass(frozen=True)
class QualityModel:
    votes: VoteModel
    weights: np.ndarray
    bias: float


def with_votes(df: DataFrame, text_col: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """Each row with ``votes``, one of -1, 0 and 1 for each of ``LABELLERS``."""

    def make():
        rolling = Rolling(FIRST_BASE)

        def work(texts):
            texts = [text or "" for text in texts]
            return [[v for part in chunks(texts) for v in Reading(texts[part], rolling).votes().tolist()]]

        return work

    return map_texts(df, text_col, "votes array<int>", make, keep)


def fit_quality(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    sample_rows: int = SAMPLE_ROWS,
) -> QualityModel:
    """Estimate the labellers on all rows and fit the scorer on at most ``sample_rows`` of them.

    No true label is used. The votes of every row are counted by pattern. The sample, half of
    it believed good and half believed bad where there are as many, is that of the least hashes.
    """
    keyed = df.select(*row_key(id_col, text_col), F.col(f"`{text_col}`").alias("text"))
    voted = Stored(with_votes(keyed, "text", ["k1", "k2"]))
    model = fit_from(voted.df, "votes", len(LABELLERS))
    patterns = [row["votes"] for row in voted.df.select("votes").distinct().collect()]
    if not patterns:
        return QualityModel(model, np.zeros(BUCKETS), 0.0)
    belief = model.posterior(np.array(patterns, dtype=np.int64))
    sample = None
    for good in (False, True):
        # Beliefs belong to patterns, of which there are at most 3 ** labellers.
        side = [p for p, b in zip(patterns, belief, strict=True) if (b >= 0.5) == good]
        if not side:
            continue
        wanted = df.sparkSession.createDataFrame([(p,) for p in side], "votes array<int>")
        rows = voted.df.join(F.broadcast(wanted), "votes").orderBy("k1", "k2").limit(sample_rows // 2).select(*voted.df.columns)
        sample = rows if sample is None else sample.unionByName(rows)
    ids = df.sparkSession.createDataFrame(sample.collect(), voted.df.schema).dropDuplicates(["k1", "k2"])
    voted.drop()

    def make():
        rolling = Rolling(FIRST_BASE)

        def work(texts):
            texts, at, share = [text or "" for text in texts], [], []
            for part in chunks(texts):
                text, index, value = Reading(texts[part], rolling).features()
                edges = np.searchsorted(text, np.arange(part.stop - part.start + 1)).tolist()
                at += [index[a:b] for a, b in zip(edges, edges[1:], strict=False)]
                share += [value[a:b] for a, b in zip(edges, edges[1:], strict=False)]
            return at, share

        return work

    chosen = keyed.join(F.broadcast(ids), ["k1", "k2"]).dropDuplicates(["k1", "k2"])
    rows = map_texts(chosen, "text", "at array<int>, share array<double>", make, ["votes"]).collect()
    targets = model.posterior(np.array([r["votes"] for r in rows], dtype=np.int64))
    at, share = ([np.array(r[c]) for r in rows] for c in ("at", "share"))
    return QualityModel(model, *fit_logistic(at, share, targets))


def score_quality(
    df: DataFrame,
    model: QualityModel,
    text_col: str = "text",
    keep: list[str] | None = None,
    least: float = KEEP_SCORE,
) -> DataFrame:
    """Each row with ``score`` (0 to 1, higher: better) and ``kept`` (score at or above ``least``).

    A null or empty text is scored like any other, by the feature of being empty. Rows are
    independent; an empty table gives an empty result; an input column of a result's name is
    replaced. Nothing is shuffled.
    """
    sent = df.sparkSession.sparkContext.broadcast((model.weights.astype(np.float32), model.bias))

    def make():
        weights, bias = sent.value
        rolling = Rolling(FIRST_BASE)

        def work(texts):
            texts, scores = [text or "" for text in texts], []
            for part in chunks(texts):
                text, at, value = Reading(texts[part], rolling).features()
                z = np.bincount(text, weights=weights[at] * value, minlength=part.stop - part.start)
                scores += sigmoid(z + bias).tolist()
            return scores, [score >= least for score in scores]

        return work

    return map_texts(df, text_col, "score double, kept boolean", make, keep)
