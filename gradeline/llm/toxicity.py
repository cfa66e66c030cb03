"""Toxicity of documents and of their sentences by multiple-instance learning.

Only documents are labelled. A sentence has a score by a hashed linear model; a document is
toxic if any of its sentences is, as a noisy-or of the scores. The model is fitted to the
documents' labels through the noisy-or and so learns which sentences offend.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from gradeline.llm.chars import Words, chunks, is_not_word, lowered, spans
from gradeline.llm.common import FIRST_BASE, Rolling, Stored, map_texts, mixed, quoted, row_key
from gradeline.llm.linear import BUCKETS, Bags, bounded_sample, fit_noisy_or, sigmoid

THRESHOLD = 0.3
SAMPLE_ROWS = 3000
# Fixed value: how many first characters of a word are features beside the whole of it.
BEGINNINGS = (3, 4, 5)


def _ends_sentence(char: str) -> bool:
    return char in ".!?\n"


class Sentences:
    """Sentences of some texts, those with words, and the features of each, every word once."""

    def __init__(self, texts: Sequence[str], rolling: Rolling):
        words = Words([lowered(text) for text in texts], is_not_word, rolling)
        points = words.points
        starts, ends = spans(points.where(_ends_sentence))
        of_word = np.searchsorted(starts, words.starts, "right") - 1
        once = np.unique(np.stack([of_word.astype(np.uint64), words.hashes]), axis=1, return_index=True)[1]
        once.sort()
        used, self.sentence = np.unique(of_word[once], return_inverse=True)
        begin = points.edges[:-1]
        self.text = np.searchsorted(begin, starts[used], "right") - 1
        self.starts, self.ends = starts[used] - begin[self.text], ends[used] - begin[self.text]
        salts = [np.uint64(0), *[np.uint64(n) for n in BEGINNINGS]]
        parts = [words.hashes, *[words.beginnings(n) for n in BEGINNINGS]]
        self.features = np.stack(
            [(mixed(part[once] + salt) % np.uint64(BUCKETS)).astype(np.int64) for part, salt in zip(parts, salts, strict=True)],
            axis=1,
        )

    def bags(self, n_texts: int) -> list[list[np.ndarray]]:
        """For each text the features of each of its sentences."""
        edges = np.searchsorted(self.sentence, np.arange(len(self.text) + 1))
        out: list[list[np.ndarray]] = [[] for _ in range(n_texts)]
        for i, text in enumerate(self.text):
            out[text].append(self.features[edges[i] : edges[i + 1]].ravel())
        return out


@dataclass(frozen=True)
class ToxicityModel:
    weights: np.ndarray
    bias: float


def sample_features(df: DataFrame, text_col: str, keep: list[str]) -> DataFrame:
    """Rows with ``features``, the hashed features of all sentences, and ``sizes`` of each.

    Both are 32-bit integers packed as binary.
    """

    def make():
        rolling = Rolling(FIRST_BASE)

        def work(texts):
            texts, bags = [text or "" for text in texts], []
            for part in chunks(texts):
                bags += Sentences(texts[part], rolling).bags(part.stop - part.start)
            none = np.zeros(0, dtype=np.int32)
            flat = [np.concatenate([none, *bag], dtype=np.int32, casting="unsafe").tobytes() for bag in bags]
            return [np.array([len(s) for s in bag], dtype=np.int32).tobytes() for bag in bags], flat

        return work

    return map_texts(df, text_col, "sizes binary, features binary", make, keep)


def fit_toxicity(
    df: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    allowed: Column | None = None,
    sample_rows: int = SAMPLE_ROWS,
) -> ToxicityModel:
    """Fit on at most ``sample_rows`` labelled documents of each class, one whole text of each.

    The sample is by the least hashes of the ids, so it is bounded whatever the input. Its features
    come to the driver file by file and wait on its disk, so their number does not count for memory. Labels
    other than 0 and 1 and null ids are left out; of several labels for one id the greatest
    counts. Without labels of both classes the model scores everything near 0.
    """
    clean = labels.filter(quoted(id_col).isNotNull() & quoted(label_col).isin(0, 1))
    if allowed is not None:
        clean = clean.filter(allowed)
    clean = clean.groupBy(quoted(id_col).alias("id")).agg(F.max(quoted(label_col)).cast("int").alias("label"))
    chosen = bounded_sample(clean, "label", ["id"], sample_rows)
    if len({row["label"] for row in chosen}) < 2:
        return ToxicityModel(np.zeros(BUCKETS), -35.0)
    numbered = [(row["id"], row["label"], n) for n, row in enumerate(chosen)]
    ids = df.sparkSession.createDataFrame(numbered, StructType([*clean.schema.fields, StructField("number", IntegerType())]))
    # The sample is bounded by sample_rows, so it may be broadcast.
    features = Stored(sample_features(_one_text_each(df, F.broadcast(ids), id_col, text_col), "text", ["number"]))
    bags = Bags()
    for row in features.df.toLocalIterator():
        bags.add(row["number"], row["sizes"], row["features"])
    features.drop()
    return ToxicityModel(*fit_noisy_or(bags, [label for _, label, _ in numbered]))


def _one_text_each(df: DataFrame, ids: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``number`` and ``text`` of the ids; of several rows of one id that of the least row hash.

    Each task first keeps one row of an id, so a repeated id moves one text a task at most.
    """
    key = F.struct(*row_key(id_col, text_col)).alias("key")
    texts = df.select(quoted(id_col).alias("id"), quoted(text_col).alias("text"), key)
    return texts.join(ids, "id").groupBy("number").agg(F.min_by("text", "key").alias("text"))


def score_toxicity(
    df: DataFrame,
    model: ToxicityModel,
    text_col: str = "text",
    keep: list[str] | None = None,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Each row with its ``score`` and the sentences that offend.

    Added columns: ``score`` (0 to 1), ``toxic`` (score at or above the threshold),
    ``sentence_starts``, ``sentence_ends`` (code points, end exclusive) and ``sentence_scores``
    of the sentences at or above the threshold. A null or empty text, or one without words,
    scores 0. Rows are independent; an empty table gives an empty result; an input column of a
    result's name is replaced. Nothing is shuffled.
    """
    sent = df.sparkSession.sparkContext.broadcast((model.weights.astype(np.float32), model.bias))

    def make():
        weights, bias = sent.value
        rolling = Rolling(FIRST_BASE)

        def work(texts):
            texts, scores, where = [text or "" for text in texts], [], []
            for part in chunks(texts):
                found, n = Sentences(texts[part], rolling), part.stop - part.start
                each = weights[found.features].sum(axis=1, dtype=np.float64)
                z = np.bincount(found.sentence, weights=each, minlength=len(found.text)) + bias
                p = sigmoid(z)
                none = np.bincount(found.text, weights=np.log1p(-p), minlength=n)
                scores += (-np.expm1(none)).tolist()
                bad = np.flatnonzero(p >= threshold)
                edges = np.searchsorted(found.text[bad], np.arange(n + 1))
                where += [(found.starts[x], found.ends[x], p[x]) for x in np.split(bad, edges[1:-1])]
            starts, ends, parts = ([w[i] for w in where] for i in range(3))
            return [s + 0.0 for s in scores], [s >= threshold for s in scores], starts, ends, parts

        return work

    results = (
        "score double, toxic boolean, sentence_starts array<int>, sentence_ends array<int>, "
        "sentence_scores array<double>"
    )
    return map_texts(df, text_col, results, make, keep)
