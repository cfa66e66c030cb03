"""Accuracies of overlapping labellers without true labels, by expectation-maximisation.

Only counts of vote patterns are needed, so the estimate is from every row of a corpus while
the driver holds at most ``3 ** labellers`` counts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUNDS = 100
SMOOTHING = 1.0


@dataclass(frozen=True)
class VoteModel:
    """``chance[class, labeller, vote + 1]`` and the share of each class; the last class is good.

    The others are ways of being bad, one for each labeller: defects seldom meet in one row,
    and a single bad class would take those that exclude each other for opposites.
    """

    share: np.ndarray
    chance: np.ndarray

    def beliefs(self, votes: np.ndarray) -> np.ndarray:
        """Chance of each class for rows of votes in -1, 0, 1."""
        labellers = np.arange(votes.shape[1])
        logs = np.log(self.share) + np.log(self.chance)[:, labellers, votes + 1].sum(axis=2).T
        logs -= logs.max(axis=1, keepdims=True)
        chances = np.exp(logs)
        return chances / chances.sum(axis=1, keepdims=True)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Chance of being good."""
        return self.beliefs(votes)[:, -1] if len(votes) else np.zeros(0)

    def accuracies(self) -> np.ndarray:
        """For each labeller the share of right ones among its votes, as estimated."""
        weight = self.share[:, None, None] * self.chance
        right = weight[:-1, :, 0].sum(axis=0) + weight[-1, :, 2]
        given = weight[:, :, 0].sum(axis=0) + weight[:, :, 2].sum(axis=0)
        return right / given


def fit_votes(patterns: np.ndarray, counts: np.ndarray) -> VoteModel:
    """Labellers err independently within a class.

    The start takes rows without a vote of -1 for good, and deals the others to the classes of
    the labellers that gave one.
    """
    labellers = patterns.shape[1]
    onehot = np.stack([patterns == v for v in (-1, 0, 1)], axis=2).astype(float)
    against = (patterns == -1).astype(float)
    times = against.sum(axis=1, keepdims=True)
    belief = np.hstack([against / np.maximum(times, 1), times == 0]) * 0.9 + 0.1 / (labellers + 1)
    model = VoteModel(np.full(labellers + 1, 1 / (labellers + 1)), np.full((labellers + 1, labellers, 3), 1 / 3))
    for _ in range(ROUNDS):
        weight = belief * counts[:, None]
        chance = np.einsum("pc,plv->clv", weight, onehot) + SMOOTHING
        share = weight.sum(axis=0) + SMOOTHING
        model = VoteModel(share / share.sum(), chance / chance.sum(axis=2, keepdims=True))
        if not len(patterns):
            break
        new = model.beliefs(patterns)
        if np.abs(new - belief).max() < 1e-7:
            break
        belief = new
    return model


def fit_from(df: DataFrame, votes_col: str, labellers: int) -> VoteModel:
    """Count the patterns of an array of votes over all rows, and fit."""
    rows = df.groupBy(votes_col).agg(F.count("*").alias("n")).collect()
    patterns = np.array([row[votes_col] for row in rows], dtype=np.int64).reshape(-1, labellers)
    return fit_votes(patterns, np.array([row["n"] for row in rows], dtype=float))
