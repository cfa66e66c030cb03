"""Hashed features and the linear models that are fitted on bounded samples."""

from __future__ import annotations

import tempfile
import zlib
from collections.abc import Iterable, Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 18
EPOCHS = 30
BATCH = 256
RATE = 0.5
#: Features that are in memory at a time while bags are fitted.
PIECE = 1 << 20


def bucket(feature: str, buckets: int = BUCKETS) -> int:
    return zlib.crc32(feature.encode("utf-8", "surrogatepass")) % buckets


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35.0, 35.0)))


def bounded_sample(df: DataFrame, group: str, by: Sequence[str], rows: int) -> list:
    """At most ``rows`` rows of each value 0 and 1 of ``group``, those with the least hash of ``by``.

    The choice depends on the rows alone, and each task keeps no more than the bound.
    """
    out = []
    for value in (0, 1):
        part = df.filter(F.col(group) == value)
        out += part.orderBy(F.xxhash64(*by), *by).limit(rows).collect()
    return out


class _Rows:
    """Rows of sparse features end to end."""

    def __init__(self, indices: Sequence[np.ndarray], values: Sequence[np.ndarray] | None = None):
        self.sizes = np.array([len(x) for x in indices], dtype=np.int64)
        self.edges = np.r_[0, np.cumsum(self.sizes)]
        self.indices = np.concatenate([*indices, np.zeros(0, dtype=np.int32)], dtype=np.int32, casting="unsafe")
        self.values = None if values is None else np.concatenate([*values, np.zeros(0)]).astype(np.float64)

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray | float]:
        """Row number within ``rows``, index and value of each feature; one value if all are 1."""
        sizes = self.sizes[rows]
        local = np.repeat(np.arange(len(rows)), sizes)
        offset = np.arange(len(local)) - np.repeat(np.r_[0, np.cumsum(sizes)[:-1]], sizes)
        at = np.repeat(self.edges[rows], sizes) + offset
        return local, self.indices[at], 1.0 if self.values is None else self.values[at]


class _AdaGrad:
    def __init__(self, buckets: int, bias: float, rate: float):
        self.weights, self.bias, self.rate = np.zeros(buckets), bias, rate
        self.seen, self.seen_bias = np.full(buckets, 1e-6), 1e-6

    def step(self, gradient: np.ndarray, bias_gradient: float) -> None:
        self.seen += gradient**2
        self.weights -= self.rate * gradient / np.sqrt(self.seen) * (gradient != 0)
        self.seen_bias += bias_gradient**2
        self.bias -= self.rate * bias_gradient / np.sqrt(self.seen_bias)


def _batches(n: int, epochs: int) -> Iterable[np.ndarray]:
    order = np.random.default_rng(7)
    for _ in range(epochs):
        shuffled = order.permutation(n)
        for at in range(0, n, BATCH):
            yield shuffled[at : at + BATCH]


def fit_logistic(
    indices: Sequence[np.ndarray],
    values: Sequence[np.ndarray],
    targets: np.ndarray,
    buckets: int = BUCKETS,
    epochs: int = EPOCHS,
    penalty: float = 1e-4,
) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic model of targets between 0 and 1."""
    rows, model = _Rows(indices, values), _AdaGrad(buckets, 0.0, RATE)
    for chosen in _batches(len(targets), epochs):
        local, at, value = rows.take(chosen)
        z = np.bincount(local, weights=model.weights[at] * value, minlength=len(chosen)) + model.bias
        error = (sigmoid(z) - targets[chosen]) / len(chosen)
        gradient = np.bincount(at, weights=error[local] * value, minlength=buckets)
        model.step(gradient + penalty * model.weights * (gradient != 0), float(error.sum()))
    return model.weights, model.bias


class Bags:
    """Bags of instances of features, which lie end to end in a file of the local temp folder.

    Only the sizes are in memory, and the file has no name and goes with this object. ``add`` takes
    what one bag has: the packed sizes of its instances and their packed features.
    """

    def __init__(self):
        self._file = tempfile.TemporaryFile()
        self._sizes: dict[int, tuple[np.ndarray, int]] = {}
        self._end = 0

    def add(self, number: int, sizes: bytes, features: bytes) -> None:
        self._file.write(features)
        self._sizes[number] = np.frombuffer(sizes, dtype=np.int32), self._end
        self._end += len(features) // 4

    def in_order(self) -> tuple[list[int], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of the bags, ascending; first instance of each; first feature and size of each instance; features."""
        self._file.flush()
        flat = np.memmap(self._file, dtype=np.int32, mode="r") if self._end else np.zeros(0, dtype=np.int32)
        numbers = sorted(self._sizes)
        sizes = [self._sizes[n][0].astype(np.int64) for n in numbers]
        starts = [self._sizes[n][1] + np.cumsum(size) - size for n, size in zip(numbers, sizes, strict=True)]
        none = np.zeros(0, dtype=np.int64)
        edges = np.r_[0, np.cumsum([len(size) for size in sizes], dtype=np.int64)]
        return numbers, edges, np.concatenate([none, *starts]), np.concatenate([none, *sizes]), flat


def _pieces(sizes: np.ndarray, most: int = PIECE) -> Iterable[slice]:
    """Consecutive instances of about ``most`` features together; a larger one is alone."""
    ends = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + most, "right")))
        yield slice(start, stop)
        start = stop


def fit_noisy_or(
    bags: Bags,
    labels: Sequence[int],
    buckets: int = BUCKETS,
    epochs: int = EPOCHS,
    penalty: float = 1e-4,
    bias: float = -5.0,
) -> tuple[np.ndarray, float]:
    """Weights and bias of instance scores whose noisy-or explains the label of each bag.

    With p the instances' scores, P = 1 - prod(1 - p). The gradient of the log loss at the
    margin of an instance is p for a bag of label 0 and -p (1 - P) / P for one of label 1.
    ``labels`` has that of each bag by its number. No more than a piece of the features of a
    batch is in memory at a time.
    """
    numbers, edges, starts, sizes, flat = bags.in_order()
    targets = np.array([labels[n] for n in numbers])
    model = _AdaGrad(buckets, bias, RATE)
    for chosen in _batches(len(numbers), epochs):
        instances = np.concatenate([np.arange(edges[b], edges[b + 1]) for b in chosen])
        bag_of = np.repeat(np.arange(len(chosen)), edges[chosen + 1] - edges[chosen])
        if not len(instances):
            continue
        z = np.empty(len(instances))
        for piece in _pieces(sizes[instances]):
            local, at = _features(instances[piece], starts, sizes, flat)
            z[piece] = np.bincount(local, weights=model.weights[at], minlength=piece.stop - piece.start)
        p = sigmoid(z + model.bias)
        none = np.exp(np.bincount(bag_of, weights=np.log1p(-p), minlength=len(chosen)))
        some = np.maximum(1.0 - none, 1e-6)
        factor = np.where(targets[chosen] == 1, -none / some, 1.0)
        error = factor[bag_of] * p / len(chosen)
        gradient = np.zeros(buckets)
        for piece in _pieces(sizes[instances]):
            local, at = _features(instances[piece], starts, sizes, flat)
            gradient += np.bincount(at, weights=error[piece][local], minlength=buckets)
        model.step(gradient + penalty * model.weights * (gradient != 0), float(error.sum()))
    return model.weights, model.bias


def _features(instances: np.ndarray, starts: np.ndarray, sizes: np.ndarray, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of the instance within ``instances``, and index, of each feature."""
    size = sizes[instances]
    local = np.repeat(np.arange(len(instances)), size)
    offset = np.arange(len(local)) - np.repeat(np.cumsum(size) - size, size)
    return local, np.asarray(flat[np.repeat(starts[instances], size) + offset])
