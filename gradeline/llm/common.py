"""Shared helpers: passes over texts, intermediate tables, word hashes."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gradeline.sources.tables import scratch_dir

# Arrow's type for each result type in use.
ARROW_TYPES = {
    "bigint": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
    "string": pa.string(),
    "binary": pa.binary(),
    "array<string>": pa.list_(pa.string()),
    "array<int>": pa.list_(pa.int32()),
    "array<bigint>": pa.list_(pa.int64()),
    "array<double>": pa.list_(pa.float64()),
}
_TEXT = "__text"
ROWS_AT_ONCE = 1000  # texts of a batch that are worked on together, which bounds what a worker holds

Texts = list[str | None]
Work = Callable[[Texts], Sequence[Sequence]]


def quoted(name: str) -> Column:
    """The column of exactly that name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_key(id_col: str, text_col: str) -> list[Column]:
    """Two longs that stand for an id with its text; equal rows have equal keys."""
    parts = [quoted(id_col).cast("string"), quoted(text_col)]
    return [F.xxhash64(*parts).alias("k1"), F.xxhash64(F.lit("second"), *parts).alias("k2")]


def to_batch(schema: StructType, columns: Sequence[Sequence]) -> pa.RecordBatch:
    arrays = [
        pa.array(values, type=ARROW_TYPES[field.dataType.simpleString()])
        for field, values in zip(schema, columns, strict=True)
    ]
    return pa.RecordBatch.from_arrays(arrays, names=schema.names)


def map_texts(
    df: DataFrame,
    text_col: str,
    results: str,
    make: Callable[[], Work],
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Add result columns computed from the whole text of each row, batch by batch.

    ``make`` is called once per task and returns the function from a list of texts to
    the result columns. ``keep`` names the input columns to carry, all by default; one
    that has the name of a result is replaced by it.
    """
    added = StructType.fromDDL(results)
    taken = {name.lower() for name in added.names}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in taken]
    # Columns go by their places meanwhile, for a name may hold a dot or a backtick, or be of a result.
    inner = [f"__{i}" for i in range(len(kept))]
    carried = [quoted(c).alias(place) for c, place in zip(kept, inner, strict=True)]
    selected = df.select(*carried, quoted(text_col).cast("string").alias(_TEXT))
    schema = StructType(selected.schema.fields[:-1] + added.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in (whole.slice(i, ROWS_AT_ONCE) for whole in batches for i in range(0, whole.num_rows, ROWS_AT_ONCE)):
            results = to_batch(added, work(batch.column(len(kept)).to_pylist()))
            arrays = [batch.column(i) for i in range(len(kept))]
            arrays += [results.column(i) for i in range(len(added))]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return selected.mapInArrow(run, schema).toDF(*kept, *added.names)


#: Removes the shuffle files of a query when it ends. Nothing reads them after a table is written.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Stored:
    """A table written once to the shared folder, which also cuts the lineage.

    The shuffle files of the write go when it ends, not when the driver next collects its garbage.
    """

    def __init__(self, df: DataFrame, compression: str | None = None):
        spark = df.sparkSession
        self.path = f"{scratch_dir(spark)}/llm-{uuid.uuid4().hex}"
        before = spark.conf.get(CLEANUP)
        spark.conf.set(CLEANUP, "true")
        try:
            df.write.parquet(self.path, compression=compression)
        finally:
            spark.conf.set(CLEANUP, before)
        self.df = spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        """Remove the files; only for tables that no result reads any more."""
        spark = self.df.sparkSession
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values, so that every bit depends on all."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


class Rolling:
    """Karp-Rabin hashes modulo 2**64 of stretches of a sequence of word hashes."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) <= n:
            size = max(2 * len(self.up), n + 1)
            factors = np.full(size, self.base, dtype=np.uint64)
            factors[0] = 1
            self.up = np.multiply.accumulate(factors)
            factors = np.full(size, self.inverse, dtype=np.uint64)
            factors[0] = 1
            self.down = np.multiply.accumulate(factors)

    def prefix(self, hashes: np.ndarray) -> np.ndarray:
        self._powers(len(hashes))
        sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
        np.cumsum(hashes * self.up[: len(hashes)], out=sums[1:])
        return sums

    def stretches(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((prefix[end] - prefix[start]) * self.down[start])

    def grams(self, hashes: np.ndarray, n: int) -> np.ndarray:
        """The hash of each stretch of ``n`` words."""
        if len(hashes) < n:
            return np.zeros(0, dtype=np.uint64)
        start = np.arange(len(hashes) - n + 1)
        return self.stretches(self.prefix(hashes), start, start + n)


# Odd multipliers of the two independent rolling hashes.
FIRST_BASE = 0x9E3779B97F4A7C15
SECOND_BASE = 0xD6E8FEB86659FD93
