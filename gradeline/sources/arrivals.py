"""A ledger of the files that loads have brought: late, repeated and changed ones are told apart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# What a file can be to a ledger.
ARRIVED = ("new", "late", "repeated", "changed")
MISSING = "missing"
LEDGER = "source_file string, status string, row_count bigint, digest string"


def digest_files(df: DataFrame, file_column: str = "_SOURCE_FILE", ignored: Sequence[str] = ("_INGESTION_TIMESTAMP",)) -> DataFrame:
    """``source_file, row_count, digest`` of each file of a loaded table.

    The digest adds up two hashes of every row and of where its NULLs are, so it does not depend on
    the order of the rows, and repeated rows count. Sums are combined in each task, so a file of a
    third of all rows costs it one row.
    """
    skipped = {name.upper() for name in (*ignored, file_column)}
    parts = [p for c in sorted(df.columns) if c.upper() not in skipped for p in (F.col(c), F.col(c).isNull())]

    def total(seed: str):
        # Parts of 24 bits, whose sum over half a trillion rows is still a long.
        h = F.xxhash64(F.lit(seed), *parts)
        return [F.sum(F.shiftrightunsigned(h, 40)), F.sum(h.bitwiseAND(F.lit((1 << 24) - 1)))]

    sums = [s.cast("string") for seed in ("first", "second") for s in total(seed)]
    files = df.groupBy(F.col(file_column).alias("source_file"))
    return files.agg(F.count("*").alias("row_count"), F.concat_ws("-", *sums).alias("digest"))


def arrival_status(arrived: DataFrame, ledger: DataFrame, expected: Sequence[str] = ()) -> DataFrame:
    """The next entries of the ledger: ``source_file, status, row_count, digest``.

    ``arrived`` is what ``digest_files`` gives for this load and ``ledger`` all entries so far. A file
    is ``repeated`` if it came before with the same digest at any time, ``changed`` if only with
    others, ``late`` if it was only ever noted as missing, and ``new`` otherwise. An expected file
    that neither came now nor before is ``missing``. The ledger has a row per file and load, and is
    grouped to one per file before it meets the files of this load.
    """
    spark = arrived.sparkSession
    came = F.col("status") != MISSING
    known = ledger.groupBy("source_file").agg(
        F.count_if(came).alias("times"), F.collect_set(F.when(came, F.col("digest"))).alias("digests")
    )
    joined = arrived.join(known, arrived["source_file"].eqNullSafe(known["source_file"]), "left").drop(known["source_file"])
    status = (
        F.when(F.col("times").isNull(), "new")
        .when(F.col("times") == 0, "late")
        .when(F.array_contains("digests", F.col("digest")), "repeated")
        .otherwise("changed")
    )
    entries = joined.select("source_file", status.alias("status"), "row_count", "digest")
    wanted = spark.createDataFrame([(name,) for name in expected], "source_file string")
    absent = wanted.join(arrived, "source_file", "left_anti").join(ledger.filter(came), "source_file", "left_anti")
    nothing = [F.lit(MISSING).alias("status"), F.lit(0).cast("bigint").alias("row_count"), F.lit(None).cast("string").alias("digest")]
    return entries.unionByName(absent.select("source_file", *nothing))
