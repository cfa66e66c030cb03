"""Have all expected source files arrived?"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def missing_sources(
    df: DataFrame, expected: Sequence[str], column: str = "_SOURCE_FILE"
) -> DataFrame:
    """Expected file names that no row of the loaded table carries.

    Only rows of expected files are looked at, so the distinct names that reach the
    join are at most ``len(expected)`` and the broadcast is bounded by it.
    """
    spark = df.sparkSession
    wanted = spark.createDataFrame([(name,) for name in expected], "missing_file string")
    arrived = (
        df.filter(F.col(column).isin(*expected))
        .select(F.col(column).alias("missing_file"))
        .distinct()
    )
    return wanted.join(F.broadcast(arrived), "missing_file", "left_anti")
