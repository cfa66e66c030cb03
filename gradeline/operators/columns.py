"""Column shaping: names, audit columns, optional columns, fixed projections."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeline.functions.names import normalize_name


class ColumnError(ValueError):
    """Column names that cannot be used as asked."""


def normalize_columns(df: DataFrame) -> DataFrame:
    """Normalise every column name; two names that become one are an error."""
    names = [normalize_name(name) for name in df.columns]
    clashes = sorted(name for name, n in Counter(names).items() if n > 1)
    if clashes:
        raise ColumnError(f"column names clash after normalising: {clashes}")
    return df.toDF(*names)


def add_audit(df: DataFrame, source_file: str | Column, source_system: str) -> DataFrame:
    """Add where each row came from and when it was loaded.

    ``source_file`` is one name for all rows, or a column such as
    ``F.col("_metadata.file_name")`` when one read covers many files.
    """
    file_column = F.lit(source_file) if isinstance(source_file, str) else source_file
    return df.withColumns(
        {
            "_source_file": file_column,
            "_source_system": F.lit(source_system),
            "_ingestion_timestamp": F.current_timestamp(),
        }
    )


def present(df: DataFrame, names: Iterable[str]) -> list[str]:
    """The given names that are columns of ``df``, in the given order, in any case."""
    existing = {name.upper() for name in df.columns}
    return [name for name in names if name.upper() in existing]


def require_columns(df: DataFrame, names: Iterable[str]) -> None:
    """Raise when a required column is missing."""
    names = list(names)
    found = set(present(df, names))
    missing = [name for name in names if name not in found]
    if missing:
        raise ColumnError(f"required columns are missing: {missing}")
