"""Operators over an array column: flags, unnesting, element statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeline.functions import contains_flag, flag_name


def multi_hot(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Add one 1/0 column per value telling whether the array holds it."""
    return df.withColumns({flag_name(v): contains_flag(F.col(column), v) for v in values})


def elements(df: DataFrame, column: str, alias: str) -> DataFrame:
    """One row per element that is neither NULL nor blank.

    The outer form adds no size test of its own below the generator, which would parse a
    derived list a second time; the row it makes of an empty list is blank and dropped.
    """
    return df.select(F.explode_outer(column).alias(alias)).filter(F.trim(alias) != "")


def element_frequency(df: DataFrame, column: str, alias: str) -> DataFrame:
    """Occurrences of each element, most frequent first."""
    counts = elements(df, column, alias).groupBy(alias).agg(F.count("*").alias("total_occurrences"))
    return counts.orderBy(F.desc("total_occurrences"))


def distinct_elements(df: DataFrame, column: str, alias: str) -> DataFrame:
    """Distinct elements in order."""
    return elements(df, column, alias).distinct().orderBy(alias)


def unknown_elements(df: DataFrame, column: str, known: Sequence[str], alias: str) -> DataFrame:
    """Rows holding each element outside the known values, with blank elements included."""
    known_values = F.array(*[F.lit(value) for value in known])
    return (
        df.select(F.explode(F.array_except(column, known_values)).alias(alias))
        .groupBy(alias)
        .agg(F.count("*").alias("n"))
    )
