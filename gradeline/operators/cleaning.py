"""Declarative cleaning pass over a table of text columns."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeline.functions import clean_text, null_outside, to_decimal, to_int
from gradeline.operators.columns import present


@dataclass(frozen=True)
class CleaningSpec:
    """Which columns to clean as what, and the closed ranges their values must keep."""

    integers: Sequence[str] = ()
    decimals: Sequence[str] = ()
    texts: Sequence[str] = ()
    ranges: Mapping[str, tuple[int, int]] = field(default_factory=dict)

    def cleaners(self) -> dict[str, Callable[[Column], Column]]:
        return {
            **dict.fromkeys(self.integers, to_int),
            **dict.fromkeys(self.decimals, to_decimal),
            **dict.fromkeys(self.texts, clean_text),
        }


def clean_columns(df: DataFrame, spec: CleaningSpec) -> DataFrame:
    """Type and clean the columns of the spec that exist; the others pass through."""
    cleaners = spec.cleaners()
    names = present(df, cleaners)
    if not names:
        return df
    return df.withColumns({name: cleaners[name](F.col(name)) for name in names})


def null_out_of_range(df: DataFrame, ranges: Mapping[str, tuple[int, int]]) -> DataFrame:
    """Null the values outside their closed range, for the columns that exist."""
    names = present(df, ranges)
    if not names:
        return df
    return df.withColumns({name: null_outside(F.col(name), *ranges[name]) for name in names})


def clean_silver(df: DataFrame, spec: CleaningSpec) -> DataFrame:
    """Clean, then apply the ranges: two projections in one stage, no shuffle."""
    return null_out_of_range(clean_columns(df, spec), spec.ranges)
