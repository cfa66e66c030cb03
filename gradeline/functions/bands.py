"""Banding: a number to a label by ordered conditions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The published labels.
UNKNOWN_BAND = "Não informado"
AGE_RANGES = ((14, 17), (18, 25), (26, 35), (36, 50), (51, 60))
AGE_OPEN_BAND = (60, "61+")
INCOME_LIMITS = ((30000, "Até 30 mil"), (60000, "30 a 60 mil"), (100000, "60 a 100 mil"))
INCOME_OPEN_BAND = (100000, "100 mil ou mais")


def band(cases: Sequence[tuple[Column, str]], default: str) -> Column:
    """Label of the first condition that is true, else ``default``."""
    (first, label), *rest = cases
    chain = F.when(first, label)
    for condition, label in rest:
        chain = chain.when(condition, label)
    return chain.otherwise(default)


def age_group(age: Column) -> Column:
    """Age band label; the bands are closed ranges and the last one is open above."""
    cases = [(age.between(low, high), f"{low}-{high}") for low, high in AGE_RANGES]
    limit, label = AGE_OPEN_BAND
    return band([*cases, (age > limit, label)], UNKNOWN_BAND)


def income_group(income: Column) -> Column:
    """Income band label; a negative income falls in the first band."""
    cases = [(income < limit, label) for limit, label in INCOME_LIMITS]
    limit, label = INCOME_OPEN_BAND
    return band([*cases, (income >= limit, label)], UNKNOWN_BAND)
