"""The four layers as functions from DataFrame to DataFrame.

None of them shuffles: each layer is a chain of projections that Spark runs in the
scan stage of its input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeline.functions import (
    age_group,
    duration_parts,
    duration_total,
    income_group,
    month_num,
    parse_list,
)
from gradeline.operators.cleaning import clean_silver
from gradeline.operators.columns import add_audit, normalize_columns, present, require_columns
from gradeline.operators.lists import multi_hot
from gradeline.operators.quality import apply_rules
from gradeline.plans.credit import (
    CREDIT_SPEC,
    GOLD_COLUMNS,
    KNOWN_LOAN_TYPES,
    REQUIRED_COLUMNS,
    SOURCE_SYSTEM,
    credit_rules,
)


def build_bronze(
    raw: DataFrame, source_file: str | Column, source_system: str = SOURCE_SYSTEM
) -> DataFrame:
    """Raw text columns as they came, with audit columns."""
    return add_audit(raw, source_file, source_system)


def _derived() -> dict[str, tuple[str, Callable[[Column], Column]]]:
    """Derived column: the column it is made from, and how."""
    return {
        "CREDIT_HISTORY_YEARS": ("CREDIT_HISTORY_AGE", lambda c: duration_parts(c)[0]),
        "CREDIT_HISTORY_MONTHS_PART": ("CREDIT_HISTORY_AGE", lambda c: duration_parts(c)[1]),
        "CREDIT_HISTORY_TOTAL_MONTHS": (
            "CREDIT_HISTORY_AGE",
            lambda c: duration_total(*duration_parts(c)),
        ),
        "MONTH_NUM": ("MONTH", month_num),
        "LOAN_TYPES": ("TYPE_OF_LOAN", parse_list),
    }


def add_derived(df: DataFrame) -> DataFrame:
    """Add the derived columns whose source column exists."""
    return df.withColumns(
        {
            name: make(F.col(source))
            for name, (source, make) in _derived().items()
            if present(df, [source])
        }
    )


def build_silver(bronze: DataFrame) -> DataFrame:
    """Normalised names, typed and cleaned columns, derived columns."""
    return add_derived(clean_silver(normalize_columns(bronze), CREDIT_SPEC))


def build_checked(silver: DataFrame) -> DataFrame:
    """Silver with the outcome of every row rule."""
    require_columns(silver, REQUIRED_COLUMNS)
    return apply_rules(silver, credit_rules())


def add_bands(df: DataFrame) -> DataFrame:
    """Age and income bands."""
    return df.withColumns(
        {
            "AGE_GROUP": age_group(F.col("AGE")),
            "INCOME_GROUP": income_group(F.col("ANNUAL_INCOME")),
        }
    )


def select_gold(df: DataFrame) -> DataFrame:
    """The published columns, in order."""
    return df.select(*GOLD_COLUMNS)


def build_gold(valid: DataFrame) -> DataFrame:
    """Valid rows with loan flags and bands, in the published schema."""
    return select_gold(add_bands(multi_hot(valid, "LOAN_TYPES", KNOWN_LOAN_TYPES)))
