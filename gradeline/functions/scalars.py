"""Cleaning expressions for text columns.

All parsing goes through ``try_cast``: a value that does not parse becomes NULL in
ANSI mode as well as outside it, and no input can fail a job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The markers that stand for "no value" in a text field.
TEXT_SENTINELS = ("", "_", "_______", "NA", "NM", "!@9#%8")

# Month names in calendar order.
MONTH_NAMES = (
    "january", "february", "march", "april", "may", "june",
    "july", "august", "september", "october", "november", "december",
)

# What precedes each unit word in a duration text.
YEARS_PATTERN = r"(\d+)\s+Years"
MONTHS_PATTERN = r"(\d+)\s+Months"


def clean_numeric(column: Column) -> Column:
    """Delete every character except digits, ``.`` and ``-``."""
    return F.regexp_replace(column, r"[^0-9.\-]", "")


def _parsable(column: Column, pattern: str) -> Column:
    """The value, stripped if need be, when it matches ``pattern``, else NULL.

    A failing ``try_cast`` throws and catches an exception inside the task, which costs
    more than all the rest of the pass, so only text that parses reaches the cast. A
    value that matches as it is holds nothing to strip.
    """
    stripped = clean_numeric(column)
    return F.when(column.rlike(pattern), column).when(stripped.rlike(pattern), stripped)


def to_int(column: Column) -> Column:
    """Stripped value as int; blank, fractional or too large becomes NULL."""
    return _parsable(column, r"^-?0*[0-9]{1,10}\z").try_cast("int")


def to_decimal(column: Column, precision: int = 18, scale: int = 4) -> Column:
    """Stripped value as decimal, rounded half up; blank or too large becomes NULL."""
    whole = rf"[0-9]{{1,{precision - scale}}}"
    pattern = rf"^-?0*(?:{whole}(?:\.[0-9]*)?|\.[0-9]+)\z"
    return _parsable(column, pattern).try_cast(f"decimal({precision},{scale})")


def to_double(column: Column) -> Column:
    """Stripped value as double, wide enough to show what an int cannot hold."""
    return _parsable(column, r"^-?(?:[0-9]+\.?[0-9]*|\.[0-9]+)\z").try_cast("double")


def clean_text(column: Column, sentinels: Sequence[str] = TEXT_SENTINELS) -> Column:
    """Trim spaces, null the sentinels, turn underscore runs into one space, capitalise words."""
    trimmed = F.trim(column)
    spaced = F.when(trimmed.contains("_"), F.regexp_replace(trimmed, "_+", " ")).otherwise(trimmed)
    return F.when(~trimmed.isin(*sentinels), F.initcap(spaced))


def null_outside(column: Column, low: int, high: int) -> Column:
    """Keep a value inside the closed range, else NULL."""
    return F.when(column.between(low, high), column)


def capture_int(column: Column, pattern: str) -> Column:
    """First capture group of ``pattern`` as int; no match becomes NULL."""
    return F.nullif(F.regexp_extract(column, pattern, 1), F.lit("")).try_cast("int")


def duration_parts(column: Column) -> tuple[Column, Column]:
    """Years and months of a text such as ``22 Years and 1 Months``."""
    return capture_int(column, YEARS_PATTERN), capture_int(column, MONTHS_PATTERN)


def duration_total(years: Column, months: Column) -> Column:
    """Total months, a missing part counting as zero."""
    return F.coalesce(years, F.lit(0)) * 12 + F.coalesce(months, F.lit(0))


def month_num(column: Column) -> Column:
    """Month name in any case as 1 to 12; an unknown name becomes NULL."""
    names = F.array(*[F.lit(name) for name in MONTH_NAMES])
    position = F.array_position(names, F.lower(column))
    return F.nullif(position, F.lit(0)).cast("int")
