"""Row rules with three-valued outcomes, the valid/rejected split, metrics and gates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeline.functions import TEXT_SENTINELS, clean_numeric, to_double
from gradeline.operators.cleaning import CleaningSpec
from gradeline.operators.columns import present

OVERALL_FLAG = "dq_is_valid"
STATUS_COLUMN = "dq_status"
INT_MIN, INT_MAX = -(2**31), 2**31 - 1


class CriticalDataError(ValueError):
    """A table that must not be published."""


class EmptyTableError(ValueError):
    """A table without rows."""


def count_where(condition: Column) -> Column:
    """Rows where the condition is true; NULL on empty input, as a sum is."""
    return F.sum(F.when(condition, 1).otherwise(0))


def _one_row_to_rows(df: DataFrame, key: str, value: str) -> DataFrame:
    """One row of counters as one row per counter."""
    return df.unpivot([], df.columns, key, value)


# --- row rules -------------------------------------------------------------


def apply_rules(df: DataFrame, rules: Mapping[str, Column], overall: str = OVERALL_FLAG) -> DataFrame:
    """Add one boolean per rule and their conjunction.

    A rule over a NULL value is NULL. The conjunction is false when any rule is false,
    else NULL when any rule is NULL, else true.
    """
    return df.withColumns({**rules, overall: reduce(and_, rules.values())})


def status(flag: Column) -> Column:
    """Name of the three outcomes of a flag."""
    return F.when(flag, "valid").when(~flag, "rejected").otherwise("unknown")


def split(
    df: DataFrame, on_unknown: str = "drop", flag: str = OVERALL_FLAG
) -> tuple[DataFrame, DataFrame]:
    """Valid and rejected rows.

    Rows whose flag is NULL are in neither with ``on_unknown="drop"`` and among the
    rejected with ``on_unknown="reject"``.
    """
    if on_unknown not in ("drop", "reject"):
        raise ValueError(f"on_unknown must be 'drop' or 'reject', not {on_unknown!r}")
    ok = F.col(flag)
    failed = ~ok if on_unknown == "drop" else ~F.coalesce(ok, F.lit(False))
    return df.filter(ok), df.filter(failed)


def partition_counts(df: DataFrame, flag: str = OVERALL_FLAG) -> DataFrame:
    """Rows per outcome, the unknown ones included."""
    return df.groupBy(status(F.col(flag)).alias(STATUS_COLUMN)).agg(F.count("*").alias("n"))


# --- metrics ---------------------------------------------------------------


def metric_counts(conditions: Mapping[str, Column], total: str = "total_rows") -> list[Column]:
    """Row count, and the rows where each condition is true, as aggregates for one pass."""
    return [F.count("*").alias(total), *[count_where(c).alias(name) for name, c in conditions.items()]]


def quality_metrics(
    df: DataFrame,
    conditions: Mapping[str, Column],
    distinct: Mapping[str, str],
    approximate: bool = False,
) -> DataFrame:
    """One row of table metrics: rows, rows per condition, distinct values per column.

    A condition that is NULL is not counted. The exact distinct count pre-aggregates on the
    value in each task before its shuffle, so a hot value costs one row per task.
    ``approximate`` counts by a sketch instead, with no shuffle of values at all.
    """
    count = F.approx_count_distinct if approximate else F.countDistinct
    return df.agg(*metric_counts(conditions), *[count(c).alias(name) for name, c in distinct.items()])


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULLs per column, all columns in one pass."""
    counts = df.agg(*[count_where(F.col(c).isNull()).alias(c) for c in columns or df.columns])
    return _one_row_to_rows(counts, "column_name", "null_count")


def malformed_counts(df: DataFrame, spec: CleaningSpec) -> DataFrame:
    """Non-NULL raw values that clean to NULL, per numeric column, in one pass."""
    cleaners = spec.cleaners()
    names = present(df, [*spec.integers, *spec.decimals])
    counts = df.agg(
        *[
            count_where(F.col(c).isNotNull() & cleaners[c](F.col(c)).isNull()).alias(c)
            for c in names
        ]
    )
    return _one_row_to_rows(counts, "column_name", "malformed")


def sentinel_counts(
    df: DataFrame, columns: Sequence[str], sentinels: Sequence[str] = TEXT_SENTINELS
) -> DataFrame:
    """Occurrences of each sentinel in each column, those that occur.

    The values are filtered down to sentinels before they become rows, and the counts
    are combined in each task before the shuffle.
    """
    trimmed = [F.struct(F.lit(c).alias("column_name"), F.trim(c).alias("sentinel")) for c in present(df, columns)]
    hits = F.filter(F.array(*trimmed), lambda item: item["sentinel"].isin(*sentinels))
    return (
        df.select(F.inline(hits))
        .groupBy("column_name", "sentinel")
        .agg(F.count("*").alias("n"))
    )


def _overflows(value: Column) -> Column:
    return (value < INT_MIN) | (value > INT_MAX)


def overflows(raw: Column) -> Column:
    """Whether a raw value is a number outside the int range."""
    return _overflows(to_double(raw))


def int_overflow_rows(df: DataFrame, column: str, keep: Sequence[str] = ()) -> DataFrame:
    """Rows whose cleaned value is a number outside the int range."""
    shown = df.select(
        *keep,
        clean_numeric(F.col(column)).alias("cleaned_value"),
        to_double(F.col(column)).alias("numeric_value"),
    )
    return shown.filter(_overflows(F.col("numeric_value")))


def int_overflow_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Values outside the int range per column, all columns in one pass."""
    counts = df.agg(*[count_where(_overflows(to_double(F.col(c)))).alias(c) for c in present(df, columns)])
    return _one_row_to_rows(counts, "column_name", "overflow_count")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def value_profile(df: DataFrame, column: str) -> DataFrame:
    """Rows per value of a column, in value order."""
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(column)


def load_profile(df: DataFrame) -> DataFrame:
    """One row per column of a load: its place, name and type, and the rows of the load."""
    columns = [
        F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("type"))
        for i, f in enumerate(df.schema)
    ]
    counted = df.agg(F.count("*").alias("row_count"))
    return counted.select("row_count", F.inline(F.array(*columns)))


# --- gates -----------------------------------------------------------------


def critical_count(df: DataFrame, id_column: str = "CUSTOMER_ID") -> DataFrame:
    """Rows without an id, as one row."""
    return df.filter(F.col(id_column).isNull()).agg(F.count("*").alias("critical_error_count"))


def assert_no_critical(df: DataFrame, id_column: str = "CUSTOMER_ID") -> None:
    """Raise when a row has no id."""
    n = critical_count(df, id_column).first()["critical_error_count"]
    if n:
        raise CriticalDataError(f"{n} rows have no {id_column}")


def emptiness(df: DataFrame, name: str) -> DataFrame:
    """Whether the table is empty, as one row; the scan stops at the first row found."""
    return df.limit(1).agg(
        F.lit(name).alias("input"),
        (F.count("*") == 0).alias("is_empty"),
    )


def assert_not_empty(df: DataFrame, name: str = "table") -> None:
    """Raise when there is no row; reads one row at most."""
    if df.isEmpty():
        raise EmptyTableError(f"{name} has no rows")
