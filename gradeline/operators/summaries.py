"""Column summaries that merge over loads, and values that many rows hold.

A summary is small and fixed in size, is stored once per load, and tells about any set of loads
without reading their rows again.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

# An estimate of distinct values errs by 0.8 % (one standard deviation), ranks by about 0.7 %.
DISTINCT_LOG_SIZE = 14
QUANTILE_SIZE = 400


def load_summary(df: DataFrame, load: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A row per column: ``load, column_name, row_count, null_count, distinct_sketch, quantile_sketch``.

    One scan for all columns, sketched in each task before the shuffle. Columns that are not
    numbers have no quantile sketch, nor has a column without a value. Distinct values are those of
    the value as text.
    """
    names = list(columns or df.columns)
    aggregates, rows = [F.count("*").alias("rows")], []
    for i, name in enumerate(names):
        value = F.col(name)
        aggregates += [F.count(value).alias(f"n{i}"), F.hll_sketch_agg(value.cast("string"), F.lit(DISTINCT_LOG_SIZE)).alias(f"d{i}")]
        quantiles: Column = F.lit(None).cast("binary")
        if isinstance(df.schema[name].dataType, NumericType):
            aggregates.append(F.kll_sketch_agg_double(value.cast("double"), F.lit(QUANTILE_SIZE)).alias(f"q{i}"))
            quantiles = F.when(F.col(f"n{i}") > 0, F.col(f"q{i}"))
        rows.append(
            F.struct(
                F.lit(load).alias("load"),
                F.lit(name).alias("column_name"),
                F.col("rows").alias("row_count"),
                (F.col("rows") - F.col(f"n{i}")).alias("null_count"),
                F.col(f"d{i}").alias("distinct_sketch"),
                quantiles.alias("quantile_sketch"),
            )
        )
    return df.agg(*aggregates).select(F.inline(F.array(*rows)))


def merged_summary(summaries: DataFrame, quantiles: Sequence[float] = (0.01, 0.5, 0.99)) -> DataFrame:
    """Per column over all given loads: ``row_count, null_count, distinct_estimate, quantiles``.

    ``quantiles`` are values of the column at about these ranks, NULL where there is none.
    """
    merged = summaries.groupBy("column_name").agg(
        F.sum("row_count").alias("row_count"),
        F.sum("null_count").alias("null_count"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("distinct_estimate"),
    )
    ranks = F.array(*[F.lit(float(q)) for q in quantiles])
    ordered = (
        summaries.filter("quantile_sketch IS NOT NULL")
        .groupBy("column_name")
        .agg(F.kll_merge_agg_double("quantile_sketch").alias("merged"))
        .select("column_name", F.kll_sketch_get_quantile_double("merged", ranks).alias("quantiles"))
    )
    return merged.join(ordered, "column_name", "left")


def propose_ranges(summaries: DataFrame, tail: float = 0.01) -> DataFrame:
    """``column_name, low, high``: a closed range per numeric column that about ``tail`` of the values miss at each end."""
    merged = merged_summary(summaries, (tail, 1 - tail)).filter("quantiles IS NOT NULL")
    return merged.select("column_name", F.col("quantiles")[0].alias("low"), F.col("quantiles")[1].alias("high"))


def distinct_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``column_name, n``: the exact number of distinct values, as text, of each column that has any.

    Each value is one narrow row of its column's place and its text, where distinct counts of many columns
    in one aggregate hold a row of all columns for each value of each.
    """
    names = list(columns or df.columns)
    each = [F.struct(F.lit(i).alias("place"), F.col(name).cast("string").alias("value")) for i, name in enumerate(names)]
    values = df.select(F.inline(F.array(*each))).filter("value IS NOT NULL").distinct()
    return values.groupBy("place").agg(F.count("*").alias("n")).select(F.get(F.array(*map(F.lit, names)), "place").alias("column_name"), "n")


def heavy_values(df: DataFrame, share: float, columns: Sequence[str] | None = None) -> DataFrame:
    """``column_name, value, n``: the values, as text, that at least ``share`` of the rows hold; NULL is one.

    The first pass keeps a summary of frequent values per column, of a size fixed by ``share``, that
    has all of them among its candidates; the second counts the candidates of all columns exactly.
    So no value that few rows hold is ever shuffled, unlike in a grouping by value.
    """
    if not 0 < share <= 1:
        raise ValueError("share must be above 0 and at most 1")
    names = list(columns or df.columns)
    texts = df.select(*[F.col(name).cast("string").alias(f"c{i}") for i, name in enumerate(names)])
    # A value's count is off by 3.5 rows in a tracked number of rows at most, so twice that is found.
    listed = math.ceil(2 / share)
    tracked = max(4096, 1 << math.ceil(math.log2(16 / share)))
    tops = [F.expr(f"approx_top_k(c{i}, {listed}, {tracked})").alias(f"c{i}") for i in range(len(names))]
    found = texts.agg(F.count("*").alias("rows"), *tops).first()
    least = max(1, math.ceil(share * found["rows"]))
    hits = []
    for i, name in enumerate(names):
        items = [item["item"] for item in found[f"c{i}"] or []]
        known = [item for item in items if item is not None]
        held = F.col(f"c{i}").isin(*known) if known else F.lit(False)
        if None in items:
            held = F.col(f"c{i}").isNull() | held
        hits.append(F.when(held, F.struct(F.lit(name).alias("column_name"), F.col(f"c{i}").alias("value"))))
    rows = texts.select(F.inline(F.filter(F.array(*hits), lambda hit: hit.isNotNull())))
    return rows.groupBy("column_name", "value").agg(F.count("*").alias("n")).filter(F.col("n") >= least)
