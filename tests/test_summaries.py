from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from gradeline.operators.summaries import distinct_counts, heavy_values, load_summary, merged_summary, propose_ranges
from gradeline.testing.queries import merged_load_summary


def _two_loads(spark):
    df = spark.range(60_000).select(
        F.col("id").cast("double").alias("number"),
        (F.col("id") % 700).cast("string").alias("text"),
        F.when(F.col("id") % 3 > 0, F.col("id") % 7).alias("some"),
        F.lit(None).cast("int").alias("never"),
    )
    return df, [df.filter("number < 20000"), df.filter("number >= 20000")]


def test_merged_sketches_are_within_their_bounds(spark):
    df, loads = _two_loads(spark)
    parts = [load_summary(load, str(i)) for i, load in enumerate(loads)]
    merged = {r["column_name"]: r for r in merged_summary(parts[0].unionByName(parts[1]), (0.0, 0.25, 0.5, 1.0)).collect()}
    assert {c: (r["row_count"], r["null_count"]) for c, r in merged.items()} == {
        "number": (60_000, 0), "text": (60_000, 0), "some": (60_000, 20_000), "never": (60_000, 60_000),
    }
    for column, exact in (("number", 60_000), ("text", 700), ("some", 7), ("never", 0)):
        assert abs(merged[column]["distinct_estimate"] - exact) <= 0.03 * exact
    for quantile, rank in zip(merged["number"]["quantiles"], (0.0, 0.25, 0.5, 1.0), strict=True):
        assert abs(quantile / 60_000 - rank) <= 0.015
    assert merged["text"]["quantiles"] is None and merged["never"]["quantiles"] is None


def test_ranges_leave_out_the_tails(spark):
    df, loads = _two_loads(spark)
    wild = df.withColumn("number", F.when(F.col("number") % 500 == 0, 1e12).otherwise(F.col("number")))
    found = {r["column_name"]: (r["low"], r["high"]) for r in propose_ranges(load_summary(wild, "x", ["number", "text"]), 0.02).collect()}
    low, high = found["number"]
    assert set(found) == {"number"} and 0 < low < 2400 and 57_000 < high < 60_000


def test_empty_loads_merge(spark):
    _, loads = _two_loads(spark)
    empty = load_summary(loads[0].filter("false"), "none")
    assert {r["distinct_estimate"] for r in merged_summary(empty).collect()} == {0}
    both = merged_summary(empty.unionByName(load_summary(loads[0], "one"))).filter("column_name = 'number'").first()
    assert both["row_count"] == 20_000 and len(both["quantiles"]) == 3


def test_a_summary_is_one_scan(spark, tmp_path):
    path = str(tmp_path / "rows")
    _two_loads(spark)[0].write.parquet(path)
    plan = load_summary(spark.read.parquet(path), "x")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "partial_hll_sketch_agg" in plan


def test_distinct_counts_are_exact_and_narrow(spark, sf_dir):
    """As many as one aggregate of all columns counts, without the rows of all columns that it makes of each row."""
    df, _ = _two_loads(spark)
    got = distinct_counts(df)
    assert {tuple(r) for r in got.collect()} == {("number", 60_000), ("text", 700), ("some", 7)}
    assert {tuple(r) for r in distinct_counts(df, ["some"]).collect()} == {("some", 7)}
    assert distinct_counts(df.filter("false")).count() == 0
    plan = merged_load_summary(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan


@pytest.mark.parametrize("share", [0.5, 0.1, 0.01])
def test_heavy_values_are_exactly_those_of_the_share(spark, share):
    """A column of unique values with some heavy ones, one with NULLs, and one on the border."""
    n = 20_000
    df = spark.range(n).select(
        F.when(F.col("id") % 4 == 0, "hot").when(F.col("id") % 100 == 1, "border").otherwise(F.col("id").cast("string")).alias("a"),
        F.when(F.col("id") % 3 == 0, F.col("id") % 2).alias("b"),
        F.col("id").alias("c"),
    )
    want = set()
    for column in df.columns:
        counted = df.groupBy(F.col(column).cast("string").alias("v")).count().filter(F.col("count") >= share * n)
        want |= {(column, r["v"], r["count"]) for r in counted.collect()}
    assert {tuple(r) for r in heavy_values(df, share).collect()} == want
    assert share < 0.5 or want == {("b", None, 2 * n // 3)} or ("b", None, 13_333) in want


def test_heavy_values_of_nothing(spark):
    assert heavy_values(spark.range(0), 0.1).count() == 0
    with pytest.raises(ValueError, match="share"):
        heavy_values(spark.range(1), 0)
