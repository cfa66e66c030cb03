from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from gradeline.operators.audits import audit, audit_conditions, outcome_histogram, outcome_masks
from gradeline.operators.cleaning import CleaningSpec

SPEC = CleaningSpec(integers=("I", "GONE"), decimals=("D",), texts=("T",))
SCHEMA = "I string, D string, T string, X string"


def _found(df):
    return {(r["rule"], r["column_name"], r["value"]): r["n"] for r in audit(df, audit_conditions(df, SPEC)).collect()}


def test_every_audit_in_one_scan(spark, tmp_path):
    rows = [("1", "1.5", "_", "a"), ("99999999999", "x", " NA ", None), (None, "", "ok", None), ("-", None, "_", "b")]
    path = str(tmp_path / "raw")
    spark.createDataFrame(rows, SCHEMA).write.parquet(path)
    df = spark.read.parquet(path)
    assert _found(df) == {
        ("null", "I", None): 1,
        ("null", "D", None): 1,
        ("null", "X", None): 2,
        ("malformed", "I", None): 2,
        ("malformed", "D", None): 2,
        ("overflow", "I", None): 1,
        ("sentinel", "T", "_"): 2,
        ("sentinel", "T", "NA"): 1,
    }
    plan = audit(df, audit_conditions(df, SPEC))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange SinglePartition") == 1


def test_nothing_in_an_empty_table(spark):
    assert _found(spark.createDataFrame([], SCHEMA)) == {}


def test_masks_of_three_valued_rules(spark):
    df = spark.createDataFrame([(1, 1), (None, 0), (0, None), (0, 0), (0, 0)], "a int, b int")
    rules = {"a_ok": F.col("a") > 0, "b_ok": F.col("b") > 0}
    masks = Counter(tuple(r) for r in outcome_masks(df, rules).select("failed", "unknown").collect())
    assert masks == {(0, 0): 1, (2, 1): 1, (1, 2): 1, (3, 0): 2}
    rows = {(r["failed_rules"], r["unknown_rules"]): r["n"] for r in outcome_histogram(df, rules).collect()}
    assert rows == {("", ""): 1, ("b_ok", "a_ok"): 1, ("a_ok", "b_ok"): 1, ("a_ok,b_ok", ""): 2}
    assert outcome_histogram(df.filter("false"), rules).count() == 0


def test_the_last_bit_and_one_too_many(spark):
    df = spark.range(1)
    rules = {f"r{i}": F.col("id") > i for i in range(63)}
    row = outcome_masks(df, rules).first()
    assert row["failed"] == 2**63 - 1
    assert outcome_histogram(df, rules).first()["failed_rules"].endswith("r62")
    with pytest.raises(ValueError, match="63"):
        outcome_masks(df, {**rules, "more": F.col("id") > 1})


def test_the_histogram_combines_before_the_shuffle(spark):
    plan = outcome_histogram(spark.range(10), {"r": F.col("id") > 3})._jdf.queryExecution().executedPlan().toString()
    assert "partial_count(1)" in plan
