from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from gradeline.operators.cleaning import CleaningSpec
from gradeline.operators.quality import (
    OVERALL_FLAG,
    CriticalDataError,
    EmptyTableError,
    apply_rules,
    assert_no_critical,
    assert_not_empty,
    duplicate_keys,
    int_overflow_counts,
    int_overflow_rows,
    load_profile,
    malformed_counts,
    null_profile,
    partition_counts,
    quality_metrics,
    sentinel_counts,
    split,
    value_profile,
)
from gradeline.plans.credit import DISTINCT_METRICS, credit_rules, metric_conditions

# id, age, income, score, overall flag
ROWS = [
    ("c1", 20, 1, "Good", True),
    ("c2", None, 1, "Good", None),
    ("c3", 20, None, "Good", None),
    ("c4", 20, 1, None, None),
    ("c5", 20, 1, "Bad", False),
    (None, None, None, None, False),
    ("c6", None, -1, "Good", False),
    ("c8", 101, 1, "Standard", False),
    ("", 20, 1, "Good", True),
]


@pytest.fixture(scope="module")
def rows(spark):
    data = [(i, r[0], r[1], None if r[2] is None else Decimal(r[2]), r[3], r[4]) for i, r in enumerate(ROWS)]
    schema = "i int, CUSTOMER_ID string, AGE int, ANNUAL_INCOME decimal(18,4), CREDIT_SCORE string, want boolean"
    return spark.createDataFrame(data, schema)


@pytest.fixture(scope="module")
def checked(rows):
    return apply_rules(rows, credit_rules())


def test_overall_flag_is_three_valued(checked):
    for row in checked.collect():
        assert row[OVERALL_FLAG] is row["want"]


def test_split_modes(checked):
    valid, rejected = split(checked)
    assert (valid.count(), rejected.count()) == (2, 4)
    valid, rejected = split(checked, on_unknown="reject")
    assert (valid.count(), rejected.count()) == (2, 7)
    with pytest.raises(ValueError, match="on_unknown"):
        split(checked, on_unknown="keep")


def test_outcomes_add_up_to_all_rows(checked):
    counts = {r["dq_status"]: r["n"] for r in partition_counts(checked).collect()}
    assert counts == {"valid": 2, "rejected": 4, "unknown": 3}


def test_metrics(rows):
    assert quality_metrics(rows, metric_conditions(), DISTINCT_METRICS).first().asDict() == {
        "total_rows": 9,
        "distinct_customers": 8,
        "null_customer_id": 1,
        "invalid_or_null_age": 3,
        "invalid_or_null_income": 2,
        "invalid_credit_score": 1,
    }


def test_metrics_by_sketch(rows):
    exact, sketched = (quality_metrics(rows, metric_conditions(), DISTINCT_METRICS, approximate=a).first().asDict() for a in (False, True))
    assert abs(exact.pop("distinct_customers") - sketched.pop("distinct_customers")) <= 1
    assert exact == sketched


def test_metrics_of_an_empty_table(rows):
    row = quality_metrics(rows.filter("false"), metric_conditions(), DISTINCT_METRICS).first()
    assert row["total_rows"] == 0
    assert row["null_customer_id"] is None


def test_gates(rows):
    with pytest.raises(CriticalDataError, match="1 rows"):
        assert_no_critical(rows)
    assert_no_critical(rows.filter("CUSTOMER_ID IS NOT NULL"))
    assert_not_empty(rows)
    with pytest.raises(EmptyTableError, match="silver"):
        assert_not_empty(rows.filter("false"), "silver")


def test_profiles(spark, rows):
    nulls = {r["column_name"]: r["null_count"] for r in null_profile(rows, ["CUSTOMER_ID", "AGE"]).collect()}
    assert nulls == {"CUSTOMER_ID": 1, "AGE": 3}
    found = load_profile(rows).orderBy("position").collect()
    assert [r["column_name"] for r in found] == rows.columns
    assert {r["row_count"] for r in found} == {9}
    assert [r["type"] for r in found] == [t for _, t in rows.dtypes]
    profile = [tuple(r) for r in value_profile(rows, "CREDIT_SCORE").collect()]
    assert profile == [(None, 2), ("Bad", 1), ("Good", 5), ("Standard", 1)]


def test_raw_audits(spark):
    spec = CleaningSpec(integers=["A"], decimals=["B"])
    values = [("1", "x"), ("99999999999", "1.5"), ("-2147483649", "_"), ("2147483647", None), ("1.5", "2")]
    raw = spark.createDataFrame(values, "A string, B string")
    malformed = {r["column_name"]: r["malformed"] for r in malformed_counts(raw, spec).collect()}
    assert malformed == {"A": 3, "B": 2}
    assert int_overflow_counts(raw, ["A"]).first()["overflow_count"] == 2
    assert {r["cleaned_value"] for r in int_overflow_rows(raw, "A").collect()} == {"99999999999", "-2147483649"}


def test_sentinels_and_duplicates(spark):
    df = spark.createDataFrame([("NA ", "x"), ("_", "NA"), ("NA", None), ("k", "")], "a string, b string")
    found = {(r["column_name"], r["sentinel"]): r["n"] for r in sentinel_counts(df, ["a", "b"]).collect()}
    assert found == {("a", "NA"): 2, ("a", "_"): 1, ("b", "NA"): 1, ("b", ""): 1}
    keys = df.select(F.trim("a").alias("a"))
    assert [tuple(r) for r in duplicate_keys(keys, ["a"]).collect()] == [("NA", 2)]
