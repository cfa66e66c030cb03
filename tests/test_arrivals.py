from __future__ import annotations

from pyspark.sql import functions as F

from gradeline.sources import arrival_status, digest_files
from gradeline.sources.arrivals import LEDGER

SCHEMA = "a string, b string, _SOURCE_FILE string, _INGESTION_TIMESTAMP timestamp"


def _rows(spark, *rows):
    return spark.createDataFrame([(*row, None) for row in rows], SCHEMA)


def _status(entries):
    return {r["source_file"]: (r["status"], r["row_count"]) for r in entries.collect()}


def test_statuses_over_three_loads(spark):
    expected = ["x", "y", "z"]
    one = _rows(spark, ("1", "p", "x"), ("2", "q", "x"), ("3", None, "w"), ("4", None, None))
    first = arrival_status(digest_files(one), spark.createDataFrame([], LEDGER), expected)
    assert _status(first) == {"x": ("new", 2), "w": ("new", 1), None: ("new", 1), "y": ("missing", 0), "z": ("missing", 0)}
    two = _rows(spark, ("2", "q", "x"), ("1", "p", "x"), (None, "3", "w"), ("5", "r", "y"), ("4", None, None))
    second = arrival_status(digest_files(two), first, expected)
    assert _status(second) == {"x": ("repeated", 2), "w": ("changed", 1), "y": ("late", 1), "z": ("missing", 0), None: ("repeated", 1)}
    ledger = first.unionByName(second)
    third = arrival_status(digest_files(_rows(spark, ("3", None, "w"))), ledger, ["x", "z"])
    assert _status(third) == {"w": ("repeated", 1), "z": ("missing", 0)}
    assert _status(arrival_status(digest_files(_rows(spark)), ledger)) == {}


def test_a_digest_sees_repeats_nulls_and_values_but_not_order_or_load_time(spark):
    base = [("1", None, "f"), ("1", None, "f"), ("2", "q", "f")]

    def digest(rows, **more):
        df = _rows(spark, *rows).withColumn("_INGESTION_TIMESTAMP", F.current_timestamp())
        return [r["digest"] for r in digest_files(df, **more).collect()]

    assert digest(base) == digest(base[::-1])
    others = [base[:2], [*base, base[0]], [(None, "1", "f"), *base[1:]], [*base[:2], ("2", "Q", "f")]]
    assert all(digest(rows) != digest(base) for rows in others)


def test_a_hot_file_is_added_up_before_the_shuffle(spark):
    plan = digest_files(_rows(spark, ("1", "p", "x")))._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan
