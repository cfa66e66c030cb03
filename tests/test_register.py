"""Every registered query against its DuckDB statement, and what the plans must show."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as register
from check import rows_of
from gradeline.plans.credit import GOLD_COLUMNS
from gradeline.testing.queries import REGISTER

@pytest.fixture(scope="module")
def db(sf_dir):
    connection = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        connection.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_every_key_has_sql():
    assert set(REGISTER) <= set(register.oracle_sql()) <= set(register.queries())


@pytest.mark.parametrize("key", sorted(REGISTER))
def test_query_equals_sql(spark, sf_dir, db, key):
    df = register.queries()[key](spark, sf_dir)
    answer = db.sql(register.oracle_sql()[key])
    assert sorted(df.columns) == sorted(answer.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(answer.columns, answer.fetchall())


def test_entry(spark):
    assert set(register.entry(spark).columns) == set(GOLD_COLUMNS) - {"_INGESTION_TIMESTAMP"}


def test_layers_over_the_fixture_do_not_shuffle(spark, sf_dir):
    """The one exchange is that of the fixture, which deals its narrow source rows."""
    plan = register.queries()["silver_customers"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert "REPARTITION_BY_NUM" in plan


def test_point_lookup_reaches_the_scan(spark, sf_dir, tmp_path):
    path = str(tmp_path / "silver")
    REGISTER["silver_customers"](spark, sf_dir).write.parquet(path)
    found = spark.read.parquet(path).filter("CUSTOMER_ID == 'CUS_1'").select("ID")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(CUSTOMER_ID,CUS_1)" in plan
    assert "ReadSchema: struct<ID:string,CUSTOMER_ID:string>" in plan


def test_metrics_combine_before_the_shuffle(spark, sf_dir):
    df = register.queries()["quality_metrics"](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
    assert "partial_count(1)" in plan
