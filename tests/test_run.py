from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from gradeline.operators.columns import ColumnError
from gradeline.operators.quality import CriticalDataError, EmptyTableError
from gradeline.plans.credit import GOLD_COLUMNS
from gradeline.plans.layers import build_checked, build_silver
from gradeline.plans.run import CreditRun
from gradeline.sources import read_raw_csv, read_table
from gradeline.testing.fixtures import credit_raw


@pytest.fixture(scope="module")
def raw(spark, sf_dir):
    return credit_raw(spark, sf_dir)


@pytest.fixture
def database():
    return f"db_{uuid.uuid4().hex}"


def _count(spark, name):
    return read_table(spark, name).count()


def test_whole_run_from_csv_files(spark, raw, database, tmp_path):
    good = raw.filter("Customer_ID IS NOT NULL")
    files = {"train.csv": good, "test.csv": good.drop("Credit_Score")}
    inputs = {}
    for name, df in files.items():
        folder = str(tmp_path / name)
        df.write.option("header", True).option("escape", '"').option("emptyValue", "").csv(folder)
        inputs[name] = read_raw_csv(spark, folder)
    run = CreditRun(spark, database)
    run.run(inputs)
    first = _count(spark, run.table("gold_customer_credit"))
    run.run(inputs)

    gold = read_table(spark, run.table("gold_customer_credit"))
    assert gold.columns == list(GOLD_COLUMNS)
    assert gold.count() == first == _count(spark, run.table("valid_customers"))
    assert "CREDIT_SCORE" not in [c.upper() for c in read_table(spark, run.table("bronze_test")).columns]
    silver = read_table(spark, run.table("silver_customers"))
    assert len(silver.columns) == 36
    assert len(read_table(spark, run.table("valid_customers")).columns) == 41
    assert _count(spark, run.table("checked_customers")) == silver.count() == good.count()
    metrics = read_table(spark, run.table("quality_metrics"))
    assert metrics.count() == 2 and metrics.first()["null_customer_id"] == 0


def test_failed_gate_leaves_gold_and_keeps_rejected(spark, raw, database):
    run = CreditRun(spark, database)
    good = raw.filter("Customer_ID IS NOT NULL")
    run.run({"train.csv": good.limit(100)})
    before = sorted(r["ID"] for r in read_table(spark, run.table("gold_customer_credit")).collect())
    with pytest.raises(CriticalDataError, match="16 rows"):
        run.run({"train.csv": raw})
    after = sorted(r["ID"] for r in read_table(spark, run.table("gold_customer_credit")).collect())
    assert before == after
    assert read_table(spark, run.table("rejected_customers")).filter("CUSTOMER_ID IS NULL").count() > 0


def test_unknown_rows_show_where_asked(spark, raw, database):
    good = raw.filter("Customer_ID IS NOT NULL")
    run = CreditRun(spark, database, on_unknown="reject")
    run.run({"train.csv": good})
    total = _count(spark, run.table("valid_customers")) + _count(spark, run.table("rejected_customers"))
    assert total == good.count()
    with pytest.raises(ValueError, match="on_unknown"):
        CreditRun(spark, database, on_unknown="keep")


def test_ingest_reports_each_load(spark, raw, database):
    profiles = CreditRun(spark, database).ingest({"a/train.csv": raw, "test.csv": raw.drop("Credit_Score")})
    assert profiles == {
        "bronze_train": {"row_count": 1500, "column_count": 31},
        "bronze_test": {"row_count": 1500, "column_count": 30},
    }


def test_empty_load_stops_the_run(spark, raw, database):
    with pytest.raises(EmptyTableError):
        CreditRun(spark, database).run({"train.csv": raw.filter("false")})


def test_outcome_views_prune_partitions(spark, raw, database):
    run = CreditRun(spark, database)
    run.run({"train.csv": raw.filter("Customer_ID IS NOT NULL")})
    plan = read_table(spark, run.table("valid_customers")).select("ID")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dq_status" in plan or "PartitionFilters: [(dq_status" in plan


def test_missing_required_column_is_refused(spark, raw):
    with pytest.raises(ColumnError, match="CREDIT_SCORE"):
        build_checked(build_silver(raw.drop("Credit_Score")))


def test_layers_do_not_shuffle(spark, sf_dir):
    stored = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        F.col("o_orderkey").cast("string").alias("Age"), F.lit("May").alias("Month"),
        F.lit("Auto Loan").alias("Type_of_Loan"), F.lit("x").alias("Customer_ID"),
        F.lit("1").alias("Annual_Income"), F.lit("Good").alias("Credit_Score"),
    )
    plan = build_checked(build_silver(stored))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_a_failed_run_resumes_where_it_stopped(spark, raw, database, monkeypatch):
    good = raw.filter("Customer_ID IS NOT NULL").limit(300).cache()
    run = CreditRun(spark, database)
    with monkeypatch.context() as patched:
        patched.setattr(CreditRun, "check", lambda self: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError, match="stopped"):
            run.run({"train.csv": good}, resume=True)
    silver = read_table(spark, run.table("silver_customers")).inputFiles()
    again = CreditRun(spark, database)
    assert again.run({"train.csv": good}, resume=True) == ["check", "publish"]
    assert read_table(spark, run.table("silver_customers")).inputFiles() == silver
    published = _count(spark, run.table("gold_customer_credit"))
    assert published == _count(spark, run.table("valid_customers")) > 0
    assert again.run({"train.csv": good}, resume=True) == []
    # Other rows, the same rows in another order, other parameters, and a run without resuming.
    assert again.run({"train.csv": good.orderBy(F.desc("ID"))}, resume=True) == []
    assert again.run({"train.csv": good.filter("ID % 2 = 0")}, resume=True) == ["ingest", "refine", "check", "publish"]
    assert again.run({"train.csv": good}, resume=True) == ["ingest", "refine", "check", "publish"]
    assert CreditRun(spark, database, on_unknown="reject").run({"train.csv": good}, resume=True) == ["ingest", "refine", "check", "publish"]
    assert len(again.run({"train.csv": good})) == 4
    assert _count(spark, run.table("gold_customer_credit")) == published
