from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from gradeline.session import configure_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("gradeline-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return configure_session(session)


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def evaluate(spark):
    """Apply an expression builder to one text value per row, in order."""
    from pyspark.sql import functions as F

    def run(build, values):
        rows = [(i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, "i int, v string").select("i", build(F.col("v")).alias("o"))
        return [row["o"] for row in sorted(df.collect(), key=lambda r: r["i"])]

    return run
