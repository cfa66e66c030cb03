"""The whole run: ingest, refine, check, publish, handing over by table."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gradeline.operators.quality import (
    OVERALL_FLAG,
    STATUS_COLUMN,
    CriticalDataError,
    EmptyTableError,
    metric_counts,
    status,
)
from gradeline.plans.credit import DISTINCT_METRICS, metric_conditions
from gradeline.plans.layers import build_bronze, build_checked, build_gold, build_silver
from gradeline.sources.arrivals import digest_files
from gradeline.sources.tables import append_table, publish_table, read_table

# Which outcomes the rejected view shows, by how unknown rows are treated.
REJECTED_STATUS = {"drop": ("rejected",), "reject": ("rejected", "unknown")}


# What a resumed run goes by. A change of what a stage makes needs another version.
STAGE_TABLE = "run_stages"
VERSION = "1"


class CreditRun:
    """The four stages over the tables of one database.

    Each stage scans its input once and writes once, but that the check reads the ids a second
    time to count the different ones. ``on_unknown`` says whether rows
    whose rules are undecided show among the rejected; they are stored in either case.
    """

    def __init__(self, spark: SparkSession, database: str = "credit_score", on_unknown: str = "drop"):
        if on_unknown not in REJECTED_STATUS:
            raise ValueError(f"on_unknown must be one of {sorted(REJECTED_STATUS)}")
        self.spark = spark
        self.database = database
        self.on_unknown = on_unknown

    def table(self, name: str) -> str:
        return f"{self.database}.{name}"

    def ingest(self, raw: Mapping[str, DataFrame]) -> dict[str, dict[str, int]]:
        """Bronze: one table per source file, e.g. ``bronze_train`` for ``train.csv``.

        Returns the row and column count of each load, counted while it is written.
        """
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database}")
        profiles = {}
        for file_name, df in raw.items():
            name = "bronze_" + file_name.rsplit("/", 1)[-1].split(".")[0]
            bronze = build_bronze(df, file_name)
            load = Observation(f"load of {file_name}")
            counted = bronze.observe(load, F.count("*").alias("row_count"))
            publish_table(counted, self.table(name), evolve_schema=True)
            profiles[name] = {**load.get, "column_count": len(bronze.columns)}
        return profiles

    def refine(self, bronze: str = "bronze_train") -> None:
        """Silver: names, types, cleaning, derived columns."""
        silver = build_silver(read_table(self.spark, self.table(bronze)))
        publish_table(silver, self.table("silver_customers"), evolve_schema=True)

    def check(self) -> None:
        """Quality: metrics, row outcomes, the valid and rejected views, the gates.

        One write stores every row partitioned by outcome, and counts on the way what the
        metrics and the gates need; only the distinct count reads the table again. An empty
        table is refused once that write has shown it to be empty, and a row without an id
        once the rejected rows of the refused run can be looked at.
        """
        silver = read_table(self.spark, self.table("silver_customers"))
        checked = build_checked(silver)
        columns = checked.columns
        seen = Observation("quality")
        counted = checked.withColumn(STATUS_COLUMN, status(F.col(OVERALL_FLAG))).observe(
            seen, *metric_counts(metric_conditions())
        )
        publish_table(
            counted,
            self.table("checked_customers"),
            evolve_schema=False,
            partition_by=[STATUS_COLUMN],
        )
        counts = seen.get
        if not counts["total_rows"]:
            raise EmptyTableError(f"{self.table('silver_customers')} has no rows")
        distinct = silver.agg(*[F.countDistinct(c).alias(name) for name, c in DISTINCT_METRICS.items()])
        metrics = distinct.select("*", *[F.lit(n).cast("long").alias(name) for name, n in counts.items()])
        append_table(
            metrics.withColumn("run_timestamp", F.current_timestamp()),
            self.table("quality_metrics"),
        )
        self._outcome_view("valid_customers", columns, ("valid",))
        self._outcome_view("rejected_customers", columns, REJECTED_STATUS[self.on_unknown])
        if counts["null_customer_id"]:
            raise CriticalDataError(f"{counts['null_customer_id']} rows have no CUSTOMER_ID")

    def _outcome_view(self, name: str, columns: list[str], outcomes: tuple[str, ...]) -> None:
        """A view over whole partitions of the checked table."""
        listed = ", ".join(f"'{outcome}'" for outcome in outcomes)
        quoted = ", ".join(f"`{column}`" for column in columns)
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self.table(name)} AS SELECT {quoted} "
            f"FROM {self.table('checked_customers')} WHERE {STATUS_COLUMN} IN ({listed})"
        )

    def publish(self) -> None:
        """Gold: the valid rows in the published schema."""
        gold = build_gold(read_table(self.spark, self.table("valid_customers")))
        publish_table(gold, self.table("gold_customer_credit"), evolve_schema=False)

    def run(self, raw: Mapping[str, DataFrame], resume: bool = False) -> list[str]:
        """All stages in order; a raised check stops before the published table.

        Returns the stages that were run. With ``resume`` a stage is left out if it finished before on
        the same input with the same parameters and nothing has been run over its tables since, so a
        run that failed goes on where it stopped and a repeated one does nothing. That takes one pass
        over the input files, to tell whether they are the same.
        """
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database}")
        steps = {"ingest": lambda: self.ingest(raw), "refine": self.refine, "check": self.check, "publish": self.publish}
        key = self._input_fingerprint(raw) if resume else uuid.uuid4().hex
        done = self._finished() if resume else {}
        ran: list[str] = []
        for stage, step in steps.items():
            key = hashlib.sha256(f"{key}/{stage}/{VERSION}/{self.on_unknown}".encode()).hexdigest()
            if not ran and done.get(stage) == key:
                continue
            step()
            self._finish(stage, key)
            ran.append(stage)
        return ran

    def _input_fingerprint(self, raw: Mapping[str, DataFrame]) -> str:
        """Names, schemas, row counts and digests of the inputs, whatever the order of their rows."""
        parts = []
        for name, df in sorted(raw.items()):
            file = F.lit(name).alias("_SOURCE_FILE")
            rows = digest_files(df.select("*", file)).collect()
            parts.append((name, df.schema.json(), [(r["row_count"], r["digest"]) for r in rows]))
        return hashlib.sha256(repr(parts).encode()).hexdigest()

    def _finished(self) -> dict[str, str]:
        """The key of each stage's last run; one row is kept per finished stage and run."""
        if not self.spark.catalog.tableExists(self.table(STAGE_TABLE)):
            return {}
        rows = read_table(self.spark, self.table(STAGE_TABLE)).groupBy("stage").agg(F.max_by("stage_key", "finished").alias("key"))
        return {row["stage"]: row["key"] for row in rows.collect()}

    def _finish(self, stage: str, key: str) -> None:
        entry = self.spark.createDataFrame([(stage, key)], "stage string, stage_key string")
        append_table(entry.withColumn("finished", F.current_timestamp()), self.table(STAGE_TABLE))
