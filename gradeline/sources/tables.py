"""Catalog tables as source and sink, and session views."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

DELTA_EXTENSION = "DeltaSparkSessionExtension"
OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


class SchemaMismatchError(ValueError):
    """A write whose schema differs from that of the existing table."""


def default_format(spark: SparkSession) -> str:
    """``delta`` when the session has it, else the session's default source."""
    if DELTA_EXTENSION in (spark.conf.get("spark.sql.extensions", "") or ""):
        return "delta"
    return spark.conf.get("spark.sql.sources.default")


@cache
def _local_scratch(application_id: str) -> str:
    return tempfile.mkdtemp(prefix="gradeline-")


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``. A local session, whose tasks all share the
    machine, may leave it unset and gets a folder of its own; any other raises.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return _local_scratch(spark.sparkContext.applicationId)


class Staged:
    """Rows computed once and kept in the shared folder while the ``with`` block runs, or until dropped."""

    def __init__(self, df: DataFrame):
        self.spark = df.sparkSession
        self.path = f"{scratch_dir(self.spark)}/staged-{uuid.uuid4().hex}"
        df.write.parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def __enter__(self) -> DataFrame:
        return self.df

    def __exit__(self, *_: object) -> None:
        self.drop()

    def drop(self) -> None:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Make DataFrames visible to SQL text in their session."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def _types(schema: StructType) -> dict[str, str]:
    return {field.name.upper(): field.dataType.simpleString() for field in schema}


def check_schema(df: DataFrame, name: str) -> None:
    """Raise when the columns or types of ``df`` differ from the table of that name."""
    have, want = _types(df.schema), _types(df.sparkSession.table(name).schema)
    if have == want:
        return
    added = sorted(have.keys() - want.keys())
    missing = sorted(want.keys() - have.keys())
    retyped = sorted(c for c in have.keys() & want.keys() if have[c] != want[c])
    raise SchemaMismatchError(
        f"{name}: new columns {added}, missing columns {missing}, other types {retyped}"
    )


def write_table(
    df: DataFrame,
    name: str,
    *,
    evolve_schema: bool,
    partition_by: Sequence[str] = (),
    path: str | None = None,
    fmt: str | None = None,
) -> None:
    """Replace the whole table, so a repeated run leaves the same rows.

    With ``evolve_schema=False`` the schema of an existing table is kept and a differing
    one is refused before anything is written. A format without atomic replacement has the
    rows computed into the shared folder first, so a failing computation leaves the old rows;
    then an existing table of the same schema has its contents replaced where it is, and keeps
    its place, kind and properties.
    """
    spark = df.sparkSession
    fmt = fmt or default_format(spark)
    exists = spark.catalog.tableExists(name)
    if exists and not evolve_schema:
        check_schema(df, name)
    if not exists or fmt == "delta":
        _save(df, name, fmt, evolve_schema, partition_by, path)
        return
    same = _types(df.schema) == _types(spark.table(name).schema)
    with Staged(df) as rows:
        if same and _partitions(spark, name) == [c.upper() for c in partition_by] and path is None:
            replace_rows(rows, name)
        else:
            _save(rows, name, fmt, evolve_schema, partition_by, path or _external_path(spark, name))


def _save(df, name, fmt, evolve_schema, partition_by, path) -> None:
    writer = df.write.format(fmt).mode("overwrite")
    if evolve_schema:
        writer = writer.option("overwriteSchema", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def replace_rows(df: DataFrame, name: str, only_partitions: bool = False) -> None:
    """Overwrite the rows of a table in place, or those of the partitions that ``df`` has."""
    spark = df.sparkSession
    before = spark.conf.get(OVERWRITE_MODE)
    spark.conf.set(OVERWRITE_MODE, "dynamic" if only_partitions else "static")
    try:
        df.select(*[f"`{c}`" for c in spark.table(name).columns]).write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set(OVERWRITE_MODE, before)


def _partitions(spark: SparkSession, name: str) -> list[str]:
    return [column.name.upper() for column in spark.catalog.listColumns(name) if column.isPartition]


def _external_path(spark: SparkSession, name: str) -> str | None:
    """Where an external table lies; none for a managed one."""
    rows = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    return rows.get("Location") if rows.get("Type") == "EXTERNAL" else None


# --- publishing by a view ----------------------------------------------------

LIVE_PROPERTY = "gradeline.live"
SLOTS = ("a", "b")


class NotAViewError(ValueError):
    """A plain table has the name of a view to publish by."""


def _live_slot(spark: SparkSession, name: str) -> str | None:
    """The slot that the published view shows; none if nothing was published."""
    if not spark.catalog.tableExists(name):
        return None
    if spark.catalog.getTable(name).tableType != "VIEW":
        raise NotAViewError(f"{name} is a table; publish_table switches a view of that name")
    properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    return properties.get(LIVE_PROPERTY)


def publish_table(
    df: DataFrame,
    name: str,
    *,
    evolve_schema: bool,
    partition_by: Sequence[str] = (),
    audit: Callable[[DataFrame], None] | None = None,
    path: str | None = None,
    fmt: str | None = None,
) -> None:
    """Replace the whole table by writing its rows beside it and switching a view over.

    ``name`` is a view over one of two tables, ``name__a`` and ``name__b``. The rows are written
    once, to the one that the view does not show; ``audit`` may look at them there and raise; then
    one statement of the catalog shows them. Readers see the old rows or the new ones and never a
    part, whatever fails leaves the old rows shown, and the old table stays until the next refresh,
    so queries that are reading it end well. The new rows may be computed from the view itself.
    With ``evolve_schema=False`` a differing schema is refused before anything is written. ``path``
    names a folder that holds both tables; without it they are managed.
    """
    spark = df.sparkSession
    live = _live_slot(spark, name)
    if live and not evolve_schema:
        check_schema(df, name)
    slot = SLOTS[live == SLOTS[0]]
    table = f"{name}__{slot}"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    folder = None if path is None and live is None else path or _shown_folder(spark, f"{name}__{live}")
    _save(df, table, fmt or default_format(spark), evolve_schema, partition_by, f"{folder}/{slot}" if folder else None)
    if audit:
        audit(spark.table(table))
    columns = ", ".join("`" + c.replace("`", "``") + "`" for c in df.columns)
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('{LIVE_PROPERTY}' = '{slot}') AS SELECT {columns} FROM {table}")


def _shown_folder(spark: SparkSession, table: str) -> str | None:
    """The folder over an external slot; none for a managed one."""
    place = _external_path(spark, table)
    return place.rsplit("/", 1)[0] if place else None


def drop_published(spark: SparkSession, name: str) -> None:
    """Remove the view and both tables; the files of external ones stay."""
    spark.sql(f"DROP VIEW IF EXISTS {name}")
    for slot in SLOTS:
        spark.sql(f"DROP TABLE IF EXISTS {name}__{slot}")


def append_table(df: DataFrame, name: str, fmt: str | None = None) -> None:
    """Add rows to a table that keeps history."""
    df.write.format(fmt or default_format(df.sparkSession)).mode("append").saveAsTable(name)
