"""Upsert by business key: one reading of the target, one computation of the source.

``upsert`` gives the merged rows, ``upsert_table`` merges into a stored table, and
``classify_changes`` tells what a source would change.

A row with a NULL in its key matches nothing: in the target it stays, in the source it
is inserted.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from gradeline.operators.quality import duplicate_keys
from gradeline.sources.tables import (
    Staged,
    check_schema,
    default_format,
    read_table,
    replace_rows,
)

BROADCAST_KEY_BYTES = 32 * 1024 * 1024
METHODS = ("broadcast", "shuffled")
CHANGES = ("inserted", "updated", "unchanged")
_SPREAD = "__spread"
_CHANGE = "__change"


class AmbiguousSourceError(ValueError):
    """Several source rows claim one key."""


def _has_key(keys: Sequence[str]) -> Column:
    return reduce(and_, [F.col(key).isNotNull() for key in keys])


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Column) -> DataFrame:
    """The row with the greatest ``order_by`` for each key, NULL-keyed rows all kept.

    Spark drops all but the best row per key in each task before the shuffle, so a hot
    key sends one row per task. Ties are broken by the remaining columns. Rows without a full
    key are groups of their own, so the input is read once.
    """
    rest = [F.col(c).desc() for c in df.columns if c not in keys]
    own = F.when(~_has_key(keys), F.monotonically_increasing_id())
    best = Window.partitionBy(*keys, _SPREAD).orderBy(order_by.desc(), *rest)
    ranked = df.withColumn(_SPREAD, own).withColumn("__rank", F.row_number().over(best))
    return ranked.filter("__rank = 1").select(*df.columns)


def _key_bytes(keys: Sequence[str]) -> Column:
    """What the full keys take when they are broadcast; a sum for one pass."""
    size = reduce(lambda a, b: a + b, [F.octet_length(F.col(k).cast("string")) + 16 for k in keys])
    return F.coalesce(F.sum(F.when(_has_key(keys), size)), F.lit(0)).alias("bytes")


def _way(n_bytes: int, method: str | None) -> str:
    if method is None:
        return "broadcast" if n_bytes <= BROADCAST_KEY_BYTES else "shuffled"
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}")
    return method


def without_keys(
    target: DataFrame, source_keys: DataFrame, keys: Sequence[str], method: str | None = None
) -> DataFrame:
    """Target rows whose key is not in ``source_keys``, which holds full keys only.

    Keys of a measured small size are broadcast and the target is not shuffled. Beyond
    that both sides are shuffled on the key. ``method`` asks for one of the two. The target is
    read once either way.
    """
    if method is None:
        method = _way(source_keys.agg(_key_bytes(keys)).first()["bytes"], None)
    if _way(0, method) == "broadcast":
        return target.join(F.broadcast(source_keys.distinct()), list(keys), "left_anti").select(*target.columns)
    left, right = _spread(target, keys), _spread(source_keys.distinct(), keys)
    return left.join(right, [*keys, _SPREAD], "left_anti").select(*target.columns)


def _spread(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """With a column to join on beside the keys, which deals the rows without a full key over all tasks.

    It is 0 for a full key. The partition of a hot key is split by adaptive execution, which
    reads a skewed side of the join in parts; rows without a key would all be one such partition,
    and they can match nothing. The zero is not a literal, which the planner would take out of
    the join's keys.
    """
    zero = F.least(F.spark_partition_id(), F.lit(0))
    return df.withColumn(_SPREAD, F.when(_has_key(keys), zero).otherwise(F.spark_partition_id() + 1))


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    order_by: Column | None = None,
    method: str | None = None,
) -> DataFrame:
    """Replace the target rows whose key the source holds, insert the rest of the source.

    Several source rows on one key are an error, unless ``order_by`` says which wins: the
    row with the greatest value. Keys of different types are compared as Spark compares them,
    in the wider type. The source is computed once, when this is called, into the shared folder,
    where the result reads it; the target is read once, by the result.
    """
    staged, method = _staged_source(source, keys, order_by, method)
    keyed = staged.df.filter(_has_key(keys)).select(*keys)
    return without_keys(target, keyed, keys, method).unionByName(staged.df)


def _staged_source(
    source: DataFrame, keys: Sequence[str], order_by: Column | None, method: str | None
) -> tuple[Staged, str]:
    """The source rows to merge, one per key, and how to find their keys in the target.

    The size of the keys is added up while the rows are written.
    """
    seen = Observation("source keys")
    picked = source if order_by is None else latest_per_key(source, keys, order_by)
    staged = Staged(picked.observe(seen, _key_bytes(keys)))
    if order_by is None and not duplicate_keys(staged.df.filter(_has_key(keys)), keys).isEmpty():
        staged.drop()
        raise AmbiguousSourceError(f"the source holds several rows for one key of {list(keys)}")
    return staged, _way(seen.get["bytes"], method)


def fingerprint(df: DataFrame, columns: Sequence[str]) -> Column:
    """Two 64-bit hashes of the values of the columns and of which of them are NULL.

    Nested values are hashed as JSON text, in which a NULL inside them has its place.
    """
    parts = [F.lit("row")]
    for name in columns:
        nested = df.schema[name].dataType.simpleString().startswith(("array", "struct", "map"))
        parts += [F.to_json(F.col(name)) if nested else F.col(name), F.col(name).isNull()]
    return F.struct(F.xxhash64(*parts).alias("h1"), F.xxhash64(F.lit("second"), *parts).alias("h2"))


def classify_changes(
    target: DataFrame, source: DataFrame, keys: Sequence[str], method: str | None = None, change: str = "change"
) -> DataFrame:
    """The source rows, one per key, with what each does to the target: one of ``CHANGES``.

    A row is unchanged if the target holds its key in one row of the same values, compared by
    fingerprint in the target's types. A key of several target rows is updated, for one row would
    take their place. A row without a full key is inserted. Of the target only the keys and
    fingerprints are shuffled, added up per key in each task first; with keys of a measured small
    size, only those of keys that the source holds.
    """
    rest = [c for c in target.columns if c.upper() not in {k.upper() for k in keys}]
    as_target = [F.col(c).cast(target.schema[c].dataType).alias(c) for c in rest]
    wanted = source.select(*keys, F.struct(*source.columns).alias("__row"), *as_target)
    wanted = wanted.select(*keys, "__row", fingerprint(target, rest).alias("__own"))
    held = target.filter(_has_key(keys))
    keyed = source.filter(_has_key(keys)).select(*keys)
    if method is None:
        method = _way(keyed.agg(_key_bytes(keys)).first()["bytes"], None)
    if _way(0, method) == "broadcast":
        held = held.join(F.broadcast(keyed.distinct()), list(keys), "left_semi")
    held = held.select(*keys, fingerprint(target, rest).alias("__held"))
    held = held.groupBy(*keys).agg(F.count("*").alias("__n"), F.min("__held").alias("__held"))
    joined = _spread(wanted, keys).join(_spread(held, keys), [*keys, _SPREAD], "left")
    same = (F.col("__n") == 1) & (F.col("__own") == F.col("__held"))
    kind = F.when(F.col("__n").isNull(), "inserted").when(same, "unchanged").otherwise("updated")
    return joined.select("__row.*", kind.alias(change))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def merge_statement(target: str, source: str, keys: Sequence[str]) -> str:
    """The same upsert as SQL, for a table format that supports MERGE."""
    condition = " AND ".join(f"target.{_quoted(key)} = source.{_quoted(key)}" for key in keys)
    return (
        f"MERGE INTO {target} AS target USING {source} AS source ON {condition} "
        "WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *"
    )


def _partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [column.name for column in spark.catalog.listColumns(name) if column.isPartition]


def touched_partitions(source: DataFrame, columns: Sequence[str]) -> Column:
    """A condition that holds at least in the partitions that the source has rows for.

    One list of values per column, which may take in more partitions than are touched. The
    values are as many as the table's partitions, which its catalog lists as well.
    """
    parts = []
    for column in columns:
        values = [row[0] for row in source.select(column).distinct().collect()]
        known = [value for value in values if value is not None]
        same = F.col(column).isin(known) if known else F.lit(False)
        parts.append(same | F.col(column).isNull() if None in values else same)
    return reduce(and_, parts)


def upsert_table(
    source: DataFrame,
    name: str,
    keys: Sequence[str],
    order_by: Column | None = None,
    fmt: str | None = None,
    method: str | None = None,
) -> dict[str, int]:
    """Merge the source into a stored table, which keeps its place, kind and properties.

    Returns how many source rows were inserted, updated and unchanged. The rows to merge are
    computed once, into the shared folder, and those that change nothing are left out of the
    merge; where none is left the table is not touched. A format with MERGE rewrites only the
    files it must. A table partitioned by key columns has only the partitions read and rewritten
    that the changes may touch. The merged rows are stored beside the table before it is
    overwritten, so a failing merge leaves it as it was.
    """
    spark = source.sparkSession
    fmt = fmt or default_format(spark)
    check_schema(source, name)
    staged, method = _staged_source(source, keys, order_by, method)
    with staged as rows:
        target = read_table(spark, name)
        partitions = _partition_columns(spark, name)
        by_partition = bool(partitions) and {c.upper() for c in partitions} <= {k.upper() for k in keys}
        near = target.filter(touched_partitions(rows, partitions)) if by_partition else target
        seen = Observation("changes")
        counts = [F.count(F.when(F.col(_CHANGE) == kind, 1)).alias(kind) for kind in CHANGES]
        classified = classify_changes(near, rows, keys, method, _CHANGE).observe(seen, *counts)
        with Staged(classified.filter(F.col(_CHANGE) != "unchanged").drop(_CHANGE)) as update:
            report = {kind: seen.get[kind] for kind in CHANGES}
            if report["inserted"] or report["updated"]:
                _merge(update, name, keys, fmt, method, partitions if by_partition else [])
    return report


def _merge(update: DataFrame, name: str, keys: Sequence[str], fmt: str, method: str, partitions: Sequence[str]) -> None:
    spark = update.sparkSession
    if fmt == "delta":
        view = name.replace(".", "_") + "__source"
        update.createOrReplaceTempView(view)
        spark.sql(merge_statement(name, view, keys))
        spark.catalog.dropTempView(view)
        return
    target = read_table(spark, name)
    base = target.filter(touched_partitions(update, partitions)) if partitions else target
    keyed = update.filter(_has_key(keys)).select(*keys)
    with Staged(without_keys(base, keyed, keys, method).unionByName(update)) as rows:
        replace_rows(rows, name, only_partitions=bool(partitions))
