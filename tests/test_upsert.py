from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from gradeline.operators import upsert as module
from gradeline.operators.upsert import (
    AmbiguousSourceError,
    classify_changes,
    latest_per_key,
    merge_statement,
    upsert,
    upsert_table,
)
from gradeline.sources import SchemaMismatchError, read_table, write_table

SCHEMA = "k string, m string, v int"
KEYS = ["k", "m"]


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(params=["broadcast", "shuffled"])
def join_way(request):
    return request.param


def test_matched_replaced_rest_kept_or_inserted(spark, join_way):
    target = spark.createDataFrame([("a", "x", 1), ("b", "x", 2), (None, "x", 3)], SCHEMA)
    source = spark.createDataFrame([("a", "x", 10), ("c", "x", 30), (None, "x", 40)], SCHEMA)
    want = sorted([("a", "x", 10), ("b", "x", 2), ("c", "x", 30), (None, "x", 3), (None, "x", 40)], key=str)
    assert _rows(upsert(target, source, KEYS, method=join_way)) == want


def test_twice_equals_once_for_full_keys(spark, join_way):
    target = spark.createDataFrame([("a", "x", 1), ("b", "x", 2)], SCHEMA)
    source = spark.createDataFrame([("a", "x", 10), ("c", "x", 30)], SCHEMA)
    once = upsert(target, source, KEYS, method=join_way)
    assert _rows(upsert(once, source, KEYS, method=join_way)) == _rows(once)


def test_ambiguous_source(spark):
    target = spark.createDataFrame([("a", "x", 1)], SCHEMA)
    source = spark.createDataFrame([("a", "x", 10), ("a", "x", 11), (None, "x", 1), (None, "x", 1)], SCHEMA)
    with pytest.raises(AmbiguousSourceError):
        upsert(target, source, KEYS)
    picked = upsert(target, source, KEYS, order_by=F.col("v"))
    assert _rows(picked) == sorted([("a", "x", 11), (None, "x", 1), (None, "x", 1)], key=str)


def test_latest_keeps_a_row_whose_order_is_null(spark):
    df = spark.createDataFrame([("a", "x", None), ("b", "x", None), ("b", "x", 5)], SCHEMA)
    assert _rows(latest_per_key(df, KEYS, F.col("v"))) == [("a", "x", None), ("b", "x", 5)]


@pytest.mark.parametrize("in_source", [True, False])
def test_hot_and_missing_keys(spark, join_way, in_source):
    """A third of the target on one key, in identical rows, and a third without a key."""
    n = 30_000
    third = F.col("id") % 3
    target = spark.range(n).select(
        F.when(third == 0, "hot").when(third == 1, F.concat(F.lit("k"), "id")).alias("k"),
        F.lit("x").alias("m"),
        F.when(third == 0, 0).otherwise(F.col("id")).cast("int").alias("v"),
    )
    first = "hot" if in_source else "absent"
    source = spark.createDataFrame([(first, "x", -1), ("k1", "x", -2), ("new", "x", -3)], SCHEMA)
    got = upsert(target, source, KEYS, method=join_way)
    counts = {r["k"]: r["count"] for r in got.groupBy("k").count().filter("k is null or count > 1").collect()}
    assert counts == ({None: n // 3} if in_source else {None: n // 3, "hot": n // 3})
    kept_hot = 0 if in_source else n // 3
    assert got.count() == n // 3 + kept_hot + (n // 3 - 1) + 3
    assert got.filter("v < 0").count() == 3


@pytest.mark.parametrize(
    "kind, wider", [("int", "bigint"), ("decimal(10,2)", "decimal(12,4)"), ("date", "timestamp")]
)
def test_keys_of_other_types_match_by_value(spark, join_way, kind, wider):
    values = ["DATE '2020-01-01'", "DATE '2020-01-02'", "DATE '2020-01-03'"] if kind == "date" else ["1", "2", "3"]
    one, two, three = values
    target = spark.sql(f"SELECT CAST(k AS {kind}) AS k, 0 AS v FROM VALUES ({one}), ({two}) t(k)")
    source = spark.sql(f"SELECT CAST(k AS {wider}) AS k, 1 AS v FROM VALUES ({one}), ({three}) t(k)")
    got = upsert(target, source, ["k"], method=join_way)
    assert sorted(r["v"] for r in got.collect()) == [0, 1, 1]


def _final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_target_is_read_once(spark, tmp_path, join_way):
    path = str(tmp_path / "target")
    spark.createDataFrame([("a", "x", 1), ("b", "x", 2), (None, "x", 3)], SCHEMA).write.parquet(path)
    source = spark.createDataFrame([("a", "x", 10)], SCHEMA)
    merged = upsert(spark.read.parquet(path), source, KEYS, order_by=F.col("v"), method=join_way)
    assert merged._jdf.queryExecution().optimizedPlan().toString().count("parquet") == 3  # target, source keys, source rows
    assert _rows(merged) == sorted([("a", "x", 10), ("b", "x", 2), (None, "x", 3)], key=str)


def test_a_hot_key_and_rows_without_key_are_split(spark, tmp_path):
    """The hot key's partition is read in parts; the rows without a key are dealt over all tasks."""
    path = str(tmp_path / "target")
    kind = F.col("id") % 3
    key = F.when(kind == 0, "hot").when(kind == 1, F.col("id").cast("string"))
    rows = spark.range(0, 60_000, 1, 8).select(key.alias("k"), F.lit("x").alias("m"), F.col("id").cast("int").alias("v"))
    rows.write.parquet(path)
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.files.maxPartitionBytes": "64k",
        "spark.sql.files.openCostInBytes": "16k",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for setting, value in settings.items():
        spark.conf.set(setting, value)
    try:
        source = spark.createDataFrame([("1", "x", 1), ("gone", "x", 1)], SCHEMA)
        kept = module.without_keys(spark.read.parquet(path), source.select(*KEYS), KEYS, method="shuffled")
        per_task = kept.groupBy("k", F.spark_partition_id().alias("p")).count().filter("k = 'hot' OR k IS NULL").collect()
        assert "skew=true" in _final_plan(kept)
    finally:
        for setting, value in before.items():
            spark.conf.set(setting, value)
    for key in ("hot", None):
        parts = [r["count"] for r in per_task if r["k"] == key]
        assert sum(parts) == 20_000 and len(parts) > 1 and max(parts) <= 10_000
    assert kept.count() == 59_999


def test_touched_partitions_in_one_list(spark):
    source = spark.range(3000).select(F.col("id").cast("string").alias("m")).unionByName(spark.sql("SELECT CAST(NULL AS STRING) AS m"))
    condition = module.touched_partitions(source, ["m"])
    found = source.filter(condition)
    assert "INSET" in found._jdf.queryExecution().optimizedPlan().toString().upper().replace(" ", "")
    assert found.count() == 3001


def test_an_empty_update_touches_no_file(spark):
    name = f"t_{uuid.uuid4().hex}"
    write_table(spark.createDataFrame([("a", "x", 1), ("b", "y", 2)], SCHEMA), name, evolve_schema=False, partition_by=["m"])
    before = sorted(read_table(spark, name).inputFiles())
    upsert_table(spark.createDataFrame([], SCHEMA), name, KEYS)
    assert sorted(read_table(spark, name).inputFiles()) == before


def test_the_source_is_computed_once(spark):
    name = f"t_{uuid.uuid4().hex}"
    write_table(spark.createDataFrame([("a", "x", 1)], SCHEMA), name, evolve_schema=False, partition_by=["m"])
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    source = spark.createDataFrame([("a", "x", 10), ("b", "y", 30)], SCHEMA).mapInArrow(counted, SCHEMA)
    upsert_table(source, name, KEYS, order_by=F.col("v"))
    assert seen.value == 2
    assert read_table(spark, name).count() == 2


@pytest.mark.parametrize("partitioned", [True, False])
def test_an_external_table_stays_external_after_an_upsert(spark, tmp_path, partitioned):
    name, path = f"t_{uuid.uuid4().hex}", str(tmp_path / "table")
    by = ["m"] if partitioned else []
    write_table(spark.createDataFrame([("a", "x", 1), ("b", "y", 2)], SCHEMA), name, evolve_schema=False, path=path, partition_by=by)
    upsert_table(spark.createDataFrame([("a", "x", 9)], SCHEMA), name, KEYS)
    assert spark.catalog.getTable(name).tableType == "EXTERNAL"
    assert sorted(r["v"] for r in spark.read.parquet(path).collect()) == [2, 9]


def test_best_row_is_picked_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", "x", 1)], SCHEMA)
    plan = latest_per_key(df, KEYS, F.col("v"))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_merge_statement_parses(spark):
    text = merge_statement("db.t", "s", KEYS)
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(text).toString()
    assert "MergeIntoTable" in plan


def test_upsert_table(spark):
    name = f"t_{uuid.uuid4().hex}"
    write_table(spark.createDataFrame([("a", "x", 1), ("b", "x", 2)], SCHEMA), name, evolve_schema=False)
    source = spark.createDataFrame([("a", "x", 10), ("c", "x", 30)], SCHEMA)
    for _ in range(2):
        upsert_table(source, name, KEYS)
        assert _rows(read_table(spark, name)) == [("a", "x", 10), ("b", "x", 2), ("c", "x", 30)]
    with pytest.raises(SchemaMismatchError):
        upsert_table(source.withColumn("w", F.lit(1)), name, KEYS)
    with pytest.raises(AmbiguousSourceError):
        upsert_table(source.union(source), name, KEYS)
    assert read_table(spark, name).count() == 3


def test_upsert_table_rewrites_only_touched_partitions(spark):
    name = f"t_{uuid.uuid4().hex}"
    stored = [("a", "x", 1), ("b", "x", 2), ("c", "y", 3), ("d", None, 4), ("e", "z", 5)]
    df = spark.createDataFrame(stored, SCHEMA)
    write_table(df, name, evolve_schema=False, partition_by=["m"])

    def files(condition):
        rows = read_table(spark, name).filter(condition)
        return {r[0] for r in rows.select("_metadata.file_path").distinct().collect()}

    untouched, touched = files("m IN ('y', 'z')"), files("m = 'x'")
    source = spark.createDataFrame([("a", "x", 10), ("f", None, 6), ("g", "new", 7)], SCHEMA)
    upsert_table(source, name, KEYS)
    want = [("a", "x", 10), ("b", "x", 2), ("c", "y", 3), ("d", None, 4), ("e", "z", 5), ("f", None, 6), ("g", "new", 7)]
    assert _rows(read_table(spark, name).select("k", "m", "v")) == sorted(want, key=str)
    assert files("m IN ('y', 'z')") == untouched
    assert not files("m = 'x'") & touched


def test_upsert_table_keeps_partitioning_when_all_is_rewritten(spark):
    name = f"t_{uuid.uuid4().hex}"
    df = spark.createDataFrame([("a", "x", 1), ("b", "y", 2)], SCHEMA)
    write_table(df, name, evolve_schema=False, partition_by=["m"])
    upsert_table(spark.createDataFrame([("a", "x", 9), ("b", "y", 8)], SCHEMA), name, KEYS)
    assert _rows(read_table(spark, name).select("k", "m", "v")) == [("a", "x", 9), ("b", "y", 8)]
    assert [c.name for c in spark.catalog.listColumns(name) if c.isPartition] == ["m"]


def _changes(target, source, **more):
    rows = classify_changes(target, source, KEYS, **more).collect()
    return sorted((tuple(r)[:-1] + (r["change"],) for r in rows), key=str)


def test_changes_by_kind(spark, join_way):
    target = [("a", "x", 1), ("b", "x", 2), ("c", "x", None), ("d", "x", 4), ("d", "x", 4), (None, "x", 5)]
    source = [("a", "x", 1), ("b", "x", 3), ("c", "x", None), ("d", "x", 4), ("e", "x", 5), (None, "x", 5)]
    got = _changes(spark.createDataFrame(target, SCHEMA), spark.createDataFrame(source, SCHEMA), method=join_way)
    kinds = ["unchanged", "updated", "unchanged", "updated", "inserted", "inserted"]
    assert got == sorted([(*row, kind) for row, kind in zip(source, kinds, strict=True)], key=str)


def test_changes_compare_in_the_types_of_the_target_and_see_where_a_null_is(spark):
    target = spark.sql("SELECT 'a' AS k, 'x' AS m, CAST(1 AS BIGINT) AS v, array('p', NULL) AS w, NULL AS s, 't' AS t")
    for w, s, t, kind in (
        ("array('p', NULL)", "NULL", "'t'", "unchanged"),
        ("array(NULL, 'p')", "NULL", "'t'", "updated"),
        ("array('p', NULL)", "'t'", "NULL", "updated"),
    ):
        source = spark.sql(f"SELECT 'a' AS k, 'x' AS m, CAST(1 AS INT) AS v, {w} AS w, {s} AS s, {t} AS t")
        assert [r["change"] for r in classify_changes(target.withColumn("s", F.col("s").cast("string")), source, KEYS).collect()] == [kind]


def test_changes_of_empty_sides(spark):
    none, one = spark.createDataFrame([], SCHEMA), spark.createDataFrame([("a", "x", 1)], SCHEMA)
    assert _changes(none, one) == [("a", "x", 1, "inserted")]
    assert _changes(one, none) == []
    keys_only = one.select("k", "m")
    assert [r["change"] for r in classify_changes(keys_only, keys_only, KEYS).collect()] == ["unchanged"]


def test_an_upsert_reports_and_leaves_what_does_not_change(spark):
    name = f"t_{uuid.uuid4().hex}"
    stored = [("a", "x", 1), ("b", "y", 2), ("c", "z", 3)]
    write_table(spark.createDataFrame(stored, SCHEMA), name, evolve_schema=False, partition_by=["m"])

    def files(part):
        return {r[0] for r in read_table(spark, name).filter(F.col("m") == part).select("_metadata.file_path").distinct().collect()}

    before = {part: files(part) for part in "xyz"}
    source = spark.createDataFrame([("a", "x", 1), ("b", "y", 20), ("d", "y", 4)], SCHEMA)
    assert upsert_table(source, name, KEYS) == {"inserted": 1, "updated": 1, "unchanged": 1}
    assert files("x") == before["x"] and files("z") == before["z"] and not files("y") & before["y"]
    after = files("y")
    assert upsert_table(source, name, KEYS) == {"inserted": 0, "updated": 0, "unchanged": 3}
    assert files("y") == after
    assert _rows(read_table(spark, name).select("k", "m", "v")) == [("a", "x", 1), ("b", "y", 20), ("c", "z", 3), ("d", "y", 4)]
