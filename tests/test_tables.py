from __future__ import annotations

import uuid
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from gradeline.sources import (
    NotAViewError,
    SchemaMismatchError,
    append_table,
    drop_published,
    publish_table,
    read_table,
    register_views,
    scratch_dir,
    write_table,
)


@pytest.fixture
def name():
    return f"t_{uuid.uuid4().hex}"


def test_full_refresh_replaces_rows_and_schema(spark, name):
    df = spark.range(5)
    write_table(df, name, evolve_schema=True)
    write_table(df, name, evolve_schema=True)
    assert read_table(spark, name).count() == 5
    write_table(df.withColumn("more", F.lit("x")), name, evolve_schema=True)
    assert read_table(spark, name).columns == ["id", "more"]


def test_fixed_schema_refuses_and_leaves_the_table(spark, name):
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    write_table(df, name, evolve_schema=False)
    write_table(df.withColumn("id", F.lit(2)), name, evolve_schema=False)
    for changed in (df.withColumn("w", F.lit(1)), df.drop("v"), df.withColumn("id", F.lit("9"))):
        with pytest.raises(SchemaMismatchError, match=name):
            write_table(changed, name, evolve_schema=False)
    assert [tuple(r) for r in read_table(spark, name).collect()] == [(2, "a")]


def test_partitioned_table_keeps_its_schema_check(spark, name):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, part string").select("part", "id")
    for _ in range(2):
        write_table(df, name, evolve_schema=False, partition_by=["part"])
    assert read_table(spark, name).filter("part = 'b'").first()["id"] == 2


def test_append_keeps_history(spark, name):
    for _ in range(2):
        append_table(spark.range(3), name)
    assert read_table(spark, name).count() == 6


def test_views_are_visible_to_sql(spark):
    register_views({"some_view": spark.range(3)})
    assert spark.sql("SELECT count(*) AS n FROM some_view WHERE id > 0").first()["n"] == 2


def _session(master, **settings):
    conf = SimpleNamespace(get=lambda key, default=None: settings.get(key, default))
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, applicationId="some"))


def test_scratch_is_the_folder_the_session_names():
    for master in ("local[2]", "spark://host:7077"):
        assert scratch_dir(_session(master, **{"spark.checkpoint.dir": "/shared"})) == "/shared"


@pytest.mark.parametrize("master", ["spark://host:7077", "local-cluster[2,1,1024]"])
def test_a_cluster_must_name_a_shared_folder(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(_session(master))


@pytest.mark.parametrize("external", [True, False])
@pytest.mark.parametrize("evolve", [True, False])
def test_a_write_that_fails_midway_leaves_the_old_rows(spark, name, tmp_path, external, evolve):
    path = str(tmp_path / "table") if external else None
    write_table(spark.range(3), name, evolve_schema=False, path=path)
    failing = spark.range(9).withColumn("id", F.when(F.col("id") < 8, F.col("id")).otherwise(F.raise_error(F.lit("no"))))
    with pytest.raises(Exception, match="no"):
        write_table(failing.select(F.col("id").cast("long")), name, evolve_schema=evolve)
    assert sorted(r["id"] for r in read_table(spark, name).collect()) == [0, 1, 2]


@pytest.mark.parametrize("evolve", [True, False])
def test_an_external_table_stays_where_it_is(spark, name, tmp_path, evolve):
    path = str(tmp_path / "table")
    write_table(spark.range(3), name, evolve_schema=False, path=path)
    df = spark.range(4).withColumn("more", F.lit(1)) if evolve else spark.range(4)
    write_table(df, name, evolve_schema=evolve)
    assert spark.catalog.getTable(name).tableType == "EXTERNAL"
    assert spark.read.parquet(path).count() == 4


def _ids(spark, name):
    return sorted(r["id"] for r in read_table(spark, name).collect())


@pytest.mark.parametrize("external", [True, False])
def test_publishing_writes_rows_once_and_switches(spark, name, tmp_path, external):
    path = str(tmp_path / "table") if external else None
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    for n in (3, 5, 4):
        publish_table(spark.range(n).mapInArrow(counted, "id long"), name, evolve_schema=False, path=path)
        assert _ids(spark, name) == list(range(n))
        path = None
    assert seen.value == 12
    tables = {f"{name}__a", f"{name}__b"}
    assert {t.name for t in spark.catalog.listTables() if t.name.startswith(name)} == {name, *tables}
    kinds = {spark.catalog.getTable(t).tableType for t in tables}
    assert kinds == {"EXTERNAL" if external else "MANAGED"}
    drop_published(spark, name)
    assert not spark.catalog.tableExists(name)


def test_a_failing_or_refused_publication_leaves_the_old_rows(spark, name):
    publish_table(spark.range(3), name, evolve_schema=False)
    failing = spark.range(9).select(F.when(F.col("id") < 8, F.col("id")).otherwise(F.raise_error(F.lit("no"))).cast("long").alias("id"))

    def refuse(rows):
        raise ValueError(f"{rows.count()} rows")

    for df, audit, text in ((failing, None, "no"), (spark.range(7), refuse, "7 rows")):
        with pytest.raises(Exception, match=text):
            publish_table(df, name, evolve_schema=True, audit=audit)
        assert _ids(spark, name) == [0, 1, 2]
    with pytest.raises(SchemaMismatchError):
        publish_table(spark.range(3).withColumn("more", F.lit(1)), name, evolve_schema=False)
    publish_table(spark.range(2).withColumn("a.b`c", F.lit(1)), name, evolve_schema=True)
    assert read_table(spark, name).columns == ["id", "a.b`c"]


def test_a_reader_of_the_old_rows_ends_well_and_the_view_may_feed_itself(spark, name):
    publish_table(spark.range(3), name, evolve_schema=False)
    reader = read_table(spark, name)
    for _ in range(2):
        publish_table(read_table(spark, name).select((F.col("id") + 1).alias("id")), name, evolve_schema=False)
        if _ == 0:
            assert sorted(r["id"] for r in reader.collect()) == [0, 1, 2]
    assert _ids(spark, name) == [2, 3, 4]


def test_a_plain_table_is_not_replaced_by_a_view(spark, name):
    write_table(spark.range(3), name, evolve_schema=True)
    with pytest.raises(NotAViewError, match=name):
        publish_table(spark.range(1), name, evolve_schema=True)


def test_a_published_table_prunes_partitions(spark, name):
    df = spark.range(10).select("id", (F.col("id") % 2).cast("string").alias("part"))
    publish_table(df, name, evolve_schema=False, partition_by=["part"])
    plan = read_table(spark, name).filter("part = '1'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan
