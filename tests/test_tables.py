"""Stored tables, copies with a lifetime, and reports written in one job."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sievemark.functions.concurrent import side_by_side
from sievemark.sources import reports, tables


@pytest.fixture
def folder(spark):
    path = Path(spark.conf.get("spark.checkpoint.dir")) / "materialised"
    return lambda: set(path.iterdir()) if path.exists() else set()


@pytest.fixture
def name(spark):
    yield "kept_rows"
    spark.sql("DROP TABLE IF EXISTS kept_rows")


def failing(df):
    return df.withColumn("id", F.when(F.col("id") == 2, F.raise_error(F.lit("no"))).otherwise(F.col("id")))


def table_names(spark):
    return {table.name for table in spark.catalog.listTables()}


def test_a_table_is_rebuilt_from_itself(spark, name):
    before = table_names(spark)
    tables.replace_table(spark.range(3), name)
    for _ in range(2):
        found = tables.replace_table(spark.table(name).withColumn("id", F.col("id") * 2), name)
    assert sorted(row.id for row in found.collect()) == [0, 4, 8]
    assert sorted(row.id for row in tables.replace_table(spark.range(1).select("id", F.lit("x").alias("s")), f"default.{name}").collect()) == [0]
    assert table_names(spark) == before | {name}


def test_a_failed_write_keeps_the_old_table(spark, name):
    tables.replace_table(spark.range(3), name)
    held = table_names(spark)
    with pytest.raises(Exception, match="no"):
        tables.replace_table(failing(spark.table(name)), name)
    assert spark.table(name).count() == 3 and table_names(spark) == held
    with pytest.raises(Exception, match="no"):
        tables.replace_table(failing(spark.range(3)), "never_there")
    assert table_names(spark) == held


def test_copies_end_with_their_block(spark, folder):
    before = folder()
    with tables.temporary_copies(spark):
        outer = tables.materialise(spark.range(4))
        with tables.temporary_copies(spark):
            assert tables.materialise(spark.range(5)).count() == 5
        assert outer.count() == 4 and len(folder() - before) == 1
        inner = tables.stored_result(spark, lambda: tables.materialise(spark.range(6)))
        assert inner.count() == 6 and len(folder() - before) == 2
    assert folder() == before


def test_copies_of_jobs_side_by_side(spark, folder):
    before = folder()
    with tables.temporary_copies(spark):
        found = side_by_side(spark, [lambda n=n: tables.materialise(spark.range(n)) for n in (2, 3)])
        assert [df.count() for df in found] == [2, 3] and len(folder() - before) == 2
    assert folder() == before


def test_copies_end_with_an_error(spark, folder):
    before = folder()
    with pytest.raises(Exception, match="no"), tables.temporary_copies(spark):
        tables.materialise(failing(tables.materialise(spark.range(4))))
    with pytest.raises(Exception, match="no"):
        tables.stored_result(spark, lambda: failing(tables.materialise(spark.range(4))))
    assert folder() == before


def test_only_the_result_is_left(spark, folder):
    before = folder()
    found = tables.stored_result(spark, lambda: tables.materialise(tables.materialise(spark.range(7)).where("id > 2")).where("id > 4"))
    assert sorted(row.id for row in found.collect()) == [5, 6] and len(folder() - before) == 1


def jobs_of(spark, call):
    spark.sparkContext.setJobGroup("counted", "counted")
    try:
        before = set(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))
        result = call()
        return result, len(set(spark.sparkContext.statusTracker().getJobIdsForGroup("counted")) - before)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_a_report_takes_one_job(spark, tmp_path):
    rows = spark.range(10, numPartitions=3).select(F.col("id").alias("value"), F.lit(None).cast("double").alias("percent"))
    written, jobs = jobs_of(spark, lambda: reports.write_report(rows, f"{tmp_path}/full"))
    assert written and jobs == 1
    assert reports.read_report(spark, f"{tmp_path}/full", "value int, percent double").count() == 10


@pytest.mark.parametrize("empty", ["filtered", "local", "aggregated"])
def test_an_empty_report_leaves_nothing(spark, tmp_path, empty):
    rows = spark.range(10, numPartitions=3)
    tables_of = {
        "filtered": lambda: rows.where("id < 0"),
        "local": lambda: spark.createDataFrame([], "id bigint"),
        "aggregated": lambda: rows.where("id % 20 = 11").groupBy("id").count(),
    }
    path = Path(f"{tmp_path}/none")
    assert reports.write_report(rows, str(path)) and path.exists()
    assert not reports.write_report(tables_of[empty](), str(path)) and not path.exists()
