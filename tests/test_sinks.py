"""Sinks: one job for a write, order over files, files for each group at any number of tasks."""

import glob
import os
import uuid

import pytest
from pyspark.sql import functions as F

from rosterflow.operators.usage import split_by_date
from rosterflow.sources import sinks


def jobs_of(spark, action):
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, group)
    try:
        out = action()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_a_write_is_one_job_and_counts_its_rows(spark, tmp_path):
    df = spark.range(0, 1000, 1, 7).withColumn("x", F.col("id") % 3)
    rows, jobs = jobs_of(spark, lambda: sinks.write_csv(df, str(tmp_path / "a")))
    assert (rows, jobs) == (1000, 1) and spark.read.option("header", True).csv(str(tmp_path / "a")).count() == 1000
    rows, jobs = jobs_of(spark, lambda: sinks.write_csv(df.where("id < 0"), str(tmp_path / "b")))
    files = glob.glob(str(tmp_path / "b" / "*.csv"))
    assert (rows, jobs) == (0, 1) and [open(f).read() for f in files] == ["id,x\n"]


def test_an_empty_result_may_be_an_error_that_leaves_the_old_report(spark, tmp_path):
    path = str(tmp_path / "report")
    sinks.write_csv(spark.range(3), path, allow_empty=False)
    with pytest.raises(RuntimeError, match="empty result"):
        sinks.write_csv(spark.range(0), path, allow_empty=False)
    assert spark.read.option("header", True).csv(path).count() == 3 and os.listdir(tmp_path) == ["report"]
    assert sinks.write_csv(spark.range(2), path) == 2
    assert spark.read.option("header", True).csv(path).count() == 2


def test_files_by_name_hold_the_order(spark, tmp_path):
    ids = [str(i * 7919 % 100003) for i in range(20000)] + ["12x", "", "007", "7"]
    df = spark.createDataFrame([(i, n) for n, i in enumerate(ids)], "id string, n int").repartition(9)
    path = str(tmp_path / "ids")
    adaptive = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as with much data: several files
    try:
        sinks.write_csv(df, path, order=[F.col("id").try_cast("decimal(20,0)"), F.col("id"), F.col("n")])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", adaptive)
    files = sorted(f for f in os.listdir(path) if f.endswith(".csv"))
    assert len(files) > 4
    lines = [line for f in files for line in open(os.path.join(path, f)).read().splitlines()[1:]]
    number = lambda i: (1, int(i)) if i.isdigit() else (0, 0)  # noqa: E731  what is no number comes first
    want = sorted(((i, n) for n, i in enumerate(ids)), key=lambda x: (*number(x[0]), x[0], x[1]))
    assert [x.replace('""', "") for x in lines] == [f"{i},{n}" for i, n in want]
    back = sinks.read_ordered_csv(spark, path, df.schema).collect()
    assert [(r.id, r.n) for r in sorted(back)] == want and sorted(r.position for r in back) == list(range(1, len(ids) + 1))


def test_groups_have_few_files_at_any_number_of_tasks(spark, tmp_path):
    df = spark.range(0, 20000, 1, 40).select(
        F.when(F.col("id") % 3 == 0, "staff").otherwise("student").alias("population"),
        F.concat(F.lit("2024-01-0"), (F.col("id") % 5 + 1).cast("string")).alias("year_month_day"), F.col("id").alias("checkouts"))
    path = str(tmp_path / "split")
    back = split_by_date(df, path)
    assert sorted(back.collect()) == sorted(df.collect()) and back.columns == df.columns
    files = glob.glob(path + "/population=*/year_month_day=*/*.csv")
    assert len({os.path.dirname(f) for f in files}) == 10 and len(files) <= 20
    # A later call replaces the days that it has, and no others.
    later = df.where("year_month_day = '2024-01-02'").withColumn("checkouts", F.lit(1).cast("bigint"))
    assert split_by_date(later, path).where("checkouts = 1 AND year_month_day = '2024-01-02'").count() == 4000
    assert spark.read.option("header", True).csv(path).count() == 20000


def test_a_large_group_is_split(spark, tmp_path):
    df = spark.range(0, 300000, 1, 16).select(F.lit("a").alias("g"), F.sha2(F.col("id").cast("string"), 256).alias("x"))
    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4m")
    try:
        sinks.write_partitions(df, str(tmp_path / "hot"), ["g"])
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", size)
    assert 2 <= len(glob.glob(str(tmp_path / "hot" / "g=a" / "*.parquet"))) <= 16


def test_ordered_partitions(spark, tmp_path):
    df = spark.range(0, 5000, 1, 11).select((F.col("id") % 3).alias("g"), (F.col("id") * 7 % 5003).alias("k"))
    sinks.write_partitions(df, str(tmp_path / "o"), ["g"], fmt="csv", order=["k"])
    for g in range(3):
        files = sorted(glob.glob(str(tmp_path / "o" / f"g={g}" / "*.csv")))
        got = [int(x) for f in files for x in open(f).read().splitlines()[1:]]
        assert got == sorted(got) and len(got) == len([i for i in range(5000) if i % 3 == g])


def test_a_bucket_is_one_file(spark):
    table = f"bucketed_{uuid.uuid4().hex}"
    sinks.write_bucketed(spark.range(0, 1000, 1, 20).withColumnRenamed("id", "patron_id"), table, "patron_id", 4)
    try:
        assert len(spark.table(table).inputFiles()) == 4
    finally:
        spark.sql(f"DROP TABLE {table}")
