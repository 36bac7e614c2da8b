"""Versioned tables: manifests, killed writes, micro-batches that run again."""

import os

import pytest

from rosterflow.sources.versioned import VersionedTable


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def data_folders(path):
    return {n for n in os.listdir(path) if n.startswith("data-")}


def test_readers_see_a_version_until_the_next_one_is_whole(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    make = lambda *v: spark.createDataFrame([(x,) for x in v], "a int")
    assert table.read() is None and table.manifest() is None
    table.replace(make(1, 2), part="x")
    table.replace(make(9), part="y")
    old = table.read()
    unfinished = table.write(make(5))  # a write that is killed before its manifest
    assert rows(table.read()) == [(1,), (2,), (9,)]
    assert rows(table.read(["y"])) == [(9,)]
    table.replace(make(3), part="x")
    assert rows(table.read()) == [(3,), (9,)]
    assert rows(old) == [(1,), (2,), (9,)]  # the version before can still be read
    assert unfinished not in data_folders(tmp_path / "t")
    for i in range(6):
        table.replace(make(i), part="x")
    assert rows(table.read()) == [(5,), (9,)]
    assert len(data_folders(tmp_path / "t")) == 3  # y, the newest x and the one before
    assert table.versions() == [7, 8]


def test_an_empty_part_and_an_unfinished_manifest(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.replace(spark.createDataFrame([], "a int, b string"))
    assert table.read().columns == ["a", "b"] and table.read().count() == 0
    (tmp_path / "t" / "_manifests" / ".000000000001-draft").write_text("{")  # killed before the rename
    assert table.read().count() == 0
    table.replace(spark.createDataFrame([(1, "x")], "a int, b string"))
    assert rows(table.read()) == [(1, "x")]


def test_two_writers_do_not_overwrite_each_other(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    df = spark.createDataFrame([(1,)], "a int")
    table.replace(df)
    other = VersionedTable(spark, str(tmp_path / "t"))
    other.versions = lambda: []  # a writer that has not seen the first version
    with pytest.raises(RuntimeError):
        other.replace(df)
    assert rows(table.read()) == [(1,)]


def test_batches_count_once_and_merge(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    make = lambda *v: spark.createDataFrame([(x,) for x in v], "a int")
    total = lambda df: df.groupBy().sum("a").toDF("a").selectExpr("CAST(a AS INT) AS a")
    for b in range(10):
        table.put_batch(make(b), b, "s", merge=total, most=4)
        table.put_batch(make(b, 100), b, "s", merge=total, most=4)  # the batch runs again
        assert sum(r.a for r in table.read().collect()) == sum(range(b + 1)) + 100 * (b + 1)
        assert sum(map(len, table.manifest()["parts"].values())) <= 5
    assert sum(r.a for r in table.before_batch(9, "s", make(1).schema).collect()) == sum(range(9)) + 900
    table.put_batch(make(7), 0, "another stream", merge=total, most=4)
    assert rows(table.read()) == [(7,)]
