"""File sources and sinks on small files written to a temporary folder."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from rosterflow.operators import media as md
from rosterflow.operators import usage as us
from rosterflow.sources import files as fs
from rosterflow.sources import sinks


def _tmp():
    return tempfile.mkdtemp(prefix="rosterflow-src-")


def test_binary_file_inventory(spark):
    d = _tmp()
    for name, size in (("190000001.jpg", 5000), ("190000002.jpg", 100), ("notes.txt", 10)):
        with open(os.path.join(d, name), "wb") as f:
            f.write(b"x" * size)
    inv = md.media_inventory(fs.read_images(spark, d), with_hash=True)
    rows = {r.file_name: r for r in inv.collect()}
    assert set(rows) == {"190000001.jpg", "190000002.jpg"}
    assert rows["190000001.jpg"].patron_id == "190000001" and rows["190000001.jpg"].n_bytes == 5000
    bad = md.media_invalid(inv.select("file_name", "n_bytes", "mtime"), run_date="2020-01-01").collect()
    assert [(r.file_name, r.reason) for r in bad] == [("190000002.jpg", "too_small")]
    later = md.media_invalid(inv.select("file_name", "n_bytes", "mtime"), run_date="2999-01-01").collect()
    assert {(r.file_name, r.reason) for r in later} == {("190000002.jpg", "too_small"), ("190000002.jpg", "not_today"),
                                                        ("190000001.jpg", "not_today")}


def test_json_pages_from_files(spark):
    d = _tmp()
    pages = [{"library_id": 3, "page": json.dumps({"items": [{"Date": "2024-01-02 10:00:00", "Patron": "190000001@x.org"},
                                                             {"Date": "2024-01-02 11:00:00", "Patron": "\"100004\""}]})},
             {"library_id": 4, "page": json.dumps({"status": "error", "message": "bad token"})}]
    with open(os.path.join(d, "p.json"), "w") as f:
        for p in pages:
            f.write(json.dumps(p) + "\n")
    df = spark.read.schema("library_id int, page string").json(d)
    items = us.json_items_explode(df).collect()
    assert [(r.library_id, r.patron_full) for r in items] == [(3, "190000001@x.org"), (3, '"100004"')]
    assert [(r.library_id, r.message) for r in us.json_error_pages(df).collect()] == [(4, "bad token")]
    ids = [r[0] for r in us.json_items_explode(df).select(us.patron_from_login(F.col("patron_full"))).collect()]
    assert ids == ["190000001", "100004"]


def test_positional_and_headered(spark):
    d = _tmp()
    with open(os.path.join(d, "a.txt"), "w") as f:
        f.write('190000001|31|DOE "J"|JOHN\n190000002|32|ROE|JANE\n')
    df = fs.read_positional(spark, d, {0: "patron_id", 2: "last_name"}, width=4)
    assert [tuple(r) for r in df.collect()] == [("190000001", 'DOE "J"'), ("190000002", "ROE")]
    h = _tmp()
    with open(os.path.join(h, "b.csv"), "w") as f:
        f.write('﻿"User ID"\tHold\n211\t1\n212\t2\textra\n')
    df = fs.read_csv_headered(spark, h, normalize=True)
    assert df.columns == ["USER ID", "HOLD"] and [tuple(r) for r in df.collect()] == [("211", "1")]


def test_header_only_file_and_dynamic_overwrite(spark):
    d = _tmp()
    empty = spark.createDataFrame([], "a string, b int")
    sinks.write_csv(empty, os.path.join(d, "empty"))
    assert spark.read.option("header", True).csv(os.path.join(d, "empty")).columns == ["a", "b"]
    hist = os.path.join(d, "hist")
    day1 = spark.createDataFrame([("2024-01-31", 1), ("2024-02-01", 2)], "report_date string, n int")
    sinks.write_partitions(day1, hist, ["report_date"])
    sinks.write_partitions(spark.createDataFrame([("2024-02-01", 5)], "report_date string, n int"), hist, ["report_date"])
    got = sorted((str(r.report_date), r.n) for r in spark.read.parquet(hist).collect())
    assert got == [("2024-01-31", 1), ("2024-02-01", 5)]


def test_ragged_rows_dropped_for_any_projection(spark):
    d = _tmp()
    with open(os.path.join(d, "r.tsv"), "w") as f:
        f.write("a\tb\n1\t2\n3\t4\textra\n5\n6\t\n")
    df = fs.read_csv_headered(spark, d)
    assert df.count() == len(df.collect()) == 2
    assert sorted(tuple(r) for r in df.collect()) == [("1", "2"), ("6", "")]


def test_header_normalized_reads_every_hold(spark, views, monkeypatch):
    from rosterflow.plans import q_sources

    read, seen = fs.read_csv_headered, []
    monkeypatch.setattr(q_sources.fs, "read_csv_headered", lambda *a, **k: seen.append(read(*a, **k)) or seen[-1])
    kept = q_sources.q_scan_header_normalized(views)
    assert seen[0].count() == views.holds.count() == kept.count() > 0


def test_records_follow_quotes(spark):
    d = _tmp()
    with open(os.path.join(d, "a.csv"), "w", newline="") as f:
        f.write('a,"b,c",d\n1,"x\ny",3\n2,"say ""hi"", ok",\n3,4\n4,5,6,7\n"",q,r\na,"b,c",d\n5,"",z\n')
    with open(os.path.join(d, "b.csv"), "w", newline="") as f:
        f.write('a,"b,c",d\n9,"l1\r\nl2",8\n')
    df = fs.read_csv_headered(spark, d)
    want = [("", "q", "r"), ("1", "x\ny", "3"), ("2", 'say "hi", ok', ""), ("5", "", "z"), ("9", "l1\r\nl2", "8")]
    assert df.columns == ["a", "b,c", "d"] and sorted(map(tuple, df.collect())) == want
    # The records that are kept do not depend on the columns that are read.
    assert df.count() == 5 and sorted(r.a for r in df.select("a").collect()) == [w[0] for w in want]
    assert sorted(r[0] for r in df.select("`b,c`").collect()) == sorted(w[1] for w in want)


def test_header_with_quoted_separators_and_line_breaks(spark):
    d = _tmp()
    with open(os.path.join(d, "a.tsv"), "w") as f:
        f.write('"x,y"\t"z,w"\n1,2,3,4\t5\n')
    df = fs.read_csv_headered(spark, d)
    assert fs.detect_delimiter(spark, d) == "\t" and df.columns == ["x,y", "z,w"] and [tuple(r) for r in df.collect()] == [("1,2,3,4", "5")]
    d = _tmp()
    with open(os.path.join(d, "a.csv"), "w") as f:
        f.write('"User\nID",n\n"7",1\n8,2,3\n')
    df = fs.read_csv_headered(spark, d, sep=",")
    assert df.columns == ["User\nID", "n"] and [tuple(r) for r in df.collect()] == [("7", "1")]


def test_a_headered_file_without_records(spark):
    d = _tmp()
    with open(os.path.join(d, "a.csv"), "w") as f:
        f.write("a,b\n")
    df = fs.read_csv_headered(spark, d)
    assert df.columns == ["a", "b"] and df.collect() == []
    d = _tmp()
    open(os.path.join(d, "a.csv"), "w").close()
    with pytest.raises(ValueError):
        fs.read_csv_headered(spark, d)
