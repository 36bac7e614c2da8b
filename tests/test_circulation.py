"""Circulation rules on hand-written rows."""

import datetime as dt

from pyspark.sql import functions as F

from rosterflow.operators import circulation as circ


def test_attribution_rules(spark):
    rows = [("181", "181", "508", "000", "508"),   # rule 1 -> patron
            ("100", "100", "200", "100", "100"),   # rule 2 -> env
            ("100", "100", "200", "300", None),    # rule 3 -> dropped
            ("100", "200", "300", "100", None),    # rule 4 -> dropped
            ("100", "200", "200", "100", "200"),   # else -> patron
            ("100", "100", None, "100", None)]     # NULL patron branch -> else -> NULL
    df = spark.createDataFrame(rows, "e string, i string, p string, now string, want string")
    got = [r[0] for r in df.select(circ.attribute_school(F.col("e"), F.col("i"), F.col("p"), F.col("now"))).collect()]
    assert got == [r[4] for r in rows]


def test_gap_rules(spark):
    ts = lambda h, m=0, s=0, d=2: dt.datetime(2024, 1, d, h, m, s)
    rows = [(1, 7, ts(23, 0, 0, d=1), "DS", "S"),   # previous day: does not count
            (2, 7, ts(8), "DS", "S"),               # first of the day -> counts
            (3, 7, ts(10), "DS", "S"),              # exactly 2 h -> no
            (4, 7, ts(12, 0, 1), "DS", "S")]        # 2 h + 1 s -> counts
    tx = spark.createDataFrame(rows, "txn_id long, item_id long, ts timestamp_ntz, txn_type string, status_before string") \
              .withColumn("item_branch", F.lit(0))
    branch = spark.createDataFrame([(0, "65000", "X", 2)], "branch_number int, branch_code string, branch_name string, branch_group int")
    out = circ.in_house_circ(tx, branch, start="2024-01-01", stop="2024-01-03")
    got = {(str(r.report_date), r.in_house) for r in out.collect()}
    assert got == {("2024-01-01", 1), ("2024-01-02", 2)}


def test_not_in_with_null_in_subquery(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    sub = spark.createDataFrame([("a",)], "k string")
    assert sorted(r[0] for r in circ.not_in(df, "k", sub, "k").collect()) == ["b"]
    sub_null = spark.createDataFrame([("a",), (None,)], "k string")
    assert circ.not_in(df, "k", sub_null, "k").count() == 0


def test_latest_checkout_keeps_ties(spark):
    t = dt.datetime(2024, 1, 5, 10)
    rows = [(1, 9, "p1", t, "CH", 2), (2, 9, "p2", t, "CH", 2), (3, 9, "p3", t - dt.timedelta(hours=1), "CH", 2)]
    tx = spark.createDataFrame(rows, "txn_id long, item_id long, patron_id string, ts timestamp_ntz, txn_type string, env_branch int")
    assert sorted(r.txn_id for r in circ.latest_checkout(tx, since="2024-01-01").collect()) == [1, 2]
