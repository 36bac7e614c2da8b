"""Skew-safe ordered operators equal their window definitions, including
when one key holds a third of the rows."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from rosterflow.operators.ordered import first_per_key, joined_lists, pieces, previous_row


def _events(spark, n=3000):
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        item = 7 if i % 3 == 0 else i % 97          # item 7 holds a third of the rows
        ts = base + dt.timedelta(seconds=(i * 37) % 86400 * 2)  # spread over two days, with ties
        rows.append((i, item, ts, "DS" if i % 2 else "CH"))
    return spark.createDataFrame(rows, "txn_id long, item_id long, ts timestamp_ntz, txn_type string") \
                .withColumn("day", F.to_date("ts"))


def test_previous_row_matches_lag_on_hot_key(spark):
    df = _events(spark)
    w = Window.partitionBy("item_id", "day").orderBy("ts", "txn_id")
    ref = df.select("txn_id", F.lag("ts").over(w).alias("r_ts"), F.lag("txn_type").over(w).alias("r_type"))
    # Buckets of one second, one minute and more than a day: many groups, some, one per key.
    for seconds in (1, 60, 10**6):
        got = previous_row(df, ["item_id", "day"], "ts", "txn_id", ["ts", "txn_type"], bucket_seconds=seconds)
        bad = got.join(ref, "txn_id").filter(~F.col("prev_ts").eqNullSafe(F.col("r_ts"))
                                             | ~F.col("prev_txn_type").eqNullSafe(F.col("r_type")))
        assert got.count() == df.count() and bad.count() == 0


def test_first_per_key_matches_row_number(spark):
    rows = [(i % 5 if i % 3 else 0, f"s{(i * 7) % 11}", i) for i in range(600)]   # key 0 is hot
    df = spark.createDataFrame(rows, "k int, street string, x int")
    got = {r.k: (r.street, r.x) for r in first_per_key(df, "k", "street").collect()}
    w = Window.partitionBy("k").orderBy(F.col("street").desc(), F.col("x"))
    ref = {r.k: (r.street, r.x) for r in df.withColumn("rn", F.row_number().over(w)).filter("rn = 1").collect()}
    assert got == ref


def test_previous_row_cuts_a_burst(spark):
    """Half of an item's events lie within one second, a third of them at one instant."""
    base = "TIMESTAMP_NTZ'2024-01-01 10:00:00'"
    n = 60_000
    df = (spark.range(0, n, 1, 6).withColumn("h", F.pmod(F.xxhash64("id"), F.lit(10**9)))
          .select(F.col("id").alias("txn_id"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("h") % 50).alias("item_id"),
                  F.expr(f"timestampadd(MICROSECOND, CASE WHEN h % 2 = 0 THEN IF(h % 6 = 0, 5, h % 1000000) ELSE h * 80 END, {base})").alias("ts")))
    cut = pieces(df, ["item_id"], "ts", "txn_id", hot_rows=2000)
    sizes = [r[0] for r in cut.where("item_id = 7").groupBy("_bucket", "_piece").count().select("count").collect()]
    burst = df.where("item_id = 7").groupBy(F.date_trunc("second", "ts")).count().agg(F.max("count")).first()[0]
    assert burst > n / 7 and max(sizes) < burst / 20
    w = Window.partitionBy("item_id").orderBy("ts", "txn_id")
    rises = cut.select((F.struct("_bucket", "_piece") < F.lag(F.struct("_bucket", "_piece")).over(w)).alias("falls")).where("falls").count()
    assert rises == 0
    ref = df.select("txn_id", F.lag("txn_id").over(w).alias("want"))
    got = previous_row(df.withColumn("t", F.col("txn_id")), ["item_id"], "ts", "txn_id", ["t"], hot_rows=2000)
    assert got.join(ref, "txn_id").where(~F.col("prev_t").eqNullSafe(F.col("want"))).count() == 0 and got.count() == n


def test_previous_row_with_null_keys_times_and_no_rows(spark):
    schema = "txn_id bigint, item_id int, ts timestamp_ntz"
    assert previous_row(spark.createDataFrame([], schema), ["item_id"], "ts", "txn_id", ["txn_id"]).collect() == []
    at = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, 1, at), (2, 1, at), (3, 1, at + dt.timedelta(days=3)), (9, 2, at)], schema)
    assert {r.txn_id: r.prev_txn_id for r in previous_row(df, ["item_id"], "ts", "txn_id", ["txn_id"], hot_rows=0).collect()} == {
        1: None, 2: 1, 3: 2, 9: None}


def test_joined_lists_of_a_hot_key(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [(i, "hot" if i % 3 == 0 else f"p{i % 40}", base + dt.timedelta(days=i * 7919 % 500 // 3)) for i in range(3000)]
    df = spark.createDataFrame(rows, "note_id bigint, patron_id string, ts timestamp_ntz").repartition(5)
    cut = pieces(df, ["patron_id"], "ts", "note_id", bucket_seconds=30 * 86_400, hot_rows=50)
    for down in (True, False):
        got = {r.patron_id: r.ids for r in joined_lists(cut, "patron_id", ["_bucket", "_piece"], ["ts", "note_id"], "note_id", "ids",
                                                        descending=down).collect()}
        want = {}
        for i, p, t in sorted(rows, key=lambda r: (r[2], r[0]), reverse=down):
            want.setdefault(p, []).append(str(i))
        assert got == {p: ",".join(ids) for p, ids in want.items()}
    assert cut.where("patron_id = 'hot'").groupBy("_bucket", "_piece").count().agg(F.max("count")).first()[0] < 200
