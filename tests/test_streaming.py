"""Stream restarts: a second availableNow run over the same checkpoint adds
nothing, and new files are picked up incrementally."""

import os
import tempfile

from pyspark.sql import functions as F

from rosterflow.streaming import jobs as sj

SCHEMA = "library_id int, activity_date string, patron_full string, user_email string, checkouts int"


def _drops(spark, folder):
    return (spark.readStream.schema(SCHEMA).option("header", True).csv(folder)
            .withColumn("drop_date", F.substring("activity_date", 1, 10)))


def test_drop_stream_is_incremental_and_idempotent(spark):
    landing = tempfile.mkdtemp(prefix="rosterflow-drops-")
    day1 = spark.createDataFrame([(1, "2024-01-02 00:00:00", "a", "x", 2), (1, "2024-01-02 00:00:00", "b", "y", 3)], SCHEMA)
    day1.write.mode("append").option("header", True).csv(landing)
    name = "drops-" + os.path.basename(landing)
    first = {(r.drop_date, r.library_id): r.checkouts
             for r in sj.stream_drops(_drops(spark, landing), name=name, keys=[F.col("drop_date"), F.col("library_id")],
                                      value="checkouts").collect()}
    assert first == {("2024-01-02", 1): 5}
    again = sj.stream_drops(_drops(spark, landing), name=name, keys=[F.col("drop_date"), F.col("library_id")],
                            value="checkouts").collect()
    assert {(r.drop_date, r.library_id): r.checkouts for r in again} == first
    day2 = spark.createDataFrame([(2, "2024-01-03 00:00:00", "c", "z", 4)], SCHEMA)
    day2.write.mode("append").option("header", True).csv(landing)
    third = {(r.drop_date, r.library_id): r.checkouts
             for r in sj.stream_drops(_drops(spark, landing), name=name, keys=[F.col("drop_date"), F.col("library_id")],
                                      value="checkouts").collect()}
    assert third == {("2024-01-02", 1): 5, ("2024-01-03", 2): 4}


def test_last_seen_stream_equals_the_batch_merge_day_by_day(spark):
    """Ids that nobody saw for more than a week leave on a later day; one that comes back enters again."""
    import datetime as dt

    from rosterflow.operators.reconcile import last_seen_merge

    landing = tempfile.mkdtemp(prefix="rosterflow-ids-")
    name = "seen-" + os.path.basename(landing)
    first = dt.date(2024, 2, 1)
    state = spark.createDataFrame([("old", first - dt.timedelta(9)), ("week", first - dt.timedelta(7)), ("never", None), ("a", first - dt.timedelta(1))],
                                  "patron_id string, last_seen date")
    nobody = spark.createDataFrame([], "patron_id string")
    batch, gone = state, set()
    days = {0: ["a", "c", "c"], 1: ["c", "d"], 7: ["c"], 8: ["c"], 9: ["c", "b"], 10: ["a"], 19: ["b", None]}
    for n, ids in days.items():
        day = first + dt.timedelta(n)
        (spark.createDataFrame([(i, day) for i in ids], "patron_id string, seen_on date").coalesce(1).write.mode("append").parquet(landing))
        stream = spark.readStream.schema("patron_id string, seen_on date").parquet(landing)
        got = {r.patron_id: r.last_seen for r in sj.stream_last_seen(stream, state, name=name).collect()}
        kept, expired = last_seen_merge(batch, nobody, spark.createDataFrame([(i,) for i in ids if i], "patron_id string").distinct(),
                                        run_date=str(day))
        want = [tuple(r) for r in kept.collect()]
        gone |= {r.patron_id for r in expired.collect() if r.last_seen}
        assert got == dict(want), n
        assert {r.patron_id for r in sj.removed_ids(spark, name).collect()} == gone
        batch = spark.createDataFrame(want, "patron_id string, last_seen date")
    assert gone == {"old", "week", "d", "a", "c"} and set(got) == {"b"}
    # Restart with nothing new: no change.
    stream = spark.readStream.schema("patron_id string, seen_on date").parquet(landing)
    assert {r.patron_id: r.last_seen for r in sj.stream_last_seen(stream, state, name=name).collect()} == got


def test_last_seen_state_is_not_written_again(spark):
    """A batch of one id changes one key of the state store, whatever the state holds."""
    import datetime as dt

    landing = tempfile.mkdtemp(prefix="rosterflow-ids-")
    name = "seen-" + os.path.basename(landing)
    state = spark.createDataFrame([(str(i), dt.date(2024, 1, 30)) for i in range(500)], "patron_id string, last_seen date")

    def run(day, *ids):
        spark.createDataFrame([(i, day) for i in ids], "patron_id string, seen_on date").coalesce(1).write.mode("append").parquet(landing)
        stream = spark.readStream.schema("patron_id string, seen_on date").parquet(landing)
        assert sj.stream_last_seen(stream, state, name=name).count() == 500
        progress = os.path.join(sj.stream_root(spark, name), "checkpoint", "commits")
        return max(int(n) for n in os.listdir(progress) if n.isdigit())

    def state_files(after):
        """Size of the changes that batches after ``after`` have written (a version is one more than its batch)."""
        folder = os.path.join(sj.stream_root(spark, name), "checkpoint", "state")
        return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(folder) for f in files
                   if f.endswith(".changelog") and f.split("_")[0].split(".")[0].isdigit() and int(f.split("_")[0].split(".")[0]) > after + 1)

    last = run(dt.date(2024, 2, 1), "7")
    whole = state_files(-1)
    run(dt.date(2024, 2, 2), "8")
    assert 0 < state_files(last) < whole / 2


def test_last_seen_ids_share_the_timer_of_their_bucket(spark, monkeypatch):
    """Keys and timers, which cost a message each, don't grow with the ids; every id still leaves on its own day."""
    import datetime as dt
    import random

    from rosterflow.streaming.jobs import settings

    monkeypatch.setattr(sj, "BUCKETS", 4, raising=False)
    rng = random.Random(3)
    landing = tempfile.mkdtemp(prefix="rosterflow-ids-")
    name = "seen-" + os.path.basename(landing)
    first = dt.date(2024, 2, 1)
    known = {f"i{i}": first - dt.timedelta(rng.randint(0, 5)) for i in range(60)}
    state = spark.createDataFrame(list(known.items()), "patron_id string, last_seen date")
    gone = set()
    # The first batch has no newest day yet, so its new ids may lie before all days of their bucket.
    days = [[(f"n{i}", first - dt.timedelta(6)) for i in range(20)] + [(f"i{i}", first) for i in range(0, 60, 7) for _ in range(3)]]
    days += [[(rng.choice("in") + str(rng.randint(0, 25)), first + dt.timedelta(n)) for _ in range(12)] for n in (1, 3, 4, 8, 9, 20)]
    for rows in days:
        spark.createDataFrame(rows, "patron_id string, seen_on date").coalesce(1).write.mode("append").parquet(landing)
        with settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "7"}):
            ids = spark.readStream.schema("patron_id string, seen_on date").parquet(landing)
            got = {r.patron_id: r.last_seen for r in sj.stream_last_seen(ids, state, name=name).collect()}
        for patron, day in rows:
            known[patron] = max(day, known.get(patron, day))
        newest = max(day for _, day in rows)
        left = {p for p, day in known.items() if (newest - day).days > 7}
        gone |= left
        known = {p: day for p, day in known.items() if p not in left}
        assert got == known and {r.patron_id for r in sj.removed_ids(spark, name).collect()} == gone
        timers = (spark.read.format("statestore").option("path", os.path.join(sj.stream_root(spark, name), "checkpoint"))
                  .option("readRegisteredTimers", True).load())
        assert 0 < timers.count() <= 4
    assert len(gone) > 60 and known


def test_a_lost_checkpoint_meets_no_state_of_the_old_stream(spark):
    landing = tempfile.mkdtemp(prefix="rosterflow-gaps-")
    name = "gaps-" + os.path.basename(landing)

    def run():
        events = (spark.readStream.schema("txn_id bigint, item_id bigint, minute bigint").parquet(landing)
                  .select("txn_id", "item_id", F.lit("DS").alias("txn_type"), F.lit("S").alias("status_before"),
                          F.timestamp_micros(F.col("minute") * 60_000_000).alias("ts")))
        return sorted(r.txn_id for r in sj.stream_gap_returns(events, name=name).collect())

    spark.createDataFrame([(1, 7, 0), (2, 7, 60), (3, 8, 5)], "txn_id bigint, item_id bigint, minute bigint").write.mode("append").parquet(landing)
    assert run() == run() == [1, 3]
    checkpoint = os.path.join(sj.stream_root(spark, name), "checkpoint")
    os.rename(checkpoint, f"{checkpoint}-elsewhere")
    assert run() == [1, 3]


def test_daily_counts_hold_late_files_and_the_last_day(spark):
    import datetime as dt

    landing = tempfile.mkdtemp(prefix="rosterflow-events-")
    name = "daily-" + os.path.basename(landing)

    def run():
        events = (spark.readStream.schema("day string, kind string").option("maxFilesPerTrigger", 1).parquet(landing)
                  .select(F.expr("timestamp_micros(unix_micros(to_timestamp(concat(day, ' 12:00:00Z'))))").alias("ts"), "kind"))
        return {(r.day, r.key): r.n for r in sj.stream_daily_counts(events, name=name, key=F.col("kind")).collect()}

    def land(*rows):
        spark.createDataFrame(rows, "day string, kind string").coalesce(1).write.mode("append").parquet(landing)

    land(("2024-01-09", "CH"), ("2024-01-10", "CH"), ("2024-01-10", "CH"))
    first = {(dt.date(2024, 1, 9), "CH"): 1, (dt.date(2024, 1, 10), "CH"): 2}
    assert run() == first
    assert run() == first
    land(("2024-01-02", "DS"), ("2024-01-10", "CH"), (None, "CH"))  # a week late
    assert run() == {**first, (dt.date(2024, 1, 2), "DS"): 1, (dt.date(2024, 1, 10), "CH"): 3}


def test_gap_returns_split_a_hot_item_and_go_on_over_batches(spark, monkeypatch):
    calls, split = [], sj.previous_row
    monkeypatch.setattr(sj, "previous_row", lambda *a, **k: calls.append(a[1]) or split(*a, **k))
    landing = tempfile.mkdtemp(prefix="rosterflow-gaps-")
    name = "gaps-" + os.path.basename(landing)

    def run():
        events = (spark.readStream.schema("txn_id bigint, item_id bigint, minute bigint").parquet(landing)
                  .select("txn_id", "item_id", F.lit("DS").alias("txn_type"), F.lit("S").alias("status_before"),
                          F.timestamp_micros(F.col("minute") * 60_000_000).alias("ts")))
        return sorted(r.txn_id for r in sj.stream_gap_returns(events, name=name).collect())

    def land(*rows):
        spark.createDataFrame(rows, "txn_id bigint, item_id bigint, minute bigint").write.mode("append").parquet(landing)

    land((1, 7, 0), (2, 7, 60), (3, 7, 181), (4, 7, 181), (5, 8, 200), (11, None, 10), (12, None, 20))
    assert run() == [1, 3, 5, 11]
    land((6, 7, 300), (7, 7, 421), (8, 8, 321), (9, 7, 1441), (10, 7, 1442))
    assert run() == [1, 3, 5, 7, 8, 9, 11] and run() == [1, 3, 5, 7, 8, 9, 11]
    assert len(calls) == 2
