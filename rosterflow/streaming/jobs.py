"""Structured Streaming versions of the daily jobs.

Every stream reads files with an explicit schema, keeps its progress in a
checkpoint folder under ``spark.checkpoint.dir`` and runs with
``trigger(availableNow=True)`` (process what has landed, then stop), so a
scheduled run is incremental and restartable after executor or driver loss.
What a stream writes is a ``VersionedTable``: a micro-batch counts once however
often it is run, a killed write changes nothing that readers see, and a stream
that lost its checkpoint begins anew instead of meeting the rows of another one.

* T1 daily counts: event-time days; the counts of each batch are summed when
  read, so every event counts once, however late it comes, and the last days
  are there too.
* T2 gap returns: ``foreachBatch``; the rows of a micro-batch find the event
  before them with ``ordered.previous_row``, so a hot item is split, and the
  first of each item in the table of last events.  A batch adds the last events
  of its own items; nothing else of that table is written again.  Events are
  assumed to arrive in time order across micro-batches (an append-only log); the
  batch job (``circulation.in_house_circ``) is exact for any order.
* T3 last seen: ``transformWithState`` on the RocksDB provider.  The state is one
  day for each id; ids share a timer with the others of their bucket, which
  removes those that were not seen for more than the days of grace.  A batch
  writes the ids that it holds.
* T4 drops: date-named drop files aggregated per batch with ``foreachBatch``.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from rosterflow.operators.ordered import previous_row
from rosterflow.session import ensure_checkpoint_dir
from rosterflow.sources.versioned import VersionedTable

DAY_US = 86_400_000_000


def stream_root(spark: SparkSession, name: str) -> str:
    return os.path.join(ensure_checkpoint_dir(spark), "streams", name)


def wall_clock_instant(ts_ntz_col: str) -> Column:
    """TIMESTAMP_NTZ wall clock -> TIMESTAMP instant of the same UTC wall
    clock (independent of the session time zone)."""
    return F.expr(f"timestamp_micros(timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {ts_ntz_col}))")


def utc_day(instant: Column) -> Column:
    return F.date_from_unix_date(F.floor(F.unix_micros(instant) / DAY_US).cast("int"))


def _run(query) -> None:
    """Wait until the stream has processed all that has landed, however long that takes."""
    query.awaitTermination()  # raises the stream's error


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """Identity of the running stream, which a checkpoint keeps over restarts."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


# -- T1 ----------------------------------------------------------------------
def stream_daily_counts(events: DataFrame, *, name: str, key: Column) -> DataFrame:
    """Daily counts per key from a streaming event frame with an instant
    column ``ts``: of all events so far, in any order."""
    def count(batch: DataFrame) -> DataFrame:
        return batch.groupBy(utc_day(F.col("ts")).alias("day"), key.alias("key")).agg(F.count(F.lit(1)).alias("n"))

    # Events without a time belong to no day.
    return _summed(events.where(F.col("ts").isNotNull()), name, count, ["day", "key"], "n")


def _summed(rows: DataFrame, name: str, aggregate, keys: list[str], value: str) -> DataFrame:
    """Totals of ``value`` over the batches of a stream, each aggregated on its own."""
    spark = rows.sparkSession
    root = stream_root(spark, name)
    checkpoint, out = os.path.join(root, "checkpoint"), VersionedTable(spark, os.path.join(root, "out"))

    def total(df: DataFrame) -> DataFrame:
        return df.groupBy(*keys).agg(F.sum(value).cast("bigint").alias(value))

    def write(batch: DataFrame, batch_id: int) -> None:
        out.put_batch(aggregate(batch), batch_id, _stream_id(spark, checkpoint), merge=total)

    _run(rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    found = out.read()
    return total(aggregate(spark.createDataFrame([], rows.schema)) if found is None else found)


# -- T2 ----------------------------------------------------------------------
GAP_OUT = T.StructType([T.StructField("txn_id", T.LongType()), T.StructField("item_id", T.LongType()),
                        T.StructField("ts_us", T.LongType())])
GAP_STATE = T.StructType([T.StructField("no_item", T.BooleanType()), T.StructField("item", T.LongType()),
                          T.StructField("last_us", T.LongType())])


def stream_gap_returns(events: DataFrame, *, name: str, gap_hours: int = 2,
                       return_code: str = "DS", shelf_status: str = "S") -> DataFrame:
    """On-shelf returns (gap > ``gap_hours`` or first event of the day) per
    item with keyed state; returns the emitted events (batch read of sink)."""
    spark = events.sparkSession
    root = stream_root(spark, name)
    checkpoint = os.path.join(root, "checkpoint")
    last, out = (VersionedTable(spark, os.path.join(root, x)) for x in ("last-events", "out"))
    # Events without an item are the events of one item; the joins need a key that is never null.
    keys = ["no_item", "item"]
    rows = events.select("txn_id", "item_id", "txn_type", "status_before", F.unix_micros("ts").alias("ts_us"),
                         F.col("item_id").isNull().alias("no_item"), F.coalesce("item_id", F.lit(0)).cast("bigint").alias("item"))

    def latest(df: DataFrame) -> DataFrame:
        return df.groupBy(*keys).agg(F.max("last_us").alias("last_us"))

    def find(batch: DataFrame, batch_id: int) -> None:
        stream = _stream_id(spark, checkpoint)
        seen = batch.select(*keys).distinct()
        state = latest(last.before_batch(batch_id, stream, GAP_STATE).join(seen, keys, "left_semi"))
        ordered = previous_row(batch.withColumn("wall", F.expr("timestampadd(MICROSECOND, ts_us, TIMESTAMP_NTZ'1970-01-01 00:00:00')")),
                               keys, "wall", "txn_id", ["ts_us"])
        prev = F.coalesce("prev_ts_us", "last_us")
        same_day = F.floor(prev / DAY_US) == F.floor(F.col("ts_us") / DAY_US)
        hit = ((F.col("txn_type") == return_code) & (F.col("status_before") == shelf_status)
               & (prev.isNull() | ~same_day | (F.col("ts_us") - prev > gap_hours * 3_600_000_000)))
        found = ordered.join(state, keys, "left").where(hit).select("txn_id", "item_id", "ts_us")
        out.put_batch(found, batch_id, stream, merge=lambda df: df)
        # Last, as a batch that is run again must not meet its own events; its own part is left out when read.
        last.put_batch(latest(batch.select(*keys, F.col("ts_us").alias("last_us"))), batch_id, stream, merge=latest)

    _run(rows.where("ts_us IS NOT NULL").writeStream.foreachBatch(find)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    found = out.read()
    return spark.createDataFrame([], GAP_OUT) if found is None else found.select("txn_id", "item_id", "ts_us")


# -- T3 ----------------------------------------------------------------------
DAY_MS = 86_400_000
# A batch writes a log of its changes; whole snapshots are made now and then in the background.
ROCKSDB = {"spark.sql.streaming.stateStore.providerClass":
           "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
           "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true"}
# Spark sends a message for each key and for each timer; a key is a bucket of ids, by hash.  A checkpoint keeps its buckets.
BUCKETS = 1 << 12
GONE = T.StructType([T.StructField("patron_id", T.StringType()), T.StructField("last_seen", T.DateType())])


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Session settings for a while."""
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


class LastSeen(StatefulProcessor):
    """Last day on which the ids of a bucket were seen, until one has not been seen for more than ``grace`` days.

    A bucket has one timer at a time, for a day no later than that of any of its
    ids.  Seeing an id again only updates its day; when the timer fires, ids
    whose day is over leave and it is set anew for the first day of the others.
    """

    def __init__(self, grace: int, late: int):
        self.grace, self.late = grace, late

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.day = handle.getMapState("last_seen", "patron_id string", "day int")
        self.due = handle.getValueState("due", "day int")

    def _timer(self, day: int) -> int:
        # The watermark stands ``late`` days before the newest day; it passes this once that day is over day + grace.
        return (day + self.grace + 1 - self.late) * DAY_MS - 1

    def _see(self, parts: Iterator[pd.DataFrame]) -> None:
        days: dict[str, int] = {}
        for part in parts:
            for patron, day in zip(part["patron_id"].tolist(), part["day"].tolist()):
                days[patron] = max(int(day), days.get(patron, int(day)))
        fresh = None
        for patron, day in days.items():
            old = self.day.getValue((patron,))
            if old is None or day > old[0]:
                self.day.updateValue((patron,), (day,))
            if old is None:
                fresh = day if fresh is None else min(day, fresh)
        if fresh is not None:
            due = self.due.get()
            if due is not None and due[0] > fresh:
                self.handle.deleteTimer(self._timer(due[0]))
            if due is None or due[0] > fresh:
                self._set(fresh)

    def _set(self, day: int) -> None:
        self.due.update((day,))
        self.handle.registerTimer(self._timer(day))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        self._see(rows)
        return iter(())

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self._see(iter([initialState]))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now, gone, left = timerValues.getCurrentWatermarkInMs(), {}, None
        for (patron,), (day,) in self.day.iterator():
            if self._timer(day) > now:
                left = day if left is None else min(day, left)
            else:
                gone[patron] = day
        for patron in gone:
            self.day.removeKey((patron,))
        if left is None:
            self.due.clear()
        else:
            self._set(left)
        if not gone:
            return iter(())
        return iter([pd.DataFrame({"patron_id": pd.Series(list(gone), dtype=object), "day": list(gone.values())})])

    def close(self) -> None:
        pass


def stream_last_seen(ids: DataFrame, initial_state: DataFrame, *, name: str, grace_days: int = 7,
                     late_days: int = 1) -> DataFrame:
    """State (patron_id, last_seen) after all rows of ``ids(patron_id, seen_on)`` that have landed.

    An id that was last seen more than ``grace_days`` before the newest
    ``seen_on`` leaves the state, as do ids of ``initial_state`` that were never
    seen; ``removed_ids`` has them.  Rows without an id or a day are left out,
    and so are rows more than ``late_days`` behind the newest day of earlier
    batches.  The initial state counts at the first start only.
    """
    spark = ids.sparkSession
    bucket = F.pmod(F.xxhash64("patron_id"), F.lit(BUCKETS)).cast("int").alias("bucket")
    root = stream_root(spark, name)
    checkpoint = os.path.join(root, "checkpoint")
    day = F.unix_date("seen_on")
    rows = (ids.where("patron_id IS NOT NULL AND seen_on IS NOT NULL")
            .select(bucket, "patron_id", day.alias("day"), F.timestamp_seconds(day.cast("bigint") * 86_400).alias("at"))
            .withWatermark("at", f"{late_days} days"))
    first = (initial_state.where("patron_id IS NOT NULL AND last_seen IS NOT NULL")
             .select(bucket, "patron_id", F.unix_date("last_seen").alias("day")))
    gone = VersionedTable(spark, os.path.join(root, "removed"))

    def write(batch: DataFrame, batch_id: int) -> None:
        gone.put_batch(batch.select("patron_id", F.date_from_unix_date("day").alias("last_seen")), batch_id,
                       _stream_id(spark, checkpoint), merge=lambda df: df)

    with settings(spark, ROCKSDB):
        changes = (rows.groupBy("bucket").transformWithStateInPandas(
            LastSeen(grace_days, late_days), "patron_id string, day int", "update", "EventTime", initialState=first.groupBy("bucket")))
        _run(changes.writeStream.outputMode("update").foreachBatch(write)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        try:
            state = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "last_seen").load()
        except AnalysisException as e:
            if "STATE_STORE" not in (e.getCondition() or "") and "STDS" not in (e.getCondition() or ""):
                raise
            return first.select("patron_id", F.date_from_unix_date("day").alias("last_seen"))  # nothing has landed yet
    return state.select(F.col("user_map_key.patron_id").alias("patron_id"), F.date_from_unix_date("user_map_value.day").alias("last_seen"))


def removed_ids(spark: SparkSession, name: str) -> DataFrame:
    """(patron_id, last_seen) of the ids that have left the state of ``stream_last_seen`` so far."""
    found = VersionedTable(spark, os.path.join(stream_root(spark, name), "removed")).read()
    return spark.createDataFrame([], GONE) if found is None else found


# -- T4 ----------------------------------------------------------------------
def stream_drops(drops: DataFrame, *, name: str, keys: list[Column], value: str) -> DataFrame:
    """Totals of landed drop files over all batches, each summed on its own."""
    names = drops.select(*keys).columns

    def total(batch: DataFrame) -> DataFrame:
        return batch.groupBy(*keys).agg(F.sum(value).cast("bigint").alias(value))

    return _summed(drops, name, total, names, value)
