"""Registered streaming queries (T1-T4); each returns what its sink holds
after an ``availableNow`` run over files landed from the stand-in tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from rosterflow.plans.catalog import register
from rosterflow.sources import files as fs
from rosterflow.sources.tables import VIEW_RUN_DATE
from rosterflow.streaming import jobs as sj


def _events_stream(v):
    path = f"{v.sf_dir.rstrip('/')}/events.parquet"
    schema = v.spark.read.parquet(path).schema
    e = (v.spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
         .option("pathGlobFilter", "events.parquet").parquet(v.sf_dir))
    eid, uid = F.col("event_id"), F.col("user_id")
    return e.select(
        eid.alias("txn_id"), uid.alias("item_id"), sj.wall_clock_instant("ts").alias("ts"),
        F.when(F.col("event_type").isin("purchase", "signup"), "CH")
         .when(F.col("event_type").isin("click", "view"), "DS").otherwise("RN").alias("txn_type"),
        F.when(eid % 4 == 0, "C").otherwise("S").alias("status_before"))


def _name(stem: str) -> str:
    return f"{stem}-{uuid.uuid4().hex}"


@register("stream_daily_counts", sql="""
WITH t AS (SELECT CAST(ts AS DATE) AS day, CASE event_type WHEN 'purchase' THEN 'CH' WHEN 'signup' THEN 'CH'
                  WHEN 'click' THEN 'DS' WHEN 'view' THEN 'DS' ELSE 'RN' END AS key FROM events)
SELECT strftime(day, '%Y-%m-%d') AS day, key, count(*) AS n FROM t WHERE day IS NOT NULL GROUP BY day, key""")
def q_stream_daily_counts(v):
    return sj.stream_daily_counts(_events_stream(v), name=_name("daily"), key=F.col("txn_type"))


@register("stream_gap_returns", sql="""
WITH t AS (SELECT event_id AS txn_id, user_id AS item_id, ts, event_id % 4 = 0 AS c,
                  CASE event_type WHEN 'click' THEN 'DS' WHEN 'view' THEN 'DS' ELSE 'X' END AS k,
                  lag(ts) OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS prev FROM events)
SELECT txn_id, item_id, epoch_us(ts) AS ts_us FROM t
WHERE k = 'DS' AND NOT c AND (prev IS NULL OR ts > prev + INTERVAL 2 HOUR)""")
def q_stream_gap_returns(v):
    return sj.stream_gap_returns(_events_stream(v), name=_name("gaps"))


# Every second id was seen last two days before the run, the others on the day itself, in a later file; ids that
# nobody saw for more than a week before the run leave.
@register("stream_last_seen", sql="""
WITH seen AS (
  SELECT patron_id, max(last_seen) AS last_seen FROM (
    SELECT patron_id, last_seen FROM v_last_seen
    UNION ALL SELECT patron_id, DATE '2024-02-01' - CAST(CAST(right(patron_id, 1) AS INT) % 2 * 2 AS INT) FROM v_extract)
  WHERE patron_id IS NOT NULL GROUP BY patron_id)
SELECT patron_id, strftime(last_seen, '%Y-%m-%d') AS last_seen FROM seen WHERE last_seen >= DATE '2024-02-01' - 7""")
def q_stream_last_seen(v):
    landed = fs.landing_path(v.spark, "roster-ids")
    back = F.expr("CAST(right(patron_id, 1) AS INT) % 2 * 2")
    for days in (2, 0):
        (v.extract.where(back == days).select("patron_id", F.date_sub(F.lit(VIEW_RUN_DATE).cast("date"), days).alias("seen_on"))
         .write.mode("append").parquet(landed))
    ids = v.spark.readStream.schema("patron_id string, seen_on date").parquet(landed)
    return sj.stream_last_seen(ids, v.last_seen, name=_name("last-seen"))


@register("stream_drops", sql="""
SELECT substr(activity_date, 1, 10) AS drop_date, library_id, CAST(sum(checkouts) AS BIGINT) AS checkouts
FROM v_usage GROUP BY 1, 2""")
def q_stream_drops(v):
    landed = fs.landing_path(v.spark, "drops")
    (v.usage.withColumn("drop_date", F.substring("activity_date", 1, 10))
     .write.partitionBy("drop_date").option("header", True).csv(landed))
    schema = "library_id int, activity_date string, patron_full string, user_email string, checkouts int"
    drops = (v.spark.readStream.schema(schema).option("header", True).option("maxFilesPerTrigger", 8)
             .csv(f"{landed}/drop_date=*")
             .withColumn("drop_date", F.regexp_extract(F.col("_metadata.file_path"), r"drop_date=([0-9-]+)", 1)))
    return sj.stream_drops(drops, name=_name("drops"), keys=[F.col("drop_date"), F.col("library_id")],
                           value="checkouts")
