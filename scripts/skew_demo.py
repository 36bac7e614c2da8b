"""Hot-key demonstration: one item holds a third of all events.

Compares the plain window ``lag`` (one task sorts the hot item's rows) with
``ordered.previous_row`` (key + minute bucket), and a row-number keep-best
with ``ordered.first_per_key``.  Task times come from Spark's event log,
written to a fresh scratch folder; the report shows, per job, the slowest
task of each job and the median task of the same stage.

Usage: ``python scripts/skew_demo.py [rows]`` (default 3,000,000).
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def task_times_by_job(log_dir: str) -> dict[str, dict[int, list[float]]]:
    """job description -> stage id -> task durations (s), from the event log."""
    stage_job: dict[int, str] = {}
    tasks: dict[int, list[float]] = {}
    for path in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True):
        if not os.path.isfile(path) or os.path.basename(path).startswith("."):
            continue
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    desc = (ev.get("Properties") or {}).get("spark.job.description")
                    for sid in ev.get("Stage IDs", []):
                        if desc:
                            stage_job[sid] = desc
                elif kind == "SparkListenerTaskEnd":
                    info = ev["Task Info"]
                    tasks.setdefault(ev["Stage ID"], []).append((info["Finish Time"] - info["Launch Time"]) / 1000)
    out: dict[str, dict[int, list[float]]] = {}
    for sid, times in tasks.items():
        if sid in stage_job:
            out.setdefault(stage_job[sid], {})[sid] = times
    return out


def main() -> None:
    n = int(sys.argv[1]) if len(sys.argv) > 1 else 3_000_000
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from rosterflow.operators.ordered import first_per_key, previous_row
    from rosterflow.session import build_session

    scratch = tempfile.mkdtemp(prefix="run-skew-")
    logs = os.path.join(scratch, "events")
    os.makedirs(logs)
    spark = build_session("local[8]", app="skew-demo", shuffle_partitions=32,
                          extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": logs,
                                 "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false",
                                 "spark.local.dir": scratch, "spark.checkpoint.dir": os.path.join(scratch, "ckpt"),
                                 "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    # One item (7) holds a third of the events; the rest spread over 10,000 items.
    ev = spark.range(n).select(
        F.col("id").alias("txn_id"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 10000).alias("item_id"),
        F.timestamp_seconds(F.lit(1704067200) + (F.col("id") * 7919) % 86400).cast("timestamp_ntz").alias("ts"),
        F.col("id").cast("string").alias("payload"))
    path = os.path.join(scratch, "events.parquet")
    ev.repartition(32).write.parquet(path)
    ev = spark.read.parquet(path).withColumn("day", F.to_date("ts"))

    jobs = {
        "window lag": lambda: ev.select("txn_id", F.lag("ts").over(
            Window.partitionBy("item_id", "day").orderBy("ts", "txn_id")).alias("prev")),
        "previous_row": lambda: previous_row(ev, ["item_id", "day"], "ts", "txn_id", ["ts"]),
        "row_number keep-best": lambda: ev.withColumn("rn", F.row_number().over(
            Window.partitionBy("item_id").orderBy(F.col("payload").desc()))).filter("rn = 1"),
        "first_per_key": lambda: first_per_key(ev.select("item_id", "payload", "txn_id"), "item_id", "payload"),
    }
    walls = {}
    for name, build in jobs.items():
        spark.sparkContext.setJobDescription(name)
        t0 = time.time()
        build().write.format("noop").mode("overwrite").save()
        walls[name] = round(time.time() - t0, 2)
    spark.stop()  # closes the event log
    by_job = task_times_by_job(logs)
    report = {}
    for name in jobs:
        # The stage holding the slowest task, with its median for comparison.
        busiest = max(by_job.get(name, {0: [0.0]}).values(), key=max)
        report[name] = {"wall_s": walls[name], "max_task_s": round(max(busiest), 2),
                        "median_task_s": round(statistics.median(busiest), 3), "tasks": len(busiest),
                        "max_over_median": round(max(busiest) / max(statistics.median(busiest), 1e-3), 1)}
    print(json.dumps({"rows": n, "hot_key_share": "1/3", "jobs": report}))


if __name__ == "__main__":
    main()
