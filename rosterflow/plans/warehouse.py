"""Daily data-warehouse reports (entry point E2).

One scan of the transaction log per report day serves all four checkout
variants (school / public items x staff / student) and the in-house report;
outputs are tab-separated files partitioned by owner, population and date.
A date range is one job over the whole range (``start``/``stop``), not a
loop of one-day jobs.
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterflow.operators import circulation as circ
from rosterflow.sources import sinks


def next_day(d: str) -> str:
    return (dt.date.fromisoformat(d) + dt.timedelta(days=1)).isoformat()


def warehouse_reports(txlog: DataFrame, branch: DataFrame, patron: DataFrame, items: DataFrame, *,
                      start: str, stop: str | None = None) -> dict[str, DataFrame]:
    stop = stop or next_day(start)
    return {
        "checkouts": circ.daily_checkouts(txlog, branch, patron, start=start, stop=stop),
        "in_house": circ.in_house_circ(txlog, branch, start=start, stop=stop),
        "collection": circ.collection_count(items, branch, run_date=start),
    }


def write_reports(reports: dict[str, DataFrame], out_dir: str) -> dict[str, str]:
    """TSV per (owner, population, day) for checkouts, ordered by patron, day and
    school (L2); per day for the others.  Dynamic partition overwrite makes a
    rerun of a day idempotent."""
    paths = {}
    chk = reports["checkouts"].withColumn("report_date", F.to_date("year_month_day", "yyyyMMdd"))
    paths["checkouts"] = os.path.join(out_dir, "checkouts")
    sinks.write_partitions(chk, paths["checkouts"], ["owner", "population", "report_date"], fmt="csv",
                           order=["patron_id", "year_month_day", "school_code"])
    for name in ("in_house", "collection"):
        paths[name] = os.path.join(out_dir, name)
        sinks.write_partitions(reports[name], paths[name], ["report_date"], fmt="csv")
    return paths
