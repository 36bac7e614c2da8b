"""Registered outputs whose order is part of the result (L1-L3): each is written
as files and read back with the position of every row."""

from __future__ import annotations

from pyspark.sql import functions as F

from rosterflow.plans import q_circulation, q_eligibility, q_reconcile  # noqa: F401  (register the rows that are written here)
from rosterflow.plans.catalog import REGISTRY, register, to_edge
from rosterflow.sources import sinks
from rosterflow.sources.files import landing_path


def _ordered(v, name: str, rows, order):
    path = landing_path(v.spark, name)
    rows = to_edge(rows)
    sinks.write_csv(rows, path, order=order)
    return sinks.read_ordered_csv(v.spark, path, rows.schema)


@register("ordered_remove_list", sql=f"""
WITH r AS ({REGISTRY["reconcile_remove"].sql})
SELECT row_number() OVER (ORDER BY patron_id) AS position, patron_id, default_branch, bty FROM r""")
def q_ordered_remove_list(v):
    rows = REGISTRY["reconcile_remove"].build(v).select("patron_id", "default_branch", "bty")
    return _ordered(v, "remove-list", rows, ["patron_id"])


CHECKOUT_ORDER = ["patron_id", "year_month_day", "school_code", "owner", "population"]


@register("ordered_checkout_report", sql=f"""
WITH r AS ({REGISTRY["daily_checkouts"].sql})
SELECT row_number() OVER (ORDER BY {", ".join(CHECKOUT_ORDER)}) AS position, * FROM r""")
def q_ordered_checkout_report(v):
    return _ordered(v, "checkout-report", REGISTRY["daily_checkouts"].build(v), CHECKOUT_ORDER)


@register("ordered_hold_ids", sql=f"""
SELECT row_number() OVER (ORDER BY CAST(sort_key AS DECIMAL(20, 0)) NULLS FIRST, user_id) AS position, user_id
FROM ({q_eligibility.HOLDS_SQL})""")
def q_ordered_hold_ids(v):
    # Ids are text; the order is that of their numbers, and a text that is no number comes first.
    rows = q_eligibility.holds(v).select("user_id")
    return _ordered(v, "hold-ids", rows, [F.col("user_id").try_cast("decimal(20,0)"), F.col("user_id")])
