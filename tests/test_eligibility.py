"""Eligibility rules on hand-written rows."""

import datetime as dt

from pyspark.sql import functions as F

from rosterflow.operators import eligibility as el

RUN = "2024-02-01"


def _patrons(spark, rows):
    return spark.createDataFrame(rows, "patron_id string, bty int, exp_date date, zip string, guid string")


def test_downgrade_recent_rule_and_cap(spark):
    d = dt.date
    p = _patrons(spark, [("a", 3, d(2024, 1, 31), "37010", "g1"), ("b", 14, d(2023, 10, 1), "37010", "g2"),
                         ("c", 15, d(2024, 3, 1), "37010", "g3"), ("d", 3, d(2023, 10, 24), "37010", "g4")])
    got = {r.patron_id: (r.new_bty, r.new_exp_date) for r in el.area_downgrade(p, run_date=RUN).collect()}
    # a lapsed 1 day ago -> +2 years; b lapsed >100 days ago -> unchanged; c not lapsed; d exactly 100 days -> unchanged
    assert got == {"a": (45, d(2026, 2, 1)), "b": (44, d(2023, 10, 1)), "d": (45, d(2023, 10, 24))}
    assert [r.patron_id for r in el.area_downgrade(p, run_date=RUN, limit=1).collect()] == ["a"]


def test_bulk_extend_window(spark):
    d = dt.date
    p = _patrons(spark, [("a", 4, d(2024, 1, 31), "", ""), ("b", 16, d(2024, 2, 1), "", ""),
                         ("c", 17, d(2026, 2, 1), "", ""), ("e", 3, d(2024, 6, 1), "", "")])
    got = {r.patron_id: r.new_exp_date for r in el.bulk_extend(p, run_date=RUN).collect()}
    assert got == {"a": d(2024, 1, 31), "b": d(2026, 1, 31), "c": d(2026, 2, 1)}


def test_out_of_area(spark):
    d = dt.date(2025, 1, 1)
    p = _patrons(spark, [("a", 3, d, "37010", ""), ("b", 3, d, "99999", ""), ("c", 21, d, "99999", "")])
    assert [r.patron_id for r in el.out_of_area(p).collect()] == ["b"]


def test_hold_cancel_plan_with_cap(spark):
    holds = spark.createDataFrame([("211920000000009",), ("211920000000003",), ("100060",), ("100070",), ("12345",),
                                   ("9999999999",)], "user_id string")
    coll = spark.createDataFrame([("100060",)], "value string")
    full = {r.user_id: r.action for r in el.hold_cancel_plan(holds, coll).collect()}
    assert full == {"211920000000009": "cancel", "211920000000003": "cancel", "100060": "skip_collision",
                    "100070": "cancel", "12345": "skip_length", "9999999999": "skip_length"}
    capped = {r.user_id: r.action for r in el.hold_cancel_plan(holds, coll, limit=2).collect()}
    # Numeric order: 12345 (wrong length, not counted), 100060 (skipped, still
    # processed), 100070; the walk stops there, so 9999999999 is not listed.
    assert capped == {"100060": "skip_collision", "100070": "cancel", "12345": "skip_length"}


def test_calendar_phases(spark):
    cal = spark.createDataFrame([(dt.date(2023, 8, 7), dt.date(2023, 9, 5), dt.date(2024, 5, 24))],
                                "start_date date, twenty_day date, stop_date date")
    acts = spark.createDataFrame([("a", 5, 34), ("b", 6, 34)], "patron_id string, default_branch int, bty int")
    skips = spark.createDataFrame([(5, 34, dt.date(2023, 8, 1), dt.date(2023, 8, 31))],
                                  "branch int, bty int, skip_start date, skip_stop date")
    phase = lambda d: {r.patron_id: (r.phase, r.allowed) for r in
                       el.calendar_gate(acts, cal, run_date=d, skip_windows=skips).collect()}
    assert phase("2023-08-20") == {"a": ("homeroom", False), "b": ("homeroom", True)}
    assert phase("2023-10-01") == {"a": ("remove", True), "b": ("remove", True)}
    assert phase("2024-06-01") == {"a": ("closed", False), "b": ("closed", False)}
