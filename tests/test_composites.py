"""End-to-end runs of the two entry points on the sf0.001 stand-ins."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from rosterflow.sources.versioned import VersionedTable
from rosterflow.operators import reconcile as rc
from rosterflow.plans.roster_sync import RosterSync
from rosterflow.plans.warehouse import warehouse_reports, write_reports
from rosterflow.sources.tables import Views

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def small(spark):
    return Views(spark, SMALL)


def test_roster_sync_run_and_rerun(spark, small):
    out, st = tempfile.mkdtemp(), tempfile.mkdtemp()
    sync = RosterSync(run_date="2024-02-01")
    w = sync.run(small.extract_x, small.sor_x, small.last_seen, out_dir=out, state_dir=st, enforce_guard=False)
    n_create = spark.read.parquet(w["create"]).count()
    assert n_create == rc.reconcile_create(small.extract_x, small.sor_x).count()
    # Rerunning the same day replaces that day's partition (idempotent).
    sync.run(small.extract_x, small.sor_x, small.last_seen, out_dir=out, state_dir=st, enforce_guard=False)
    assert spark.read.parquet(w["create"]).count() == n_create
    state = VersionedTable(spark, w["state"]).read()
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("rosterflow_")]
    assert state.filter(F.col("last_seen").isNull()).count() == 0


def test_roster_sync_guard_aborts(spark, small):
    with pytest.raises(RuntimeError):
        RosterSync(run_date="2024-02-01").run(small.extract_x, small.sor_x, small.last_seen,
                                              out_dir=tempfile.mkdtemp(), state_dir=tempfile.mkdtemp())


def test_warehouse_day(spark, small):
    reps = warehouse_reports(small.txlog, small.branch, small.patron, small.item, start="2024-01-10")
    paths = write_reports(reps, tempfile.mkdtemp())
    days = {r[0] for r in reps["checkouts"].select("year_month_day").distinct().collect()}
    assert days <= {"20240110"}
    assert os.path.isdir(paths["checkouts"])


def test_payload_json_and_addresses(spark, small):
    import json

    from rosterflow.operators import actions as ac
    from rosterflow.operators import roster as ro
    from rosterflow.plans import fixtures as fx

    roster = ro.format_student_roster(fx.roster_df(small), run_date="2024-02-01", expiration="2026-10-01").limit(5)
    out = ac.to_payload_json(ac.payload_create(roster, run_date="2024-02-01", test_pin="7357")).collect()
    assert out and all(r.action == "create" for r in out)
    p = json.loads(out[0].payload)
    assert [a["type"] for a in p["addresses"]] == ["Primary", "Secondary"]
    assert len(p["pin"]) == 4 and p["preferred_address"] in ("Sponsor", "Primary")


def test_co_partitioned_inputs_join_without_shuffle(spark, small):
    import contextlib
    import io

    from rosterflow.operators import reconcile as rc

    ext, sor, state = RosterSync.co_partition(small.extract_x, small.sor_x, small.last_seen)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            rc.reconcile_create(ext, sor).explain()
        plan = buf.getvalue()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_roster_sync_staff_policy(spark, small):
    sync = RosterSync(run_date="2024-02-01", population="staff")
    t = sync.plan(small.extract_x, small.sor_x, small.last_seen)
    upd = t["update"]
    assert "changed_cols" in upd.columns
    # Sticky collection status: a SoR status of 2 is kept and never counts as a change.
    sent = small.sor_x.filter("collection_status = 2").select("patron_id")
    kept = upd.join(sent, "patron_id")
    assert kept.filter("collection_status <> 2").count() == 0
    assert kept.filter("changed_cols LIKE '%collection_status%'").count() == 0


def test_roster_sync_report_matches_action_tables(spark, small):
    from pyspark.sql import functions as F

    sync = RosterSync(run_date="2024-02-01")
    t = sync.plan(small.extract_x, small.sor_x, small.last_seen)
    b = F.col("bty")
    slow = rc.reconcile_report(small.extract_x, small.sor_x, t["create"], t["update"], t["remove"], by="bty",
                               sor_yes=b.between(21, 34) | (b == 46), sor_no=b.between(35, 37) | (b == 47),
                               extract_yes=F.col("permission") == "Yes", extract_no=F.col("permission") == "No",
                               run_date="2024-02-01")
    assert sorted(t["report_bty"].collect()) == sorted(slow.collect())


def test_staff_run_needs_no_student_columns(spark, small):
    """The staff extract has no yes/no flags, guarantor or address; the plan must not read them."""
    staff = small.extract_x.filter("length(patron_id) = 6").drop("permission", "laptop", "tech_optout", "guarantor", "street", "city", "state",
                                                                 "postal_code", "phone", "phone1", "teacher_id", "teacher_name", "birth_date")
    sor = small.sor_x.filter("length(patron_id) = 6")
    state = small.last_seen.filter("length(patron_id) = 6")
    t = RosterSync(run_date="2024-02-01", population="staff").plan(staff, sor, state)
    counts = {r.default_branch: r for r in t["report_default_branch"].collect()}
    assert "sor_yes" not in t["report_default_branch"].columns
    assert sum(r.updated for r in counts.values()) == t["update"].count()
    assert sum(r.removed for r in counts.values()) == t["remove"].count()
    assert "phone" not in t["remove"].columns
    t["guard_bty"].collect()


def test_each_student_column_is_compared(spark, small):
    """Every 29th id differs from the SoR in one further column; all of them are updates."""
    t = RosterSync(run_date="2024-02-01").plan(small.extract_x, small.sor_x, small.last_seen)
    updated = {r.patron_id for r in t["update"].select("patron_id").collect()}
    ids = {r.patron_id for r in small.extract_x.join(small.sor_x, "patron_id", "left_semi").select("patron_id").collect()}
    assert {i for i in ids if 1 <= int(i[-4:]) % 29 <= 9} <= updated
    assert {"phone1", "phone", "teacher_id", "teacher_name"} <= set(t["remove"].columns)
