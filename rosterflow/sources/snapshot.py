"""System-of-record snapshot with the fixed projection the reconcile reads.

At scale the patron table comes from ``spark.read.jdbc`` (partitioned on a
numeric column, fetch size 10,000) or a parquet export; the note aggregates
are per-patron group-bys joined back on the patron id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterflow.operators import notes as nt

STUDENT_TYPES = (tuple(range(21, 39)) + (46, 47))


def patron_snapshot(patron: DataFrame, branch: DataFrame, notes: DataFrame, loans: DataFrame, *,
                    run_date: str, guarantor_marker: str = "Guarantor effective",
                    expired_marker: str = nt.EXPIRED_MARKER, closed_branch: str = "XMNPS") -> DataFrame:
    """Student patrons (types 21-38, 46-47 or student-shaped ids) with branch
    codes, current guarantor, expiry-note ids and guarantor notes to delete."""
    b = (branch.select("branch_number", "branch_code"))
    p = patron.filter(F.col("bty").isin(*STUDENT_TYPES) | F.col("patron_id").rlike(r"^190[0-9]{6}$"))
    guarantor = nt.latest_note(notes, marker=guarantor_marker).select("patron_id", "guarantor")
    expired = nt.expired_note_ids(notes, marker=expired_marker)
    dels = nt.guarantor_note_delete(notes, loans, run_date=run_date, prefix=guarantor_marker)
    out = (p.join(b, p["default_branch"] == b["branch_number"], "left")
           .withColumnRenamed("branch_code", "default_branch_code").drop("branch_number")
           .join(b, F.col("edit_branch") == b["branch_number"].cast("string"), "left")
           .withColumn("edit_branch_code", F.when(F.col("edit_branch") == closed_branch, F.lit(closed_branch))
                       .otherwise(F.col("branch_code")))
           .join(guarantor, "patron_id", "left").join(expired, "patron_id", "left").join(dels, "patron_id", "left"))
    return out.select("patron_id", "bty", "last_name", "first_name", "default_branch_code", "exp_date", "email",
                      "birth_date", "guarantor", "email_notices", "expired_note_ids", "delete_note_ids",
                      "collection_status", "edit_branch_code", "guid")
