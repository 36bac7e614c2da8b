"""Nightly roster synchronisation (entry point E1): one run date, one
population, every action table, the run report and the change guard.

``RosterSync.plan`` returns lazy DataFrames; ``RosterSync.run`` persists them:
* the extract, the SoR snapshot and the state are staged once as tables
  bucketed on ``patron_id`` under ``spark.checkpoint.dir``: the outputs that
  read them neither recompute the scans and cleaning nor shuffle them again
  for their id joins, and a lost executor does not replay the lineage;
* the guard is evaluated before anything is written and aborts the run;
* action tables are written with dynamic partition overwrite on
  ``run_date`` (a rerun of a day replaces that day only);
* the new last-seen state is the next version of the table at ``state_dir``
  (``VersionedTable``): what readers see changes when it is whole;
* the staged tables are dropped at the end, also after a failure.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterflow.operators import notes as nt
from rosterflow.operators import reconcile as rc
from rosterflow.session import ensure_checkpoint_dir
from rosterflow.sources import sinks
from rosterflow.sources.versioned import VersionedTable

STUDENT_COMPARE = ["bty", "last_name", "first_name", "middle_name", "suffix", "street", "city", "state", "postal_code", "phone",
                   "default_branch", "exp_date", "birth_date", "teacher_id", "teacher_name", "collection_status"]
STAFF_COMPARE = ["bty", "last_name", "first_name", "middle_name", "suffix", "default_branch", "exp_date", "email",
                 "email_notices", "collection_status"]
STUDENT_CONTACT = ["email", "collection_status", "default_branch", "bty", "phone1", "phone", "teacher_id", "teacher_name"]
STAFF_CONTACT = ["email", "collection_status", "default_branch", "bty"]


@dataclass
class RosterSync:
    run_date: str
    population: str = "student"
    programme: bool = False
    grace_days: int = 7
    # Fixed values of the school system: its e-mail domain and closed branch code.
    school_domain: str = "mnpsk12.org"
    closed_branch: str = "XMNPS"
    closed_type: int = 38
    contact_cols: list[str] | None = None  # what a removal carries; by population if not given

    def _yes_no(self) -> tuple[Column, Column, Column, Column]:
        b = F.col("bty")
        return (b.between(21, 34) | (b == 46), b.between(35, 37) | (b == 47),
                F.col("permission") == "Yes", F.col("permission") == "No")

    def _report_rules(self) -> dict:
        """What the report counts: staff by any column and without the yes/no flags."""
        if self.population != "student":
            return {"compare_cols": STAFF_COMPARE, "policy": "any_column", "sticky": {"collection_status": 2}}
        names = ("sor_yes", "sor_no", "extract_yes", "extract_no")
        return {"compare_cols": STUDENT_COMPARE, **dict(zip(names, self._yes_no()))}

    def plan(self, extract: DataFrame, sor: DataFrame, state: DataFrame,
             notes: DataFrame | None = None) -> dict[str, DataFrame]:
        state_new, expired = rc.last_seen_merge(state, sor, extract, run_date=self.run_date,
                                                grace_days=self.grace_days, enabled=not self.programme)
        remove = rc.reconcile_remove(expired, sor, contact_cols=self.contact_cols or (STUDENT_CONTACT if self.population == "student" else STAFF_CONTACT),
                                     closed_branch=self.closed_branch, enabled=not self.programme)
        create = rc.reconcile_create(extract, sor)
        if self.population == "student":
            update = rc.reconcile_update(extract, sor, compare_cols=STUDENT_COMPARE)
        else:
            update = rc.reconcile_update(extract, sor, compare_cols=STAFF_COMPARE, policy="any_column",
                                         sticky={"collection_status": 2})
        out = {"state": state_new, "remove": remove, "create": create, "update": update,
               "email": rc.email_actions(extract, sor, school_domain=self.school_domain)}
        if notes is not None:
            out["expired_note_delete"] = nt.expired_note_delete(extract, notes, marker=nt.EXPIRED_MARKER)
        for by, exempt in (("default_branch", self.closed_branch), ("bty", self.closed_type)):
            if self.programme:
                sy, sn, ey, en = self._yes_no()
                rep = rc.reconcile_report(extract, sor, create, update, remove, by=by, sor_yes=sy, sor_no=sn,
                                          extract_yes=ey, extract_no=en, run_date=self.run_date)
            else:
                # Same counts as the action tables, each input read once.
                rep = rc.reconcile_report_onepass(
                    extract, sor, state, by=by, run_date=self.run_date, grace_days=self.grace_days,
                    closed_branch=self.closed_branch, **self._report_rules())
            out[f"report_{by}"] = rep
            out[f"guard_{by}"] = rc.abort_guard(rep, by=by, exempt=exempt)
        return out

    @classmethod
    def co_partition(cls, extract: DataFrame, sor: DataFrame, state: DataFrame,
                     buckets: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
        """The tables of ``stage`` as DataFrames."""
        return tuple(extract.sparkSession.table(t) for t in cls.stage(extract, sor, state, buckets))

    @staticmethod
    def stage(extract: DataFrame, sor: DataFrame, state: DataFrame, buckets: int | None = None) -> list[str]:
        """Stage the three inputs as tables bucketed identically on the id
        under the shared checkpoint folder.  Every later join on
        ``patron_id`` between them reads matching buckets (no shuffle of the
        inputs), and the staged tables cut the lineage back to the source
        scans (a lost executor re-reads a bucket file, not the sources)."""
        spark = extract.sparkSession
        n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        root = os.path.join(ensure_checkpoint_dir(spark), "roster-sync", uuid.uuid4().hex)
        out = []
        for name, df in (("extract", extract), ("sor", sor), ("state", state)):
            table = f"rosterflow_{name}_{os.path.basename(root)}"
            sinks.write_bucketed(df, table, "patron_id", n, path=os.path.join(root, name))
            out.append(table)
        return out

    def run(self, extract: DataFrame, sor: DataFrame, state: DataFrame, *, out_dir: str, state_dir: str,
            notes: DataFrame | None = None, enforce_guard: bool = True) -> dict[str, str]:
        """Persist one run; returns the written locations."""
        spark = extract.sparkSession
        tables = self.stage(extract, sor, state)
        try:
            return self._write(self.plan(*map(spark.table, tables), notes), out_dir, state_dir, enforce_guard)
        finally:
            for table in tables:
                spark.sql(f"DROP TABLE IF EXISTS {table}")

    def _write(self, tables: dict[str, DataFrame], out_dir: str, state_dir: str, enforce_guard: bool) -> dict[str, str]:
        if enforce_guard:
            for k in [k for k in tables if k.startswith("guard_")]:
                rc.raise_if_any(tables[k], f"{k} fired for {self.run_date}")
        written = {}
        new_state = tables.pop("state")
        VersionedTable(new_state.sparkSession, state_dir).replace(new_state, note={"run_date": self.run_date})
        written["state"] = state_dir
        for name, df in tables.items():
            path = os.path.join(out_dir, name)
            sinks.write_partitions(df.withColumn("run_date", F.lit(self.run_date)), path, ["run_date"])
            written[name] = path
        return written
