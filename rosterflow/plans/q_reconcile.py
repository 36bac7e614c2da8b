"""Registered reconcile queries.

Inputs: ``x_sor`` (SoR snapshot), ``x_extract`` (roster) and ``v_last_seen``
(state) with run date 2024-02-01 and a 7-day grace period.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from rosterflow.sources.files import landing_path
from rosterflow.sources.versioned import VersionedTable
from rosterflow.operators import reconcile as rc
from rosterflow.plans.catalog import register
from rosterflow.plans.roster_sync import STAFF_COMPARE, STUDENT_COMPARE, STUDENT_CONTACT
from rosterflow.sources.tables import VIEW_RUN_DATE

RUN = VIEW_RUN_DATE
STUDENT_COLS, STAFF_COLS, CONTACT = STUDENT_COMPARE, STAFF_COMPARE, STUDENT_CONTACT
FLAGS = {"tech_optout": 1, "laptop": 3, "permission": 4}


def student_extract(v):
    """The roster with the collection status that every student gets."""
    return v.extract_x.withColumn("collection_status", F.lit(78))


def run(v):
    """One reconcile run over the stand-in inputs -> dict of action tables."""
    sor, ext = v.sor_x, student_extract(v)
    state, expired = rc.last_seen_merge(v.last_seen, sor, ext, run_date=RUN)
    remove = rc.reconcile_remove(expired, sor, contact_cols=CONTACT)
    create = rc.reconcile_create(ext, sor)
    update = rc.reconcile_update(ext, sor, compare_cols=STUDENT_COLS)
    return {"state": state, "expired": expired, "remove": remove, "create": create, "update": update}


def report(v, by):
    b = F.col("bty")
    return rc.reconcile_report_onepass(
        student_extract(v), v.sor_x, v.last_seen, by=by, compare_cols=STUDENT_COLS, run_date=RUN,
        sor_yes=b.between(21, 34) | (b == 46), sor_no=b.between(35, 37) | (b == 47),
        extract_yes=F.col("permission") == "Yes", extract_no=F.col("permission") == "No")


# The state from one list of who was seen where: each id once, with its last day and what holds it.
STATE_SQL = """
sighted AS (
  SELECT patron_id, max(day) AS last_seen, bool_or(roster) AS in_roster, bool_or(live) AS in_sor FROM (
    SELECT patron_id, last_seen AS day, FALSE AS roster, FALSE AS live FROM v_last_seen
    UNION ALL BY NAME SELECT patron_id, DATE '2024-02-01' AS day, TRUE AS roster, FALSE AS live FROM x_extract
    UNION ALL BY NAME SELECT patron_id, FALSE AS roster, TRUE AS live FROM x_sor)
  GROUP BY patron_id
), aged AS (
  SELECT *, coalesce(date_diff('day', last_seen, DATE '2024-02-01') > 7, TRUE) AS gone FROM sighted
), rm AS (
  SELECT c.patron_id, a.last_seen, c.email, c.collection_status, c.default_branch, c.bty, c.phone1, c.phone, c.teacher_id,
         c.teacher_name
  FROM x_sor c JOIN aged a USING (patron_id) WHERE a.gone AND c.edit_branch <> 'XMNPS' GROUP BY ALL
), cr AS (
  SELECT * FROM x_extract i WHERE NOT EXISTS (SELECT 1 FROM x_sor WHERE patron_id = i.patron_id)
), up AS (
  SELECT DISTINCT i.patron_id, i.bty, i.last_name, i.first_name, i.middle_name, i.suffix, i.street, i.city, i.state, i.postal_code,
         i.phone, i.default_branch, i.exp_date, i.birth_date, i.teacher_id, i.teacher_name, i.collection_status
  FROM x_student i JOIN x_sor c USING (patron_id)
  WHERE (c.bty, c.last_name, c.first_name, c.default_branch, c.exp_date, c.birth_date, c.collection_status)
          IS DISTINCT FROM (i.bty, i.last_name, i.first_name, i.default_branch, i.exp_date, i.birth_date, i.collection_status)
     OR (c.middle_name, c.suffix, c.street, c.city, c.state, c.postal_code, c.phone, c.teacher_id, c.teacher_name)
          IS DISTINCT FROM (i.middle_name, i.suffix, i.street, i.city, i.state, i.postal_code, i.phone, i.teacher_id, i.teacher_name)
)"""


@register("last_seen_merge", sql=f"""WITH {STATE_SQL}
SELECT patron_id, strftime(last_seen, '%Y-%m-%d') AS last_seen FROM aged WHERE NOT gone""")
def q_last_seen_merge(v):
    return run(v)["state"]


@register("seen_today", sql="""
SELECT patron_id, strftime(last_seen, '%Y-%m-%d') AS last_seen FROM v_last_seen
WHERE patron_id IN (SELECT patron_id FROM x_extract)""")
def q_seen_today(v):
    return rc.seen_today(v.last_seen, v.extract_x)


@register("reconcile_remove", sql=f"""WITH {STATE_SQL}
SELECT patron_id, strftime(last_seen, '%Y-%m-%d') AS last_seen, email, collection_status, default_branch, bty,
       phone1, phone, teacher_id, teacher_name FROM rm""")
def q_reconcile_remove(v):
    return run(v)["remove"]


@register("reconcile_create", sql="""
SELECT patron_id, bty, last_name, first_name, default_branch, strftime(exp_date, '%Y-%m-%d') AS exp_date,
       strftime(birth_date, '%Y-%m-%d') AS birth_date, email
FROM v_extract ANTI JOIN v_patron USING (patron_id)""")
def q_reconcile_create(v):
    return rc.reconcile_create(v.extract, v.patron)


@register("reconcile_update_student", sql=f"""WITH {STATE_SQL}
SELECT * REPLACE (strftime(exp_date, '%Y-%m-%d') AS exp_date, strftime(birth_date, '%Y-%m-%d') AS birth_date) FROM up""")
def q_reconcile_update_student(v):
    return run(v)["update"]


# The staff changes as one list of the columns that differ (a NULL on either side is no change).
STAFF_SQL = """
staff_pair AS (
  SELECT i.*, c.bty AS s_bty, c.collection_status AS s_status, list_filter([
           CASE WHEN i.bty <> c.bty THEN 'bty' END, CASE WHEN i.last_name <> c.last_name THEN 'last_name' END,
           CASE WHEN i.first_name <> c.first_name THEN 'first_name' END, CASE WHEN i.middle_name <> c.middle_name THEN 'middle_name' END,
           CASE WHEN i.suffix <> c.suffix THEN 'suffix' END, CASE WHEN i.default_branch <> c.default_branch THEN 'default_branch' END,
           CASE WHEN i.exp_date <> c.exp_date THEN 'exp_date' END, CASE WHEN i.email <> c.email THEN 'email' END,
           CASE WHEN i.email_notices <> c.email_notices THEN 'email_notices' END,
           CASE WHEN c.collection_status NOT IN (2, i.collection_status) THEN 'collection_status' END], lambda x: x IS NOT NULL) AS changes
  FROM x_extract i JOIN x_sor c USING (patron_id)
)"""


@register("reconcile_update_staff", sql=f"""WITH {STAFF_SQL}
SELECT patron_id, bty, last_name, first_name, middle_name, suffix, default_branch, strftime(exp_date, '%Y-%m-%d') AS exp_date,
       email, email_notices, CASE s_status WHEN 2 THEN 2 ELSE collection_status END AS collection_status,
       array_to_string(changes, ',') AS changed_cols
FROM staff_pair WHERE len(changes) > 0""")
def q_reconcile_update_staff(v):
    return rc.reconcile_update(v.extract_x, v.sor_x, compare_cols=STAFF_COLS, policy="any_column",
                               sticky={"collection_status": 2})


STUDENT_POLICY = {
    **{c: (rc.take_extract(), rc.take_extract()) for c in STUDENT_COLS if c != "collection_status"},
    "email": (rc.take_extract(), rc.take_sor()),
    "email_notices": (rc.const("1"), rc.const("send email")),
    "collection_status": (rc.const(78), rc.keep_sor_if((2,), rc.const(78))),
    "registration_date": (rc.today(RUN), rc.unset("date")),
}


@register("merged_patron", sql="""
SELECT i.patron_id, c.patron_id IS NOT NULL AS exists_in_sor, i.bty, i.last_name, i.first_name, i.default_branch,
       strftime(i.exp_date, '%Y-%m-%d') AS exp_date, strftime(i.birth_date, '%Y-%m-%d') AS birth_date,
       i.middle_name, i.suffix, i.street, i.city, i.state, i.postal_code, i.phone, i.teacher_id, i.teacher_name,
       CASE WHEN c.patron_id IS NULL THEN i.email ELSE c.email END AS email,
       CASE WHEN c.patron_id IS NULL THEN '1' ELSE 'send email' END AS email_notices,
       CASE WHEN c.patron_id IS NOT NULL AND c.collection_status = 2 THEN 2 ELSE 78 END AS collection_status,
       CASE WHEN c.patron_id IS NULL THEN '2024-02-01' END AS registration_date
FROM x_extract i LEFT JOIN x_sor c ON i.patron_id = c.patron_id""")
def q_merged_patron(v):
    return rc.merge_policy(v.extract_x, v.sor_x, policy=STUDENT_POLICY)


@register("email_actions", sql="""
WITH pair AS (
  SELECT i.patron_id, i.email AS new, c.email AS old, c.email_notices AS n,
         CASE WHEN c.email = '' THEN 'blank' WHEN ends_with(lower(c.email), 'school.example') THEN 'school' ELSE 'other' END AS kind
  FROM x_extract i JOIN x_sor c USING (patron_id)
), decided AS (
  SELECT *, CASE kind WHEN 'school' THEN CASE WHEN n <> '1' THEN 'extract' END
                      WHEN 'other' THEN CASE n WHEN '0' THEN 'extract' WHEN '3' THEN 'extract' WHEN '2' THEN 'sor' END
                      ELSE CASE WHEN new <> '' OR (new = '' AND n <> '1') THEN 'extract' END END AS source
  FROM pair WHERE old IS NOT NULL
)
SELECT patron_id, CASE source WHEN 'sor' THEN old ELSE new END AS email, 'send email' AS email_notices, source
FROM decided WHERE source IS NOT NULL""")
def q_email_actions(v):
    return rc.email_actions(v.extract_x, v.sor_x, school_domain="SCHOOL.example")


# What roster and SoR say about each flag of a patron, side by side; a flag's number is its place in the list.
TOLD_SQL = """
said AS (
  UNPIVOT (SELECT patron_id, 'roster' AS source, tech_optout, laptop, permission FROM x_extract
           UNION ALL SELECT patron_id, 'sor', tech_optout, laptop, permission FROM x_sor)
  ON tech_optout, laptop, permission INTO NAME flag VALUE answer
), told AS (
  SELECT patron_id, flag, CAST(list_position(['tech_optout', '-', 'laptop', 'permission'], flag) AS VARCHAR) AS field_id,
         any_value(answer) FILTER (source = 'roster') AS now, any_value(answer) FILTER (source = 'sor') AS before
  FROM said GROUP BY patron_id, flag
)"""


@register("attribute_create", sql=f"""WITH {TOLD_SQL},
missing AS (
  SELECT patron_id, field_id, if(flag = 'permission' AND now <> 'No', 'Yes', now) AS value_name FROM told
  WHERE now IS NOT NULL AND if(flag = 'permission', coalesce(before, '') = '',
                               coalesce(before, '') NOT IN ('Yes', 'No') AND now IN ('Yes', 'No')))
SELECT patron_id, '0' AS occur, field_id, if(value_name = 'Yes', '1', '2') AS num_code, '0' AS type, value_name FROM missing""")
def q_attribute_create(v):
    return rc.attribute_changes(v.extract_x, v.sor_x, fields=FLAGS, default_yes=["permission"])[0]


@register("attribute_update", sql=f"""WITH {TOLD_SQL}
SELECT patron_id, field_id, if(now = 'Yes', '1', '2') AS num_code, now AS value_name,
       if(before = 'Yes', '1', '2') AS old_num_code, before AS old_value_name
FROM told WHERE length(now) > 0 AND length(before) > 0 AND (now = 'Yes') <> (before = 'Yes')""")
def q_attribute_update(v):
    return rc.attribute_changes(v.extract_x, v.sor_x, fields=FLAGS, default_yes=["permission"])[1]


def report_sql(by: str) -> str:
    """The report as one conditional count over a tagged list of rows; only groups of the SoR stand in it."""
    return f"""WITH {STATE_SQL},
tagged AS (
  SELECT {by}, 'sor' AS kind, CASE WHEN bty IN (46, 21, 22, 23, 24, 25, 26, 27, 28, 29, 30, 31, 32, 33, 34) THEN 'yes'
                                   WHEN bty IN (47, 35, 36, 37) THEN 'no' END AS answer FROM x_sor
  UNION ALL SELECT {by}, 'extract', lower(permission) FROM x_extract
  UNION ALL SELECT {by}, 'created', NULL FROM cr
  UNION ALL SELECT {by}, 'updated', NULL FROM up
  UNION ALL SELECT {by}, 'removed', NULL FROM rm
)
SELECT '2024-02-01' AS report_date, {by},
       count(*) FILTER (kind = 'sor') AS sor, count(*) FILTER (kind = 'extract') AS extract,
       count(*) FILTER (kind = 'created') AS created, count(*) FILTER (kind = 'updated') AS updated,
       count(*) FILTER (kind = 'removed') AS removed,
       count(*) FILTER (kind = 'sor' AND answer = 'yes') AS sor_yes, count(*) FILTER (kind = 'extract' AND answer = 'yes') AS extract_yes,
       count(*) FILTER (kind = 'sor' AND answer = 'no') AS sor_no, count(*) FILTER (kind = 'extract' AND answer = 'no') AS extract_no
FROM tagged GROUP BY {by} HAVING bool_or(kind = 'sor') AND {by} IS NOT NULL"""


@register("reconcile_report_branch", sql=report_sql("default_branch"))
def q_reconcile_report_branch(v):
    return report(v, "default_branch")


@register("reconcile_report_staff", sql=f"""WITH {STATE_SQL}, {STAFF_SQL},
tagged AS (
  SELECT default_branch, 'sor' AS kind FROM x_sor UNION ALL SELECT default_branch, 'extract' FROM x_extract
  UNION ALL SELECT default_branch, 'created' FROM cr
  UNION ALL SELECT default_branch, 'updated' FROM staff_pair WHERE len(changes) > 0
  UNION ALL SELECT default_branch, 'removed' FROM rm
)
SELECT '2024-02-01' AS report_date, default_branch, count(*) FILTER (kind = 'sor') AS sor,
       count(*) FILTER (kind = 'extract') AS extract, count(*) FILTER (kind = 'created') AS created,
       count(*) FILTER (kind = 'updated') AS updated, count(*) FILTER (kind = 'removed') AS removed
FROM tagged GROUP BY default_branch HAVING bool_or(kind = 'sor')""")
def q_reconcile_report_staff(v):
    return rc.reconcile_report_onepass(v.extract_x, v.sor_x, v.last_seen, by="default_branch", compare_cols=STAFF_COLS,
                                       run_date=RUN, policy="any_column", sticky={"collection_status": 2})


@register("reconcile_report_type", sql=report_sql("bty"))
def q_reconcile_report_type(v):
    return report(v, "bty")


@register("abort_guard", sql=f"""
SELECT * FROM ({report_sql('bty')}) r
WHERE CAST(bty AS VARCHAR) <> '38'
  AND (extract <= sor * 0.9 OR created >= sor * 0.1 OR updated >= sor * 0.1 OR removed >= sor * 0.1
       OR coalesce(abs(sor_yes - extract_yes) / CAST(nullif(sor_yes, 0) AS DOUBLE) >= 0.1, FALSE))""")
def q_abort_guard(v):
    return rc.abort_guard(report(v, "bty"), by="bty", exempt=38)


@register("report_history_upsert", sql=f"""
WITH r AS ({report_sql('default_branch')})
SELECT '2024-01-31' AS report_date, default_branch, sor, extract, created, updated, removed,
       sor_yes, extract_yes, sor_no, extract_no FROM r
UNION ALL SELECT * FROM r""")
def q_report_history_upsert(v):
    # Yesterday's run, a stale run of today, and today's run again.
    history = VersionedTable(v.spark, landing_path(v.spark, "report-history"))
    rows = rc.report_history_upsert(history, report(v, "default_branch").drop("report_date"), run_date="2024-01-31").drop("report_date")
    rc.report_history_upsert(history, rows.withColumn("extract", F.lit(0).cast("bigint")), run_date=RUN)
    return rc.report_history_upsert(history, rows, run_date=RUN)


@register("exceptions_redundant", sql="""
WITH o AS (SELECT patron_id, bty, default_branch FROM v_patron WHERE CAST(right(patron_id, 4) AS INT) % 9 = 0),
once AS (SELECT patron_id, min(bty) AS bty, min(default_branch) AS default_branch FROM v_extract
         GROUP BY patron_id HAVING count(*) = 1)
SELECT o.patron_id, o.bty, o.default_branch,
       CASE WHEN once.patron_id IS NOT NULL AND o.bty = once.bty AND o.default_branch = once.default_branch
            THEN 'delete' ELSE 'keep' END AS action
FROM o LEFT JOIN once ON o.patron_id = once.patron_id""")
def q_exceptions_redundant(v):
    overrides = v.patron.filter(F.expr("CAST(right(patron_id, 4) AS INT) % 9 = 0")) \
                        .select("patron_id", "bty", "default_branch")
    return rc.exceptions_redundant(overrides, v.extract, compare_cols=["bty", "default_branch"])


@register("action_summary", sql=f"""WITH {STATE_SQL}
SELECT 'create' AS action, count(*) AS n FROM cr
UNION ALL SELECT 'update', count(*) FROM up
UNION ALL SELECT 'remove', count(*) FROM rm""")
def q_action_summary(v):
    return rc.action_counts(student_extract(v), v.sor_x, v.last_seen, compare_cols=STUDENT_COLS, run_date=RUN)
