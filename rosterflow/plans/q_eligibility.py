"""Registered eligibility / bulk-maintenance queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from rosterflow.operators import eligibility as el
from rosterflow.operators import reconcile as rc
from rosterflow.plans.catalog import register
from rosterflow.sources.tables import VIEW_RUN_DATE

RUN = VIEW_RUN_DATE
ZIPS = ", ".join(f"'{z}'" for z in el.SERVICE_ZIPS)


@register("out_of_area", sql=f"""
SELECT patron_id, strftime(exp_date, '%Y-%m-%d') AS exp_date, 52 AS new_bty FROM v_patron
WHERE bty IN (3, 14, 15, 43, 44, 45) AND zip NOT IN ({ZIPS})""")
def q_out_of_area(v):
    return el.out_of_area(v.patron)


DOWNGRADE_SQL = """
SELECT patron_id, bty, CASE bty WHEN 3 THEN 45 WHEN 14 THEN 44 WHEN 15 THEN 43 END AS new_bty,
       strftime(exp_date, '%Y-%m-%d') AS exp_date,
       strftime(CASE WHEN exp_date > DATE '2024-02-01' - INTERVAL 100 DAY THEN DATE '2026-02-01' ELSE exp_date END,
                '%Y-%m-%d') AS new_exp_date
FROM v_patron WHERE bty IN (3, 14, 15) AND exp_date <= DATE '2024-02-01'"""


@register("area_downgrade", sql=DOWNGRADE_SQL)
def q_area_downgrade(v):
    return el.area_downgrade(v.patron, run_date=RUN)


@register("batch_cap", sql=DOWNGRADE_SQL + " ORDER BY patron_id LIMIT 5")
def q_batch_cap(v):
    return el.area_downgrade(v.patron, run_date=RUN, limit=5)


@register("bulk_extend", sql="""
SELECT patron_id, 52 AS new_bty, strftime(exp_date, '%Y-%m-%d') AS exp_date,
       strftime(CASE WHEN exp_date >= DATE '2024-02-01' AND exp_date < DATE '2024-02-01' + INTERVAL 730 DAY
                     THEN exp_date + INTERVAL 730 DAY ELSE exp_date END, '%Y-%m-%d') AS new_exp_date
FROM v_patron WHERE bty IN (4, 16, 17)""")
def q_bulk_extend(v):
    return el.bulk_extend(v.patron, run_date=RUN)


@register("bulk_expiry", sql="""
SELECT patron_id FROM v_patron WHERE bty = 48 AND exp_date = DATE '2024-10-01' AND patron_id LIKE 'B%'""")
def q_bulk_expiry(v):
    return el.bulk_expiry(v.patron, bty=48, exp_date="2024-10-01", prefix="B")


INELIGIBLE_SQL = """SELECT patron_id, guid, bty, exp_date FROM v_patron
WHERE bty IN (43, 44, 45) OR (bty = 52 AND exp_date < DATE '2024-02-01')"""


@register("ineligible_patrons", sql=f"""
SELECT patron_id, guid, bty, strftime(exp_date, '%Y-%m-%d') AS exp_date FROM ({INELIGIBLE_SQL})""")
def q_ineligible_patrons(v):
    return el.ineligible_patrons(v.patron, run_date=RUN)


COLLISION_SQL = """
SELECT guid AS value FROM v_patron g
WHERE length(guid) = 6 AND EXISTS (SELECT 1 FROM v_patron p WHERE p.patron_id = g.guid AND p.patron_id <> g.patron_id)
GROUP BY guid"""


@register("id_collisions", sql=COLLISION_SQL)
def q_id_collisions(v):
    return el.id_collisions(v.patron)


HOLDS_SQL = f"""
SELECT trim(h.user_id) AS user_id, CAST(TRY_CAST(trim(h.user_id) AS DECIMAL(20,0)) AS VARCHAR) AS sort_key, h.hold_no
FROM v_holds h
WHERE lower(trim(h.user_id)) IN (SELECT lower(trim(guid)) FROM ({INELIGIBLE_SQL}) WHERE guid IS NOT NULL AND guid <> '')"""


def holds(v):
    return el.ineligible_holds(v.holds, el.ineligible_patrons(v.patron, run_date=RUN))


@register("ineligible_holds", sql=HOLDS_SQL)
def q_ineligible_holds(v):
    return holds(v)


@register("hold_cancel_plan", sql=f"""
WITH m AS (SELECT DISTINCT user_id FROM ({HOLDS_SQL})), c AS ({COLLISION_SQL})
SELECT m.user_id, CASE WHEN length(m.user_id) NOT IN (15, 6) THEN 'skip_length'
                       WHEN length(m.user_id) = 6 AND c.value IS NOT NULL THEN 'skip_collision'
                       ELSE 'cancel' END AS action
FROM m LEFT JOIN c ON m.user_id = c.value""")
def q_hold_cancel_plan(v):
    return el.hold_cancel_plan(holds(v), el.id_collisions(v.patron))


@register("hold_cancel_batch", sql=f"""
WITH m AS (SELECT DISTINCT user_id FROM ({HOLDS_SQL})), c AS ({COLLISION_SQL}),
w AS (SELECT *, count(*) FILTER (length(user_id) IN (15, 6)) OVER (
        ORDER BY TRY_CAST(user_id AS DECIMAL(20, 0)) NULLS FIRST, user_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS done
      FROM m)
SELECT user_id, CASE WHEN length(user_id) NOT IN (15, 6) THEN 'skip_length'
                     WHEN length(user_id) = 6 AND user_id IN (SELECT value FROM c) THEN 'skip_collision' ELSE 'cancel' END AS action
FROM w WHERE done < 12""")
def q_hold_cancel_batch(v):
    return el.hold_cancel_plan(holds(v), el.id_collisions(v.patron), limit=12)


@register("graduation_actions", sql="""
WITH ids AS (SELECT DISTINCT patron_id FROM v_extract WHERE bty = 34),
sel AS (SELECT patron_id, bty FROM v_patron
        WHERE bty IN (34, 37, 46, 47)
           OR (regexp_matches(patron_id, '^190[0-9]{6}$')
               AND bty NOT IN (21,22,23,24,25,26,27,28,29,30,31,32,33,34,35,36,37,46,47)))
SELECT ids.patron_id, sel.bty AS sor_bty,
       CASE WHEN sel.bty IS NULL THEN 'not_found' WHEN sel.bty = 38 THEN 'already_closed'
            WHEN sel.bty IN (34, 37, 46, 47) THEN 'update' ELSE 'review' END AS action
FROM ids LEFT JOIN sel ON ids.patron_id = sel.patron_id""")
def q_graduation_actions(v):
    return el.graduation_actions(v.extract, v.patron)


@register("calendar_gate", sql="""
WITH cr AS (SELECT patron_id, default_branch, bty FROM v_extract ANTI JOIN v_patron USING (patron_id)),
days AS (FROM (VALUES (DATE '2023-08-20', 'homeroom'), (DATE '2024-02-01', 'remove'), (DATE '2024-06-01', 'closed')) t(run_date, phase)),
j AS (SELECT *, run_date = DATE '2024-02-01' AND default_branch < 12 AND bty IN (22, 27, 34, 37, 46, 47) AS skipped FROM cr, days)
SELECT strftime(run_date, '%Y-%m-%d') AS run_date, patron_id, default_branch, bty, phase, skipped,
       phase <> 'closed' AND NOT skipped AS allowed FROM j""")
def q_calendar_gate(v):
    spark = v.spark
    calendar = spark.createDataFrame([(dt.date(2023, 8, 7), dt.date(2023, 9, 5), dt.date(2024, 5, 24))],
                                     "start_date date, twenty_day date, stop_date date")
    skips = spark.createDataFrame([(b, t, dt.date(2024, 1, 30), dt.date(2024, 2, 2)) for b in range(12) for t in (22, 27, 34, 37, 46, 47)],
                                  "branch int, bty int, skip_start date, skip_stop date")
    actions = rc.reconcile_create(v.extract, v.patron).select("patron_id", "default_branch", "bty")
    # A day of each phase; the skip windows are open on the second one.
    out = None
    for day in ("2023-08-20", "2024-02-01", "2024-06-01"):
        gated = el.calendar_gate(actions, calendar, run_date=day, skip_windows=skips).withColumn("run_date", F.lit(day))
        out = gated if out is None else out.unionByName(gated)
    return out


# University onboarding column names and constant defaults.
ONBOARD = {"patron_id": "BUID", "last_name": "Last Name", "first_name": "First Name",
           "middle_name": "Middle Name", "email": "Email"}
ONBOARD_DEFAULTS = {"bty": 48, "city": "Nashville", "state": "TN", "zip": "37212", "default_branch": "EH",
                    "reg_branch": "VI", "collection_status": "not sent", "email_notices": "send email",
                    "exp_date": "2025-10-01", "status_code": "G", "preferred_address": "Primary"}


@register("onboard_csv", sql="""
SELECT concat('B', right(guid, 8)) AS patron_id, last_name, first_name, '' AS middle_name, email,
       concat('Belmont University, ', concat('Hall', CAST(bty % 7 AS VARCHAR)), ' Hall') AS street,
       48 AS bty, 'Nashville' AS city, 'TN' AS state, '37212' AS zip, 'EH' AS default_branch, 'VI' AS reg_branch,
       'not sent' AS collection_status, 'send email' AS email_notices, '2025-10-01' AS exp_date,
       'G' AS status_code, 'Primary' AS preferred_address
FROM v_patron""")
def q_onboard_csv(v):
    csv = v.patron.select(
        F.col("last_name").alias("Last Name"), F.col("first_name").alias("First Name"),
        F.lit("").alias("Middle Name"), F.concat(F.lit("B"), F.expr("right(guid, 8)")).alias("BUID"),
        F.concat(F.lit("Hall"), (F.col("bty") % 7).cast("string")).alias("Hall"), F.col("email").alias("Email"))
    return el.onboard_csv(csv, mapping=ONBOARD, defaults=ONBOARD_DEFAULTS,
                          derived={"street": F.concat(F.lit("Belmont University, "), F.col("Hall"), F.lit(" Hall"))})
