"""Registered action-payload queries (K28), flattened for comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from rosterflow.operators import actions as ac
from rosterflow.operators import eligibility as el
from rosterflow.operators import notes as nt
from rosterflow.operators import roster as ro
from rosterflow.plans import fixtures as fx
from rosterflow.plans import q_eligibility, q_notes, q_reconcile, q_roster
from rosterflow.plans.catalog import REGISTRY, register
from rosterflow.sources.tables import VIEW_RUN_DATE

TEST_PIN = "7357"


def _flat(df):
    """The first address as columns, and the street of the second."""
    if "addresses" not in df.columns:
        return df
    at = lambda i, c: F.try_element_at("addresses", F.lit(i))[c]
    return df.select(*[c for c in df.columns if c != "addresses"], at(1, "type").alias("address_type"), at(1, "street").alias("street"),
                     at(1, "city").alias("city"), at(1, "state").alias("state"), at(1, "postal_code").alias("postal_code"),
                     at(2, "street").alias("sponsor_street"))


def _roster(v):
    return ro.format_student_roster(fx.roster_df(v), run_date=VIEW_RUN_DATE, expiration=q_roster.EXPIRATION)


EDITED = "'2024-02-01' AS last_edit_date, 'PIK' AS last_edited_by"
REGISTERED = "'G' AS patron_status, 'PIK' AS registered_by, '2024-02-01' AS registration_date"
NAMES = "last_name, first_name, middle_name, suffix"
BRANCHES = "default_branch, default_branch AS last_edit_branch, default_branch AS reg_branch"
CLOSED = ("38 AS patron_type, 'XMNPS' AS default_branch, 'XMNPS' AS last_edit_branch, 'XMNPS' AS reg_branch, "
          "'Primary' AS preferred_address, '800' AS note_type")
CLEARED = ("'' AS phone2, '' AS sponsor_name, 'Secondary' AS address_type, '' AS street, CAST(NULL AS VARCHAR) AS city, "
           "CAST(NULL AS VARCHAR) AS state, CAST(NULL AS VARCHAR) AS postal_code, CAST(NULL AS VARCHAR) AS sponsor_street")
CONVERT = ("This account may be converted to NPL after staff update patron barcode, patron type, email, phone, address, branch, "
           "and guarantor.")
STUDENT = (f"bty AS patron_type, {NAMES}, {BRANCHES}, phone AS phone2, birth_date, expiration_date, "
           "CASE teacher_id WHEN '' THEN 'Primary' ELSE 'Sponsor' END AS preferred_address, teacher_name AS sponsor_name, "
           "'Primary' AS address_type, street, city, state, zip AS postal_code, teacher_id AS sponsor_street")
MMDD = "birth_date[6:7] || birth_date[9:10]"


@register("payload_create", sql=f"""
WITH r AS ({q_roster._roster_sql()})
SELECT patron_id, 'create' AS action, {STUDENT}, {EDITED}, {REGISTERED}, email, 'send email' AS email_notices,
       'do not send' AS collection_status, CASE WHEN patron_id LIKE '190999%' THEN '7357' ELSE {MMDD} END AS pin
FROM r ANTI JOIN v_patron USING (patron_id)""")
def q_payload_create(v):
    # Only patrons missing from the SoR are created: the anti join runs on the
    # raw roster (ids are not changed by the formatting), so the name-case
    # work is spent on the new patrons only.
    raw = fx.roster_df(v).join(v.patron.select("patron_id"), "patron_id", "left_anti")
    r = ro.format_student_roster(raw, run_date=VIEW_RUN_DATE, expiration=q_roster.EXPIRATION)
    return _flat(ac.payload_create(r, run_date=VIEW_RUN_DATE, test_pin=TEST_PIN))


@register("payload_update", sql=f"""
WITH r AS ({q_roster._roster_sql()})
SELECT patron_id, 'update' AS action, {STUDENT}, {EDITED},
       CASE WHEN CAST(collection_status AS INT) IN (0, 1, 78) THEN 'do not send' END AS collection_status,
       CASE WHEN patron_id LIKE '190999%' THEN '7357' ELSE {MMDD} END AS pin
FROM r WHERE EXISTS (SELECT 1 FROM v_patron c WHERE c.patron_id = r.patron_id
                     AND (r.bty <> CAST(c.bty AS VARCHAR) OR r.last_name <> c.last_name))""")
def q_payload_update(v):
    c = v.patron.select("patron_id", F.col("bty").cast("string").alias("_cb"), F.col("last_name").alias("_cl"))
    r = _roster(v).join(c, "patron_id").filter((F.col("bty") != F.col("_cb")) | (F.col("last_name") != F.col("_cl")))
    return _flat(ac.payload_update(r, run_date=VIEW_RUN_DATE, start="2024-01-08", twenty_day="2024-02-05", test_pin=TEST_PIN))


@register("payload_remove", sql=f"""WITH {q_reconcile.STATE_SQL},
m AS (SELECT * REPLACE (CASE WHEN regexp_matches(email, '.@mnps(k12)?[.]org', 'i') THEN '' ELSE email END AS email),
             strftime(coalesce(last_seen, DATE '2024-01-31'), '%Y-%m-%d') AS expiration_date FROM rm)
SELECT patron_id, 'remove' AS action, {CLOSED}, {EDITED}, {CLEARED},
       CASE WHEN collection_status IN (0, 1, 78) THEN 'not sent' END AS collection_status, email,
       CASE email WHEN '' THEN 'do not send email' END AS email_notices, expiration_date,
       format('MNPS patron expired {{}}. Previous branchcode: {{}}. Previous bty: {{}}. {CONVERT}',
              expiration_date, default_branch, bty) AS note_text
FROM m""")
def q_payload_remove(v):
    return _flat(ac.payload_remove(q_reconcile.run(v)["remove"], run_date=VIEW_RUN_DATE))


@register("payload_graduation", sql=f"""
WITH g AS ({REGISTRY["graduation_actions"].sql})
SELECT p.patron_id, 'remove' AS action, {CLOSED}, {EDITED}, {CLEARED},
       CASE WHEN collection_status IN (0, 1, 78) THEN 'not sent' END AS collection_status,
       CASE WHEN regexp_matches(email, '.@mnps(k12)?[.]org', 'i') THEN '' END AS email,
       CASE WHEN regexp_matches(email, '.@mnps(k12)?[.]org', 'i') THEN 'do not send email' END AS email_notices,
       '2024-01-31' AS expiration_date,
       format('MNPS 12th grade patron expired 2024-01-31. Previous branchcode: {{}}. Previous bty: {{}}. {CONVERT}',
              p.default_branch, p.bty) AS note_text
FROM v_patron p SEMI JOIN (SELECT patron_id FROM g WHERE action = 'update') u USING (patron_id)""")
def q_payload_graduation(v):
    rows = el.graduation_actions(v.extract, v.patron).where("action = 'update'").select("patron_id")
    return _flat(ac.payload_graduation(v.patron.join(rows, "patron_id", "left_semi"), run_date=VIEW_RUN_DATE))


STAFF = (f"bty AS patron_type, {NAMES}, {BRANCHES}, email, 'send email' AS email_notices, expiration_date")


@register("payload_staff_create", sql=f"""
WITH r AS ({q_roster._staff_sql()})
SELECT patron_id, 'create' AS action, {STAFF}, {EDITED}, {REGISTERED},
       CASE WHEN bty IN ('13', '40', '51') THEN 'do not send' ELSE 'not sent' END AS collection_status,
       CASE WHEN patron_id LIKE '999%' THEN '7357' END AS pin, patron_id NOT LIKE '999%' AS draw_pin
FROM r""")
def q_payload_staff_create(v):
    # As on the first run, with nobody in the SoR yet.
    return ac.payload_staff_create(q_roster.q_roster_staff(v), run_date=VIEW_RUN_DATE, test_pin=TEST_PIN)


# The status that decides is the SoR's: it is what the update is compared with.
@register("payload_staff_update", sql=f"""
WITH r AS (SELECT r.* REPLACE (p.collection_status AS collection_status)
           FROM ({q_roster._staff_sql()}) r JOIN v_patron p USING (patron_id))
SELECT patron_id, 'update' AS action, {STAFF}, {EDITED},
       CASE WHEN CAST(bty AS INT) IN (13, 40, 51) AND collection_status IN (1, 2, 78) THEN 'do not send'
            WHEN coalesce(collection_status, 0) < 2 THEN 'not sent' WHEN collection_status = 2 THEN 'sent' END AS collection_status,
       CASE WHEN patron_id LIKE '999%' THEN '7357' END AS pin
FROM r""")
def q_payload_staff_update(v):
    sor = v.patron.select("patron_id", F.col("collection_status"))
    rows = q_roster.q_roster_staff(v).drop("collection_status").join(sor, "patron_id")
    return ac.payload_staff_update(rows, run_date=VIEW_RUN_DATE, test_pin=TEST_PIN)


@register("payload_staff_remove", sql=f"""WITH {q_reconcile.STATE_SQL}
SELECT patron_id, 'remove' AS action, {CLOSED}, {EDITED},
       CASE WHEN bty IN (13, 40, 51) AND collection_status IN (0, 1, 78) THEN 'not sent' END AS collection_status,
       strftime(coalesce(last_seen, DATE '2024-01-31'), '%Y-%m-%d') AS expiration_date,
       format('Former MNPS staffer, patron expired {{}}. Previous branchcode: {{}}. Previous bty: {{}}. DO NOT convert this account '
              'to NPL; create new account after outstanding transactions are resolved.',
              strftime(coalesce(last_seen, DATE '2024-01-31'), '%Y-%m-%d'), default_branch, bty) AS note_text
FROM rm""")
def q_payload_staff_remove(v):
    return ac.payload_staff_remove(q_reconcile.run(v)["remove"], run_date=VIEW_RUN_DATE)


@register("payload_university_create", sql=f"""
WITH o AS ({REGISTRY["onboard_csv"].sql})
SELECT patron_id, 'create' AS action, bty AS patron_type, last_name, first_name, middle_name, default_branch, reg_branch, email,
       email_notices, collection_status, exp_date AS expiration_date, preferred_address, {EDITED}, {REGISTERED},
       'Primary' AS address_type, street, city, state, zip AS postal_code, CAST(NULL AS VARCHAR) AS sponsor_street,
       CASE WHEN starts_with(patron_id, 'B99999999') THEN '7357' END AS pin, NOT starts_with(patron_id, 'B99999999') AS draw_pin
FROM o""")
def q_payload_university_create(v):
    return _flat(ac.payload_university_create(q_eligibility.q_onboard_csv(v), run_date=VIEW_RUN_DATE, test_pin=TEST_PIN))


@register("payload_item_create", sql="""
SELECT 'create_item' AS action, item_id, CAST(item_id AS BIGINT) * 10 AS bid, owning_branch, status, price,
       CAST(owning_branch AS VARCHAR) || '-' || item_id AS call_number FROM v_item""")
def q_payload_item_create(v):
    rows = v.item.withColumns({"bid": F.col("item_id").cast("bigint") * 10,
                               "call_number": F.concat(F.col("owning_branch").cast("string"), F.lit("-"), F.col("item_id"))})
    return ac.payload_item_create(rows).select("action", "item_id", "bid", "owning_branch", "status", "price", "call_number")


_note_add_sql = REGISTRY["guarantor_note_create"].sql
_note_del_sql = REGISTRY["expired_note_delete"].sql


@register("payload_notes", sql=f"""
WITH a AS ({_note_add_sql}), d AS ({_note_del_sql})
SELECT patron_id, 'note_add' AS action, '800' AS note_type, note AS note_text, CAST(NULL AS VARCHAR) AS note_id FROM a
UNION ALL SELECT patron_id, 'note_delete', NULL, NULL, note_id FROM d""")
def q_payload_notes(v):
    sor_g = v.sor_x.select("patron_id").join(nt.latest_note(v.note, marker=q_notes.GUARANTOR), "patron_id", "left")
    add = nt.guarantor_note_create(v.extract_x, sor_g, run_date=VIEW_RUN_DATE, term_start="2024-01-08")
    delete = nt.expired_note_delete(v.extract, v.note, marker=q_notes.EXPIRED)
    return ac.payload_notes(add, delete)
