"""Registered note queries (K7-K9, C37, W3, A8, J6, J9) over ``v_note`` / ``v_loan``."""

from __future__ import annotations

from rosterflow.operators import notes as nt
from rosterflow.plans.catalog import register
from rosterflow.sources.tables import VIEW_RUN_DATE

GUARANTOR, EXPIRED = "Guarantor effective", nt.EXPIRED_MARKER

LATEST_SQL = """
SELECT patron_id, first(text ORDER BY ts DESC, note_id DESC) AS text
FROM v_note WHERE text LIKE '%Guarantor effective%' GROUP BY patron_id"""

IDS_SQL = """
SELECT patron_id, string_agg(CAST(note_id AS VARCHAR), ',' ORDER BY ts DESC, note_id DESC) AS expired_note_ids
FROM v_note WHERE text LIKE '%Patron expired%' GROUP BY patron_id"""

WINDOWS_SQL = r"""
SELECT note_id, patron_id,
       coalesce(CAST(try_strptime(regexp_extract(text, '^Guarantor effective ([-/0-9]+) - ([-/0-9]+):', 1), '%Y-%m-%d') AS DATE),
                CAST(try_strptime(regexp_extract(text, '^Guarantor effective ([-/0-9]+) - ([-/0-9]+):', 1), '%m/%d/%Y') AS DATE)) AS g_start,
       coalesce(CAST(try_strptime(regexp_extract(text, '^Guarantor effective ([-/0-9]+) - ([-/0-9]+):', 2), '%Y-%m-%d') AS DATE),
                CAST(try_strptime(regexp_extract(text, '^Guarantor effective ([-/0-9]+) - ([-/0-9]+):', 2), '%m/%d/%Y') AS DATE)) AS g_stop
FROM v_note WHERE regexp_matches(text, '^Guarantor effective ([-/0-9]+) - ([-/0-9]+):')"""

IDLE_SQL = f"""
w AS ({WINDOWS_SQL}),
idle AS (SELECT w.* FROM w WHERE NOT EXISTS (
           SELECT 1 FROM v_loan t WHERE t.trans_code IN ('C', 'O', 'L', 'F1', 'F2', 'FS')
             AND t.patron_id = w.patron_id AND t.trans_date BETWEEN w.g_start AND w.g_stop))"""


@register("latest_note", sql=f"""
WITH l AS ({LATEST_SQL})
SELECT patron_id, text, nullif(upper(trim(regexp_extract(text, '[-/0-9]+:.+$', 0))), '') AS guarantor FROM l""")
def q_latest_note(v):
    return nt.latest_note(v.note, marker=GUARANTOR)


@register("expired_note_ids", sql=IDS_SQL)
def q_expired_note_ids(v):
    return nt.expired_note_ids(v.note, marker=EXPIRED)


@register("notes_reappeared", sql=f"""
WITH c AS ({IDS_SQL})
SELECT c.patron_id, c.expired_note_ids FROM v_extract i JOIN c ON i.patron_id = c.patron_id
WHERE c.expired_note_ids <> ''""")
def q_notes_reappeared(v):
    return nt.notes_reappeared(v.extract, v.note, marker=EXPIRED)


@register("expired_note_delete", sql=f"""
WITH c AS ({IDS_SQL})
SELECT c.patron_id, unnest(string_split(c.expired_note_ids, ',')) AS note_id
FROM v_extract i JOIN c ON i.patron_id = c.patron_id WHERE c.expired_note_ids <> ''""")
def q_expired_note_delete(v):
    return nt.expired_note_delete(v.extract, v.note, marker=EXPIRED)


@register("guarantor_note_create", sql=f"""
WITH l AS ({LATEST_SQL}),
g AS (SELECT patron_id, nullif(upper(trim(regexp_extract(text, '[-/0-9]+:.+$', 0))), '') AS guarantor FROM l),
c AS (SELECT p.patron_id, coalesce(g.guarantor, '') AS cg FROM x_sor p LEFT JOIN g ON p.patron_id = g.patron_id)
SELECT i.patron_id, concat('Guarantor effective ', CAST(greatest(DATE '2024-02-01', DATE '2024-01-08') AS VARCHAR),
                           ' - ', upper(i.guarantor)) AS note,
       strftime(i.exp_date, '%Y-%m-%d') AS exp_date
FROM x_extract i JOIN c ON i.patron_id = c.patron_id
WHERE upper(i.guarantor) <> upper(c.cg) AND i.guarantor <> '' AND i.guarantor IS NOT NULL""")
def q_guarantor_note_create(v):
    sor_g = v.sor_x.select("patron_id").join(nt.latest_note(v.note, marker=GUARANTOR), "patron_id", "left")
    return nt.guarantor_note_create(v.extract_x, sor_g, run_date=VIEW_RUN_DATE, term_start="2024-01-08")


@register("notes_without_activity", sql=f"""
WITH {IDLE_SQL}
SELECT note_id, patron_id, strftime(g_start, '%Y-%m-%d') AS g_start, strftime(g_stop, '%Y-%m-%d') AS g_stop FROM idle""")
def q_notes_without_activity(v):
    return nt.notes_without_activity(nt.guarantor_windows(v.note), v.loan)


@register("guarantor_note_delete", sql=f"""
WITH {IDLE_SQL}
SELECT patron_id, string_agg(CAST(note_id AS VARCHAR), ',' ORDER BY note_id) AS delete_note_ids
FROM idle WHERE g_stop < DATE '2024-02-01' GROUP BY patron_id""")
def q_guarantor_note_delete(v):
    return nt.guarantor_note_delete(v.note, v.loan, run_date=VIEW_RUN_DATE)


@register("note_cleanup", sql="""
SELECT n.note_id, 'student_type' AS reason FROM v_note n LEFT JOIN v_patron p ON n.patron_id = p.patron_id
WHERE p.bty BETWEEN 21 AND 37 AND n.text LIKE 'Guarantor effective%'
UNION ALL
SELECT note_id, 'blank_name' FROM v_note WHERE regexp_matches(text, '^Guarantor effective .*:$')""")
def q_note_cleanup(v):
    return nt.note_cleanup(v.note, v.patron)
