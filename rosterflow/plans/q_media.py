"""Registered image queries (K24-K26, S11, J17-J19, J25, A7, A11, C41) over ``v_media`` / ``pages``."""

from __future__ import annotations

from pyspark.sql import functions as F

from rosterflow.operators import media as md
from rosterflow.plans.catalog import register

ROSTER_SQL = """(SELECT e.patron_id, b.branch_code FROM v_extract e LEFT JOIN v_branch b ON e.default_branch = b.branch_number
 WHERE TRY_CAST(e.patron_id AS BIGINT) < 190999000)"""
IDS_SQL = "(SELECT file_name, mtime, n_bytes, unnest(regexp_extract_all(file_name, '(\\d{9})', 1)) AS patron_id FROM v_media)"


def roster(v):
    b = v.branch.select("branch_number", "branch_code")
    return v.extract.join(b, v.extract["default_branch"] == b["branch_number"], "left").select("patron_id", "branch_code")


def binary_files(v):
    """Rows shaped like ``spark.read.format('binaryFile')`` output."""
    p = v.table("pages")
    return p.select(F.concat(F.lit("/images/"), (F.col("page_id") + 190000000).cast("string"), F.lit(".jpg")).alias("path"),
                    F.date_add(F.lit("2022-01-01").cast("date"), (F.col("page_id") % 900).cast("int")).alias("modificationTime"),
                    F.length("html").cast("bigint").alias("length"), F.encode("html", "UTF-8").alias("content"))


@register("media_inventory", sql="""
SELECT concat(CAST(190000000 + page_id AS VARCHAR), '.jpg') AS file_name, CAST(190000000 + page_id AS VARCHAR) AS patron_id,
       CAST(length(html) AS BIGINT) AS n_bytes, strftime(CAST(DATE '2022-01-01' + CAST(page_id % 900 AS INT) AS DATE), '%Y-%m-%d') AS mtime,
       sha256(html) AS sha256
FROM pages""")
def q_media_inventory(v):
    return md.media_inventory(binary_files(v), with_hash=True)


@register("media_missing", sql=f"""
SELECT r.patron_id, r.branch_code FROM {ROSTER_SQL} r WHERE r.patron_id NOT IN (SELECT patron_id FROM {IDS_SQL})""")
def q_media_missing(v):
    return md.media_missing(md.report_roster(roster(v)), v.media)


@register("media_report", sql=f"""
WITH r AS {ROSTER_SQL}, ids AS {IDS_SQL},
miss AS (SELECT branch_code, count(*) AS n FROM r WHERE patron_id NOT IN (SELECT patron_id FROM ids) GROUP BY branch_code),
old AS (SELECT r.branch_code, count(*) AS n FROM ids JOIN r ON ids.patron_id = r.patron_id
        WHERE ids.mtime < DATE '2022-08-01' GROUP BY r.branch_code),
j AS (SELECT coalesce(miss.branch_code, old.branch_code) AS branch_code, coalesce(miss.n, 0) AS m, coalesce(old.n, 0) AS o
      FROM miss FULL OUTER JOIN old ON miss.branch_code = old.branch_code)
SELECT branch_code, m AS missing_images, o AS old_images, m + o AS total_images_needing_update FROM j
UNION ALL SELECT 'Total', sum(m)::BIGINT, sum(o)::BIGINT, (sum(m) + sum(o))::BIGINT FROM j""")
def q_media_report(v):
    return md.media_report(v.media, roster(v), cutoff="2022-08-01")


@register("media_missing_staff", sql="""
SELECT patron_id FROM v_patron WHERE bty = 40
  AND patron_id NOT IN (SELECT regexp_extract(file_name, '^(\\d+)\\.jpg$', 1) FROM v_media)""")
def q_media_missing_staff(v):
    return md.media_missing_type(v.patron, v.media, bty=40)


@register("media_orphans", sql="""
SELECT file_name FROM v_media WHERE file_name NOT IN (SELECT concat(patron_id, '.jpg') FROM v_extract)""")
def q_media_orphans(v):
    return md.media_orphans(v.media, v.extract)


@register("media_by_day", sql="""
SELECT strftime(mtime, '%Y-%m-%d') AS day, count(*) AS n FROM v_media
WHERE mtime >= DATE '2022-05-01' AND mtime < DATE '2022-06-01' GROUP BY mtime""")
def q_media_by_day(v):
    return md.media_by_day(v.media, month="2022-05")


@register("media_invalid", sql="""
SELECT file_name, 'too_small' AS reason FROM v_media WHERE n_bytes < 4096
UNION ALL SELECT file_name, 'bad_name' FROM v_media WHERE NOT regexp_matches(file_name, '^\\d{6,9}\\.jpg$')
UNION ALL SELECT file_name, 'not_today' FROM v_media WHERE mtime < DATE '2022-06-15'""")
def q_media_invalid(v):
    return md.media_invalid(v.media, run_date="2022-06-15")


@register("media_upload_list", sql=f"""
SELECT ids.patron_id, ids.file_name, strftime(ids.mtime, '%Y-%m-%d') AS mtime FROM {IDS_SQL} ids
WHERE ids.mtime >= DATE '2022-06-01' AND ids.patron_id IN (SELECT patron_id FROM v_extract)""")
def q_media_upload_list(v):
    return md.media_upload_list(v.media, v.extract, since="2022-06-01")


@register("media_changed", sql="""
WITH l AS (SELECT CAST(190000000 + page_id AS VARCHAR) AS patron_id, sha256(html) AS local_sha FROM pages),
s AS (SELECT CAST(190000000 + page_id AS VARCHAR) AS patron_id,
             sha256(CASE WHEN page_id % 3 = 0 THEN concat(html, ' ') ELSE html END) AS stored_sha FROM pages)
SELECT l.patron_id, local_sha, stored_sha FROM l JOIN s ON l.patron_id = s.patron_id WHERE local_sha <> stored_sha""")
def q_media_changed(v):
    p = v.table("pages")
    pid = (F.col("page_id") + 190000000).cast("string").alias("patron_id")
    local = p.select(pid, F.col("html").alias("content"))
    stored = p.select(pid, F.when(F.col("page_id") % 3 == 0, F.concat("html", F.lit(" "))).otherwise(F.col("html"))
                      .alias("content"))
    return md.media_changed(local, stored)
