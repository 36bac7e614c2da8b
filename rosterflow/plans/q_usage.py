"""Registered vendor-usage and drop-file queries over ``v_usage`` (K16-K18,
K27, S7-S9, S12, S13, S17, S19, A4, A13, J10-J12, J16)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rosterflow.operators import usage as us
from rosterflow.plans.catalog import register
from rosterflow.sources.files import landing_path
from rosterflow.sources.tables import VIEW_RUN_DATE


def library_school(v):
    """Vendor library id -> school code and SoR branch (school branches)."""
    return v.branch.filter(F.col("branch_group") == 2).select(
        F.col("branch_number").alias("library_id"),
        F.substring("branch_code", -3, 3).alias("school_code"),
        F.col("branch_number").alias("sor_branch"))


def vendor_b_rows(v):
    lk = library_school(v)
    u = v.usage.select("library_id", F.substring("activity_date", 1, 10).alias("year_month_day"),
                       F.col("user_email").alias("user_id"), "checkouts")
    return u.join(lk, "library_id", "left")


def staff_roster(v):
    return v.patron.filter(F.length("patron_id").isin(6, 7)).select(
        "patron_id", "first_name", "last_name", "default_branch",
        F.when(F.expr("CAST(right(patron_id, 2) AS INT) % 8 = 0"), F.lit(""))
         .otherwise(F.substring("first_name", 2, 1)).alias("middle_name"))


# The id of a login: what stands before the @, without quotes and blanks.  Its school is that of the patron's own
# branch if that is an open school branch, else that of the branch which sent the usage.
LOGIN = """use AS (
  SELECT *, regexp_replace(split_part(patron_full, '@', 1), '^["\\s]+|["\\s]+$', '', 'g') AS patron_id FROM v_usage
), school AS (
  SELECT branch_number, right(branch_code, 3) AS code, branch_code = 'XMNPS' AS closed FROM v_branch WHERE branch_group = 2
), own AS (
  SELECT p.patron_id, s.code FROM v_patron p SEMI JOIN use USING (patron_id) JOIN school s ON s.branch_number = p.default_branch
  WHERE NOT s.closed
), use_school AS (
  SELECT use.*, coalesce((SELECT any_value(code) FROM own WHERE own.patron_id = use.patron_id),
                         (SELECT any_value(code) FROM school WHERE branch_number = use.library_id)) AS school_code
  FROM use
)"""


@register("vendor_usage_a", sql=f"""WITH {LOGIN}
SELECT CASE length(patron_id) WHEN 9 THEN 'student' ELSE 'staff' END AS population, school_code,
       activity_date[1:10] AS year_month_day, patron_id, sum(checkouts)::BIGINT AS checkouts
FROM use_school WHERE school_code IS NOT NULL AND length(patron_id) IN (6, 7, 9)
GROUP BY ALL""")
def q_vendor_usage_a(v):
    return us.vendor_usage_a(v.usage, library_school(v), v.patron, v.branch)


@register("lookup_fallback", sql=f"""WITH {LOGIN}
SELECT library_id, activity_date, patron_full, patron_id, user_email, checkouts, school_code FROM use_school""")
def q_lookup_fallback(v):
    return us.lookup_fallback(v.usage, us.registered_school(v.patron, v.branch), library_school(v))


@register("school_lookup", sql=f"""WITH {LOGIN} SELECT patron_id, code AS school_code FROM own""")
def q_school_lookup(v):
    ids = v.usage.select(us.patron_from_login(F.col("patron_full")).alias("patron_id"))
    return us.school_lookup(ids, v.patron, v.branch)


@register("vendor_usage_sum", sql="""
SELECT library_id, substr(activity_date, 1, 10) AS year_month_day, CAST(sum(checkouts) AS BIGINT) AS checkouts
FROM v_usage GROUP BY 1, 2""")
def q_vendor_usage_sum(v):
    rows = v.usage.withColumn("year_month_day", F.substring("activity_date", 1, 10))
    return us.vendor_usage_sum(rows, ["library_id", "year_month_day"], "checkouts", "checkouts")


# Every staff member has up to two login names at their branch: the initial or both initials before the last name.
STAFF_LOGIN = """WITH staff AS (
  SELECT patron_id, default_branch, upper(last_name) AS last, upper(first_name[1]) AS one,
         CASE WHEN CAST(patron_id[-2:] AS INT) % 8 = 0 THEN '' ELSE upper(first_name[2]) END AS two
  FROM v_patron WHERE length(patron_id) BETWEEN 6 AND 7
), login AS (
  SELECT patron_id, default_branch, one || last AS name FROM staff
  UNION
  SELECT patron_id, default_branch, one || two || last FROM staff WHERE two <> ''
)
SELECT (SELECT any_value(right(branch_code, 3)) FROM v_branch WHERE branch_number = u.library_id) AS school_code,
       u.activity_date[1:10] AS year_month_day, login.patron_id, u.checkouts
FROM v_usage u JOIN login ON login.default_branch = u.library_id AND login.name = upper(split_part(u.user_email, '@', 1))
WHERE EXISTS (SELECT 1 FROM v_branch WHERE branch_number = u.library_id AND branch_group = 2)"""


@register("vendor_usage_b_staff", sql=STAFF_LOGIN)
def q_vendor_usage_b_staff(v):
    return us.email_name_match(vendor_b_rows(v), staff_roster(v))


@register("email_name_match", sql=STAFF_LOGIN)
def q_email_name_match(v):
    # Same match, always reporting the matched roster id.
    rows = vendor_b_rows(v)
    m = us.email_name_match(rows, staff_roster(v))
    return m


STUDENT_B = """
SELECT (SELECT any_value(right(branch_code, 3)) FROM v_branch WHERE branch_number = u.library_id AND branch_group = 2) AS school_code,
       u.activity_date[1:10] AS year_month_day,
       CASE WHEN length(u.login) = 9 AND starts_with(u.login, '190') THEN u.login
            ELSE coalesce(nullif(e.patron_id, ''), u.login) END AS patron_id, u.checkouts
FROM (SELECT *, trim(patron_full, '"') AS login FROM v_usage) u
LEFT JOIN (SELECT patron_id, lower(email) AS mail FROM v_extract WHERE coalesce(email, '') <> '') e ON e.mail = lower(u.login)"""


def vendor_b_students(v):
    lk = library_school(v).select("library_id", "school_code")
    u = v.usage.select("library_id", F.substring("activity_date", 1, 10).alias("year_month_day"),
                       F.btrim("patron_full", F.lit('"')).alias("user_id"), "checkouts")
    return us.email_match(u.join(lk, "library_id", "left"), v.extract)


@register("vendor_usage_b_student", sql=STUDENT_B)
def q_vendor_usage_b_student(v):
    return vendor_b_students(v)


@register("email_match", sql=STUDENT_B)
def q_email_match(v):
    return vendor_b_students(v)


@register("vendor_usage_c", sql="""
SELECT right(b.branch_code, 3) AS school_code, '2024-02-01' AS year_month_day, c.patron_id,
       CAST(sum(od.hold_no) AS BIGINT) AS checkouts
FROM v_holds od JOIN v_patron c ON od.user_id = c.guid LEFT JOIN v_branch b ON c.default_branch = b.branch_number
GROUP BY 1, 2, 3""")
def q_vendor_usage_c(v):
    usage = v.holds.select("user_id", F.col("hold_no").alias("checkouts"))
    return us.vendor_usage_c(usage, v.patron, v.branch, report_date=VIEW_RUN_DATE)


def pages(v):
    """One JSON result page per usage row; library 0 answers with an error."""
    item = F.struct(F.col("activity_date").alias("Date"), F.col("patron_full").alias("Patron"))
    ok = F.to_json(F.struct(F.lit("ok").alias("status"), F.lit(None).cast("string").alias("message"),
                            F.array(item, item).alias("items")))
    err = F.to_json(F.struct(F.lit("error").alias("status"), F.lit("rate limited").alias("message")))
    return v.usage.select("library_id", F.when(F.col("library_id") == 0, err).otherwise(ok).alias("page"))


@register("json_items_explode", sql="""
SELECT library_id, activity_date, patron_full, 1 AS checkouts FROM v_usage, (VALUES (1), (2)) copy(n) WHERE library_id <> 0""")
def q_json_items_explode(v):
    return us.json_items_explode(pages(v))


@register("json_error_pages", sql="SELECT library_id, 'rate limited' AS message FROM v_usage WHERE library_id = 0")
def q_json_error_pages(v):
    return us.json_error_pages(pages(v))


@register("missing_dates", sql="""
SELECT strftime(CAST(d AS DATE), '%Y-%m-%d') AS d
FROM generate_series(TIMESTAMP '2023-12-28', TIMESTAMP '2024-02-02', INTERVAL 1 DAY) t(d)
WHERE CAST(d AS DATE) NOT IN (SELECT CAST(substr(activity_date, 1, 10) AS DATE) FROM v_usage)""")
def q_missing_dates(v):
    present = v.usage.select(F.to_date(F.substring("activity_date", 1, 10)).alias("d"))
    return us.missing_dates(present, start="2023-12-28", stop="2024-02-03")


@register("backfill_range", sql="""
SELECT strftime(CAST(substr(activity_date, 1, 10) AS DATE), '%Y-%m-%d') AS report_date, library_id,
       CAST(sum(checkouts) AS BIGINT) AS checkouts
FROM v_usage WHERE CAST(substr(activity_date, 1, 10) AS DATE) >= DATE '2024-01-05'
  AND CAST(substr(activity_date, 1, 10) AS DATE) < DATE '2024-01-20'
GROUP BY 1, 2""")
def q_backfill_range(v):
    return us.backfill_range(v.usage, start="2024-01-05", stop="2024-01-20", keys=["library_id"])


@register("report_date_of_drop", sql="""
SELECT strftime(coalesce(min(CAST(substr(activity_date, 1, 10) AS DATE)), DATE '2024-02-01'), '%Y-%m-%d') AS report_date
FROM v_usage""")
def q_report_date_of_drop(v):
    return us.report_date_of_drop(v.usage, requested=VIEW_RUN_DATE)


@register("drop_dates", sql="SELECT DISTINCT substr(activity_date, 1, 10) AS year_month_day FROM v_usage")
def q_drop_dates(v):
    return us.drop_dates(v.usage)


@register("split_by_date", sql=f"""WITH {LOGIN},
paid AS (SELECT *, activity_date[1:10] AS year_month_day FROM use_school WHERE school_code IS NOT NULL)
SELECT 'student' AS population, school_code, year_month_day, patron_id, sum(checkouts)::BIGINT AS checkouts
FROM paid WHERE length(patron_id) = 9 GROUP BY ALL
UNION ALL
SELECT 'staff', school_code, year_month_day, patron_id, sum(checkouts)::BIGINT
FROM paid WHERE length(patron_id) BETWEEN 6 AND 7 GROUP BY ALL""")
def q_split_by_date(v):
    # Written as files for each population and date, and read back from them.
    rows = us.vendor_usage_a(v.usage, library_school(v), v.patron, v.branch)
    return us.split_by_date(rows, landing_path(v.spark, "usage-by-date"))


HEADER = {"library_id": "library_id", "activity_date": "activity_date", "patron_full": "patron_full",
          "user_email": "user_email", "checkouts": "checkouts"}


@register("drop_header_rows", sql="""
SELECT CAST(library_id AS VARCHAR) AS library_id, activity_date, patron_full, user_email,
       CAST(checkouts AS VARCHAR) AS checkouts FROM v_usage""")
def q_drop_header_rows(v):
    raw = v.usage.select(*[F.col(c).cast("string").alias(c) for c in HEADER])
    # A drop whose header line was ingested as data, once per library file.
    headers = v.usage.select("library_id").distinct().select(*[F.lit(h).alias(c) for c, h in HEADER.items()])
    return us.drop_header_rows(raw.unionByName(headers), HEADER)


@register("file_date_from_name", sql="""
WITH d AS (SELECT DISTINCT CAST(substr(activity_date, 1, 10) AS DATE) AS d FROM v_usage),
n AS (SELECT d, CASE WHEN d >= DATE '2024-01-15' OR day(d) % 7 = 0
                     THEN concat('VIA_report_', strftime(d, '%Y%m%d'), '.csv')
                     ELSE concat('drop report_', strftime(d, '%m_%d_%Y'), '.csv') END AS file_name FROM d)
SELECT file_name, strftime(d, '%Y-%m-%d') AS file_date,
       CASE WHEN file_name LIKE 'VIA_report_%' THEN d >= DATE '2024-01-15' ELSE d < DATE '2024-01-15' END AS scheme_ok
FROM n""")
def q_file_date_from_name(v):
    d = v.usage.select(F.to_date(F.substring("activity_date", 1, 10)).alias("d")).distinct()
    name = F.when((F.col("d") >= F.lit("2024-01-15").cast("date")) | (F.dayofmonth("d") % 7 == 0),
                  F.concat(F.lit("VIA_report_"), F.date_format("d", "yyyyMMdd"), F.lit(".csv"))) \
            .otherwise(F.concat(F.lit("drop report_"), F.date_format("d", "MM_dd_yyyy"), F.lit(".csv")))
    return us.file_date_from_name(d.select(name.alias("file_name")), switch_date="2024-01-15")
