"""Registered roster-cleaning queries (C1-C24, A10) over the raw roster stand-ins."""

from __future__ import annotations

from pyspark.sql import functions as F

from rosterflow.functions.text import namecase, namecase_if_caps, scrub_ascii, trim_fields
from rosterflow.operators import quality as dq
from rosterflow.operators import roster as ro
from rosterflow.plans import fixtures as fx
from rosterflow.plans.catalog import register
from rosterflow.plans.oracle_text import namecase_ctes
from rosterflow.plans.oracle_views import VIEW_SQL
from rosterflow.sources.tables import VIEW_RUN_DATE

VIEW_SQL["x_roster"] = fx.roster_sql()[1:-1]
VIEW_SQL["x_staff"] = fx.staff_sql()[1:-1]
EXPIRATION = "2026-10-01"
ROSTER_NAMES = [n for n, _ in fx.ROSTER_COLS]
STAFF_KEY_FIELDS = ["patron_id", "bty", "last_name", "first_name", "middle_name", "suffix", "school_code"]


@register("roster_with_overrides", sql=f"""
SELECT patron_id, 'OVERRIDE' AS last_name, '' AS street, 0 AS priority FROM x_roster WHERE {fx.OVERRIDE_FILTER}
UNION ALL SELECT patron_id, last_name, street, 1 FROM x_roster""")
def q_roster_with_overrides(v):
    r = fx.roster_df(v)
    ov = r.filter(F.expr(fx.OVERRIDE_FILTER)).select("patron_id", F.lit("OVERRIDE").alias("last_name"),
                                                    F.lit("").alias("street"))
    return ro.roster_with_overrides(r.select("patron_id", "last_name", "street"), ov)


_rest = ", ".join(f"{c} ASC NULLS FIRST" for c in ROSTER_NAMES if c != "street")


@register("dedupe_student", sql=f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY patron_id ORDER BY street DESC NULLS LAST, {_rest}) AS rn FROM x_roster)
WHERE rn = 1""")
def q_dedupe_student(v):
    return ro.dedupe_student(fx.roster_df(v))


_skey = "concat_ws('|', " + ", ".join(STAFF_KEY_FIELDS) + ")"


_OVERRIDES_SQL = f"""SELECT patron_id, bty, 'OVERRIDE' AS last_name, first_name, middle_name, suffix, school_code, email
FROM x_staff WHERE {fx.OVERRIDE_FILTER} AND school_code NOT LIKE '%9'"""


@register("dedupe_staff", sql=f"""
WITH best AS (SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY patron_id ORDER BY {_skey} DESC, school_code, email) AS rn FROM x_staff)
  WHERE rn = 1),
both_ AS (SELECT *, 0 AS priority FROM ({_OVERRIDES_SQL}) UNION ALL SELECT *, 1 FROM best)
SELECT * EXCLUDE (rn, priority) FROM (
  SELECT *, row_number() OVER (PARTITION BY patron_id ORDER BY priority, {_skey} DESC) AS rn FROM both_)
WHERE rn = 1""")
def q_dedupe_staff(v):
    s = fx.staff_df(v)
    ov = (s.filter(F.expr(fx.OVERRIDE_FILTER) & ~F.col("school_code").endswith("9"))
          .withColumn("last_name", F.lit("OVERRIDE")))
    return ro.dedupe_staff(s, ov, fields=STAFF_KEY_FIELDS)


@register("filter_id_shape", sql=r"""
SELECT patron_id, 'student' AS population FROM x_roster WHERE regexp_matches(patron_id, '^190\d{6}$')
UNION ALL SELECT patron_id, 'staff' FROM x_staff WHERE patron_id IS NOT NULL AND patron_id <> ''""")
def q_filter_id_shape(v):
    a = ro.filter_id_shape(fx.roster_df(v), population="student").select("patron_id", F.lit("student").alias("population"))
    b = ro.filter_id_shape(fx.staff_df(v), population="staff").select("patron_id", F.lit("staff").alias("population"))
    return a.unionByName(b)


@register("scrub_ascii", sql=r"""
SELECT patron_id, regexp_replace(first_name, '[^\n\r\x20-\x7E]', '', 'g') AS first_name,
       regexp_replace(teacher_name, '[^\n\r\x20-\x7E]', '', 'g') AS teacher_name FROM x_roster""")
def q_scrub_ascii(v):
    return fx.roster_df(v).select("patron_id", scrub_ascii("first_name").alias("first_name"),
                                  scrub_ascii("teacher_name").alias("teacher_name"))


@register("trim_fields", sql=r"""
SELECT patron_id,
       regexp_replace(regexp_replace(replace(teacher_name, '"', ''''), '[\n\r]+', '', 'g'), '^\s+|\s+$', '', 'g') AS teacher_name,
       regexp_replace(regexp_replace(street, '[\n\r]+', '', 'g'), '^\s+|\s+$', '', 'g') AS street
FROM x_roster""")
def q_trim_fields(v):
    return fx.roster_df(v).select("patron_id", trim_fields("teacher_name", quote_to_apostrophe=True).alias("teacher_name"),
                                  trim_fields("street").alias("street"))


def _nc_chain(src: str, cols: list[str], tag: str = "n", **opts) -> tuple[str, str]:
    parts, cur = [], src
    for i, c in enumerate(cols):
        ctes, cur = namecase_ctes(cur, c, f"nc_{c}", f"{tag}{i}", **opts)
        parts.append(ctes)
    return ",\n".join(parts), cur


_ncq, _ncl = _nc_chain("x_roster", ["last_name", "first_name", "middle_name", "suffix"])
_caps = "(regexp_matches(last_name, '^[- .A-Z'']+$') AND NOT starts_with(last_name, 'TEST'))"


@register("namecase_if_caps", sql=f"""WITH {_ncq}
SELECT patron_id, CASE WHEN {_caps} THEN nc_last_name ELSE last_name END AS last_name,
       CASE WHEN {_caps} THEN nc_first_name ELSE first_name END AS first_name,
       CASE WHEN {_caps} THEN nc_middle_name ELSE middle_name END AS middle_name,
       CASE WHEN {_caps} THEN nc_suffix ELSE suffix END AS suffix FROM {_ncl}""")
def q_namecase_if_caps(v):
    r = fx.roster_df(v)
    cols = namecase_if_caps("last_name", "first_name", "middle_name", "suffix")
    return r.select("patron_id", *[c.alias(n) for c, n in zip(cols, ["last_name", "first_name", "middle_name", "suffix"])])


@register("school_remap", sql=r"""
SELECT patron_id, CASE WHEN s = '7F748' OR starts_with(s, '83116') OR starts_with(s, '84117') OR starts_with(s, '85480')
                            OR starts_with(s, '86665') THEN '7Z999' ELSE s END AS school_code
FROM (SELECT patron_id, regexp_replace(school_code, '\s', '', 'g') AS s FROM x_roster)""")
def q_school_remap(v):
    return fx.roster_df(v).select("patron_id", ro.school_remap(F.col("school_code")).alias("school_code"))


OPTOUT_SQL = """CASE WHEN permission LIKE 'N%' AND bty IN ('21','22','23','24','25','26','27') THEN '35'
     WHEN permission LIKE 'N%' AND bty IN ('28','29','30') THEN '36'
     WHEN permission LIKE 'N%' AND bty IN ('31','32','33','34') THEN '37' ELSE bty END"""


@register("optout_type", sql=f"SELECT patron_id, {OPTOUT_SQL} AS bty FROM x_roster")
def q_optout_type(v):
    return fx.roster_df(v).select("patron_id", ro.optout_type(F.col("bty"), F.col("permission")).alias("bty"))


def _stop(years: int) -> str:
    return (f"(CASE WHEN regexp_matches(birth_date, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') THEN "
            f"CAST(CAST(try_strptime(birth_date, '%Y-%m-%d') AS DATE) + INTERVAL {years} YEAR - INTERVAL 1 DAY AS DATE) END)")


AGE_SQL = f"""CASE WHEN b IN ('31','32','33','34') AND coalesce({_stop(18)} < DATE '2024-02-01', false) THEN '46'
     WHEN b = '37' AND coalesce({_stop(18)} < DATE '2024-02-01', false) THEN '47' ELSE b END"""


@register("age_promotion", sql=f"""
SELECT patron_id, {AGE_SQL} AS bty FROM (SELECT *, {OPTOUT_SQL} AS b FROM x_roster)""")
def q_age_promotion(v):
    r = fx.roster_df(v).withColumn("bty", ro.optout_type(F.col("bty"), F.col("permission")))
    return r.select("patron_id", ro.age_promotion(F.col("bty"), F.col("birth_date"), run_date=VIEW_RUN_DATE).alias("bty"))


@register("staff_type_rules", sql=r"""
SELECT patron_id, CASE WHEN regexp_replace(school_code, '\s', '', 'g') IN ('79118', '7E601') THEN '12' ELSE bty END AS bty,
       school_code FROM x_staff
WHERE NOT (regexp_replace(school_code, '\s', '', 'g') = '86665' AND CAST(bty AS INT) <> 40)""")
def q_staff_type_rules(v):
    return ro.staff_type_rules(fx.staff_df(v)).select("patron_id", "bty", "school_code")


@register("collection_status", sql="""
SELECT patron_id, bty, CASE WHEN CAST(bty AS INT) IN (13, 40, 51) THEN '78' ELSE '1' END AS collection_status,
       '78' AS student_status FROM x_staff""")
def q_collection_status(v):
    return fx.staff_df(v).select("patron_id", "bty", ro.collection_status(F.col("bty"), population="staff").alias("collection_status"),
                                 ro.collection_status(F.col("bty"), population="student").alias("student_status"))


_CITY_MAP = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in ro.CITY_CORRECTIONS.items())
_addr_src = "(SELECT *, regexp_replace(street, '  +', ' ', 'g') AS street1 FROM x_roster)"
_addr_q, _addr_l = _nc_chain(_addr_src, ["street1", "city"])


@register("address_clean", sql=f"""WITH {_addr_q}
SELECT patron_id, nc_street1 AS street, coalesce(CASE nc_city {_CITY_MAP} END, nc_city) AS city,
       CASE WHEN state = 'Tn' THEN 'TN' ELSE state END AS state,
       regexp_replace(zip, '-\\d{{4}}', ' ', 'g') AS zip FROM {_addr_l}""")
def q_address_clean(v):
    return ro.address_clean(fx.roster_df(v)).select("patron_id", "street", "city", "state", "zip")


_city_q, _city_l = _nc_chain("x_roster", ["city"])


@register("city_corrections", sql=f"""WITH {_city_q}
SELECT patron_id, coalesce(CASE nc_city {_CITY_MAP} END, nc_city) AS city FROM {_city_l}""")
def q_city_corrections(v):
    return fx.roster_df(v).select("patron_id", ro.city_corrections(namecase(F.col("city"))).alias("city"))


@register("phone_clean", sql=r"""
SELECT patron_id, CASE WHEN length(phone) > 14 THEN
         CASE WHEN length(regexp_replace(phone, '\D', '', 'g')) > 14 THEN substr(regexp_replace(phone, '\D', '', 'g'), 1, 10)
              ELSE regexp_replace(phone, '\D', '', 'g') END
       ELSE phone END AS phone FROM x_roster""")
def q_phone_clean(v):
    return fx.roster_df(v).select("patron_id", ro.phone_clean(F.col("phone")).alias("phone"))


def _yn(c: str) -> str:
    return f"CASE WHEN {c} = 'N' THEN 'No' WHEN {c} = 'Y' THEN 'Yes' ELSE {c} END"


@register("flags_yes_no", sql=f"""
SELECT patron_id, {_yn('laptop')} AS laptop, {_yn('p')} AS permission, {_yn('tech_optout')} AS tech_optout
FROM (SELECT *, CASE WHEN permission = '' THEN 'Yes' ELSE permission END AS p FROM x_roster)""")
def q_flags_yes_no(v):
    return ro.flags_yes_no(fx.roster_df(v)).select("patron_id", "laptop", "permission", "tech_optout")


GUARANTOR_SQL = f"""CASE WHEN guarantor = '' THEN guarantor
     WHEN {_stop(13)} IS NULL THEN concat('2026-10-01', ': ', guarantor)
     WHEN {_stop(13)} < DATE '2024-02-01' THEN ''
     WHEN {_stop(13)} > DATE '2026-10-01' THEN concat('2026-10-01', ': ', guarantor)
     ELSE concat(CAST({_stop(13)} AS VARCHAR), ': ', guarantor) END"""


@register("guarantor_stop_date", sql=f"SELECT patron_id, {GUARANTOR_SQL} AS guarantor FROM x_roster")
def q_guarantor_stop_date(v):
    return fx.roster_df(v).select("patron_id", ro.guarantor_stop_date(
        F.col("guarantor"), F.col("birth_date"), run_date=VIEW_RUN_DATE, expiration=EXPIRATION).alias("guarantor"))


@register("program_mode", sql="""
SELECT patron_id, programme_branch AS school_code, concat('998', right(programme_branch, 3)) AS teacher_id,
       'Promising Scholars 2026' AS teacher_name FROM x_roster WHERE programme_branch IS NOT NULL AND programme_branch <> ''""")
def q_program_mode(v):
    return ro.program_mode(fx.roster_df(v)).select("patron_id", "school_code", "teacher_id", "teacher_name")


@register("dq_must_be_blank", sql="""
SELECT 'permission' AS column_name, count(*) FILTER (WHERE NOT regexp_matches(permission, '^\\s*$')) AS non_blank
FROM x_roster""")
def q_dq_must_be_blank(v):
    return dq.must_be_blank(fx.roster_df(v), ["permission"])


@register("dq_duplicate_keys", sql="""
SELECT patron_id, count(*) AS n FROM x_roster GROUP BY patron_id HAVING count(*) > 1""")
def q_dq_duplicate_keys(v):
    return dq.duplicate_keys(fx.roster_df(v), "patron_id")


@register("dq_id_or_email", sql="""
SELECT library_id, activity_date, trim(patron_full, '"') AS user_id FROM v_usage
WHERE NOT regexp_matches(trim(patron_full, '"'), '^[^@]+@[^@]+\\.[^@]+$')
  AND NOT regexp_matches(trim(patron_full, '"'), '^190[0-9]{6}$')""")
def q_dq_id_or_email(v):
    u = v.usage.select("library_id", "activity_date", F.btrim("patron_full", F.lit('"')).alias("user_id"))
    return dq.id_or_email_violations(u, "user_id", id_pattern=r"^190[0-9]{6}$")


@register("dq_freshness", sql="""
SELECT strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS latest,
       (epoch_us(TIMESTAMP '2024-01-31 12:00:00') - epoch_us(max(ts))) // 1000000 AS age_seconds,
       (epoch_us(TIMESTAMP '2024-01-31 12:00:00') - epoch_us(max(ts))) // 1000000 > 86400 AS stale
FROM events""")
def q_dq_freshness(v):
    return dq.freshness(v.table("events"), "ts", run_ts="2024-01-31 12:00:00", max_age_seconds=86400)


# -- the whole nightly student roster ------------------------------------------
def _roster_sql() -> str:
    scrub = ", ".join(f"regexp_replace({c}, '[^\\n\\r\\x20-\\x7E]', '', 'g') AS {c}" for c in ROSTER_NAMES)
    nc1, nl1 = _nc_chain("s", ["last_name", "first_name", "middle_name", "suffix"])
    nc2, nl2 = _nc_chain("a", ["street1", "city"], tag="m")
    trim = ", ".join(
        f"regexp_replace(regexp_replace(replace(CAST({c} AS VARCHAR), '\"', ''''), '[\\n\\r]+', '', 'g'), "
        f"'^\\s+|\\s+$', '', 'g') AS {c}" for c in ro.STUDENT_LAYOUT)
    return f"""WITH d AS (SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY patron_id ORDER BY street DESC NULLS LAST, {_rest}) AS rn FROM x_roster)
  WHERE rn = 1 AND regexp_matches(patron_id, '^190\\d{{6}}$')),
s AS (SELECT {scrub} FROM d),
{nc1},
c AS (SELECT patron_id,
        CASE WHEN {_caps} THEN nc_last_name ELSE last_name END AS last_name,
        CASE WHEN {_caps} THEN nc_first_name ELSE first_name END AS first_name,
        CASE WHEN {_caps} THEN nc_middle_name ELSE middle_name END AS middle_name,
        CASE WHEN {_caps} THEN nc_suffix ELSE suffix END AS suffix,
        bty, street, city, state, zip, phone, school_code, birth_date, guarantor, laptop, permission, tech_optout,
        teacher_id, teacher_name, email FROM {nl1}),
r AS (SELECT *, CASE WHEN s2 = '7F748' OR starts_with(s2, '83116') OR starts_with(s2, '84117') OR starts_with(s2, '85480')
                       OR starts_with(s2, '86665') THEN '7Z999' ELSE s2 END AS school2, {OPTOUT_SQL} AS b
      FROM (SELECT *, regexp_replace(school_code, '\\s', '', 'g') AS s2 FROM c)),
a AS (SELECT *, {AGE_SQL} AS bty2, regexp_replace(street, '  +', ' ', 'g') AS street1 FROM r),
{nc2},
f AS (SELECT patron_id, bty2 AS bty, last_name, first_name, middle_name, suffix, nc_street1 AS street,
        coalesce(CASE nc_city {_CITY_MAP} END, nc_city) AS city, CASE WHEN state = 'Tn' THEN 'TN' ELSE state END AS state,
        regexp_replace(zip, '-\\d{{4}}', ' ', 'g') AS zip,
        CASE WHEN length(phone) > 14 THEN
          CASE WHEN length(regexp_replace(phone, '\\D', '', 'g')) > 14 THEN substr(regexp_replace(phone, '\\D', '', 'g'), 1, 10)
               ELSE regexp_replace(phone, '\\D', '', 'g') END ELSE phone END AS phone,
        school2 AS default_branch, '2026-10-01' AS expiration_date, email, birth_date,
        {GUARANTOR_SQL} AS guarantor,
        {_yn('laptop')} AS laptop, {_yn("CASE WHEN permission = '' THEN 'Yes' ELSE permission END")} AS permission,
        {_yn('tech_optout')} AS tech_optout, teacher_id, teacher_name, '1' AS email_notices, '' AS expired_note_ids,
        '' AS delete_note_ids, '78' AS collection_status, '' AS edit_branch, '' AS phone1 FROM {nl2})
SELECT {trim} FROM f"""


@register("roster_student", sql=_roster_sql())
def q_roster_student(v):
    return ro.format_student_roster(fx.roster_df(v), run_date=VIEW_RUN_DATE, expiration=EXPIRATION)


def _staff_sql() -> str:
    names = ["patron_id", "bty", "last_name", "first_name", "middle_name", "suffix", "school_code", "email"]
    scrub = ", ".join(f"regexp_replace({c}, '[^\\n\\r\\x20-\\x7E]', '', 'g') AS {c}" for c in names)
    nc, last = _nc_chain("s", ["last_name", "first_name", "middle_name", "suffix"], tag="t")
    cased = ", ".join(f"CASE WHEN {_caps} THEN nc_{c} ELSE {c} END AS {c}" for c in ("last_name", "first_name", "middle_name", "suffix"))
    trim = ", ".join(f"regexp_replace(regexp_replace({c}, '[\\n\\r]+', '', 'g'), '^\\s+|\\s+$', '', 'g') AS {c}" for c in ro.STAFF_LAYOUT)
    return f"""WITH best AS (
  SELECT *, 1 AS priority FROM x_staff
  QUALIFY row_number() OVER (PARTITION BY patron_id ORDER BY {_skey} DESC, school_code, email) = 1
), one AS (
  SELECT * FROM (SELECT *, 0 AS priority FROM ({_OVERRIDES_SQL}) UNION ALL BY NAME SELECT * FROM best)
  WHERE patron_id <> '' QUALIFY row_number() OVER (PARTITION BY patron_id ORDER BY priority, {_skey} DESC) = 1
), s AS (SELECT {scrub} FROM one),
{nc},
typed AS (
  SELECT patron_id, {cased}, email, regexp_replace(school_code, '\\s', '', 'g') AS default_branch,
         CASE WHEN regexp_replace(school_code, '\\s', '', 'g') IN ('79118', '7E601') THEN '12' ELSE bty END AS bty
  FROM {last} WHERE regexp_replace(school_code, '\\s', '', 'g') <> '86665' OR CAST(bty AS INT) = 40
), f AS (
  SELECT *, '2026-10-01' AS expiration_date, '1' AS email_notices, '' AS expired_note_ids, '' AS edit_branch,
         CASE WHEN bty IN ('13', '40', '51') THEN '78' ELSE '1' END AS collection_status FROM typed
)
SELECT {trim} FROM f"""


@register("roster_staff", sql=_staff_sql())
def q_roster_staff(v):
    s = fx.staff_df(v)
    ov = (s.filter(F.expr(fx.OVERRIDE_FILTER) & ~F.col("school_code").endswith("9"))
          .withColumn("last_name", F.lit("OVERRIDE")))
    return ro.format_staff_roster(s, ov, expiration=EXPIRATION)
