"""Registered name-case and standardisation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from rosterflow.functions import text as tx
from rosterflow.operators import standardize as sd
from rosterflow.plans.catalog import register
from rosterflow.plans.fixtures import R1, R2, R3, R4
from rosterflow.plans.oracle_text import namecase_ctes
from rosterflow.plans.oracle_views import VIEW_SQL

STD_COLS = [
    ("patron_id", "patron_id"), ("bty", "bty"), ("edit_date", "edit_date"),
    ("zip", f"CASE WHEN {R2} % 4 = 0 THEN concat(zip, '-', right(patron_id, 4)) ELSE zip END"),
    ("state", f"CASE {R1} % 3 WHEN 0 THEN 'T.N.' WHEN 1 THEN 'tn' ELSE 'TN' END"),
    ("city", f"CASE {R2} % 5 WHEN 0 THEN 'FT. CAMPBELL' WHEN 1 THEN 'mt juliet' WHEN 2 THEN 'Nashville' "
             f"WHEN 3 THEN 'LA VERGNE' ELSE 'old hickory' END"),
    ("street", f"concat(right(patron_id, 3), ' ', CASE {R1} % 4 WHEN 0 THEN 'MAIN ST.' "
               f"WHEN 1 THEN concat('O', chr(39), 'BRIEN CT') WHEN 2 THEN 'Elm  St' ELSE 'MT VIEW RD' END)"),
    ("first_name", "first_name"),
    ("middle_name", f"CASE WHEN {R2} % 2 = 0 THEN 'q' ELSE 'Quinn' END"),
    ("last_name", f"CASE WHEN {R4} % 6 = 0 THEN concat('##', last_name) ELSE last_name END"),
    ("suffix", f"CASE WHEN {R3} % 3 = 0 THEN 'JR' ELSE '' END"),
]
VIEW_SQL["x_std"] = "SELECT " + ", ".join(f"{e} AS {n}" for n, e in STD_COLS) + " FROM v_patron"
MARKS = {"zip": "2023-12-20", "state": "2024-01-01", "city": "2023-12-01", "street": "2023-12-01",
         "first_name": "2023-12-10", "middle_name": "2023-12-01", "last_name": "2023-12-01", "suffix": "2023-12-01"}
LAST_PAT = r"^(#{1,2})#*\s*(.*)$"


def std_df(v):
    return v.patron.selectExpr(*[f"{e} AS {n}" for n, e in STD_COLS])


@register("namecase_column", sql=(lambda c: f"""WITH src AS (SELECT p_partkey, concat(p_name, ' ', p_type) AS name FROM part),
{c[0]}
SELECT p_partkey, name, name_cased FROM {c[1]}""")(namecase_ctes("src", "name", "name_cased", "p")))
def q_namecase_column(v):
    p = v.table("part").select("p_partkey", F.concat("p_name", F.lit(" "), "p_type").alias("name"))
    return p.select("p_partkey", "name", tx.namecase(F.col("name")).alias("name_cased"))


@register("std_zip_state", sql="""
SELECT patron_id, regexp_replace(zip, '-([0-9]{4})$', '') AS zip, replace(upper(state), '.', '') AS state FROM x_std""")
def q_std_zip_state(v):
    return std_df(v).select("patron_id", tx.std_zip("zip").alias("zip"), tx.std_state("state").alias("state"))


def _city_sql(col: str, tag: str, src: str) -> tuple[str, str, str]:
    ctes, last = namecase_ctes(src, col, f"{tag}_nc", tag)
    e = f"translate({tag}_nc, '.''', '')"
    e = f"regexp_replace({e}, '(?i)^FT\\.?\\b', 'Fort')"
    e = f"regexp_replace({e}, '(?i)^LA\\b', 'La')"
    e = f"regexp_replace({e}, '(?i)^MT\\.?\\b', 'Mount')"
    return ctes, last, e


def _street_sql(col: str, tag: str, src: str) -> tuple[str, str, str]:
    ctes, last = namecase_ctes(src, col, f"{tag}_nc", tag, spanish=False, postnominal=False)
    e = f"translate(regexp_replace({tag}_nc, ' {{2,}}', ' ', 'g'), '.''', '')"
    for a, b in tx.STREET_SUFFIXES:
        e = f"replace({e}, '{a}', '{b}')"
    return ctes, last, e


_cq, _cl, _ce = _city_sql("city", "c", "x_std")


@register("std_city", sql=f"WITH {_cq} SELECT patron_id, {_ce} AS city FROM {_cl}")
def q_std_city(v):
    return std_df(v).select("patron_id", tx.std_city("city").alias("city"))


_sq, _sl, _se = _street_sql("street", "s", "x_std")


@register("std_street", sql=f"WITH {_sq} SELECT patron_id, {_se} AS street FROM {_sl}")
def q_std_street(v):
    return std_df(v).select("patron_id", tx.std_street("street").alias("street"))


def _name_sql(src: str) -> tuple[str, str]:
    pre = (f"nm AS (SELECT *, CASE WHEN regexp_matches(last_name, '{LAST_PAT}') "
           f"THEN regexp_extract(last_name, '{LAST_PAT}', 1) ELSE '' END AS l_hash, "
           f"CASE WHEN regexp_matches(last_name, '{LAST_PAT}') THEN regexp_extract(last_name, '{LAST_PAT}', 2) "
           f"ELSE last_name END AS l_rest FROM {src})")
    parts, cur = [pre], "nm"
    for i, c in enumerate(["first_name", "middle_name", "l_rest", "suffix"]):
        ctes, cur = namecase_ctes(cur, c, f"nc_{c}", f"q{i}")
        parts.append(ctes)
    return ",\n".join(parts), cur


_nq, _nl = _name_sql("x_std")


@register("std_name", sql=f"""WITH {_nq}
SELECT patron_id, nc_first_name AS first_name, nc_middle_name AS middle_name,
       concat(l_hash, nc_l_rest) AS last_name, nc_suffix AS suffix FROM {_nl}""")
def q_std_name(v):
    s = std_df(v)
    return s.select("patron_id", tx.std_name("first_name").alias("first_name"),
                    tx.std_name("middle_name").alias("middle_name"),
                    tx.std_name("last_name", last_name=True).alias("last_name"),
                    tx.std_name("suffix").alias("suffix"))


def _cand_sql() -> str:
    excl = ", ".join(str(t) for t in sd.EXCLUDED_TYPES)
    parts = []
    for f, mark in MARKS.items():
        pat = sd.CLEAN_PATTERNS[f].replace("'", "''")
        parts.append(f"SELECT patron_id, edit_date, '{f}' AS field, {f} AS old FROM x_std "
                     f"WHERE bty NOT IN ({excl}) AND patron_id NOT LIKE 'B%' AND edit_date > TIMESTAMP '{mark}' "
                     f"AND {f} IS NOT NULL AND {f} <> '' AND NOT regexp_matches({f}, '{pat}')")
    return "\nUNION ALL ".join(parts)


@register("std_candidates", sql=f"""
SELECT patron_id, strftime(edit_date, '%Y-%m-%d') AS edit_date, field, old FROM ({_cand_sql()})""")
def q_std_candidates(v):
    return sd.std_candidates(std_df(v), MARKS)


def _changes_sql() -> str:
    cq, cl, ce = _city_sql("old", "c", "cand")
    sq, sl, se = _street_sql("old", "s", cl)
    pre = (f"nm AS (SELECT *, CASE WHEN regexp_matches(old, '{LAST_PAT}') "
           f"THEN regexp_extract(old, '{LAST_PAT}', 1) ELSE '' END AS l_hash, "
           f"CASE WHEN regexp_matches(old, '{LAST_PAT}') THEN regexp_extract(old, '{LAST_PAT}', 2) "
           f"ELSE old END AS l_rest FROM {sl})")
    n1, l1 = namecase_ctes("nm", "old", "nc_old", "q0")
    n2, l2 = namecase_ctes(l1, "l_rest", "nc_rest", "q1")
    return f"""WITH cand AS ({_cand_sql()}),
{cq},
{sq},
{pre},
{n1},
{n2},
r AS (SELECT patron_id, field, old, CASE field
        WHEN 'zip' THEN regexp_replace(old, '-([0-9]{{4}})$', '')
        WHEN 'state' THEN replace(upper(old), '.', '')
        WHEN 'city' THEN {ce}
        WHEN 'street' THEN {se}
        WHEN 'last_name' THEN concat(l_hash, nc_rest)
        ELSE nc_old END AS new FROM {l2})
SELECT * FROM r WHERE new <> old"""


@register("std_changes", sql=_changes_sql())
def q_std_changes(v):
    return sd.std_changes(std_df(v), MARKS, run_ts="2024-02-01 00:00:00")[0]
