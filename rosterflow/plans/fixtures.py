"""Raw roster stand-ins derived from the driver tables.

The roster cleaning jobs read a raw pipe-delimited extract (all text).  These
columns are derived deterministically from ``v_extract`` / ``v_patron`` with
SQL expressions that parse identically in Spark SQL and DuckDB, so the same
text builds the test input on both sides (the jobs under test are written
separately in each engine).  The derivations plant the edge cases the jobs
must handle: TEST and apostrophe names, duplicate ids with and without an
address, non-ASCII and line-break characters, ZIP+4, long phones, malformed
birth dates, school codes with trailing blanks and remapped schools.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

R1, R2, R3, R4 = ("CAST(right(patron_id, %d) AS INT)" % n for n in (1, 2, 3, 4))

def _differs(k: int, other: str, same: str) -> str:
    """The SoR differs from the roster on every 29th id, one column for each remainder."""
    return f"CASE WHEN {R4} % 29 = {k} THEN {other} ELSE {same} END"


_SAME = {
    "middle_name": f"CASE WHEN {R4} % 3 = 0 THEN 'J' ELSE '' END", "suffix": f"CASE WHEN {R4} % 11 = 0 THEN 'JR' ELSE '' END",
    "street": "concat(right(patron_id, 3), ' Main St')", "city": "'Nashville'", "state": "'TN'",
    "postal_code": "concat('372', right(patron_id, 2))", "phone": "concat('615555', right(patron_id, 4))",
    "teacher_id": f"CASE WHEN {R4} % 5 = 0 THEN CAST(NULL AS STRING) ELSE concat('T', right(patron_id, 2)) END",
    "teacher_name": "concat('Teacher ', right(patron_id, 2))",
}
_OTHER = {"middle_name": "'X'", "suffix": "'SR'", "street": "'9 Old Rd'", "city": "'Antioch'", "state": "CAST(NULL AS STRING)",
          "postal_code": "'37013'", "phone": "''", "teacher_id": "'T0'", "teacher_name": "CAST(NULL AS STRING)"}
# Further columns of the roster (x_extract) and of the SoR snapshot (x_sor).
EXTRACT_MORE = [*_SAME.items(), ("phone1", "''"), ("email_notices", "'1'")]
SOR_MORE = [*[(c, _differs(k, _OTHER[c], e)) for k, (c, e) in enumerate(_SAME.items(), 1)],
            ("phone1", f"CASE WHEN {R4} % 2 = 0 THEN '' ELSE concat('615', right(patron_id, 4)) END")]

ROSTER_COLS = [
    ("patron_id", "patron_id"),
    ("bty", "CAST(bty AS STRING)"),
    ("last_name", f"CASE WHEN {R4} % 19 = 0 THEN concat('TEST', last_name) "
                  f"WHEN {R4} % 10 = 3 THEN concat('O', chr(39), upper(last_name)) ELSE last_name END"),
    ("first_name", f"CASE WHEN {R4} % 9 = 0 THEN concat(first_name, chr(233)) ELSE first_name END"),
    ("middle_name", f"CASE WHEN {R2} % 3 = 0 THEN 'J' ELSE '' END"),
    ("suffix", f"CASE WHEN {R3} % 11 = 0 THEN 'JR' ELSE '' END"),
    ("street", f"concat(right(patron_id, 3), '  ', CASE {R1} % 4 WHEN 0 THEN 'OLD HICKORY  BLVD' "
               f"WHEN 1 THEN 'main st.' WHEN 2 THEN 'MCGAVOCK PK' ELSE 'VAN BUREN RD' END)"),
    ("city", f"CASE {R2} % 8 WHEN 0 THEN 'NASHVILLE' WHEN 1 THEN 'Nashviile' WHEN 2 THEN 'MT. JULIET' "
             f"WHEN 3 THEN 'GOODLETSVILLE' WHEN 4 THEN 'antioch' WHEN 5 THEN 'La Vegne' "
             f"WHEN 6 THEN 'FT. CAMPBELL' ELSE 'WHITES CREKK' END"),
    ("state", f"CASE WHEN {R1} % 2 = 0 THEN 'Tn' ELSE 'TN' END"),
    ("zip", f"concat('372', right(patron_id, 2), CASE WHEN {R2} % 3 = 0 THEN '-1234' ELSE '' END)"),
    ("phone", f"CASE {R1} % 4 WHEN 0 THEN concat('(615) 555-', right(patron_id, 4), ' x', right(patron_id, 3)) "
              f"WHEN 1 THEN concat('615555', right(patron_id, 4)) WHEN 2 THEN '' "
              f"ELSE concat('+1 (615) 555-', right(patron_id, 4), '99999999') END"),
    ("school_code", f"concat(CASE {R4} % 13 WHEN 0 THEN '7F748' WHEN 1 THEN '83116' "
                    f"WHEN 2 THEN concat('8411', right(patron_id, 1)) "
                    f"ELSE concat(CAST(60 + default_branch AS STRING), '1') END, "
                    f"CASE WHEN {R1} = 7 THEN ' ' ELSE '' END)"),
    ("programme_branch", f"CASE WHEN {R3} % 5 = 0 THEN concat('7P', right(patron_id, 3)) ELSE '' END"),
    ("birth_date", f"CASE WHEN {R3} % 17 = 0 THEN replace(CAST(birth_date AS STRING), '-', '/') "
                   f"ELSE CAST(birth_date AS STRING) END"),
    ("guarantor", f"CASE WHEN {R1} < 4 THEN concat('PARENT ', right(patron_id, 2)) ELSE '' END"),
    ("laptop", f"CASE {R2} % 3 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' ELSE '' END"),
    ("permission", f"CASE {R3} % 4 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' ELSE '' END"),
    ("tech_optout", f"CASE {R1} % 3 WHEN 0 THEN 'N' WHEN 1 THEN 'Y' ELSE '' END"),
    ("teacher_id", "concat('T', right(patron_id, 4))"),
    ("teacher_name", f"concat(' ', chr(34), 'Teacher', chr(34), ' ', right(patron_id, 2), "
                     f"CASE WHEN {R1} % 5 = 0 THEN chr(10) ELSE '' END, ' ')"),
    ("email", "email"),
]

# Second copy of some ids without an address: the keep-best dedupe must drop it.
DUP_FILTER = f"{R4} % 10 = 1"

STAFF_COLS = [
    ("patron_id", "patron_id"),
    ("bty", "CAST(bty AS STRING)"),
    ("last_name", f"CASE WHEN {R4} % 7 = 0 THEN concat('TEST', last_name) ELSE last_name END"),
    ("first_name", "first_name"),
    ("middle_name", "''"),
    ("suffix", "''"),
    ("school_code", f"CASE {R4} % 11 WHEN 0 THEN '86665' WHEN 1 THEN '79118' WHEN 2 THEN '7E601 ' "
                    f"ELSE concat(CAST(60 + default_branch AS STRING), '2') END"),
    ("email", "email"),
]


def roster_sql() -> str:
    cols = ", ".join(f"{e} AS {n}" for n, e in ROSTER_COLS)
    dup = ", ".join(("'' AS street" if n == "street" else f"{e} AS {n}") for n, e in ROSTER_COLS)
    return (f"(SELECT {cols} FROM v_extract UNION ALL "
            f"SELECT {dup} FROM v_extract WHERE {DUP_FILTER})")


def roster_df(v) -> DataFrame:
    base = v.extract.selectExpr(*[f"{e} AS {n}" for n, e in ROSTER_COLS])
    dup = v.extract.filter(F.expr(DUP_FILTER)).selectExpr(
        *[("'' AS street" if n == "street" else f"{e} AS {n}") for n, e in ROSTER_COLS])
    return base.unionByName(dup)


STAFF_FILTER = "length(patron_id) = 6"


def staff_sql() -> str:
    cols = ", ".join(f"{e} AS {n}" for n, e in STAFF_COLS)
    alt = ", ".join((f"concat(CAST(60 + default_branch AS STRING), '9') AS {n}" if n == "school_code"
                     else f"{e} AS {n}") for n, e in STAFF_COLS)
    return (f"(SELECT {cols} FROM v_patron WHERE {STAFF_FILTER} UNION ALL "
            f"SELECT {alt} FROM v_patron WHERE {STAFF_FILTER} AND {R4} % 3 = 0)")


def staff_df(v) -> DataFrame:
    p = v.patron.filter(F.expr(STAFF_FILTER))
    base = p.selectExpr(*[f"{e} AS {n}" for n, e in STAFF_COLS])
    alt = p.filter(F.expr(f"{R4} % 3 = 0")).selectExpr(
        *[(f"concat(CAST(60 + default_branch AS STRING), '9') AS {n}" if n == "school_code"
           else f"{e} AS {n}") for n, e in STAFF_COLS])
    return base.unionByName(alt)


OVERRIDE_FILTER = f"{R4} % 29 = 0"
