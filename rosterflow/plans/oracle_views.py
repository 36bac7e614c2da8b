"""DuckDB text of the stand-in views (FIXTURES.md section 3).

The oracle SQL of a registered query names these views; ``with_views``
prepends the ones it references (and their dependencies) as CTEs so the
statement runs on the bare driver tables.
"""

from __future__ import annotations

import re

from rosterflow.plans.fixtures import EXTRACT_MORE, SOR_MORE

VIEW_SQL: dict[str, str] = {
    "v_branch": """
SELECT n_nationkey AS branch_number,
       CASE WHEN n_regionkey < 3 THEN concat(CAST(60 + n_nationkey AS VARCHAR), CASE n_nationkey WHEN 2 THEN '181' WHEN 5 THEN '508'
                 ELSE lpad(CAST((n_nationkey * 37) % 1000 AS VARCHAR), 3, '0') END)
            ELSE concat('NP', lpad(CAST(n_nationkey AS VARCHAR), 3, '0')) END AS branch_code,
       CASE n_nationkey WHEN 17 THEN 'Mark as error' WHEN 21 THEN 'DNU ' || n_name ELSE n_name END AS branch_name,
       CASE WHEN n_regionkey < 3 THEN 2 ELSE 1 END AS branch_group
FROM nation""",
    "v_patron": """
SELECT CASE WHEN c_custkey % 4 = 0 THEN CAST(100000 + c_custkey AS VARCHAR)
            WHEN c_custkey % 59 = 3 THEN concat('B', CAST(100000 + c_custkey AS VARCHAR))
            ELSE CAST(190000000 + c_custkey AS VARCHAR) END AS patron_id,
       CAST(CASE WHEN c_custkey % 28 = 0 THEN CASE CAST(floor(c_custkey / 28) AS INT) % 7 WHEN 0 THEN 3 WHEN 1 THEN 14 WHEN 2 THEN 15 WHEN 3 THEN 43 WHEN 4 THEN 44 WHEN 5 THEN 45 ELSE 52 END
                 WHEN c_custkey % 44 = 4 THEN 38
                 WHEN c_custkey % 4 = 0 THEN CASE c_custkey % 3 WHEN 0 THEN 13 WHEN 1 THEN 40 ELSE 51 END
                 WHEN c_custkey % 59 = 3 THEN 48
                 WHEN c_custkey % 53 = 2 THEN CASE c_custkey % 3 WHEN 0 THEN 4 WHEN 1 THEN 16 ELSE 17 END
                 WHEN c_custkey % 37 = 1 THEN 38 WHEN c_custkey % 43 = 1 THEN 46 WHEN c_custkey % 47 = 1 THEN 47
                 ELSE 21 + c_custkey % 17 END AS INT) AS bty,
       concat('LAST', CAST(c_custkey % 97 AS VARCHAR)) AS last_name,
       c_mktsegment AS first_name,
       c_nationkey AS default_branch,
       CASE WHEN c_custkey % 41 = 0 THEN 'XMNPS' ELSE CAST(c_nationkey AS VARCHAR) END AS edit_branch,
       CAST(CASE WHEN c_custkey % 118 = 3 THEN DATE '2024-10-01' ELSE DATE '2023-10-01' + CAST(c_custkey % 400 AS INT) END AS DATE) AS exp_date,
       CAST(DATE '2004-01-01' + CAST(c_custkey % 4000 AS INT) AS DATE) AS birth_date,
       CASE WHEN c_custkey % 5 = 0 THEN '' WHEN c_custkey % 5 = 1 THEN concat('u', CAST(c_custkey AS VARCHAR), '@home.example')
            ELSE concat('u', CAST(c_custkey AS VARCHAR), '@SCHOOL.example') END AS email,
       CAST(c_custkey % 4 AS VARCHAR) AS email_notices,
       CAST(CASE WHEN c_custkey % 9 = 0 THEN 2 ELSE 78 END AS INT) AS collection_status,
       concat('37', lpad(CAST(c_custkey % 250 AS VARCHAR), 3, '0')) AS zip,
       CASE WHEN c_custkey % 140 = 0 THEN concat('7', lpad(CAST(c_custkey AS VARCHAR), 9, '0'))
            WHEN c_custkey % 56 = 0 THEN CAST(100004 + c_custkey AS VARCHAR)
            ELSE concat('21192', lpad(CAST(c_custkey AS VARCHAR), 10, '0')) END AS guid,
       CAST(DATE '2023-12-15' + CAST(c_custkey % 60 AS INT) AS DATE) AS edit_date
FROM customer""",
    "v_extract": """
SELECT patron_id,
       CAST(CASE WHEN bty IN (4, 16, 17, 38) AND CAST(right(patron_id, 4) AS INT) % 2 = 0 THEN 34
                 WHEN CAST(right(patron_id, 4) AS INT) % 11 = 0 THEN bty + 1 ELSE bty END AS INT) AS bty,
       CASE WHEN CAST(right(patron_id, 4) AS INT) % 13 = 0 THEN lower(last_name) ELSE last_name END AS last_name,
       first_name, default_branch, exp_date, birth_date,
       concat('s', patron_id, '@SCHOOL.example') AS email
FROM v_patron WHERE CAST(right(patron_id, 4) AS INT) % 17 <> 3
UNION ALL
SELECT concat('1905', right(patron_id, 5)), bty, last_name, first_name, default_branch, exp_date, birth_date,
       concat('n', patron_id, '@SCHOOL.example')
FROM v_patron WHERE CAST(right(patron_id, 4) AS INT) % 23 = 0 AND length(patron_id) = 9""",
    "v_last_seen": """
SELECT patron_id,
       CASE WHEN CAST(right(patron_id, 4) AS INT) % 7 = 0 THEN CAST(NULL AS DATE)
            ELSE CAST(DATE '2024-01-15' + CAST(CAST(right(patron_id, 4) AS INT) % 16 AS INT) AS DATE) END AS last_seen
FROM v_patron""",
    "v_txlog": """
SELECT event_id AS txn_id, ts, user_id AS item_id,
       CAST(CASE WHEN event_id % 11 = 3 THEN 100000 ELSE 190000000 END + event_id % 150 AS VARCHAR) AS patron_id,
       CASE event_type WHEN 'purchase' THEN 'CH' WHEN 'signup' THEN 'CH' WHEN 'click' THEN 'DS' WHEN 'view' THEN 'DS' ELSE 'RN' END AS txn_type,
       CAST(CASE WHEN event_id % 13 = 5 THEN 29 ELSE user_id % 25 END AS INT) AS env_branch,
       CAST(CASE WHEN event_id % 5 = 0 THEN (user_id + 3) % 25 ELSE user_id % 25 END AS INT) AS item_branch,
       CAST(CASE WHEN event_id % 7 = 2 THEN (user_id + 7) % 25 WHEN event_id % 3 = 0 THEN (user_id + 3) % 25 WHEN event_id % 31 = 1 THEN NULL ELSE user_id % 25 END AS INT) AS patron_branch,
       CASE WHEN event_id % 4 = 0 THEN 'C' ELSE 'S' END AS status_before
FROM events""",
    "v_loan": """
SELECT o_orderkey AS item_id, CASE WHEN o_orderkey % 50 = 7 THEN 'a9' ELSE '' END || CAST(190000000 + o_custkey AS VARCHAR) AS patron_id,
       CASE o_orderkey % 6 WHEN 0 THEN 'C' WHEN 1 THEN 'O' WHEN 2 THEN 'L' WHEN 3 THEN 'F1' WHEN 4 THEN 'F2' ELSE 'H' END AS trans_code,
       CAST(o_orderdate AS DATE) AS trans_date,
       CAST(CAST(o_orderdate AS DATE) + 21 AS DATE) AS due_date,
       CAST(o_totalprice AS DECIMAL(12,2)) AS amount
FROM orders""",
    "v_note": """
SELECT o_orderkey AS note_id, CAST(190000000 + o_custkey AS VARCHAR) AS patron_id, o_orderdate AS ts,
       CASE WHEN o_orderkey % 70 = 5 THEN concat('Guarantor effective ', CAST(CAST(o_orderdate AS DATE) AS VARCHAR), ':')
            WHEN o_orderkey % 3 = 0 THEN concat('Patron expired ', CAST(CAST(o_orderdate AS DATE) AS VARCHAR))
            ELSE concat('Guarantor effective ', CAST(CAST(o_orderdate AS DATE) AS VARCHAR), ' - ',
                        CAST(CAST(CAST(o_orderdate AS DATE) + 90 AS DATE) AS VARCHAR), ': G', CAST(o_orderkey % 50 AS VARCHAR)) END AS text
FROM orders""",
    "v_item": """
SELECT CAST(p_partkey AS VARCHAR) AS item_id,
       CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS VARCHAR) AS price,
       CAST(p_size % 25 AS INT) AS owning_branch,
       CASE p_partkey % 5 WHEN 0 THEN 'C' WHEN 1 THEN 'S' WHEN 2 THEN 'H' WHEN 3 THEN 'SW' ELSE 'IH' END AS status
FROM part""",
    "v_usage": """
SELECT CAST(user_id % 25 AS INT) AS library_id,
       concat(CAST(CAST(ts AS DATE) AS VARCHAR), ' 00:00:00') AS activity_date,
       CASE WHEN event_id % 20 = 7 THEN concat('S', CAST(190000000 + event_id % 150 AS VARCHAR), '@School.example')
            WHEN event_id % 4 = 0 THEN concat('"', CAST(100000 + event_id % 150 AS VARCHAR), '"')
            ELSE concat(CAST(190000000 + event_id % 150 AS VARCHAR), '@school.example') END AS patron_full,
       concat(CASE event_id % 5 WHEN 0 THEN 'b' WHEN 1 THEN 'a' WHEN 2 THEN 'h' WHEN 3 THEN 'm' ELSE 'f' END, CASE WHEN event_id % 3 <> 1 THEN '' WHEN event_id % 5 = 2 THEN 'o' WHEN event_id % 5 = 3 THEN 'a' ELSE 'u' END, 'last', CAST(event_id % 97 AS VARCHAR), '@school.example') AS user_email,
       1 AS checkouts
FROM events""",
    "v_media": """
SELECT concat(CAST(190000000 + page_id AS VARCHAR), CASE WHEN page_id % 19 = 5 THEN 'x.jpg' ELSE '.jpg' END) AS file_name,
       CAST(length(html) AS BIGINT) AS n_bytes,
       CAST(DATE '2022-01-01' + CAST(page_id % 900 AS INT) AS DATE) AS mtime
FROM pages""",
    "v_ip_range": """
SELECT s_suppkey AS range_id,
       concat('10.', CAST(s_suppkey % 8 AS VARCHAR), '.', CAST(s_suppkey % 256 AS VARCHAR), '.0') AS start_ip,
       concat('10.', CAST(s_suppkey % 8 AS VARCHAR), '.', CAST(s_suppkey % 256 AS VARCHAR), '.255') AS end_ip,
       s_nationkey AS branch_number
FROM supplier""",
    "v_open_loan": """
SELECT user_id AS item_id, CAST(190000000 + event_id % 150 AS VARCHAR) AS patron_id,
       CAST(CAST(ts AS DATE) + 21 AS DATE) AS due_date,
       CASE WHEN event_id % 10 = 9 THEN 'L' WHEN event_id % 2 = 0 THEN 'C' ELSE 'O' END AS trans_code
FROM events WHERE event_id % 3 <> 2""",
    "v_holds": """
SELECT guid AS user_id, 1 AS hold_no FROM v_patron WHERE bty IN (3, 14, 43, 44, 45, 52)
UNION ALL
SELECT concat(' ', guid), 2 FROM v_patron WHERE bty IN (43, 45)""",
    # Derived reconcile inputs: yes/no flags, guarantor and collection status
    # that the roster carries but the base views do not.
    "x_extract": """
SELECT e.*,
       CASE CAST(right(patron_id, 1) AS INT) % 4 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' WHEN 2 THEN '' ELSE 'Yes' END AS permission,
       CASE CAST(right(patron_id, 2) AS INT) % 3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' ELSE '' END AS laptop,
       CASE CAST(right(patron_id, 3) AS INT) % 5 WHEN 0 THEN 'No' WHEN 1 THEN '' ELSE 'Yes' END AS tech_optout,
       CASE WHEN CAST(right(patron_id, 1) AS INT) < 3 THEN ''
            ELSE concat('G', CAST(CAST(right(patron_id, 2) AS INT) % 50 AS VARCHAR)) END AS guarantor,
       CAST(CASE WHEN bty IN (13, 40, 51) THEN 78 ELSE 1 END AS INT) AS collection_status,
       """ + ", ".join(f"{e} AS {c}" for c, e in EXTRACT_MORE) + """
FROM v_extract e""",
    "x_sor": """
SELECT p.*,
       CASE CAST(right(patron_id, 1) AS INT) % 3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' ELSE '' END AS permission,
       CASE CAST(right(patron_id, 2) AS INT) % 4 WHEN 0 THEN 'No' WHEN 1 THEN 'Yes' ELSE '' END AS laptop,
       CASE CAST(right(patron_id, 3) AS INT) % 5 WHEN 0 THEN 'Yes' WHEN 1 THEN '' ELSE 'No' END AS tech_optout,
       """ + ", ".join(f"{e} AS {c}" for c, e in SOR_MORE) + """
FROM v_patron p""",
    # Students always get collection status 78.
    "x_student": "SELECT * REPLACE (CAST(78 AS INT) AS collection_status) FROM x_extract",
}

_NAME = re.compile(r"\b[vx]_[a-z_]+\b")


def _needed(sql: str) -> list[str]:
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order or name not in VIEW_SQL:
            return
        for dep in _NAME.findall(VIEW_SQL[name]):
            if dep != name:
                visit(dep)
        order.append(name)

    for name in _NAME.findall(sql):
        visit(name)
    return order


def with_views(sql: str) -> str:
    """Prefix ``sql`` with CTEs for every stand-in view it references."""
    names = _needed(sql)
    body = sql.strip()
    if not names:
        return body
    ctes = ",\n".join(f"{n} AS ({VIEW_SQL[n].strip()})" for n in names)
    if body[:4].upper() == "WITH":
        return f"WITH {ctes},\n{body[4:].lstrip()}"
    return f"WITH {ctes}\n{body}"
