"""Registered circulation queries."""

from __future__ import annotations


from rosterflow.operators import circulation as circ
from rosterflow.plans.catalog import register
from rosterflow.sources.tables import VIEW_RUN_DATE

# The driver events cover January 2024; the monthly window covers all of it.
START, STOP = "2024-01-01", VIEW_RUN_DATE


@register("daily_checkouts", sql="""
WITH person AS (
  SELECT patron_id, default_branch FROM v_patron
), seen AS (
  SELECT t.patron_id, t.ts, t.env_branch = 29 AS at_public,
         (SELECT any_value(branch_group) FROM v_branch WHERE branch_number = t.env_branch) AS env_group,
         (SELECT any_value(branch_group) FROM v_branch WHERE branch_number = t.item_branch) AS item_group,
         (SELECT any_value(right(branch_code, 3)) FROM v_branch WHERE branch_number = t.env_branch) AS site,
         (SELECT any_value(right(branch_code, 3)) FROM v_branch WHERE branch_number = t.item_branch) AS owned,
         (SELECT any_value(right(branch_code, 3)) FROM v_branch WHERE branch_number = t.patron_branch) AS home,
         (SELECT any_value(right(b.branch_code, 3)) FROM person n JOIN v_branch b ON b.branch_number = n.default_branch
          WHERE n.patron_id = t.patron_id) AS today
  FROM v_txlog t
  WHERE t.txn_type = 'CH' AND CAST(t.ts AS DATE) BETWEEN DATE '2024-01-01' AND DATE '2024-01-31'
), typed AS (
  SELECT *, CASE length(patron_id) WHEN 9 THEN 'student' ELSE 'staff' END AS population,
         CASE WHEN at_public THEN 'public' ELSE 'school' END AS owner
  FROM seen
  WHERE regexp_full_match(patron_id, '[0-9]+')
    AND ((length(patron_id) = 9 AND patron_id[1:3] = '190' AND patron_id[4:6] <> '999')
         OR (length(patron_id) IN (6, 7) AND patron_id[1:3] <> '999'))
    AND ((at_public AND item_group = 1) OR (NOT at_public AND env_group = 2 AND item_group = 2))
), rules AS (
  SELECT *, list_position([
           coalesce(site = '181' AND owned = '181' AND '508' IN (home, today), FALSE),
           coalesce(site = owned AND home <> site AND today = site, FALSE),
           coalesce(site = owned AND home <> site AND today <> site, FALSE),
           coalesce(site <> owned AND site <> home AND owned <> home, FALSE),
           TRUE], TRUE) AS rule
  FROM typed
)
SELECT owner, population, CASE rule WHEN 2 THEN site ELSE home END AS school_code,
       strftime(ts, '%Y%m%d') AS year_month_day, patron_id, count(*) AS checkouts
FROM rules
WHERE rule IN (1, 2, 5) AND CASE rule WHEN 2 THEN site ELSE home END IS NOT NULL
GROUP BY ALL
""")
def q_daily_checkouts(v):
    return circ.daily_checkouts(v.txlog, v.branch, v.patron, start=START, stop=STOP)


@register("branch_roles", sql="""
SELECT t.txn_id, be.branch_code AS env_code, bi.branch_code AS item_code, bp.branch_code AS pat_code,
       be.branch_group AS env_group, bi.branch_group AS item_group, bp.branch_group AS pat_group
FROM v_txlog t
LEFT JOIN v_branch be ON t.env_branch = be.branch_number
LEFT JOIN v_branch bi ON t.item_branch = bi.branch_number
LEFT JOIN v_branch bp ON t.patron_branch = bp.branch_number
""")
def q_branch_roles(v):
    return circ.branch_roles(v.txlog, v.branch, {"env_branch": "env", "item_branch": "item",
                                                  "patron_branch": "pat"}) \
        .select("txn_id", "env_code", "item_code", "pat_code", "env_group", "item_group", "pat_group")


@register("txn_gap", sql="""
SELECT txn_id, item_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, txn_type, status_before, item_branch,
       lag(txn_type) OVER w AS prev_txn_type,
       lag(status_before) OVER w AS prev_status_before,
       strftime(lag(ts) OVER w, '%Y-%m-%d %H:%M:%S.%f') AS prev_ts,
       epoch_us(ts) - epoch_us(lag(ts) OVER w) AS gap_us
FROM v_txlog
WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-02-01'
WINDOW w AS (PARTITION BY item_id, CAST(ts AS DATE) ORDER BY ts, txn_id)
""")
def q_txn_gap(v):
    return circ.txn_gap(v.txlog, start=START, stop=STOP)


@register("in_house_circ", sql="""
SELECT substr(b.branch_code, 3, 3) AS school_code, strftime(t.ts, '%Y-%m-%d') AS report_date, count(*) AS in_house
FROM v_txlog t JOIN v_branch b ON b.branch_number = t.item_branch AND b.branch_group = 2
WHERE t.txn_type = 'DS' AND t.status_before = 'S' AND ascii(b.branch_code) BETWEEN ascii('0') AND ascii('9')
  AND t.ts BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-01-31 23:59:59.999999'
  AND NOT EXISTS (  -- an earlier event of that item on that day, two hours back at most
    SELECT 1 FROM v_txlog e
    WHERE e.item_id = t.item_id AND (e.ts, e.txn_id) < (t.ts, t.txn_id)
      AND e.ts >= greatest(date_trunc('day', t.ts), t.ts - INTERVAL 2 HOUR))
GROUP BY b.branch_code, 2
""")
def q_in_house_circ(v):
    return circ.in_house_circ(v.txlog, v.branch, start=START, stop=STOP)


@register("collection_count", sql="""
SELECT school_code, sum(held)::BIGINT AS collection_count, '2024-02-01' AS report_date
FROM (SELECT branch_number, substr(branch_code, 3) AS school_code FROM v_branch
      WHERE branch_group = 2 AND NOT list_contains(['Bailey building - MNPS', 'Bransford building - MNPS', 'Former MNPS', 'Limitless Bookmobile Annex',
  'Limitless Libraries', 'Limitless Libraries Bookmobile', 'Mark as error', 'Martin Professional Development Center',
  'NPL delivery only'], branch_name)
  AND NOT regexp_matches(branch_name, '^(Robertson Academy|DO NOT USE|DNU|was )')) s
JOIN LATERAL (SELECT count(*) AS held FROM v_item
              WHERE owning_branch = s.branch_number
                AND list_contains(['C', 'H', 'I', 'IH', 'S', 'SC', 'SI', 'SP', 'SS', 'SU'], status)) h ON h.held > 0
GROUP BY branch_number, school_code
""")
def q_collection_count(v):
    return circ.collection_count(v.item, v.branch, run_date=VIEW_RUN_DATE)


@register("right_join_counts", sql="""
SELECT branch_number, branch_code,
       (SELECT count(*) FROM v_item WHERE owning_branch = v_branch.branch_number) AS item_count
FROM v_branch
WHERE branch_group = 2 AND NOT list_contains(['Bailey building - MNPS', 'Bransford building - MNPS', 'Former MNPS', 'Limitless Bookmobile Annex',
  'Limitless Libraries', 'Limitless Libraries Bookmobile', 'Mark as error', 'Martin Professional Development Center',
  'NPL delivery only'], branch_name)
  AND NOT regexp_matches(branch_name, '^(Robertson Academy|DO NOT USE|DNU|was )')
""")
def q_right_join_counts(v):
    return circ.right_join_counts(v.item, v.branch)


@register("latest_checkout", sql="""
SELECT txn_id, item_id, patron_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, env_branch FROM (
  SELECT t.*, rank() OVER (PARTITION BY item_id ORDER BY ts DESC) AS rk
  FROM v_txlog t WHERE ts >= TIMESTAMP '2023-08-01' AND txn_type = 'CH'
) WHERE rk = 1
""")
def q_latest_checkout(v):
    return circ.latest_checkout(v.txlog, since="2023-08-01")


@register("due_date_extension", sql="""
SELECT DISTINCT o.patron_id, o.item_id, strftime(p.exp_date, '%Y-%m-%d') AS exp_date
FROM v_open_loan o JOIN v_patron p USING (patron_id)
WHERE p.exp_date > DATE '2024-02-01' AND o.due_date < DATE '2024-02-15' AND o.trans_code IN ('C', 'O')
  AND EXISTS (  -- this patron made the last checkout of the item at the branch
    SELECT 1 FROM v_txlog t
    WHERE t.item_id = o.item_id AND t.patron_id = o.patron_id AND t.txn_type = 'CH' AND t.env_branch = 29
      AND t.ts = (SELECT max(l.ts) FROM v_txlog l
                  WHERE l.item_id = o.item_id AND l.txn_type = 'CH' AND l.env_branch = 29 AND l.ts >= TIMESTAMP '2023-08-01'))
""")
def q_due_date_extension(v):
    return circ.due_date_extension(v.open_loan, v.txlog, v.patron,
                                   branch=29, due_before="2024-02-15", run_date=VIEW_RUN_DATE)


@register("not_in_antijoin", sql="""
SELECT patron_id, bty FROM v_patron
WHERE patron_id NOT IN (SELECT patron_id FROM v_loan)
""")
def q_not_in_antijoin(v):
    return circ.not_in(v.patron.select("patron_id", "bty"), "patron_id", v.loan, "patron_id")


@register("fee_waiver", sql="""
WITH schools AS (SELECT list(branch_number) AS numbers FROM v_branch WHERE branch_group = 2)
SELECT l.item_id, (SELECT any_value(branch_code) FROM v_branch WHERE branch_number = i.owning_branch) AS item_branch_code,
       l.patron_id, CAST(l.amount AS VARCHAR) AS amount
FROM v_loan l JOIN v_patron p USING (patron_id) JOIN v_item i ON i.item_id = CAST(l.item_id AS VARCHAR), schools
WHERE l.trans_code IN ('L', 'O') AND l.trans_date >= DATE '1997-01-02'
  AND NOT list_contains([10, 13, 40, 42, 51], p.bty) AND (p.bty <> 38 OR starts_with(l.patron_id, '190'))
  AND list_contains(schools.numbers, i.owning_branch) AND list_contains(schools.numbers, p.default_branch)
""")
def q_fee_waiver(v):
    return circ.fee_waiver(v.loan, v.patron, v.item, v.branch, since="1997-01-01")


@register("patron_delete", sql="""
SELECT patron_id FROM v_patron
WHERE bty = 38 AND patron_id NOT LIKE '190%' AND edit_date < DATE '2024-02-01' - INTERVAL 14 DAY
  AND last_name NOT LIKE '%TEST%' AND last_name NOT LIKE '%Test%'
  AND patron_id NOT IN (SELECT patron_id FROM v_loan)
""")
def q_patron_delete(v):
    return circ.patron_delete(v.patron, v.loan, run_date=VIEW_RUN_DATE)


@register("items_at_location", sql="SELECT item_id FROM v_item WHERE owning_branch = 7")
def q_items_at_location(v):
    return circ.items_at_location(v.item, column="owning_branch", value=7)


@register("price_rounding", sql="""
SELECT item_id, price, format('{:,.2f}', round(CAST(price AS DECIMAL(12,2)), 0)) AS rounded_price
FROM v_item
WHERE right(price, 2) <> '00' AND owning_branch <> 28 AND upper(status) NOT IN ('SW', 'SC')
  AND item_id NOT IN (SELECT CAST(item_id AS VARCHAR) FROM v_loan WHERE patron_id LIKE 'a9%')
""")
def q_price_rounding(v):
    return circ.price_rounding(v.item, v.loan)
