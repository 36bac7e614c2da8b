"""Registered IP-range queries (K31 / J20 / J21) over ``v_ip_range``."""

from __future__ import annotations

from pyspark.sql import functions as F

from rosterflow.operators import netrange as nr
from rosterflow.plans.catalog import register

# Targets (one per nation): /24 and /16 blocks, exact addresses and patterns.
TARGET_EXPR = (r"CASE WHEN n_nationkey % 5 = 4 THEN concat('10.', CAST(n_nationkey % 8 AS STRING), '.0.0/16') "
               r"WHEN n_nationkey % 3 = 0 THEN concat('10.', CAST(n_nationkey % 8 AS STRING), '.', "
               r"CAST((n_nationkey * 11) % 256 AS STRING), '.0/24') "
               r"WHEN n_nationkey % 3 = 1 THEN concat('10.', CAST(n_nationkey % 8 AS STRING), '.', "
               r"CAST((n_nationkey * 7) % 256 AS STRING), '.255') "
               r"ELSE concat('^10[.]', CAST(n_nationkey % 8 AS STRING), '[.]', CAST(n_nationkey AS STRING), '[0-9]?[.]') END")


def _ip(v: str) -> str:
    return (f"(CASE WHEN regexp_matches({v}, '^(\\d{{1,3}})\\.(\\d{{1,3}})\\.(\\d{{1,3}})\\.(\\d{{1,3}})$') THEN "
            f"CAST(split_part({v}, '.', 1) AS BIGINT) * 16777216 + CAST(split_part({v}, '.', 2) AS BIGINT) * 65536 + "
            f"CAST(split_part({v}, '.', 3) AS BIGINT) * 256 + CAST(split_part({v}, '.', 4) AS BIGINT) END)")


_net = "split_part(t.target, '/', 1)"
_bits = "CAST(split_part(t.target, '/', 2) AS INT)"


@register("ip_match", sql=f"""
WITH r AS (SELECT range_id, trim(start_ip) AS value FROM v_ip_range UNION ALL SELECT range_id, trim(end_ip) FROM v_ip_range),
t AS (SELECT n_nationkey AS target_order, {TARGET_EXPR} AS target FROM nation),
m AS (SELECT r.range_id, t.target_order, t.target FROM r, t
      WHERE r.value <> '' AND (r.value = t.target
         OR (contains(t.target, '/') AND {_ip('r.value')} BETWEEN
               {_ip(_net)} - ({_ip(_net)} % (CAST(1 AS BIGINT) << (32 - {_bits})))
               AND {_ip(_net)} - ({_ip(_net)} % (CAST(1 AS BIGINT) << (32 - {_bits}))) + (CAST(1 AS BIGINT) << (32 - {_bits})) - 1)
         OR (regexp_matches(t.target, '[\\^$*\\[\\]()\\\\|]') AND regexp_matches(r.value, t.target))))
SELECT range_id, arg_min(target, target_order) AS target FROM m GROUP BY range_id""")
def q_ip_match(v):
    targets = v.table("nation").select(F.col("n_nationkey").alias("target_order"), F.expr(TARGET_EXPR).alias("target"))
    return nr.ip_match(v.ip_range, targets)


CAND_EXPR = {
    "a": "concat('10.', CAST(s_suppkey % 8 AS STRING), '.', CAST((s_suppkey + CASE WHEN s_suppkey % 3 = 0 THEN 1 ELSE 0 END) % 256 AS STRING), '.0')",
    "b": "concat('10.', CAST(s_suppkey % 8 AS STRING), '.', CAST((s_suppkey + CASE WHEN s_suppkey % 3 = 0 THEN 1 ELSE 0 END) % 256 AS STRING), '.255')",
}
RANGE_TEXT = (f"CASE s_suppkey % 4 WHEN 0 THEN concat({CAND_EXPR['a']}, ' - ', {CAND_EXPR['b']}) "
              f"WHEN 1 THEN concat({CAND_EXPR['a']}, ' ', {CAND_EXPR['b']}) "
              f"WHEN 2 THEN concat({CAND_EXPR['a']}, ',', {CAND_EXPR['b']}) ELSE {CAND_EXPR['a']} END")
BRANCH_TEXT = "CASE WHEN s_suppkey % 10 = 9 THEN '' ELSE CAST(s_nationkey AS STRING) END"


@register("ip_new_ranges", sql=f"""
WITH c AS (SELECT {RANGE_TEXT} AS ip_range, {BRANCH_TEXT} AS branch FROM supplier),
p AS (SELECT CASE WHEN contains(ip_range, ' - ') THEN trim(split_part(ip_range, ' - ', 1))
                  WHEN contains(ip_range, ' ') THEN trim(split_part(ip_range, ' ', 1))
                  WHEN contains(ip_range, '-') THEN trim(split_part(ip_range, '-', 1))
                  WHEN contains(ip_range, ',') THEN trim(split_part(ip_range, ',', 1)) ELSE trim(ip_range) END AS start_ip,
             CASE WHEN contains(ip_range, ' - ') THEN trim(split_part(ip_range, ' - ', 2))
                  WHEN contains(ip_range, ' ') THEN trim(split_part(ip_range, ' ', 2))
                  WHEN contains(ip_range, '-') THEN trim(split_part(ip_range, '-', 2))
                  WHEN contains(ip_range, ',') THEN trim(split_part(ip_range, ',', 2)) ELSE trim(ip_range) END AS end_ip,
             trim(branch) AS branch
      FROM c WHERE ip_range IS NOT NULL AND trim(ip_range) <> '')
SELECT start_ip, end_ip, branch FROM p
WHERE start_ip <> '' AND branch IS NOT NULL AND branch <> ''
  AND NOT EXISTS (SELECT 1 FROM v_ip_range e WHERE e.start_ip = p.start_ip AND e.end_ip = p.end_ip)""")
def q_ip_new_ranges(v):
    cand = v.table("supplier").select(F.expr(RANGE_TEXT).alias("ip_range"), F.expr(BRANCH_TEXT).alias("branch"))
    return nr.ip_new_ranges(cand, v.ip_range)
