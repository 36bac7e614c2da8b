"""SQL names for the scalar rules (section 2.11), as SQL functions.

``register_sql_functions(spark)`` creates session-scoped SQL functions
(``CREATE TEMPORARY FUNCTION ... RETURN <expression>``).  They are inlined
into the plan like built-ins -- no Python runs -- so SQL users get the same
rules as the DataFrame functions of ``functions.text``, ``operators.roster``
and ``functions.net``, including the multi-pass name case (``rf_namecase``).
"""

from __future__ import annotations

from pyspark.sql import SparkSession

_FUNCTIONS = {
    "rf_scrub_ascii": ("s STRING", "STRING", r"regexp_replace(s, '[^\\n\\r\\x20-\\x7E]', '')"),
    "rf_trim_fields": ("s STRING", "STRING",
                       r"regexp_replace(regexp_replace(translate(s, '\"', ''''), '[\\n\\r]+', ''), '^\\s+|\\s+$', '')"),
    "rf_std_zip": ("z STRING", "STRING", r"regexp_replace(z, '-([0-9]{4})$', '')"),
    "rf_std_state": ("s STRING", "STRING", "replace(upper(s), '.', '')"),
    "rf_phone_clean": ("p STRING", "STRING",
                       r"CASE WHEN length(p) > 14 THEN CASE WHEN length(regexp_replace(p, '\\D', '')) > 14 "
                       r"THEN substring(regexp_replace(p, '\\D', ''), 1, 10) ELSE regexp_replace(p, '\\D', '') END "
                       r"ELSE p END"),
    "rf_school_remap": ("s STRING", "STRING",
                        r"CASE WHEN regexp_replace(s, '\\s', '') = '7F748' "
                        r"OR regexp_replace(s, '\\s', '') RLIKE '^(83116|84117|85480|86665)' THEN '7Z999' "
                        r"ELSE regexp_replace(s, '\\s', '') END"),
    "rf_ip_to_long": ("ip STRING", "BIGINT",
                      r"CASE WHEN ip RLIKE '^(\\d{1,3})\\.(\\d{1,3})\\.(\\d{1,3})\\.(\\d{1,3})$' "
                      r"AND try_cast(split(ip, '[.]')[0] AS BIGINT) <= 255 AND try_cast(split(ip, '[.]')[1] AS BIGINT) <= 255 "
                      r"AND try_cast(split(ip, '[.]')[2] AS BIGINT) <= 255 AND try_cast(split(ip, '[.]')[3] AS BIGINT) <= 255 "
                      r"THEN try_cast(split(ip, '[.]')[0] AS BIGINT) * 16777216 + try_cast(split(ip, '[.]')[1] AS BIGINT) * 65536 "
                      r"+ try_cast(split(ip, '[.]')[2] AS BIGINT) * 256 + try_cast(split(ip, '[.]')[3] AS BIGINT) END"),
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Create the SQL functions in ``spark``; returns their names."""
    for name, (params, ret, body) in _FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) RETURNS {ret} RETURN {body}")
    return list(_FUNCTIONS) + [register_namecase(spark)]


# -- name case as one SQL expression -------------------------------------------
def _lit(s: str) -> str:
    """Python string -> Spark SQL string literal (backslashes and quotes escaped)."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _in(values) -> str:
    return ", ".join(_lit(v) for v in values)


def _map_case(expr: str, mapping: dict[str, str]) -> str:
    return "CASE " + expr + " " + " ".join(f"WHEN {_lit(k)} THEN {_lit(v)}" for k, v in mapping.items()) + " END"


def namecase_sql(x: str, *, spanish: bool = True, hebrew: bool = True, roman: bool = True,
                 postnominal: bool = True) -> str:
    """SQL text of ``functions.text.namecase`` applied to the SQL expression ``x``.

    Same rules and the same single-evaluation structure: every intermediate
    string and token array is bound once as a lambda variable
    (``element_at(transform(array(v), n -> ...), 1)``), and neighbours are read
    by index from the bound array.
    """
    import re

    from rosterflow.functions import text as tx

    def let(value: str, var: str, body: str) -> str:
        return f"element_at(transform(array({value}), {var} -> {body}), 1)"

    tok = _lit(tx.TOKENS)
    # Pass 1: capitalise words; a single letter after an apostrophe stays lower.
    cap_rule = (f"CASE WHEN t RLIKE {_lit(r'^\w')} AND NOT (length(t) = 1 AND "
                f"coalesce(endswith(IF(i > 0, element_at(tk, i), NULL), {_lit(chr(39))}), false)) "
                f"THEN concat(upper(substring(t, 1, 1)), substring(t, 2)) ELSE t END")
    cap = let(f"regexp_extract_all(lower(s0), {tok}, 0)", "tk",
              f"array_join(transform(tk, (t, i) -> {cap_rule}), '')")
    # Pass 2: Irish Mac/Mc, with the listed exceptions kept lower.
    mac_rule = (f"CASE WHEN w RLIKE {_lit('^Mac[A-Za-z]')} AND NOT lower(w) RLIKE {_lit(tx._MAC_KEEP)} "
                f"THEN concat('Mac', upper(substring(w, 4, 1)), substring(w, 5)) "
                f"WHEN w RLIKE {_lit('^Mc[A-Za-z]')} THEN concat('Mc', upper(substring(w, 3, 1)), substring(w, 4)) "
                f"ELSE w END")
    irish = (f"replace(CASE WHEN s1 RLIKE {_lit(tx.IRISH_TRIGGER)} THEN "
             f"array_join(transform(regexp_extract_all(s1, {tok}, 0), w -> {mac_rule}), '') ELSE s1 END, "
             f"'Macmurdo', 'MacMurdo')")
    # Pass 3: particles, initials, Roman numerals, title words, post-nominals.
    plain = dict(tx._PARTICLE_WORDS, **({} if spanish else tx._SPANISH_WORDS))
    followed = dict(tx._FOLLOWED_WORDS, **(tx._HEBREW_WORDS if hebrew else {}))
    nxt = "IF(i + 2 <= size(tk), element_at(tk, i + 2), NULL)"
    after = "IF(i + 3 <= size(tk), element_at(tk, i + 3), NULL)"
    particle = (f"coalesce({_map_case('t', plain)}, CASE WHEN coalesce({nxt} RLIKE {_lit(r'^\s+$')} "
                f"AND {after} IS NOT NULL, false) THEN {_map_case('t', followed)} END, t)")
    shape = (f"CASE WHEN p RLIKE {_lit(tx.INITIALS)} AND p NOT IN ({_in(tx.INITIAL_EXCEPTIONS)}) "
             f"AND coalesce({nxt} RLIKE {_lit(r'^\s')}, false) THEN upper(p) "
             + (f"WHEN p RLIKE {_lit(tx.ROMAN)} THEN upper(p) " if roman else "")
             + f"WHEN p IN ({_in(tx.LOWER_CASE_WORDS)}) THEN lower(p) ELSE p END")
    word_pns = [p for p in tx.POST_NOMINALS if re.fullmatch(r"\w+", p)] if postnominal else []
    shaped = let(particle, "p", shape)
    if word_pns:
        shaped = let(shaped, "q", f"coalesce({_map_case('lower(q)', {p.lower(): p for p in word_pns})}, q)")
    words = let(f"regexp_extract_all(s2, {tok}, 0)", "tk", f"array_join(transform(tk, (t, i) -> {shaped}), '')")
    body = words
    if spanish:
        for cj in tx.SPANISH_CONJUNCTIONS:
            body = f"regexp_replace({body}, {_lit(r'(\s)' + cj + r'(\s)')}, {_lit('$1' + cj.lower() + '$2')})"
    if postnominal:
        for pn in tx.POST_NOMINALS:
            if not re.fullmatch(r"\w+", pn):
                body = f"regexp_replace({body}, {_lit('(?i)' + chr(92) + 'b' + re.escape(pn) + chr(92) + 'b')}, {_lit(pn)})"
    stage2 = let(cap, "s1", let(irish, "s2", body))
    return let(x, "s0", f"CASE WHEN s0 IS NULL OR s0 = '' THEN s0 ELSE {stage2} END")


def register_namecase(spark: SparkSession) -> str:
    """``rf_namecase(s STRING)``: the default name case as a SQL function."""
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION rf_namecase(s STRING) RETURNS STRING RETURN {namecase_sql('s')}")
    return "rf_namecase"
