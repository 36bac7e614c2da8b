"""DuckDB text of the name-case rules, for oracle statements.

``namecase_ctes`` emits a chain of CTEs that adds one name-cased column to
a source relation.  It follows the rule list in ``functions/text.py`` but is
written for DuckDB (RE2 has no look-ahead, so ``X(?=\\s+\\w)`` rules capture
the look-ahead and put it back).
"""

from __future__ import annotations

import re

from rosterflow.functions.text import (
    INITIAL_EXCEPTIONS, INITIALS, IRISH_TRIGGER, LOWER_CASE_WORDS, MAC_EXCEPTIONS,
    POST_NOMINALS, ROMAN, SPANISH_CONJUNCTIONS)

_TOK = r"'(\w+|\W+)'"
_RE2_PARTICLES = [
    (r"\bAl(\s+\w)", r"al\1"), (r"\bAp\b", "ap"), (r"\b(Bin|Binti|Binte)\b", "bin"),
    (r"\bDell([ae])\b", r"dell\1"), (r"\bD([aeiou])\b", r"d\1"), (r"\bD([ao]s)\b", r"d\1"),
    (r"\bDe([lrn])\b", r"de\1"), (r"\bL([eo])\b", r"l\1"), (r"\bTe([rn])\b", r"te\1"),
    (r"\bVan(\s+\w)", r"van\1"), (r"\bVon\b", "von"),
]
_RE2_SPANISH_ARTICLES = [(r"\bEl\b", "el"), (r"\bLa\b", "la")]
_RE2_HEBREW = [(r"\bBen(\s+\w)", r"ben\1"), (r"\bBat(\s+\w)", r"bat\1")]


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _rr(expr: str, pat: str, rep: str, flags: str = "g") -> str:
    return f"regexp_replace({expr}, {_q(pat)}, {_q(rep)}, '{flags}')"


def namecase_ctes(src: str, col: str, out: str, tag: str, *, irish: bool = True, spanish: bool = True,
                  roman: bool = True, hebrew: bool = True, postnominal: bool = True,
                  post_nominals=POST_NOMINALS) -> tuple[str, str]:
    """Return (ctes, last_cte) adding column ``out`` = namecase(``col``) to ``src``."""
    t = tag
    ctes = [f"{t}0 AS (SELECT *, regexp_extract_all(lower({col}), {_TOK}) AS {t}_tk FROM {src})"]
    cap = (f"array_to_string(list_transform({t}_tk, lambda w, i: CASE WHEN regexp_matches(w, '^\\w') "
           f"AND NOT (length(w) = 1 AND coalesce(ends_with({t}_tk[i - 1], ''''), false)) "
           f"THEN upper(w[1]) || w[2:] ELSE w END), '')")
    ctes.append(f"{t}1 AS (SELECT *, {cap} AS {t}_a FROM {t}0)")
    b = f"{t}_a"
    if irish:
        mac = (f"array_to_string(list_transform(regexp_extract_all({t}_a, {_TOK}), lambda w: "
               f"CASE WHEN regexp_matches(w, '^Mac[A-Za-z]') THEN 'Mac' || upper(w[4]) || w[5:] "
               f"WHEN regexp_matches(w, '^Mc[A-Za-z]') THEN 'Mc' || upper(w[3]) || w[4:] ELSE w END), '')")
        for pat, rep in MAC_EXCEPTIONS:
            mac = _rr(mac, r"\b" + pat, rep)
        b = f"CASE WHEN regexp_matches({t}_a, {_q(IRISH_TRIGGER)}) THEN {mac} ELSE {t}_a END"
        b = f"replace({b}, 'Macmurdo', 'MacMurdo')"
    rules = list(_RE2_PARTICLES) + ([] if spanish else _RE2_SPANISH_ARTICLES) + (_RE2_HEBREW if hebrew else [])
    for pat, rep in rules:
        b = _rr(b, pat, rep)
    ctes.append(f"{t}2 AS (SELECT *, {b} AS {t}_c, regexp_extract_all({b}, {_TOK}) AS {t}_tk2 FROM {t}1)")
    excl = ", ".join(_q(x) for x in INITIAL_EXCEPTIONS)
    roman_rule = f"WHEN regexp_matches(w, {_q(ROMAN)}) THEN upper(w) " if roman else ""
    d = (f"array_to_string(list_transform({t}_tk2, lambda w, i: CASE "
         f"WHEN regexp_matches(w, {_q(INITIALS)}) AND w NOT IN ({excl}) "
         f"AND coalesce(regexp_matches({t}_tk2[i + 1], '^\\s'), false) THEN upper(w) "
         f"{roman_rule}ELSE w END), '')")
    for w in LOWER_CASE_WORDS:
        d = _rr(d, r"\b" + w + r"\b", w.lower())
    if spanish:
        for cj in SPANISH_CONJUNCTIONS:
            d = _rr(d, r"(\s)" + cj + r"(\s)", r"\1" + cj.lower() + r"\2")
    if postnominal:
        for pn in post_nominals:
            d = _rr(d, r"\b" + re.escape(pn) + r"\b", pn, "gi")
    ctes.append(f"{t}3 AS (SELECT *, CASE WHEN {col} IS NULL OR {col} = '' THEN {col} ELSE {d} END AS {out} "
                f"FROM {t}2)")
    return ",\n".join(ctes), f"{t}3"
