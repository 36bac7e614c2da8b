"""Literals that a regular expression requires, as native column expressions.

An index over literals finds the patterns that can match a text at all; only
these are then tried.  What is returned is always safe: every text that a
pattern matches holds the literal.  Constructs that the rules below do not
read (look-around, flags, back references, nested classes) give the empty literal, which
every text holds.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters with a meaning in patterns; escaped ones stand for themselves and are held as
# private code points meanwhile, in this order.
SPECIAL = "\\.*+?()[]{}|^$-/"
_HELD = "".join(chr(0xE000 + i) for i in range(len(SPECIAL)))
_GAP = "\x01"  # anything may stand here
_QUANTIFIER = r"(?:[*+?]|\{[^}]*\})[?+]?"
_GROUP_DEPTH = 4


def _literal(c: Column) -> Column:
    return F.translate(c, _HELD, SPECIAL)


def required_literals(pattern: Column) -> Column:
    """One literal for each alternative of the pattern: a text that matches holds at least one of them."""
    unread = pattern.rlike(r"\(\?|\\[A-Za-z0-9&&[^dDwWsSbB]]|&&|[\x01\uE000-\uE0FF]")
    p = pattern
    for special, held in zip(SPECIAL, _HELD):  # the backslash itself comes first
        p = F.replace(p, F.lit("\\" + special), F.lit(held))
    p = F.regexp_replace(p, r"\\[dDwWsSbB]", _GAP)
    for special, held in zip(SPECIAL[1:], _HELD[1:]):  # a class of one character is that character
        if special not in "[]^":
            p = F.replace(p, F.lit(f"[{special}]"), F.lit(held))
    p = F.regexp_replace(p, r"\[\^?\]?[^\]\[]*\]", _GAP)
    for _ in range(_GROUP_DEPTH):
        p = F.regexp_replace(p, rf"\([^()]*\)(?:{_QUANTIFIER})?", _GAP)
    p = F.regexp_replace(p, rf"{_GAP}{_QUANTIFIER}", _GAP)
    p = F.regexp_replace(p, r"(.)\+[?+]?", "$1" + _GAP)
    p = F.regexp_replace(p, rf".{_QUANTIFIER}", _GAP)
    p = F.regexp_replace(p, r"[.^$]", _GAP)
    odd = p.rlike(r"[\\\[\](){}*+?]")
    pieces = F.transform(F.split(p, r"\|", -1), lambda a: F.array_max(F.transform(
        F.split(a, _GAP, -1), lambda s: F.struct(F.length(s).alias("n"), s.alias("s"))))["s"])
    return F.when(unread | odd, F.array(F.lit(""))).otherwise(F.transform(pieces, _literal))
