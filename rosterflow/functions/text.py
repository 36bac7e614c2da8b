"""Text column functions: scrubbing, trimming, name case and field
standardisation (C4, C5, C25-C29).

Everything is built from native Spark expressions (``regexp_replace``,
``regexp_extract_all`` + ``transform`` over word/non-word tokens,
``array_join``), so the work stays JVM-side inside whole-stage codegen; no
Python runs per row.  Case changes of a regex capture (which
``regexp_replace`` cannot do) are done on tokens: the text is split into
alternating ``\\w+`` / ``\\W+`` runs, each run is rewritten with
neighbour-aware ``when`` rules, and the runs are joined again.
"""

from __future__ import annotations

import re
from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from rosterflow.functions.common import let as _let

TOKENS = r"(\w+|\W+)"

# ---------------------------------------------------------------------------
# Fixed values of the name-case rules (they define the expected output).
# Irish "Mac" exceptions: pattern at a word start -> replacement.
MAC_EXCEPTIONS = [
    ("MacEdo", "Macedo"), ("MacEvicius", "Macevicius"), ("MacHado", "Machado"),
    ("MacHar", "Machar"), ("MacHell", "Machell"), ("MacHen", "Machen"),
    ("MacHiel", "Machiel"), ("MacHin", "Machin"), ("MacHlin", "Machlin"),
    ("MacHon", "Machon"), ("MacIas", "Macias"), ("MacIn", "Macin"),
    ("MacIol", "Maciol"), ("Macisaac", "MacIsaac"), ("MacIulis", "Maciulis"),
    ("MacKell", "Mackell"), ("MacKen", "Macken"), ("MacKey", "Mackey"),
    ("MacKie", "Mackie"), ("MacKintosh", "Mackintosh"), ("MacKle", "Mackle"),
    ("MacKlem", "Macklem"), ("MacKley", "Mackley"), ("MacKlin", "Macklin"),
    ("MacKmin", "Mackmin"), ("MacKrell", "Mackrell"), ("MacLin", "Maclin"),
    ("MacOmber", "Macomber"), ("MacQuarie", "Macquarie"),
]
# Particles lower-cased after capitalisation (Java regex, $n back-references).
PARTICLES = [
    (r"\bAl(?=\s+\w)", "al"), (r"\bAp\b", "ap"), (r"\b(Bin|Binti|Binte)\b", "bin"),
    (r"\bDell([ae])\b", "dell$1"), (r"\bD([aeiou])\b", "d$1"), (r"\bD([ao]s)\b", "d$1"),
    (r"\bDe([lrn])\b", "de$1"), (r"\bL([eo])\b", "l$1"), (r"\bTe([rn])\b", "te$1"),
    (r"\bVan(?=\s+\w)", "van"), (r"\bVon\b", "von"),
]
# Applied only when the ``spanish`` option is OFF (the reference's inverted switch).
SPANISH_ARTICLES = [(r"\bEl\b", "el"), (r"\bLa\b", "la")]
HEBREW = [(r"\bBen(?=\s+\w)", "ben"), (r"\bBat(?=\s+\w)", "bat")]
SPANISH_CONJUNCTIONS = ["Y", "E", "I"]
INITIALS = r"^(Aj|[bcdfghjklmnpqrstvwxyzBCDFGHJKLMNPQRSTVWXYZ]{2})$"
INITIAL_EXCEPTIONS = ["Mr", "Ms", "Dr", "St", "Jr", "Sr", "Lt"]
LOWER_CASE_WORDS = ["The", "Of", "And"]
ROMAN = r"^(?:[Xx]{1,3}|[Xx][Ll]|[Ll][Xx]{0,3})?(?:[Ii]{1,3}|[Ii][VvXx]|[Vv][Ii]{0,3})?$"
IRISH_TRIGGER = r"\bMac[A-Za-z]{2,}[^aciozj]\b|\bMc"
# The post-nominal list is a parameter; this default covers common degrees
# and honours.
POST_NOMINALS = ["PhD", "MD", "MBA", "MSc", "BSc", "MA", "BA", "JP", "QC", "KC", "OBE", "MBE", "CBE",
                 "DDS", "DPhil", "LLB", "LLM", "MEng", "BEng", "MPhil", "EdD", "RN"]
# ---------------------------------------------------------------------------


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def code_tail(c: Column | str, n: int = 3) -> Column:
    """The last ``n`` characters of a code; NULL when it is shorter."""
    return F.when(F.length(_col(c)) >= n, F.substring(_col(c), -n, n))


def code_part(c: Column | str, start: int, n: int) -> Column:
    """``n`` characters of a code from ``start``; NULL when there are none."""
    return F.nullif(F.substring(_col(c), start, n), F.lit(""))


def scrub_ascii(c: Column | str) -> Column:
    """Drop characters outside printable ASCII, keeping CR and LF (C4)."""
    return F.regexp_replace(_col(c), r"[^\n\r\x20-\x7E]", "")


def trim_fields(c: Column | str, *, quote_to_apostrophe: bool = False) -> Column:
    """Remove CR/LF runs, trim leading/trailing white space; optionally turn
    double quotes into apostrophes (C5)."""
    x = _col(c)
    if quote_to_apostrophe:
        x = F.translate(x, '"', "'")
    x = F.regexp_replace(x, r"[\n\r]+", "")
    return F.regexp_replace(x, r"^\s+|\s+$", "")


def _tokens(s: Column) -> Column:
    return F.regexp_extract_all(s, F.lit(TOKENS), 0)


def _is_word(t: Column) -> Column:
    return t.rlike(r"^\w")


def _neighbours(toks: Column) -> Column:
    """Tokens zipped with their previous, next and second-next token
    (``toks`` must be a bound variable: it is referenced four times)."""
    n = F.size(toks)
    none = F.array(F.lit(None).cast("string"))
    prev = F.concat(none, F.slice(toks, 1, F.greatest(n - 1, F.lit(0))))
    nxt = F.concat(F.slice(toks, 2, F.greatest(n, F.lit(1))), none)
    nxt2 = F.concat(F.slice(toks, 3, F.greatest(n, F.lit(1))), none, none)
    return F.arrays_zip(toks.alias("t"), prev.alias("p"), nxt.alias("n"), nxt2.alias("n2"))


def _capitalize(s: Column) -> Column:
    """Lower-case, upper-case the first letter of each word; a single letter
    after an apostrophe stays lower (possessive 's)."""
    def rule(x):
        t, prev = x["t"], x["p"]
        after_apostrophe = (F.length(t) == 1) & F.coalesce(prev.endswith("'"), F.lit(False))
        return F.when(_is_word(t) & ~after_apostrophe,
                      F.concat(F.upper(F.substring(t, 1, 1)), F.substring(t, 2, 1 << 20))).otherwise(t)

    return _let(_tokens(F.lower(s)), lambda toks: F.array_join(F.transform(_neighbours(toks), rule), ""))


# Exceptions whose fourth letter stays lower case, as one prefix pattern over
# the lower-cased word (derived from MAC_EXCEPTIONS).
_MAC_KEEP = "^mac(" + "|".join(p[3:].lower() for p, r in MAC_EXCEPTIONS if r[3].islower()) + ")"


def _irish(s: Column) -> Column:
    """Mac/Mc + upper-case letter, except the listed Mac names; applied only
    when the name looks Irish (``s`` must be a bound variable)."""
    def rule(t):
        return (F.when(t.rlike(r"^Mac[A-Za-z]") & ~F.lower(t).rlike(_MAC_KEEP),
                       F.concat(F.lit("Mac"), F.upper(F.substring(t, 4, 1)), F.substring(t, 5, 1 << 20)))
                .when(t.rlike(r"^Mc[A-Za-z]"),
                      F.concat(F.lit("Mc"), F.upper(F.substring(t, 3, 1)), F.substring(t, 4, 1 << 20)))
                .otherwise(t))

    fixed = F.array_join(F.transform(_tokens(s), rule), "")
    out = F.when(s.rlike(IRISH_TRIGGER), fixed).otherwise(s)
    return F.replace(out, F.lit("Macmurdo"), F.lit("MacMurdo"))


# Particles as whole-word rules (the PARTICLES / SPANISH_ARTICLES / HEBREW
# patterns above, restated per word): word -> replacement, and the words that
# change only when another word follows after white space.
_PARTICLE_WORDS = {"Ap": "ap", "Bin": "bin", "Binti": "bin", "Binte": "bin", "Della": "della", "Delle": "delle",
                   "Da": "da", "De": "de", "Di": "di", "Do": "do", "Du": "du", "Das": "das", "Dos": "dos",
                   "Del": "del", "Der": "der", "Den": "den", "Le": "le", "Lo": "lo", "Ter": "ter", "Ten": "ten",
                   "Von": "von"}
_FOLLOWED_WORDS = {"Al": "al", "Van": "van"}
_SPANISH_WORDS = {"El": "el", "La": "la"}
_HEBREW_WORDS = {"Ben": "ben", "Bat": "bat"}


def _map(d: dict[str, str]) -> Column:
    return F.create_map(*[x for k, v in d.items() for x in (F.lit(k), F.lit(v))])


def _word_pass(s: Column, roman: bool, post_nominals: list[str], *, spanish: bool, hebrew: bool) -> Column:
    """Particles, initials, Roman numerals, lower-case title words and
    post-nominals in one token pass (each rule matches whole words only)."""
    canon = {p.lower(): p for p in post_nominals if re.fullmatch(r"\w+", p)}
    pn_map = _map(canon) if canon else None
    plain = dict(_PARTICLE_WORDS, **({} if spanish else _SPANISH_WORDS))
    followed = dict(_FOLLOWED_WORDS, **(_HEBREW_WORDS if hebrew else {}))
    plain_map, followed_map = _map(plain), _map(followed)

    def shape(t, nxt):
        initial = (t.rlike(INITIALS) & ~t.isin(*INITIAL_EXCEPTIONS)
                   & F.coalesce(nxt.rlike(r"^\s"), F.lit(False)))
        r = F.when(initial, F.upper(t))
        if roman:
            r = r.when(t.rlike(ROMAN), F.upper(t))
        r = r.when(t.isin(*LOWER_CASE_WORDS), F.lower(t))
        w = r.otherwise(t)
        return F.coalesce(pn_map[F.lower(w)], w) if pn_map is not None else w

    def rule(x):
        followed_ok = F.coalesce(x["n"].rlike(r"^\s+$") & x["n2"].isNotNull(), F.lit(False))
        word = F.coalesce(plain_map[x["t"]], F.when(followed_ok, followed_map[x["t"]]), x["t"])
        # Bind the particle result so the shape rules read it once.
        return _let(word, lambda w: shape(w, x["n"]))

    return _let(_tokens(s), lambda toks: F.array_join(F.transform(_neighbours(toks), rule), ""))


def namecase(c: Column | str, *, lazy: bool = False, irish: bool = True, spanish: bool = True,
             roman: bool = True, hebrew: bool = True, postnominal: bool = True,
             post_nominals: Iterable[str] = POST_NOMINALS) -> Column:
    """Proper-case a person or place name.

    Steps: lower-case and capitalise words; Irish Mac/Mc with exceptions;
    particles (al, ap, bin, da/de/di/do/du, del/der/den, le/lo, ten/ter,
    van, von; el/la when ``spanish`` is off; ben/bat when ``hebrew``); two
    consonant initials upper-cased; the/of/and lower; Roman numerals upper;
    Spanish conjunctions y/e/i lower (blanks kept); post-nominals in their
    canonical case.  Options are per call.  ``lazy`` leaves mixed-case input
    untouched.  NULL stays NULL, '' stays ''.  Every intermediate string is
    bound once (``_let``), so the passes add up instead of multiplying.
    """
    word_pns = [p for p in post_nominals if re.fullmatch(r"\w+", p)] if postnominal else []

    def body(s: Column) -> Column:
        name = _capitalize(s)
        if irish:
            name = _let(name, _irish)
        name = _let(name, lambda v: _word_pass(v, roman, word_pns, spanish=spanish, hebrew=hebrew))
        if spanish:
            for cj in SPANISH_CONJUNCTIONS:
                name = F.regexp_replace(name, r"(\s)" + cj + r"(\s)", "$1" + cj.lower() + "$2")
        if postnominal:
            # Post-nominals with punctuation cannot be matched as one word token.
            for pn in post_nominals:
                if not re.fullmatch(r"\w+", pn):
                    name = F.regexp_replace(name, r"(?i)\b" + re.escape(pn) + r"\b", pn.replace("$", r"\$"))
        if lazy:
            first_lower = F.substring(s, 1, 1) == F.lower(F.substring(s, 1, 1))
            uniform = (s == F.lower(s)) | (s == F.upper(s))
            name = F.when(first_lower | uniform, name).otherwise(s)
        return F.when(s.isNull() | (s == ""), s).otherwise(name)

    return _let(_col(c), body)


def namecase_if_caps(last: Column | str, *cols: Column | str) -> list[Column]:
    """Name-case ``last`` and ``cols`` only when the last name is ALL CAPS
    (letters, blank, dot, dash, apostrophe) and does not start with TEST (C7)."""
    l_ = _col(last)
    caps = l_.rlike(r"^[- .A-Z']+$") & ~l_.startswith("TEST")
    return [F.when(caps, namecase(_col(x))).otherwise(_col(x)) for x in (last, *cols)]


# -- field standardisation (C26-C29) -----------------------------------------
def std_zip(c: Column | str) -> Column:
    """Drop a trailing ZIP+4 extension."""
    return F.regexp_replace(_col(c), r"-([0-9]{4})$", "")


def std_state(c: Column | str) -> Column:
    return F.replace(F.upper(_col(c)), F.lit("."), F.lit(""))


def std_city(c: Column | str) -> Column:
    x = namecase(c)
    x = F.translate(x, ".'", "")
    x = F.regexp_replace(x, r"(?i)^FT\.?\b", "Fort")
    x = F.regexp_replace(x, r"(?i)^LA\b", "La")
    return F.regexp_replace(x, r"(?i)^MT\.?\b", "Mount")


# Street suffix replacements (search -> replace, case-sensitive).
STREET_SUFFIXES = [(" CT", " Ct"), (" LN", " Ln"), (" MT", " Mount"), (" PK", " Pk"),
                   (" PL", " Pl"), (" RD", " Rd"), (" SQ", " Sq")]


def std_street(c: Column | str) -> Column:
    x = namecase(c, spanish=False, postnominal=False)
    x = F.regexp_replace(x, " {2,}", " ")
    x = F.translate(x, ".'", "")
    for a, b in STREET_SUFFIXES:
        x = F.replace(x, F.lit(a), F.lit(b))
    return x


def std_name(c: Column | str, *, last_name: bool = False) -> Column:
    """Name-case a person name; a last name keeps up to two leading '#'."""
    x = _col(c)
    if not last_name:
        return namecase(x)
    pat = r"^(#{1,2})#*\s*(.*)$"
    hashed = F.concat(F.regexp_extract(x, pat, 1), namecase(F.regexp_extract(x, pat, 2)))
    return F.when(x.rlike(pat), hashed).otherwise(namecase(x))
