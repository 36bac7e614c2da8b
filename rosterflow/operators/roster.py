"""Roster extract cleaning (C1-C21): overrides, keep-best de-duplication,
id-shape filter, scrubbing, name case, school / type / status rules, address,
phone, flags, guarantor stop date, programme mode and the final layout.

All rules are column expressions over one row, so a whole roster is one
narrow stage after the de-duplication on ``patron_id``.  The keep-best choice
is made with aggregates (``ordered.first_per_key``: max of the address, then
min of the row, both with map-side partial combine), so an id that occurs
very often does not load one task.  ``run_date`` is always a parameter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterflow.functions.common import let
from rosterflow.functions.text import namecase, namecase_if_caps, scrub_ascii, trim_fields
from rosterflow.operators.ordered import first_per_key

KEY = "patron_id"

# Schools whose students are remapped to the no-delivery code
# (exact match for the first, prefix match for the rest).
NO_DELIVERY = "7Z999"
NO_DELIVERY_EXACT = ("7F748",)
NO_DELIVERY_PREFIXES = ("83116", "84117", "85480", "86665")
# City misspellings -> correction (applied after name case).
CITY_CORRECTIONS = {
    "Goodletsville": "Goodlettsville", "Goodlettsvlle": "Goodlettsville", "Goodlettville": "Goodlettsville",
    "La Vegne": "La Vergne", "Lavergne": "La Vergne", "Mt Juliet": "Mount Juliet",
    "Mt. Juliet": "Mount Juliet", "Mt.Juliet": "Mount Juliet", "Nahville": "Nashville",
    "Nashille": "Nashville", "Nashviile": "Nashville", "Nashviille": "Nashville",
    "Nashvillet": "Nashville", "Nashvillle": "Nashville", "Nasvhille": "Nashville",
    "Nasville": "Nashville", "Whites Crekk": "Whites Creek", "Whitescreek": "Whites Creek",
}
# Opt-out type mapping (flag starting with N).
OPTOUT_TYPES = {**{str(t): 35 for t in range(21, 28)}, **{str(t): 36 for t in range(28, 31)},
                **{str(t): 37 for t in range(31, 35)}}
STUDENT_LAYOUT = ["patron_id", "bty", "last_name", "first_name", "middle_name", "suffix", "street", "city",
                  "state", "zip", "phone", "default_branch", "expiration_date", "email", "birth_date",
                  "guarantor", "laptop", "permission", "tech_optout", "teacher_id", "teacher_name",
                  "email_notices", "expired_note_ids", "delete_note_ids", "collection_status",
                  "edit_branch", "phone1"]

STAFF_LAYOUT = ["patron_id", "bty", "last_name", "first_name", "middle_name", "suffix", "default_branch", "expiration_date",
                "email", "email_notices", "expired_note_ids", "collection_status", "edit_branch"]
STAFF_FIELDS = ["patron_id", "bty", "last_name", "first_name", "middle_name", "suffix", "school_code"]


def _d(x: str) -> Column:
    return F.lit(x).cast("date")


def roster_with_overrides(extract: DataFrame, overrides: DataFrame) -> DataFrame:
    """Hand-maintained override rows in front of the extract (C1); ``priority``
    0 marks an override, 1 an extract row."""
    return (overrides.withColumn("priority", F.lit(0))
            .unionByName(extract.withColumn("priority", F.lit(1)), allowMissingColumns=True))


def dedupe_student(df: DataFrame, *, address_col: str = "street") -> DataFrame:
    """Per id the row with the greatest address (blank addresses last); equal
    addresses resolved by the whole row ascending (C2)."""
    return first_per_key(df, KEY, address_col, descending=True).select(*df.columns)


def dedupe_staff(extract: DataFrame, overrides: DataFrame, *, fields: list[str]) -> DataFrame:
    """Per id the greatest row over ``fields`` (as one text key); override rows
    then win over extract rows for the same id (C3)."""
    k = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in fields])
    best = first_per_key(extract.withColumn("_k", k), KEY, "_k", descending=True).drop("_k")
    both = roster_with_overrides(best.select(*extract.columns), overrides)
    return first_per_key(both, KEY, "priority", descending=False).drop("priority").select(*extract.columns)


def filter_id_shape(df: DataFrame, *, population: str) -> DataFrame:
    """Student ids ``190`` + 6 digits; staff ids non-blank."""
    if population == "student":
        return df.filter(F.col(KEY).rlike(r"^190\d{6}$"))
    return df.filter(F.col(KEY).isNotNull() & (F.col(KEY) != ""))


def school_remap(school: Column) -> Column:
    """Blank-free school code; ineligible schools -> the no-delivery code."""
    s = F.regexp_replace(school, r"\s", "")
    cond = s.isin(*NO_DELIVERY_EXACT)
    for p in NO_DELIVERY_PREFIXES:
        cond = cond | s.startswith(p)
    return F.when(cond, F.lit(NO_DELIVERY)).otherwise(s)


def optout_type(bty: Column, permission: Column) -> Column:
    """Opt-out borrower types: 21-27 -> 35, 28-30 -> 36, 31-34 -> 37 when the
    permission flag starts with N (C10)."""
    m = F.create_map(*[x for k, v in OPTOUT_TYPES.items() for x in (F.lit(k), F.lit(str(v)))])
    return F.when(permission.startswith("N") & m[bty].isNotNull(), m[bty]).otherwise(bty)


def _birth(birth: Column) -> Column:
    return F.when(birth.rlike(r"^\d{4}-\d{2}-\d{2}$"),
                  F.try_to_timestamp(birth, F.lit("yyyy-MM-dd")).cast("date"))


def _birthday_minus_one(birth: Column, years: int) -> Column:
    return F.date_sub(F.add_months(_birth(birth), 12 * years), 1)


def age_promotion(bty: Column, birth: Column, *, run_date: str) -> Column:
    """Adults (birth + 18 years - 1 day before ``run_date``): 31-34 -> 46, 37 -> 47 (C11)."""
    def rule(adult: Column) -> Column:
        return (F.when(bty.isin("31", "32", "33", "34") & adult, F.lit("46"))
                .when((bty == "37") & adult, F.lit("47")).otherwise(bty))

    return let(F.coalesce(_birthday_minus_one(birth, 18) < _d(run_date), F.lit(False)), rule)


def staff_type_rules(df: DataFrame, *, school_col: str = "school_code") -> DataFrame:
    """School 86665 keeps only type 40; schools 79118 / 7E601 get type 12."""
    s = F.regexp_replace(F.col(school_col), r"\s", "")
    kept = df.filter(~((s == "86665") & (F.col("bty").cast("int") != 40)))
    return kept.withColumn("bty", F.when(s.isin("79118", "7E601"), F.lit("12")).otherwise(F.col("bty")))


def collection_status(bty: Column, *, population: str) -> Column:
    """Staff of types 13/40/51 and all students: 78 (do not send); others 1."""
    if population == "student":
        return F.lit("78")
    return F.when(bty.cast("int").isin(13, 40, 51), F.lit("78")).otherwise(F.lit("1"))


def address_clean(df: DataFrame) -> DataFrame:
    """Street blanks collapsed and name-cased; city name-cased and corrected;
    state 'Tn' -> 'TN'; ZIP+4 suffix removed (C14/C15)."""
    street = namecase(F.regexp_replace("street", "  +", " "))
    city = city_corrections(namecase(F.col("city")))
    return df.withColumns({
        "street": street, "city": city,
        "state": F.when(F.col("state") == "Tn", F.lit("TN")).otherwise(F.col("state")),
        "zip": F.regexp_replace("zip", r"-\d{4}", " "),
    })


def city_corrections(city: Column) -> Column:
    """Exact misspelling dictionary lookup (C15) as a literal map (no join)."""
    m = F.create_map(*[x for k, v in CITY_CORRECTIONS.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(m[city], city)


def phone_clean(phone: Column, *, max_len: int = 14) -> Column:
    """Longer than ``max_len``: keep digits; still longer: first 10 digits."""
    digits = F.regexp_replace(phone, r"\D", "")
    return F.when(F.length(phone) > max_len,
                  F.when(F.length(digits) > max_len, F.substring(digits, 1, 10)).otherwise(digits)
                  ).otherwise(phone)


def flags_yes_no(df: DataFrame, *, flags=("laptop", "permission", "tech_optout"),
                 default_yes: str = "permission") -> DataFrame:
    """Blank ``default_yes`` flag -> Yes; Y/N -> Yes/No (C17; the rules are
    independent of the phone rule)."""
    out = df.withColumn(default_yes, F.when(F.col(default_yes) == "", F.lit("Yes"))
                        .otherwise(F.col(default_yes)))
    return out.withColumns({f: F.when(F.col(f) == "N", F.lit("No")).when(F.col(f) == "Y", F.lit("Yes"))
                            .otherwise(F.col(f)) for f in flags})


def guarantor_stop_date(guarantor: Column, birth: Column, *, run_date: str, expiration: str) -> Column:
    """Guarantor text with its stop date prefixed.

    Stop = birth + 13 years - 1 day; a patron past it gets no guarantor;
    otherwise ``least(stop, expiration): GUARANTOR``; a malformed birth date
    uses the expiration date.
    """
    exp = _d(expiration)
    with_date = lambda d: F.concat(d.cast("string"), F.lit(": "), guarantor)

    def rule(stop: Column) -> Column:
        return (F.when(guarantor == "", guarantor)
                .when(stop.isNull(), with_date(exp))
                .when(stop < _d(run_date), F.lit(""))
                .when(stop > exp, with_date(exp))
                .otherwise(with_date(stop)))

    # The stop date (a regex test and a date parse) is computed once per row.
    return let(_birthday_minus_one(birth, 13), rule)


def program_mode(df: DataFrame, *, label: str = "Promising Scholars 2026") -> DataFrame:
    """Summer programme: only rows with a programme branch, which becomes the
    default branch; homeroom = '998' + its last 3 characters (C20)."""
    p = F.col("programme_branch")
    return (df.filter(p.isNotNull() & (p != ""))
            .withColumns({"school_code": p,
                          "teacher_id": F.concat(F.lit("998"), F.substring(p, -3, 3)),
                          "teacher_name": F.lit(label)}))


def format_student_roster(raw: DataFrame, overrides: DataFrame | None = None, *, run_date: str,
                          expiration: str, programme: bool = False) -> DataFrame:
    """Nightly student roster in the 27-column layout (C1-C21 in order)."""
    df = raw if overrides is None else roster_with_overrides(raw, overrides).drop("priority")
    df = dedupe_student(df)
    if programme:
        df = program_mode(df)
    df = filter_id_shape(df, population="student")
    df = df.select(*[scrub_ascii(c).alias(c) for c in df.columns])
    last, first, middle, suffix = namecase_if_caps("last_name", "first_name", "middle_name", "suffix")
    df = df.withColumns({"last_name": last, "first_name": first, "middle_name": middle, "suffix": suffix})
    df = df.withColumn("school_code", school_remap(F.col("school_code")))
    df = df.withColumn("bty", optout_type(F.col("bty"), F.col("permission")))
    df = df.withColumn("bty", age_promotion(F.col("bty"), F.col("birth_date"), run_date=run_date))
    df = address_clean(df)
    df = df.withColumn("phone", phone_clean(F.col("phone")))
    df = flags_yes_no(df)
    df = df.withColumn("guarantor", guarantor_stop_date(F.col("guarantor"), F.col("birth_date"),
                                                        run_date=run_date, expiration=expiration))
    df = df.withColumns({"expiration_date": F.lit(expiration), "email_notices": F.lit("1"),
                         "expired_note_ids": F.lit(""), "delete_note_ids": F.lit(""),
                         "collection_status": collection_status(F.col("bty"), population="student"),
                         "edit_branch": F.lit(""), "phone1": F.lit(""),
                         "default_branch": F.col("school_code")})
    return df.select(*[trim_fields(c, quote_to_apostrophe=True).alias(c) for c in STUDENT_LAYOUT])


def format_staff_roster(raw: DataFrame, overrides: DataFrame, *, expiration: str) -> DataFrame:
    """Nightly staff roster in the 13-column layout (C3-C7, C12, C13, C19, C21):
    the best row of each id, override rows first."""
    df = filter_id_shape(dedupe_staff(raw, overrides, fields=STAFF_FIELDS), population="staff")
    df = df.select(*[scrub_ascii(c).alias(c) for c in df.columns])
    last, first, middle, suffix = namecase_if_caps("last_name", "first_name", "middle_name", "suffix")
    df = df.withColumns({"last_name": last, "first_name": first, "middle_name": middle, "suffix": suffix})
    df = staff_type_rules(df.withColumn("school_code", F.regexp_replace("school_code", r"\s", "")))
    df = df.withColumns({"expiration_date": F.lit(expiration), "email_notices": F.lit("1"), "expired_note_ids": F.lit(""),
                         "collection_status": collection_status(F.col("bty"), population="staff"),
                         "edit_branch": F.lit(""), "default_branch": F.col("school_code")})
    return df.select(*[trim_fields(c).alias(c) for c in STAFF_LAYOUT])
