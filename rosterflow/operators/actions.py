"""Action payloads (K28): typed request rows for create / update / remove /
note actions of every population, and for items, built as column projections
(``struct`` / ``array(struct)``) over the action tables -- the hand-off to
whatever applies them.  One row per action; ``to_payload_json`` renders the
nested request when a text payload is needed.

A null in an update or removal means that the field is not part of the request;
an empty text clears it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterflow.operators.notes import EXPIRED_MARKER

KEY = "patron_id"
# Prefixes of test ids, school e-mail domains, who edits, codes of the requests.
TEST_PREFIX = {"student": "190999", "staff": "999", "university": "B99999999"}
SCHOOL_MAIL_DOMAINS = ("@mnpsk12.org", "@mnps.org")
EDITOR = "PIK"
GOOD = "G"
NOT_COLLECTED = (0, 1, 78)
STAFF_NOT_COLLECTED = (13, 40, 51)
NOTE_TYPE = "800"
CONVERT = (" This account may be converted to NPL after staff update patron barcode, patron type, email, phone, address, branch, "
           "and guarantor.")
NO_CONVERT = " DO NOT convert this account to NPL; create new account after outstanding transactions are resolved."


def _d(x: str) -> Column:
    return F.lit(x).cast("date")


def _text(x: str | None = None) -> Column:
    return F.lit(x).cast("string")


def _pin(birth: Column) -> Column:
    """Default PIN: month and day of birth (MMDD) from an ISO date text."""
    return F.concat(F.substring(birth, 6, 2), F.substring(birth, 9, 2))


def _is_test(population: str) -> Column:
    return F.col(KEY).startswith(TEST_PREFIX[population])


def _address(kind: str, street: Column, city: Column | None = None, state: Column | None = None, zip_: Column | None = None) -> Column:
    rest = {"city": city, "state": state, "postal_code": zip_}
    return F.struct(F.lit(kind).alias("type"), street.alias("street"), *[(_text() if c is None else c).alias(n) for n, c in rest.items()])


def _branches(branch: Column) -> dict[str, Column]:
    """The branch as default, of the last edit and of the registration."""
    return {"default_branch": branch, "last_edit_branch": branch, "reg_branch": branch}


def _edited(run_date: str) -> dict[str, Column]:
    return {"last_edit_date": _d(run_date), "last_edited_by": F.lit(EDITOR)}


def _registered(run_date: str) -> dict[str, Column]:
    return {"patron_status": F.lit(GOOD), "registered_by": F.lit(EDITOR), "registration_date": _d(run_date)}


def _names() -> dict[str, Column]:
    return {c: F.col(c) for c in ("last_name", "first_name", "middle_name", "suffix")}


def _request(rows: DataFrame, action: str, *fields: dict[str, Column]) -> DataFrame:
    every = {KEY: F.col(KEY), "action": F.lit(action)}
    for f in fields:
        every |= f
    return rows.select(*[c.alias(n) for n, c in every.items()])


def _student(roster: DataFrame) -> list[dict[str, Column]]:
    """What the creation and the update of a student share: homeroom teacher as
    sponsor with the second address, which is preferred when there is one."""
    return [{"patron_type": F.col("bty")}, _names(), _branches(F.col("default_branch")),
            {"phone2": F.col("phone"), "birth_date": F.col("birth_date"), "expiration_date": F.col("expiration_date"),
             "preferred_address": F.when(F.col("teacher_id") != "", F.lit("Sponsor")).otherwise(F.lit("Primary")),
             "sponsor_name": F.col("teacher_name"),
             "addresses": F.array(_address("Primary", F.col("street"), F.col("city"), F.col("state"), F.col("zip")),
                                  _address("Secondary", F.col("teacher_id")))}]


def payload_create(roster: DataFrame, *, run_date: str, test_pin: str) -> DataFrame:
    """createPatron rows of students: PIN = birth MMDD, ``test_pin`` for test ids."""
    return _request(roster, "create", *_student(roster), _edited(run_date), _registered(run_date), {
        "email": F.col("email"), "email_notices": F.lit("send email"), "collection_status": F.lit("do not send"),
        "pin": F.when(_is_test("student"), F.lit(test_pin)).otherwise(_pin(F.col("birth_date")))})


def payload_update(rows: DataFrame, *, run_date: str, start: str, twenty_day: str, test_pin: str) -> DataFrame:
    """updatePatron rows of students: without the e-mail (the SoR keeps its own),
    with the PIN reset only between the term start and the twentieth day, and
    the collection status only where it stands for no collection."""
    d = _d(run_date)
    reset = (d >= _d(start)) & (d < _d(twenty_day))
    return _request(rows, "update", *_student(rows), _edited(run_date), {
        "collection_status": F.when(F.col("collection_status").cast("int").isin(*NOT_COLLECTED), F.lit("do not send")),
        "pin": F.when(_is_test("student"), F.lit(test_pin)).when(reset, _pin(F.col("birth_date")))})


def _school_mail(email: Column, domains) -> Column:
    found = F.lit(False)
    for dom in domains:
        found = found | (F.instr(F.lower(email), dom.lower()) > 1)
    return found


def _closed(branch: str, bty: int, expiration: Column, run_date: str) -> list[dict[str, Column]]:
    return [{"patron_type": F.lit(bty)}, _branches(F.lit(branch)), _edited(run_date),
            {"expiration_date": expiration, "preferred_address": F.lit("Primary")}]


def _without_sponsor() -> dict[str, Column]:
    return {"phone2": F.lit(""), "sponsor_name": F.lit(""), "addresses": F.array(_address("Secondary", F.lit("")))}


def _note(start: str, expiration: Column, end: str) -> dict[str, Column]:
    text = F.concat(F.lit(start + " "), expiration.cast("string"), F.lit(". Previous branchcode: "), F.col("default_branch").cast("string"),
                    F.lit(". Previous bty: "), F.col("bty").cast("string"), F.lit("." + end))
    return {"note_type": F.lit(NOTE_TYPE), "note_text": text}


def payload_remove(remove: DataFrame, *, run_date: str, closed_branch: str = "XMNPS", closed_type: int = 38,
                   mail_domains=SCHOOL_MAIL_DOMAINS) -> DataFrame:
    """Removal rows of students: closed type and branch, collection status reset,
    school e-mail blanked (and notices off), homeroom teacher and second phone
    cleared, expiry = last seen (else the day before the run), plus the expiry note."""
    email = F.when(_school_mail(F.col("email"), mail_domains), F.lit("")).otherwise(F.col("email"))
    exp = F.coalesce(F.col("last_seen"), F.date_sub(_d(run_date), 1))
    return _request(remove, "remove", *_closed(closed_branch, closed_type, exp, run_date), _without_sponsor(), {
        "collection_status": F.when(F.col("collection_status").isin(*NOT_COLLECTED), F.lit("not sent")),
        "email": email, "email_notices": F.when(email == "", F.lit("do not send email"))},
        _note(f"MNPS {EXPIRED_MARKER}", exp, CONVERT))


def payload_graduation(rows: DataFrame, *, run_date: str, closed_branch: str = "XMNPS", closed_type: int = 38,
                       mail_domains=SCHOOL_MAIL_DOMAINS) -> DataFrame:
    """Closing rows of graduating students (SoR columns): as a removal, but the
    expiry is the day before the run, and an e-mail is part of the request only
    if it is a school's."""
    school = _school_mail(F.col("email"), mail_domains)
    exp = F.date_sub(_d(run_date), 1)
    return _request(rows, "remove", *_closed(closed_branch, closed_type, exp, run_date), _without_sponsor(), {
        "collection_status": F.when(F.col("collection_status").isin(*NOT_COLLECTED), F.lit("not sent")),
        "email": F.when(school, F.lit("")), "email_notices": F.when(school, F.lit("do not send email"))},
        _note(f"MNPS 12th grade {EXPIRED_MARKER}", exp, CONVERT))


# -- staff -------------------------------------------------------------------
def _staff() -> list[dict[str, Column]]:
    return [{"patron_type": F.col("bty")}, _names(), _branches(F.col("default_branch")),
            {"email": F.col("email"), "email_notices": F.lit("send email"), "expiration_date": F.col("expiration_date")}]


def _staff_uncollected() -> Column:
    return F.col("bty").cast("int").isin(*STAFF_NOT_COLLECTED)


def payload_staff_create(roster: DataFrame, *, run_date: str, test_pin: str) -> DataFrame:
    """createPatron rows of staff.  ``pin`` is null where whoever applies the row draws one (``draw_pin``)."""
    return _request(roster, "create", *_staff(), _edited(run_date), _registered(run_date), {
        "collection_status": F.when(_staff_uncollected(), F.lit("do not send")).otherwise(F.lit("not sent")),
        "pin": F.when(_is_test("staff"), F.lit(test_pin)), "draw_pin": ~_is_test("staff")})


def payload_staff_update(rows: DataFrame, *, run_date: str, test_pin: str) -> DataFrame:
    """updatePatron rows of staff (roster fields): with the e-mail; the collection
    status follows type and status, and a PIN is set for test ids alone."""
    status = F.col("collection_status").cast("int")
    return _request(rows, "update", *_staff(), _edited(run_date), {
        "collection_status": F.when(_staff_uncollected() & status.isin(1, 2, 78), F.lit("do not send"))
        .when(status.isNull() | status.isin(0, 1), F.lit("not sent")).when(status == 2, F.lit("sent")),
        "pin": F.when(_is_test("staff"), F.lit(test_pin))})


def payload_staff_remove(remove: DataFrame, *, run_date: str, closed_branch: str = "XMNPS", closed_type: int = 38) -> DataFrame:
    """Removal rows of staff: e-mail, phone and address stay, and the note forbids a conversion."""
    exp = F.coalesce(F.col("last_seen"), F.date_sub(_d(run_date), 1))
    return _request(remove, "remove", *_closed(closed_branch, closed_type, exp, run_date), {
        "collection_status": F.when(_staff_uncollected() & F.col("collection_status").isin(*NOT_COLLECTED), F.lit("not sent"))},
        _note(f"Former MNPS staffer, {EXPIRED_MARKER}", exp, NO_CONVERT))


# -- university and items ------------------------------------------------------
def payload_university_create(rows: DataFrame, *, run_date: str, test_pin: str) -> DataFrame:
    """createPatron rows of the onboarding list (``eligibility.onboard_csv``)."""
    return _request(rows, "create", {"patron_type": F.col("bty")}, {c: F.col(c) for c in ("last_name", "first_name", "middle_name")},
                    {c: F.col(c) for c in ("default_branch", "reg_branch", "email", "email_notices", "collection_status")},
                    {"expiration_date": F.col("exp_date"), "preferred_address": F.col("preferred_address"),
                     "addresses": F.array(_address("Primary", F.col("street"), F.col("city"), F.col("state"), F.col("zip")))},
                    _edited(run_date), _registered(run_date) | {"patron_status": F.col("status_code")},
                    {"pin": F.when(_is_test("university"), F.lit(test_pin)), "draw_pin": ~_is_test("university")})


# The fields of a createItem request.
ITEM_FIELDS = ["item_id", "bid", "owning_branch", "owning_location", "reserve_loan_period", "reserve_media", "status", "media", "price",
               "rotate_flag", "call_number", "branch", "location", "reserve_branch", "reserve_location", "reserve_type",
               "reserve_call_number", "manually_suppressed", "alternate_status"]


def payload_item_create(items: DataFrame) -> DataFrame:
    """createItem rows; a field that the list does not have is null, further columns are not read."""
    have = set(items.columns)
    return items.select(F.lit("create_item").alias("action"), *[(F.col(c) if c in have else _text()).alias(c) for c in ITEM_FIELDS])


# -- notes and text ------------------------------------------------------------
def payload_notes(note_add: DataFrame, note_delete: DataFrame, *, note_type: str = NOTE_TYPE) -> DataFrame:
    """Note requests: one add per new guarantor note, one delete per note id."""
    add = note_add.select(KEY, F.lit("note_add").alias("action"), F.lit(note_type).alias("note_type"),
                          F.col("note").alias("note_text"), F.lit(None).cast("string").alias("note_id"))
    delete = note_delete.select(KEY, F.lit("note_delete").alias("action"), F.lit(None).cast("string").alias("note_type"),
                                F.lit(None).cast("string").alias("note_text"), F.col("note_id").cast("string"))
    return add.unionByName(delete)


def to_payload_json(df: DataFrame, *, keep=(KEY, "action")) -> DataFrame:
    """(patron_id, action, payload JSON) for the hand-off."""
    rest = [c for c in df.columns if c not in keep]
    return df.select(*keep, F.to_json(F.struct(*rest)).alias("payload"))
