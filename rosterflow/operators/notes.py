"""Patron-note jobs.

Notes are keyed by patron; every job is an aggregate or a join on
``patron_id``.  The activity range join (J9) first reduces transactions to
distinct (patron, day) pairs -- bounded by the number of days a patron was
active -- so even a patron holding a third of all transactions contributes at
most a few thousand rows to the equi-join with range residual.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterflow.functions.common import let
from rosterflow.operators.ordered import joined_lists, pieces

KEY = "patron_id"
# Words of the expiry notes: the removal writes them, the clean-up finds them (in any case).
EXPIRED_MARKER = "patron expired"
ACTIVITY_CODES = ("C", "O", "L", "F1", "F2", "FS")


def _parse_day(s: Column) -> Column:
    """ISO ``yyyy-MM-dd`` or US ``M/d/yyyy`` text -> DATE (NULL if neither);
    the text (a regex extract) is evaluated once."""
    return let(s, lambda v: F.coalesce(F.try_to_timestamp(v, F.lit("yyyy-MM-dd")).cast("date"),
                                       F.try_to_timestamp(v, F.lit("M/d/yyyy")).cast("date")))


def latest_note(notes: DataFrame, *, marker: str) -> DataFrame:
    """Latest note per patron whose text contains ``marker`` and the guarantor
    parsed from it (W3): ``upper(trim(<digits/dashes>: <rest>))``.

    ``max_by`` over (ts, note_id) is an ordinary aggregate with map-side
    partial combine; ties on ts resolve to the highest note id.
    """
    latest = (notes.filter(F.col("text").contains(marker))
              .groupBy(KEY).agg(F.max_by("text", F.struct("ts", "note_id")).alias("text")))
    g = F.upper(F.trim(F.regexp_extract("text", r"[-/0-9]+:.+$", 0)))
    return latest.select(KEY, "text", F.nullif(g, F.lit("")).alias("guarantor"))


# Notes of a patron are listed by months, and those of a month in pieces if they are many.
LIST_SECONDS = 30 * 86_400
# Note ids that are listed together.
LIST_IDS = 65_536


def expired_notes(notes: DataFrame, *, marker: str) -> DataFrame:
    """The expiry notes, one row each."""
    return notes.filter(F.lower("text").contains(marker.lower())).select(KEY, "note_id", "ts")


def expired_note_ids(notes: DataFrame, *, marker: str) -> DataFrame:
    """Comma list of the expiry-note ids of each patron, newest first."""
    return _newest_first(expired_notes(notes, marker=marker))


def _newest_first(rows: DataFrame) -> DataFrame:
    cut = pieces(rows, [KEY], "ts", "note_id", bucket_seconds=LIST_SECONDS)
    return joined_lists(cut, KEY, ["_bucket", "_piece"], ["ts", "note_id"], "note_id", "expired_note_ids", descending=True)


def notes_reappeared(extract: DataFrame, notes: DataFrame, *, marker: str) -> DataFrame:
    """Lists of the expiry notes of patrons who are back in the extract, once for each of their rows there."""
    back = extract.select(KEY)
    return back.join(_newest_first(expired_notes(notes, marker=marker).join(back, KEY, "left_semi")), KEY)


def expired_note_delete(extract: DataFrame, notes: DataFrame, *, marker: str) -> DataFrame:
    """One delete action per expiry note of a patron who is back in the extract (K9); no list is made."""
    rows = expired_notes(notes, marker=marker).select(KEY, F.col("note_id").cast("string").alias("note_id"))
    return rows.join(extract.select(KEY), KEY)


def guarantor_note_create(extract: DataFrame, sor_guarantor: DataFrame, *, run_date: str,
                          term_start: str, prefix: str = "Guarantor effective") -> DataFrame:
    """New guarantor notes where the roster's guarantor differs (K7).

    Compared upper-cased; a SoR patron without a guarantor compares as ''.
    Note text: ``<prefix> <greatest(run_date, term_start)> - <GUARANTOR>``.
    """
    start = F.greatest(F.lit(run_date).cast("date"), F.lit(term_start).cast("date")).cast("string")
    j = extract.select(KEY, "guarantor", "exp_date").join(
        sor_guarantor.select(KEY, F.coalesce("guarantor", F.lit("")).alias("_cg")), KEY, "inner")
    return (j.filter((F.upper("guarantor") != F.upper("_cg")) & (F.col("guarantor") != "")
                     & F.col("guarantor").isNotNull())
            .select(KEY, F.concat(F.lit(prefix + " "), start, F.lit(" - "), F.upper("guarantor")).alias("note"),
                    "exp_date"))


def guarantor_windows(notes: DataFrame, *, prefix: str = "Guarantor effective") -> DataFrame:
    """Notes carrying a ``<prefix> <start> - <stop>:`` window.  A date that
    does not parse stays NULL: such a window can never contain activity, so
    the note counts as idle (as in the reference, where the keep-join needs
    both dates)."""
    pat = "^" + prefix + r" ([-/0-9]+) - ([-/0-9]+):"
    return notes.filter(F.col("text").rlike(pat)).select(
        "note_id", KEY,
        _parse_day(F.regexp_extract("text", pat, 1)).alias("g_start"),
        _parse_day(F.regexp_extract("text", pat, 2)).alias("g_stop"))


def notes_without_activity(windows: DataFrame, loans: DataFrame, *, codes=ACTIVITY_CODES) -> DataFrame:
    """Guarantor windows with no patron transaction inside [start, stop].

    Equi-join on patron with a range residual, as an anti join; the
    transaction side is first reduced to distinct (patron, day).
    """
    days = (loans.filter(F.col("trans_code").isin(*codes))
            .select(F.col(KEY).alias("_p"), F.col("trans_date").alias("_d")).distinct())
    cond = ((F.col(KEY) == F.col("_p")) & (F.col("g_start") <= F.col("_d")) & (F.col("g_stop") >= F.col("_d")))
    return windows.join(days, cond, "left_anti")


def guarantor_note_delete(notes: DataFrame, loans: DataFrame, *, run_date: str,
                          codes=ACTIVITY_CODES, prefix: str = "Guarantor effective") -> DataFrame:
    """Per patron, the ids of ended guarantor notes with no activity (K8)."""
    w = guarantor_windows(notes, prefix=prefix).filter(F.col("g_stop") < F.lit(run_date).cast("date"))
    idle = notes_without_activity(w, loans, codes=codes).withColumn("_part", F.floor(F.col("note_id") / LIST_IDS))
    return joined_lists(idle, KEY, ["_part"], ["note_id"], "note_id", "delete_note_ids")


def note_cleanup(notes: DataFrame, patron: DataFrame, *, prefix: str = "Guarantor effective",
                 types=(21, 37)) -> DataFrame:
    """Guarantor notes to delete (C37): notes of patrons with a type in
    ``types`` range, and guarantor notes with a blank name (``...:`` at end)."""
    g = notes.filter(F.col("text").startswith(prefix))
    by_type = (g.join(patron.select(KEY, "bty"), KEY, "left")
               .filter(F.col("bty").between(*types))
               .select("note_id", F.lit("student_type").alias("reason")))
    blank = notes.filter(F.col("text").rlike("^" + prefix + " .*:$")) \
                 .select("note_id", F.lit("blank_name").alias("reason"))
    return by_type.unionByName(blank)
