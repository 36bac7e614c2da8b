"""Registered file-source queries (S1-S6).  Each lands a file derived from the
stand-in tables under the shared checkpoint folder, then reads it back with
the source under test."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterflow.plans import q_notes  # noqa: F401  (registers the note queries reused below)
from rosterflow.plans.catalog import REGISTRY, register
from rosterflow.sources.snapshot import patron_snapshot
from rosterflow.sources import files as fs

POSITIONS = {0: "patron_id", 1: "bty", 2: "last_name", 3: "first_name", 6: "default_branch", 7: "exp_date", 9: "email"}


def _land_csv(v, name: str, df, *, sep: str):
    """Write ``df`` as delimited text with a header line in every part file
    and no quoting (values are written raw, as vendor exports are)."""
    path = fs.landing_path(v.spark, name)
    df.write.option("header", True).option("sep", sep).option("quote", "").option("escape", "") \
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return path


@register("scan_positional", sql="""
SELECT patron_id, CAST(bty AS VARCHAR) AS bty, last_name, first_name, CAST(default_branch AS VARCHAR) AS default_branch,
       CAST(exp_date AS VARCHAR) AS exp_date, email FROM v_extract""")
def q_scan_positional(v):
    e = v.extract
    cols = {0: "patron_id", 1: "bty", 2: "last_name", 3: "first_name", 4: None, 5: None, 6: "default_branch",
            7: "exp_date", 8: None, 9: "email"}
    line = F.concat_ws("|", *[F.col(c).cast("string") if c else F.lit("x") for c in cols.values()])
    path = fs.landing_path(v.spark, "positional")
    e.select(line.alias("value")).write.text(path)
    return fs.read_positional(v.spark, path, POSITIONS, width=10)


@register("scan_csv_headerless", sql="SELECT patron_id, bty, last_name, email FROM v_patron")
def q_scan_csv_headerless(v):
    path = fs.landing_path(v.spark, "headerless")
    v.patron.select("patron_id", "bty", "last_name", "email").write.option("header", False).csv(path)
    schema = T.StructType([T.StructField("patron_id", T.StringType()), T.StructField("bty", T.IntegerType()),
                           T.StructField("last_name", T.StringType()), T.StructField("email", T.StringType())])
    return fs.read_csv_headerless(v.spark, path, schema)


@register("scan_csv_headered", sql="""
SELECT user_id AS "User ID", CAST(hold_no AS VARCHAR) AS "Hold No" FROM v_holds WHERE hold_no = 1""")
def q_scan_csv_headered(v):
    # Tab-separated export; second holds carry a stray extra field (ragged rows).
    hold = F.when(F.col("hold_no") == 1, F.col("hold_no").cast("string")) \
            .otherwise(F.concat(F.col("hold_no").cast("string"), F.lit("\textra")))
    path = _land_csv(v, "headered", v.holds.select(F.col("user_id").alias("User ID"), hold.alias("Hold No")), sep="\t")
    return fs.read_csv_headered(v.spark, path)


@register("scan_header_normalized", sql="""
SELECT user_id AS "USER ID", CAST(hold_no AS VARCHAR) AS "HOLD NO" FROM v_holds""")
def q_scan_header_normalized(v):
    rows = v.holds.select(F.col("user_id").alias('\ufeff"User ID"'), F.col("hold_no").cast("string").alias("'hold no'"))
    path = _land_csv(v, "normalized", rows, sep=",")
    return fs.read_csv_headered(v.spark, path, sep=",", normalize=True)


@register("scan_alias_columns", sql="SELECT user_id FROM v_holds")
def q_scan_alias_columns(v):
    rows = v.holds.select(F.col("user_id").alias("Patron ID"), F.col("hold_no").cast("string").alias("Hold No"))
    path = _land_csv(v, "alias", rows, sep="\t")
    df = fs.read_csv_headered(v.spark, path)
    return fs.alias_columns(df, "user_id", ["User ID", "user id", "UserID", "Patron ID"]).select("user_id")


_LATEST = REGISTRY["latest_note"].sql
_IDS = REGISTRY["expired_note_ids"].sql
_DELS = REGISTRY["guarantor_note_delete"].sql


@register("patron_snapshot", sql=f"""
WITH g AS ({_LATEST}), x AS ({_IDS}), dl AS ({_DELS})
SELECT p.patron_id, p.bty, p.last_name, p.first_name, b.branch_code AS default_branch_code,
       strftime(p.exp_date, '%Y-%m-%d') AS exp_date, p.email, strftime(p.birth_date, '%Y-%m-%d') AS birth_date,
       g.guarantor, p.email_notices, x.expired_note_ids, dl.delete_note_ids, p.collection_status,
       CASE WHEN p.edit_branch = 'XMNPS' THEN 'XMNPS' ELSE e.branch_code END AS edit_branch_code, p.guid
FROM v_patron p
LEFT JOIN v_branch b ON p.default_branch = b.branch_number
LEFT JOIN v_branch e ON p.edit_branch = CAST(e.branch_number AS VARCHAR)
LEFT JOIN g ON p.patron_id = g.patron_id LEFT JOIN x ON p.patron_id = x.patron_id LEFT JOIN dl ON p.patron_id = dl.patron_id
WHERE (p.bty BETWEEN 21 AND 38 OR p.bty IN (46, 47)) OR regexp_matches(p.patron_id, '^190[0-9]{{6}}$')""")
def q_patron_snapshot(v):
    return patron_snapshot(v.patron, v.branch, v.note, v.loan, run_date="2024-02-01")
