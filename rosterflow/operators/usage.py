"""Vendor usage reports and drop-file handling (K16-K18, K27, S7-S9, S12-S13,
S17, S19, A4, A13, J10-J12, J16).

Usage rows are the fact side; lookups (vendor library -> school, roster) are
joined on equi keys.  The name-key match of vendor B staff (an OR of two
conditions in the reference) is one equi join: a roster person is posted under
one or two keys, which differ in length, so a usage row meets a person once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterflow.functions.text import code_tail
from rosterflow.sources.sinks import write_partitions


KEY = "patron_id"


def patron_from_login(c: Column) -> Column:
    """Text before ``@`` (whole text without one), quotes and blanks trimmed."""
    return F.btrim(F.substring_index(c, "@", 1), F.lit('" '))


def population_by_length(pid: Column) -> Column:
    return (F.when(F.length(pid) == 9, F.lit("student"))
            .when(F.length(pid).isin(6, 7), F.lit("staff")))


def registered_school(patron: DataFrame, branch: DataFrame, *, reg_col: str = "default_branch",
                      closed_code: str = "XMNPS") -> DataFrame:
    """(patron_id, school_code) of the patrons registered at an open school branch."""
    b = (branch.filter((F.col("branch_group") == 2) & (F.col("branch_code") != closed_code))
         .select("branch_number", code_tail(F.col("branch_code")).alias("school_code")))
    return (patron.select(KEY, F.col(reg_col).alias("_reg")).join(b, F.col("_reg") == F.col("branch_number"))
            .select(KEY, "school_code"))


def school_lookup(patron_ids: DataFrame, patron: DataFrame, branch: DataFrame, *,
                  reg_col: str = "default_branch", closed_code: str = "XMNPS") -> DataFrame:
    """Registered school (last 3 of the branch code) of each id.

    One join instead of IN-lists chunked by 1,000 ids.
    """
    schools = registered_school(patron, branch, reg_col=reg_col, closed_code=closed_code)
    return schools.join(patron_ids.select(KEY), KEY, "left_semi")


def lookup_fallback(usage: DataFrame, patron_school: DataFrame, library_school: DataFrame) -> DataFrame:
    """School = patron's registered school, else the vendor library's."""
    return _with_school(usage.withColumn(KEY, patron_from_login(F.col("patron_full"))), patron_school, library_school)


def _with_school(rows: DataFrame, patron_school: DataFrame, library_school: DataFrame) -> DataFrame:
    """Rows of (patron_id, library_id) with the patron's school, else the library's."""
    lib = library_school.select("library_id", F.col("school_code").alias("_lib_school"))
    ps = patron_school.select(KEY, F.col("school_code").alias("_p_school"))
    out = rows.join(lib, "library_id", "left").join(ps, KEY, "left")
    return out.select(*rows.columns, F.coalesce("_p_school", "_lib_school").alias("school_code"))


def vendor_usage_sum(df: DataFrame, keys: list[str], value: str, alias: str) -> DataFrame:
    """``sum(value)`` by keys, as BIGINT (A4)."""
    return df.groupBy(*keys).agg(F.sum(value).cast("bigint").alias(alias))


def vendor_usage_a(usage: DataFrame, library_school: DataFrame, patron: DataFrame,
                   branch: DataFrame) -> DataFrame:
    """Vendor A checkouts per (population, school, day, patron).

    Staff (6-7 character ids) and students (9) come from the same rows, so
    one pass computes both with a ``population`` column.  Usage is first
    summed per (library, day, patron) -- the school depends only on the
    patron and the library -- so the lookup joins see one row per patron and
    day however many checkouts a patron has.  The usage is read once.
    """
    pre = (usage.select("library_id", F.substring("activity_date", 1, 10).alias("year_month_day"),
                        patron_from_login(F.col("patron_full")).alias(KEY), "checkouts")
           .groupBy("library_id", "year_month_day", KEY).agg(F.sum("checkouts").alias("checkouts")))
    rows = (_with_school(pre, registered_school(patron, branch), library_school).filter(F.col("school_code").isNotNull())
            .withColumn("population", population_by_length(F.col(KEY))).filter(F.col("population").isNotNull()))
    return vendor_usage_sum(rows, ["population", "school_code", "year_month_day", KEY], "checkouts",
                            "checkouts")


def email_match(usage: DataFrame, roster: DataFrame, *, user_col: str = "user_id",
                student_like: str = "190______") -> DataFrame:
    """Vendor B students (K17/J11): ids kept when id-shaped, else the roster id
    with the same e-mail (case-insensitive, blanks never match), else the
    login; no aggregation."""
    r = roster.filter(F.col("email").isNotNull() & (F.col("email") != "")) \
              .select(F.lower("email").alias("_em"), F.col(KEY).alias("_rid"))
    j = usage.join(r, F.lower(F.col(user_col)) == F.col("_em"), "left")
    pid = F.when(F.col(user_col).like(student_like), F.col(user_col)) \
           .otherwise(F.coalesce(F.nullif("_rid", F.lit("")), F.col(user_col)))
    return j.select("school_code", "year_month_day", pid.alias(KEY), "checkouts")


def name_keys(first: Column, middle: Column, last: Column) -> tuple[Column, Column]:
    """(initial+last, initial+middle initial+last), upper-cased; NULL when an
    initial it needs is missing, so an empty middle name never turns key 2
    into key 1."""
    f, m, l_ = F.upper(F.substring(first, 1, 1)), F.upper(F.substring(middle, 1, 1)), F.upper(last)
    has_f = F.length(f) == 1
    return (F.when(has_f, F.concat(f, l_)),
            F.when(has_f & (F.length(m) == 1), F.concat(f, m, l_)))


def email_name_match(usage: DataFrame, roster: DataFrame, *, user_col: str = "user_id",
                     branch_col: str = "sor_branch") -> DataFrame:
    """Vendor B staff (K17/J10): the e-mail local part equals initial+last or
    initial+middle-initial+last of a roster person at the same branch.

    Rows whose login is already a 6-7 digit id keep it; a usage row may match
    several people (kept, as in the reference).
    """
    local = F.when(F.instr(F.col(user_col), "@") > 0, F.upper(F.substring_index(F.col(user_col), "@", 1)))
    keys = F.array_distinct(F.array_compact(F.array(*name_keys(F.col("first_name"), F.col("middle_name"), F.col("last_name")))))
    r = roster.select(F.col(KEY).alias("_rid"), F.col("default_branch").alias("_rb"), F.explode(keys).alias("_key"))
    j = usage.withColumn("_local", local).join(r, (F.col("_local") == F.col("_key")) & (F.col(branch_col) == F.col("_rb")))
    pid = F.when(F.length(F.col(user_col)).isin(6, 7), F.col(user_col)).otherwise(F.col("_rid"))
    return j.select("school_code", "year_month_day", pid.alias(KEY), "checkouts")


def vendor_usage_c(usage: DataFrame, patron: DataFrame, branch: DataFrame, *, report_date: str) -> DataFrame:
    """Vendor C checkouts by guid (K18): inner join on the guid, sum per patron."""
    b = (branch.select("branch_number", "branch_code"))
    p = patron.select(KEY, "guid", "default_branch").join(
        b, F.col("default_branch") == F.col("branch_number"), "left")
    # One row per guid before the join: a heavy user does not skew it.
    per_user = usage.groupBy("user_id").agg(F.sum("checkouts").alias("checkouts"))
    j = per_user.join(p, per_user["user_id"] == p["guid"], "inner")
    rows = j.select(code_tail(F.col("branch_code")).alias("school_code"),
                    F.lit(report_date).alias("year_month_day"), KEY, "checkouts")
    return vendor_usage_sum(rows, ["school_code", "year_month_day", KEY], "checkouts", "checkouts")


# -- drop files --------------------------------------------------------------
PAGE_SCHEMA = T.StructType([
    T.StructField("status", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("items", T.ArrayType(T.StructType([
        T.StructField("Date", T.StringType()), T.StructField("Patron", T.StringType())]))),
])


def json_items_explode(pages: DataFrame, *, json_col: str = "page", library_col: str = "library_id") -> DataFrame:
    """One row per item of each JSON result page, with the page's library and
    a count of 1 (S8); pages flagged ``status = 'error'`` are skipped."""
    p = pages.select(library_col, F.from_json(json_col, PAGE_SCHEMA).alias("_p"))
    ok = p.filter(F.coalesce(F.col("_p.status"), F.lit("")) != "error")
    return ok.select(library_col, F.explode("_p.items").alias("_i")).select(
        library_col, F.col("_i.Date").alias("activity_date"), F.col("_i.Patron").alias("patron_full"),
        F.lit(1).alias("checkouts"))


def json_error_pages(pages: DataFrame, *, json_col: str = "page", library_col: str = "library_id") -> DataFrame:
    """Pages reporting an error, with their message."""
    p = pages.select(library_col, F.from_json(json_col, PAGE_SCHEMA).alias("_p"))
    return p.filter(F.col("_p.status") == "error").select(library_col, F.col("_p.message").alias("message"))


def drop_header_rows(df: DataFrame, header: dict[str, str]) -> DataFrame:
    """Remove rows that are a repeated header line ingested as data."""
    cond = F.lit(True)
    for c, v in header.items():
        cond = cond & (F.col(c) == F.lit(v))
    return df.filter(~F.coalesce(cond, F.lit(False)))


def file_date_from_name(names: DataFrame, *, name_col: str = "file_name",
                        switch_date: str = "2025-08-05") -> DataFrame:
    """Date embedded in a drop-file name (S12): ``yyyyMMdd`` (newer scheme) or
    ``MM_dd_yyyy`` (older scheme); dates of the older pattern after
    ``switch_date`` and of the newer before it are flagged ``scheme_ok=False``."""
    new = F.regexp_extract(name_col, r"(\d{8})", 1)
    old = F.regexp_extract(name_col, r"(\d{2}_\d{2}_\d{4})", 1)
    d_new = F.try_to_timestamp(F.nullif(new, F.lit("")), F.lit("yyyyMMdd")).cast("date")
    d_old = F.try_to_timestamp(F.nullif(old, F.lit("")), F.lit("MM_dd_yyyy")).cast("date")
    d = F.coalesce(d_new, d_old)
    sw = F.lit(switch_date).cast("date")
    ok = F.when(d_new.isNotNull(), d >= sw).otherwise(d < sw)
    return names.select(name_col, d.alias("file_date"), ok.alias("scheme_ok"))


def missing_dates(present: DataFrame, *, start: str, stop: str, date_col: str = "d") -> DataFrame:
    """Days in [start, stop) with no drop."""
    spark = present.sparkSession
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"),
                                                      F.date_sub(F.lit(stop).cast("date"), 1))).alias(date_col))
    return days.join(present.select(date_col).distinct(), date_col, "left_anti")


def backfill_range(usage: DataFrame, *, start: str, stop: str, keys: list[str]) -> DataFrame:
    """Per-day totals over a whole date range in one pass (S13): filter on the
    range, group by day -- written with ``partitionBy('report_date')``."""
    d = F.to_date(F.substring("activity_date", 1, 10))
    rows = usage.filter((d >= F.lit(start).cast("date")) & (d < F.lit(stop).cast("date")))
    return rows.groupBy(d.alias("report_date"), *keys).agg(F.sum("checkouts").cast("bigint").alias("checkouts"))


def report_date_of_drop(usage: DataFrame, *, requested: str) -> DataFrame:
    """Report date of a drop (S19): earliest activity day, else the requested date."""
    return usage.agg(F.coalesce(F.min(F.to_date(F.substring("activity_date", 1, 10))),
                                F.lit(requested).cast("date")).alias("report_date"))


def drop_dates(usage: DataFrame) -> DataFrame:
    """Distinct activity days of a drop."""
    return usage.select(F.substring("activity_date", 1, 10).alias("year_month_day")).distinct()


def split_by_date(rows: DataFrame, path: str, *, population_col: str = "population",
                  date_col: str = "year_month_day") -> DataFrame:
    """Write ``rows`` as CSV files in a folder for each population and date, and
    return the rows that these folders hold (S17).

    A folder has one file, or a few if it is large; a later call replaces the
    folders that it has rows for.  Rows without a date or population come back
    as such; empty texts in other columns stay empty.
    """
    by = [population_col, date_col]
    write_partitions(rows, path, by, fmt="csv", sep=",")
    schema = T.StructType([*[f for f in rows.schema.fields if f.name not in by], *[rows.schema[c] for c in by]])
    spark = rows.sparkSession
    back = spark.read.schema(schema).option("header", True).option("nullValue", "\u0000").option("emptyValue", "").csv(path)
    return back.select(*rows.columns)
