"""Circulation reports and maintenance lists over the transaction log.

Jobs: daily checkouts with school attribution (K13), transaction gaps and
in-house use (W1/K14), collection counts (K15/J8), latest checkout and due-date
extension (W2/K20), fee waiver (K21), patron deletion (K22), item lists
(C38/C39) and the null-aware NOT IN anti join (J5).

Scale notes
* The transaction log is the fact table (billions of rows); it is filtered on
  date and type first so the parquet scan prunes row groups, then
  pre-aggregated before any join with the patron table.
* Branch is a dimension (hundreds of rows): the planner broadcasts it while it
  is below ``spark.sql.autoBroadcastJoinThreshold`` bytes, else it shuffles.
* "Latest per key" is computed with an aggregate (partial combine per map
  task) and a join back, never by sorting one key's rows in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterflow.functions.text import code_part, code_tail
from rosterflow.operators.ordered import previous_row

STAFF_ID = r"^[0-9]{6,7}$"
STUDENT_ID = r"^190[0-9]{6}$"


def branch_roles(events: DataFrame, branch: DataFrame, roles: dict[str, str],
                 *, code_col: str = "branch_code") -> DataFrame:
    """Left-join one branch dimension under several roles.

    ``roles`` maps an event column holding a branch number to the output
    prefix; each role adds ``<prefix>_code`` and ``<prefix>_group``.
    """
    dim = (branch.select("branch_number", code_col, "branch_group"))
    out = events
    for col_name, prefix in roles.items():
        d = dim.select(F.col("branch_number").alias(f"_{prefix}_no"),
                       F.col(code_col).alias(f"{prefix}_code"),
                       F.col("branch_group").alias(f"{prefix}_group"))
        out = out.join(d, out[col_name] == d[f"_{prefix}_no"], "left").drop(f"_{prefix}_no")
    return out


def person_population(patron_id: Column) -> Column:
    """'staff' / 'student' / NULL from the shape of the patron id."""
    return (F.when(patron_id.rlike(STAFF_ID) & ~patron_id.startswith("999"), F.lit("staff"))
            .when(patron_id.rlike(STUDENT_ID) & ~patron_id.startswith("190999"), F.lit("student")))


def attribute_school(e: Column, i: Column, p: Column, now: Column, *,
                     special_env: str = "181", special_patron: str = "508") -> Column:
    """School credited with a checkout; NULL when the row is to be dropped.

    First matching rule wins, with SQL three-valued logic (a NULL comparison
    never matches, so such rows fall through to the last rule):
    1. env = item = special_env and (patron or current branch = special_patron) -> patron
    2. env = item, env != patron, env = current -> env
    3. env = item, env != patron, env != current -> NULL
    4. env, item, patron all different -> NULL
    5. otherwise -> patron
    """
    return (F.when((e == special_env) & (i == special_env)
                   & ((p == special_patron) | (now == special_patron)), p)
            .when((e == i) & (e != p) & (e == now), e)
            .when((e == i) & (e != p) & (e != now), F.lit(None).cast("string"))
            .when((e != i) & (e != p) & (i != p), F.lit(None).cast("string"))
            .otherwise(code_tail(p)))


def daily_checkouts(txlog: DataFrame, branch: DataFrame, patron: DataFrame, *,
                    start: str, stop: str, public_env: int = 29,
                    special_env: str = "181", special_patron: str = "508",
                    checkout_code: str = "CH") -> DataFrame:
    """Checkouts per (owner, population, school, day, patron) in [start, stop).

    All four report variants (school / public items x staff / student) come
    from one scan: ``owner`` and ``population`` are computed columns.
    """
    co = (txlog
          .filter((F.col("ts") >= F.lit(start).cast("timestamp_ntz"))
                  & (F.col("ts") < F.lit(stop).cast("timestamp_ntz"))
                  & (F.col("txn_type") == checkout_code))
          .select("ts", "patron_id", "env_branch", "item_branch", "patron_branch"))
    co = co.withColumn("population", person_population(F.col("patron_id"))) \
           .filter(F.col("population").isNotNull())
    co = branch_roles(co, branch, {"env_branch": "env", "item_branch": "item",
                                   "patron_branch": "pat"})
    owner = (F.when((F.col("env_branch") != public_env) & (F.col("env_group") == 2)
                    & (F.col("item_group") == 2), F.lit("school"))
             .when((F.col("env_branch") == public_env) & (F.col("item_group") == 1),
                   F.lit("public")))
    # Pre-aggregate per patron/day/code triple before the patron join: at
    # scale this shrinks the fact side by the number of checkouts per patron
    # and day, and the partial aggregate runs map-side.
    pre = (co.withColumn("owner", owner).filter(F.col("owner").isNotNull())
           .groupBy("owner", "population", "patron_id",
                    F.date_format("ts", "yyyyMMdd").alias("year_month_day"),
                    code_tail("env_code").alias("e"),
                    code_tail("item_code").alias("i"),
                    code_tail("pat_code").alias("p"))
           .agg(F.count(F.lit(1)).alias("n")))
    dim = (branch.select("branch_number", "branch_code"))
    current = (patron.select("patron_id", "default_branch")
               .join(dim, F.col("default_branch") == F.col("branch_number"), "left")
               .select("patron_id", code_tail("branch_code").alias("now")))
    joined = pre.join(current, "patron_id", "left")
    school = attribute_school(F.col("e"), F.col("i"), F.col("p"), F.col("now"),
                              special_env=special_env, special_patron=special_patron)
    return (joined.withColumn("school_code", school)
            .filter(F.col("school_code").isNotNull())
            .groupBy("owner", "population", "school_code", "year_month_day", "patron_id")
            .agg(F.sum("n").cast("bigint").alias("checkouts")))


def txn_gap(txlog: DataFrame, *, start: str, stop: str) -> DataFrame:
    """Previous event of the same item on the same day, and the gap.

    The reference restricts to one day before the window, so the first event
    of a day has no predecessor.  The predecessor is found with
    ``ordered.previous_row``: an item-day with very many events is split into
    minute buckets, so one item carrying a large share of the events does not
    load one task; the rest is a plain window per item and day.
    """
    t = (txlog.filter((F.col("ts") >= F.lit(start).cast("timestamp_ntz"))
                      & (F.col("ts") < F.lit(stop).cast("timestamp_ntz")))
         .select("txn_id", "item_id", "ts", "txn_type", "status_before", "item_branch",
                 F.to_date("ts").alias("_day")))
    p = previous_row(t, ["item_id", "_day"], "ts", "txn_id", ["ts", "txn_type", "status_before"])
    return p.select(
        "txn_id", "item_id", "ts", "txn_type", "status_before", "item_branch",
        F.col("prev_txn_type"), F.col("prev_status_before"), F.col("prev_ts"),
        F.expr("timestampdiff(MICROSECOND, prev_ts, ts)").alias("gap_us"),
    )


def in_house_circ(txlog: DataFrame, branch: DataFrame, *, start: str, stop: str,
                  gap_hours: int = 2, return_code: str = "DS",
                  shelf_status: str = "S") -> DataFrame:
    """On-shelf returns per school and day (K14): gap > gap_hours or first of day."""
    g = txn_gap(txlog, start=start, stop=stop)
    dim = (branch.select("branch_number", "branch_code", "branch_group"))
    osr = (g.join(dim, g["item_branch"] == dim["branch_number"], "left")
           .filter((F.col("branch_group") == 2) & F.col("branch_code").rlike("^[0-9]")
                   & (F.col("txn_type") == return_code)
                   & (F.col("status_before") == shelf_status)
                   & (F.col("prev_ts").isNull()
                      | (F.col("ts") > F.col("prev_ts") + F.expr(f"INTERVAL {int(gap_hours)} HOURS")))))
    return (osr.groupBy("branch_code", F.to_date("ts").alias("report_date"))
            .agg(F.count(F.lit(1)).alias("in_house"))
            .select(code_part("branch_code", 3, 3).alias("school_code"), "report_date", "in_house"))


# Branch names and name prefixes never counted as school
# collections, and the shelf statuses that count as holdings.
COLLECTION_EXCLUDED_NAMES = (
    "Bailey building - MNPS", "Bransford building - MNPS", "Former MNPS",
    "Limitless Bookmobile Annex", "Limitless Libraries", "Limitless Libraries Bookmobile",
    "Mark as error", "Martin Professional Development Center", "NPL delivery only",
)
COLLECTION_EXCLUDED_PREFIXES = ("Robertson Academy", "DO NOT USE", "DNU", "was ")
COLLECTION_STATUSES = ("C", "H", "I", "IH", "S", "SC", "SI", "SP", "SS", "SU")


def school_branches(branch: DataFrame, *, excluded_names=COLLECTION_EXCLUDED_NAMES,
                    excluded_prefixes=COLLECTION_EXCLUDED_PREFIXES) -> DataFrame:
    cond = (F.col("branch_group") == 2) & ~F.col("branch_name").isin(*excluded_names)
    for p in excluded_prefixes:
        cond = cond & ~F.col("branch_name").startswith(p)
    return branch.filter(cond)


def collection_count(items: DataFrame, branch: DataFrame, *, run_date: str,
                     statuses=COLLECTION_STATUSES,
                     excluded_names=COLLECTION_EXCLUDED_NAMES,
                     excluded_prefixes=COLLECTION_EXCLUDED_PREFIXES) -> DataFrame:
    """Items per school branch with a holdings status.

    Items are counted per owning branch first (partial aggregate), then the
    small per-branch result meets the branch dimension.
    """
    b = (school_branches(branch, excluded_names=excluded_names,
                                           excluded_prefixes=excluded_prefixes)
                           .select("branch_number", "branch_code"))
    counts = (items.filter(F.col("status").isin(*statuses))
              .join(b.select("branch_number"), F.col("owning_branch") == F.col("branch_number"), "left_semi")
              .groupBy("owning_branch").agg(F.count("item_id").alias("collection_count")))
    return (counts.join(b, counts["owning_branch"] == b["branch_number"], "inner")
            .select(code_part("branch_code", 3, 1 << 20).alias("school_code"),
                    "collection_count", F.lit(run_date).cast("date").alias("report_date")))


def right_join_counts(items: DataFrame, branch: DataFrame) -> DataFrame:
    """Items per school branch keeping branches without items (J8 as a right join)."""
    b = (school_branches(branch).select("branch_number", "branch_code"))
    per = items.groupBy("owning_branch").agg(F.count("item_id").alias("n"))
    return (per.join(b, per["owning_branch"] == b["branch_number"], "right")
            .select("branch_number", "branch_code",
                    F.coalesce("n", F.lit(0)).cast("bigint").alias("item_count")))


def latest_checkout(txlog: DataFrame, *, since: str, env_branch: int | None = None,
                    checkout_code: str = "CH") -> DataFrame:
    """Checkouts ranked first (latest, ties kept) per item since ``since``.

    rank() = 1 is rebuilt as max(ts) per item (map-side partial aggregate) and
    an equi join back on (item, ts), so no single item is sorted in one task.
    """
    tx = txlog.filter((F.col("ts") >= F.lit(since).cast("timestamp_ntz"))
                      & (F.col("txn_type") == checkout_code))
    if env_branch is not None:
        tx = tx.filter(F.col("env_branch") == env_branch)
    tx = tx.select("txn_id", "item_id", "patron_id", "ts", "env_branch")
    latest = tx.groupBy("item_id").agg(F.max("ts").alias("ts"))
    return tx.join(latest, ["item_id", "ts"], "left_semi")


def due_date_extension(open_loans: DataFrame, txlog: DataFrame, patron: DataFrame, *,
                       branch: int, due_before: str, run_date: str,
                       months: int = 6, codes=("C", "O")) -> DataFrame:
    """Open loans due before a date whose latest checkout was at ``branch``.
    Only loans with a ``trans_code`` of ``codes`` (checked out / overdue) count."""
    open_loans = open_loans.filter(F.col("trans_code").isin(*codes))
    since = F.add_months(F.trunc(F.lit(run_date).cast("date"), "MM"), -months)
    tx = txlog.filter(F.col("ts") >= since.cast("timestamp_ntz"))
    latest = latest_checkout(tx, since="1900-01-01", env_branch=branch)
    ti = open_loans.filter(F.col("due_date") < F.lit(due_before).cast("date")) \
                   .select("item_id", "patron_id")
    tix = ti.join(latest.select("item_id", "patron_id"), ["item_id", "patron_id"], "left_semi").distinct()
    p = patron.filter(F.col("exp_date") > F.lit(run_date).cast("date")).select("patron_id", "exp_date")
    return tix.join(p, "patron_id", "inner").select("patron_id", "item_id", "exp_date")


def not_in(df: DataFrame, key: str, sub: DataFrame, sub_key: str) -> DataFrame:
    """SQL ``key NOT IN (select sub_key ...)`` with its null semantics.

    When the sub-query yields a NULL nothing qualifies; rows whose own key is
    NULL qualify only if the sub-query is empty.  Rebuilt as a left-anti join on non-null keys (a
    hash or sort-merge join that scales with both sides) guarded by a scalar
    sub-query flag for NULLs in the sub-query, instead of the null-aware
    anti join that falls back to a nested loop when the sub-query is large.
    """
    s = sub.select(F.col(sub_key).alias("_k"))
    null_in_sub = s.agg(F.max(F.col("_k").isNull().cast("int"))).scalar()  # NULL: the sub-query is empty
    # Distinct keys on the anti side: a key repeated many times in the
    # sub-query (one patron with a third of all loans) becomes one row.
    keys = s.filter(F.col("_k").isNotNull()).distinct()
    kept = df.join(keys, F.col(key) == F.col("_k"), "left_anti")  # keeps NULL keys
    return kept.filter(null_in_sub.isNull() | ((null_in_sub == 0) & F.col(key).isNotNull()))


def fee_waiver(loans: DataFrame, patron: DataFrame, items: DataFrame, branch: DataFrame, *,
               since: str, codes=("L", "O"), excluded_types=(10, 13, 40, 42, 51),
               closed_type: int = 38, student_prefix: str = "190") -> DataFrame:
    """Loans to waive: school patrons, school items, lost/overdue codes."""
    dim = (branch.select("branch_number", "branch_code", "branch_group"))
    t = loans.filter(F.col("trans_code").isin(*codes) & (F.col("trans_date") > F.lit(since).cast("date")))
    p = patron.select("patron_id", "bty", "default_branch")
    i = items.select(F.col("item_id").alias("i_item"), "owning_branch")
    j = (t.join(p, "patron_id", "left")
         .join(i, t["item_id"].cast("string") == F.col("i_item"), "left")
         .join(dim.select(F.col("branch_number").alias("pb_no"), F.col("branch_group").alias("pb_group")),
               F.col("default_branch") == F.col("pb_no"), "left")
         .join(dim.select(F.col("branch_number").alias("ib_no"), F.col("branch_code").alias("item_branch_code"),
                          F.col("branch_group").alias("ib_group")),
               F.col("owning_branch") == F.col("ib_no"), "left")
         .filter(~F.col("bty").isin(*excluded_types) & (F.col("ib_group") == 2) & (F.col("pb_group") == 2)))
    closed = patron.filter((F.col("bty") == closed_type) & ~F.col("patron_id").startswith(student_prefix))
    j = not_in(j, "patron_id", closed, "patron_id")
    return j.select("item_id", "item_branch_code", "patron_id", "amount")


def patron_delete(patron: DataFrame, loans: DataFrame, *, run_date: str, idle_days: int = 14,
                  closed_type: int = 38, student_prefix: str = "190") -> DataFrame:
    """Closed non-student patrons idle for ``idle_days`` with no transaction."""
    cand = patron.filter(
        (F.col("bty") == closed_type) & ~F.col("patron_id").startswith(student_prefix)
        & (F.col("edit_date") < F.date_sub(F.lit(run_date).cast("date"), idle_days))
        & ~F.col("last_name").contains("TEST") & ~F.col("last_name").contains("Test"))
    return not_in(cand, "patron_id", loans, "patron_id").select("patron_id")


def items_at_location(items: DataFrame, *, column: str, value) -> DataFrame:
    """Item ids at one location / branch / status."""
    return items.filter(F.col(column) == F.lit(value)).select("item_id")


def price_rounding(items: DataFrame, loans: DataFrame, *, excluded_branch: int | None = 28,
                   excluded_statuses=("SW", "SC"), loan_patron_prefix: str = "a9",
                   item_prefix: str | None = None, limit: int | None = None) -> DataFrame:
    """Items whose price has cents, with the price rounded to whole units.

    Rounding is half away from zero (decimal ROUND), formatted with a
    thousands separator and two decimals.
    """
    price = F.col("price").cast("decimal(12,2)")
    cand = items.filter(F.substring("price", -2, 2) != "00")
    if excluded_branch is not None:
        cand = cand.filter(F.col("owning_branch") != excluded_branch)
    cand = cand.filter(~F.upper("status").isin(*excluded_statuses))
    if item_prefix:
        cand = cand.filter(F.col("item_id").startswith(item_prefix))
    on_loan = loans.filter(F.col("patron_id").startswith(loan_patron_prefix)) \
                   .select(F.col("item_id").cast("string").alias("item_id"))
    cand = not_in(cand, "item_id", on_loan, "item_id")
    out = cand.select("item_id", "price",
                      F.format_number(F.round(price, 0), 2).alias("rounded_price"))
    if limit is not None:
        out = out.orderBy("item_id").limit(limit)
    return out
