"""Eligibility and bulk-maintenance lists (C32-C36, C40, K19, K23, K29,
J13, J14, L3-L5).

Filters and type maps are column expressions; fixed code lists compile to
hash-set membership tests (``isin`` -> InSet), so no join is needed for them.
Batch caps are explicit ``orderBy(...).limit(n)`` on a unique key (a
deterministic TakeOrdered), used only where the cap is the job's feature.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


KEY = "patron_id"

# ZIP codes of the service area.
SERVICE_ZIPS = (
    "37010", "37014", "37015", "37019", "37020", "37022", "37025", "37027", "37029", "37031", "37032",
    "37033", "37034", "37035", "37036", "37037", "37040", "37042", "37043", "37046", "37047", "37048",
    "37049", "37051", "37052", "37055", "37060", "37062", "37064", "37066", "37067", "37069", "37072",
    "37073", "37074", "37075", "37076", "37080", "37082", "37085", "37086", "37087", "37090", "37091",
    "37098", "37118", "37122", "37127", "37128", "37129", "37130", "37132", "37135", "37137", "37138",
    "37140", "37141", "37142", "37143", "37146", "37148", "37153", "37160", "37165", "37167", "37171",
    "37172", "37174", "37179", "37180", "37181", "37183", "37184", "37186", "37187", "37188", "37191",
    "37221", "38401", "38451", "38454", "38461", "38474", "38476", "38482", "38487",
)
# Full-fee non-resident type -> limited type.
DOWNGRADE = {3: 45, 14: 44, 15: 43}
GRADUATING_TYPES = (34, 37, 46, 47)
STUDENT_TYPES = tuple(range(21, 38)) + (46, 47)


def _d(x: str):
    return F.lit(x).cast("date")


def _cap(df: DataFrame, limit: int | None, order: str = KEY) -> DataFrame:
    return df if limit is None else df.orderBy(order).limit(limit)


def out_of_area(patron: DataFrame, *, types=(3, 14, 15, 43, 44, 45), zips=SERVICE_ZIPS,
                new_type: int = 52) -> DataFrame:
    """Non-resident patrons whose ZIP is outside the service area."""
    return (patron.filter(F.col("bty").isin(*types) & ~F.col("zip").isin(*zips))
            .select(KEY, "exp_date", F.lit(new_type).alias("new_bty")))


def area_downgrade(patron: DataFrame, *, run_date: str, recent_days: int = 100, years: int = 2,
                   limit: int | None = None) -> DataFrame:
    """Expired full-fee non-residents -> limited types; expiry moves to
    ``run_date + years`` when it lapsed within ``recent_days`` (C33)."""
    m = F.create_map(*[x for k, v in DOWNGRADE.items() for x in (F.lit(k), F.lit(v))])
    rows = patron.filter(F.col("bty").isin(*DOWNGRADE) & (F.col("exp_date") <= _d(run_date)))
    new_exp = F.when(F.col("exp_date") > F.date_sub(_d(run_date), recent_days),
                     F.add_months(_d(run_date), 12 * years)).otherwise(F.col("exp_date"))
    return _cap(rows.select(KEY, "bty", m[F.col("bty")].alias("new_bty"), "exp_date", new_exp.alias("new_exp_date")),
                limit)


def bulk_extend(patron: DataFrame, *, run_date: str, types=(4, 16, 17), new_type: int = 52,
                days: int = 730) -> DataFrame:
    """Type change for a type list, expiry +``days`` when it falls in
    [run_date, run_date + days) (C34, rule as described by the job)."""
    exp = F.col("exp_date")
    in_window = (exp >= _d(run_date)) & (exp < F.date_add(_d(run_date), days))
    return (patron.filter(F.col("bty").isin(*types))
            .select(KEY, F.lit(new_type).alias("new_bty"), exp,
                    F.when(in_window, F.date_add(exp, days)).otherwise(exp).alias("new_exp_date")))


def bulk_expiry(patron: DataFrame, *, bty: int, exp_date: str, prefix: str, limit: int | None = None) -> DataFrame:
    """Patrons of one type with one expiry date and id prefix; with ``limit`` the first so many by id."""
    rows = patron.filter((F.col("bty") == bty) & (F.col("exp_date") == _d(exp_date))
                         & F.col(KEY).startswith(prefix)).select(KEY)
    return _cap(rows, limit)


def ineligible_patrons(patron: DataFrame, *, run_date: str, types=(43, 44, 45), lapsed_type: int = 52) -> DataFrame:
    """Limited non-residents, and lapsed out-of-area patrons."""
    return patron.filter(F.col("bty").isin(*types)
                         | ((F.col("bty") == lapsed_type) & (F.col("exp_date") < _d(run_date)))) \
                 .select(KEY, "guid", "bty", "exp_date")


def id_collisions(patron: DataFrame, *, length: int = 6) -> DataFrame:
    """Values of ``length`` characters that are one patron's id and another
    patron's guid (J13 / U2)."""
    ids = patron.filter(F.length(KEY) == length).select(F.col(KEY).alias("value"))
    guids = patron.filter((F.length("guid") == length) & (F.col("guid") != F.col(KEY))).select(F.col("guid").alias("value"))
    return guids.distinct().join(ids, "value", "left_semi")


def ineligible_holds(holds: DataFrame, ineligible: DataFrame, *, user_col: str = "user_id") -> DataFrame:
    """Holds whose user matches an ineligible patron's guid (J14): the probe is
    ``lower(trim(user))``; the trimmed original id is reported and duplicate
    holds of one user are kept."""
    g = (ineligible.filter(F.col("guid").isNotNull() & (F.col("guid") != ""))
         .select(F.lower(F.trim("guid")).alias("_g")).distinct())
    j = holds.join(g, F.lower(F.trim(F.col(user_col))) == F.col("_g"), "left_semi")
    return j.select(F.trim(F.col(user_col)).alias("user_id"),
                    F.trim(F.col(user_col)).try_cast("decimal(20,0)").alias("sort_key"),
                    *[c for c in holds.columns if c != user_col])


def hold_cancel_plan(matches: DataFrame, collisions: DataFrame, *, limit: int | None = None) -> DataFrame:
    """One action per distinct matched user (K19): ids of length 15 or 6 are
    cancelled, 6-character ids that collide are skipped, other lengths are
    skipped.  Users are walked in numeric order; with ``limit``, the walk
    stops once ``limit`` users were processed (cancelled or skipped as
    colliding), so later users -- of any kind -- are not listed."""
    users = matches.select("user_id").distinct()
    col = collisions.select(F.col("value").alias("_c")).distinct()
    j = users.join(col, F.col("user_id") == F.col("_c"), "left")
    n = F.length("user_id")
    action = (F.when(~n.isin(15, 6), F.lit("skip_length"))
              .when((n == 6) & F.col("_c").isNotNull(), F.lit("skip_collision"))
              .otherwise(F.lit("cancel")))
    out = j.select("user_id", action.alias("action"),
                   F.struct(F.col("user_id").try_cast("decimal(20,0)").alias("k"), F.col("user_id").alias("u"))
                   .alias("_pos"))
    if limit is None:
        return out.drop("_pos")
    # Position of the limit-th processed user (a bounded TakeOrdered), as a
    # scalar sub-query; the walk keeps everything up to it.
    processed = out.filter(F.col("action") != "skip_length")
    last = processed.orderBy("_pos").limit(limit).agg(F.max("_pos"), F.count(F.lit(1)))
    last_pos = last.select(F.col("max(_pos)")).scalar()
    reached = last.select((F.col("count(1)") >= limit).alias("r")).scalar()
    keep = ~F.coalesce(reached, F.lit(False)) | (F.col("_pos") <= last_pos)
    return out.filter(keep).drop("_pos")


def graduation_actions(extract: DataFrame, sor: DataFrame, *, grade_type: int = 34,
                       closed_type: int = 38) -> DataFrame:
    """Graduating students -> action (K23 / J23): SoR type 38 -> 'already_closed';
    34/37/46/47 -> 'update'; other SoR types -> 'review'; not in the SoR
    selection -> 'not_found'."""
    ids = extract.filter(F.col("bty").cast("int") == grade_type).select(KEY).distinct()
    sel = sor.filter(F.col("bty").isin(*GRADUATING_TYPES)
                     | (F.col(KEY).rlike(r"^190[0-9]{6}$") & ~F.col("bty").isin(*STUDENT_TYPES)))
    j = ids.join(sel.select(KEY, F.col("bty").alias("sor_bty")), KEY, "left")
    action = (F.when(F.col("sor_bty").isNull(), F.lit("not_found"))
              .when(F.col("sor_bty") == closed_type, F.lit("already_closed"))
              .when(F.col("sor_bty").isin(*GRADUATING_TYPES), F.lit("update"))
              .otherwise(F.lit("review")))
    return j.select(KEY, "sor_bty", action.alias("action"))


def calendar_gate(actions: DataFrame, calendar: DataFrame, *, run_date: str,
                  skip_windows: DataFrame | None = None) -> DataFrame:
    """Phase of the school calendar on ``run_date`` for every action row and
    whether it may run (C40): [start, twenty_day) 'homeroom', [twenty_day,
    stop) 'remove', else 'closed'.  ``skip_windows`` (branch, bty, start,
    stop) suppresses matching rows inside their window."""
    d = _d(run_date)
    # The calendar is a one-row configuration table; its dates enter the plan
    # as scalar sub-queries (no join with the action rows).
    start, twenty, stop = (calendar.agg(F.min(c)).scalar() for c in ("start_date", "twenty_day", "stop_date"))
    phase = (F.when((d >= start) & (d < twenty), F.lit("homeroom"))
             .when((d >= twenty) & (d < stop), F.lit("remove"))
             .otherwise(F.lit("closed")))
    out = actions.withColumn("phase", phase)
    if skip_windows is not None:
        w = (skip_windows.filter((d >= F.col("skip_start")) & (d <= F.col("skip_stop")))
                               .select(F.col("branch").alias("_sb"), F.col("bty").alias("_st")).distinct())
        out = out.join(w, (F.col("default_branch") == F.col("_sb")) & (F.col("bty") == F.col("_st")), "left") \
                 .withColumn("skipped", F.col("_sb").isNotNull()).drop("_sb", "_st")
    else:
        out = out.withColumn("skipped", F.lit(False))
    return out.withColumn("allowed", (F.col("phase") != "closed") & ~F.col("skipped"))


def onboard_csv(df: DataFrame, *, mapping: dict[str, str], defaults: dict[str, object],
                derived: dict | None = None) -> DataFrame:
    """Third-party onboarding rows: renamed columns, constant defaults and
    derived text (K29)."""
    cols = [F.col(f"`{src}`").alias(dst) for dst, src in mapping.items()]
    cols += [c.alias(n) for n, c in (derived or {}).items()]
    cols += [F.lit(v).alias(k) for k, v in defaults.items()]
    return df.select(*cols)
