"""Patron image inventory and maintenance lists.

Image files arrive through ``spark.read.format('binaryFile')`` (path,
modificationTime, length, content); jobs only need the id embedded in the
name, the size and the time, so ``media_inventory`` drops ``content`` unless
a hash is requested (the hash is computed in the scan task, and only 64
characters travel further).  Roster-vs-image checks are anti/inner joins on
the patron id; the per-branch report is one tagged aggregate with ROLLUP.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = "patron_id"


def media_inventory(files: DataFrame, *, with_hash: bool = False) -> DataFrame:
    """binaryFile rows -> (file_name, patron_id, n_bytes, mtime[, sha256])."""
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    cols = [name.alias("file_name"), F.regexp_extract(name, r"(\d{6,9})", 1).alias(KEY),
            F.col("length").alias("n_bytes"), F.col("modificationTime").alias("mtime")]
    if with_hash:
        cols.append(F.sha2(F.col("content"), 256).alias("sha256"))
    return files.select(*cols)


def image_ids(media: DataFrame) -> DataFrame:
    """9-digit ids found in image names (one row per id occurrence)."""
    return media.select("file_name", "mtime", "n_bytes",
                        F.explode(F.regexp_extract_all("file_name", F.lit(r"(\d{9})"), 1)).alias(KEY))


def report_roster(roster: DataFrame, *, test_floor: int = 190999000) -> DataFrame:
    """Roster ids below the test-id floor (numeric compare) with branch code."""
    return roster.filter(F.col(KEY).try_cast("bigint") < test_floor).select(KEY, "branch_code")


def media_missing(roster: DataFrame, media: DataFrame) -> DataFrame:
    """Roster patrons with no image (J17, unmatched right side)."""
    return roster.join(image_ids(media).select(KEY).distinct(), KEY, "left_anti")


def media_report(media: DataFrame, roster: DataFrame, *, cutoff: str) -> DataFrame:
    """Per branch: images missing, images older than ``cutoff`` and their sum,
    plus a 'Total' row (K24; J18 full outer join + A7 grand total as ROLLUP).

    Each input is read once: the images of an id are counted first, one left
    join gives the roster its counts, one grouped aggregate adds them up.
    Branches with neither missing nor old images have no row.
    """
    old = F.count_if(F.col("mtime") < F.lit(cutoff).cast("date"))
    images = image_ids(media).groupBy(KEY).agg(old.alias("o"))
    rows = (report_roster(roster).join(images, KEY, "left")
            .select("branch_code", F.col("o").isNull().cast("bigint").alias("m"), F.coalesce("o", F.lit(0)).alias("o")))
    agg = (rows.where("m + o > 0").rollup("branch_code")
           .agg(F.sum("m").alias("missing_images"), F.sum("o").alias("old_images"), F.grouping("branch_code").alias("_g")))
    return agg.select(F.when(F.col("_g") == 1, F.lit("Total")).otherwise(F.col("branch_code")).alias("branch_code"),
                      "missing_images", "old_images",
                      (F.col("missing_images") + F.col("old_images")).alias("total_images_needing_update"))


def media_missing_type(roster: DataFrame, media: DataFrame, *, bty: int | None = None) -> DataFrame:
    """Staff (optionally of one type) without an image."""
    r = roster if bty is None else roster.filter(F.col("bty") == bty)
    ids = media.select(F.regexp_extract("file_name", r"^(\d+)\.jpg$", 1).alias(KEY))
    return r.select(KEY).join(ids.distinct(), KEY, "left_anti")


def media_orphans(media: DataFrame, roster: DataFrame) -> DataFrame:
    """Image files whose name is not ``<roster id>.jpg`` (J19 delete list)."""
    valid = roster.select(F.concat(F.col(KEY), F.lit(".jpg")).alias("file_name"))
    return media.select("file_name").join(valid, "file_name", "left_anti")


def media_by_day(media: DataFrame, *, month: str) -> DataFrame:
    """Image count per modification day within one month (A11); the window
    end is ``add_months(start, 1)``, so December works."""
    start = F.lit(month + "-01").cast("date")
    return (media.filter((F.col("mtime") >= start) & (F.col("mtime") < F.add_months(start, 1)))
            .groupBy(F.col("mtime").alias("day")).agg(F.count(F.lit(1)).alias("n")))


def media_invalid(media: DataFrame, *, run_date: str, min_bytes: int = 4096) -> DataFrame:
    """Files that are not uploaded, once for each reason (C41): smaller than
    ``min_bytes``, a name that is not ``<6-9 digits>.jpg``, or not changed on
    the day of the run (or later)."""
    reasons = {"too_small": F.col("n_bytes") < min_bytes, "bad_name": ~F.col("file_name").rlike(r"^\d{6,9}\.jpg$"),
               "not_today": F.col("mtime") < F.lit(run_date).cast("date")}
    found = F.array_compact(F.array(*[F.when(c, F.lit(r)) for r, c in reasons.items()]))
    return media.select("file_name", F.explode(found).alias("reason"))


def media_upload_list(media: DataFrame, roster: DataFrame, *, since: str) -> DataFrame:
    """Images changed on or after ``since`` that belong to a roster patron."""
    changed = image_ids(media).filter(F.col("mtime") >= F.lit(since).cast("date"))
    return changed.join(roster.select(KEY), KEY, "left_semi").select(KEY, "file_name", "mtime")


def media_changed(local: DataFrame, stored: DataFrame) -> DataFrame:
    """Ids whose local image differs from the stored one by SHA-256."""
    a = local.select(KEY, F.sha2(F.col("content"), 256).alias("local_sha"))
    b = stored.select(KEY, F.sha2(F.col("content"), 256).alias("stored_sha"))
    return a.join(b, KEY, "inner").filter(F.col("local_sha") != F.col("stored_sha"))
