"""Sinks: CSV/TSV reports, ordered files, partitioned history, empty-result policy."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_csv(df: DataFrame, path: str, *, sep: str = ",", header: bool = True, allow_empty: bool = True,
              order: list[Column | str] | None = None) -> int:
    """CSV with header (S14); returns the number of rows, which the write itself counts.

    The rows are computed once.  An empty result is a header-only file, since
    the first task of a write always makes a file; with ``allow_empty`` off it
    is an error instead, and what was at ``path`` before stays (S16).

    With ``order`` the files hold the rows in that order when they are read by
    name (L1-L3): rows are dealt by ranges of the order, and sorted inside each
    file.  No task holds more than its range.  Add a unique last column where
    ties matter; an order may be any expression, such as a cast of a text id to
    a number.
    """
    seen = Observation(f"rows-{uuid.uuid4().hex}")
    out = df.repartitionByRange(*order).sortWithinPartitions(*order) if order else df
    out = out.observe(seen, F.count(F.lit(1)).alias("rows"))
    spark, jvm = df.sparkSession, df.sparkSession._jvm
    target, draft = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, f"{path.rstrip('/')}.draft-{uuid.uuid4().hex}"))
    out.write.option("header", header).option("sep", sep).csv(draft.toString())
    rows = seen.get["rows"]
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not rows and not allow_empty:
        fs.delete(draft, True)
        raise RuntimeError(f"{path}: empty result")
    fs.delete(target, True)
    if not fs.rename(draft, target):
        raise RuntimeError(f"{path}: cannot be written")
    return rows


def read_ordered_csv(spark: SparkSession, path: str, schema: T.StructType, *, sep: str = ",",
                     position: str = "position") -> DataFrame:
    """Rows of the files of ``write_csv`` with their ``position`` (from 1) in the order of file names and lines.

    Lines are numbered inside each piece of a file that a task reads; what is
    added up in one task is one row for each piece, never the lines.
    """
    names = [f.name for f in schema.fields]
    rows = (spark.read.schema(schema).option("sep", sep).option("header", True).option("nullValue", "\u0000").option("emptyValue", "").csv(path)
            .select(*names, F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"),
                    F.monotonically_increasing_id().alias("_line")))
    piece = ["_file", "_start"]
    before = (rows.groupBy(*piece).agg(F.min("_line").alias("_first"), F.count(F.lit(1)).alias("_n"))
              .withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy(*piece).rowsBetween(Window.unboundedPreceding, -1)),
                                                F.lit(0))))
    return rows.join(before, piece).select((F.col("_before") + F.col("_line") - F.col("_first") + 1).alias(position), *names)


def write_partitions(df: DataFrame, path: str, partition_cols: list[str], *, fmt: str = "parquet",
                     sep: str = "\t", header: bool = True, order: list[str] | None = None) -> None:
    """Partitioned write with dynamic partition overwrite (S15, S17, S18):
    only the partitions present in ``df`` (e.g. today's report date) are
    replaced, so a rerun of one day is idempotent and history stays.

    The rows of a partition value are brought together first, so it gets one
    file, or a few if it is large: the rebalance splits partitions above the
    advisory size and joins small ones, however many tasks made the rows.  With
    ``order`` the rows are dealt by ranges of (partition columns, order), and
    the files of a partition, by name, hold them in that order (L2).
    """
    if order:
        by = [*partition_cols, *order]
        df = df.repartitionByRange(*by).sortWithinPartitions(*by)
    else:
        df = df.hint("rebalance", *partition_cols)
    w = (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_cols))
    if fmt == "csv":
        w.option("sep", sep).option("header", header).csv(path)
    else:
        w.parquet(path)


def require_nonempty(df: DataFrame, what: str) -> DataFrame:
    """Fail a run whose result must not be empty (S16); reads one row.  A written
    report has ``write_csv(allow_empty=False)``, which does not compute it twice."""
    if df.isEmpty():
        raise RuntimeError(f"{what}: empty result")
    return df


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, *, mode: str = "overwrite",
                   path: str | None = None) -> None:
    """Save ``df`` as a table bucketed and sorted by ``key`` (at ``path`` when
    given, else in the warehouse), one file for each bucket.

    Two tables bucketed the same way on the join key (the SoR snapshot and
    the last-seen state on ``patron_id``) join without shuffling either side:
    the reconcile joins read matching buckets directly.
    """
    w = df.repartition(buckets, key).write.mode(mode).format("parquet").bucketBy(buckets, key).sortBy(key)
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)
