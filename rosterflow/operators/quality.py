"""Data-quality checks (C22-C24, A10) as DataFrames of findings.

Each check returns its findings rather than raising, so a run can both
persist them and abort with ``reconcile.raise_if_any``.  All are single
aggregates or filters (one pass, map-side partial aggregation).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EMAIL = r"^[^@]+@[^@]+\.[^@]+$"


def must_be_blank(df: DataFrame, cols: list[str]) -> DataFrame:
    """Per column, the number of rows with a non-blank value."""
    counts = df.agg(*[F.count_if(~F.col(c).rlike(r"^\s*$")).alias(c) for c in cols])
    return counts.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("non_blank")) for c in cols])).alias("x")) \
        .select("x.column_name", "x.non_blank")


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys occurring more than once (A10), with their count."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def id_or_email_violations(df: DataFrame, col: str, *, id_pattern: str) -> DataFrame:
    """Rows whose ``col`` is neither an e-mail address nor an id."""
    c = F.col(col)
    return df.filter(~c.rlike(EMAIL) & ~c.rlike(id_pattern))


def freshness(df: DataFrame, ts_col: str, *, run_ts: str, max_age_seconds: int = 86400) -> DataFrame:
    """Latest timestamp of an input, its age at ``run_ts`` and a stale flag."""
    latest = df.agg(F.max(ts_col).alias("latest"))
    age = F.floor(F.expr(f"timestampdiff(MICROSECOND, latest, TIMESTAMP_NTZ '{run_ts}')") / 1_000_000)
    return latest.select("latest", age.cast("bigint").alias("age_seconds"),
                         (age > max_age_seconds).alias("stale"))
