"""Incremental field standardisation with per-field high-water marks.

One scan of the patron table serves all fields: rows edited after the
smallest mark are read once (the predicate reaches the parquet/JDBC scan),
unpivoted to ``(patron_id, field, old)``, filtered per field by its own mark
and "needs work" pattern, and transformed with a per-field ``CASE`` -- no
per-field job, no Python.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterflow.functions import text as tx

KEY = "patron_id"

# Types never standardised (inter-library loan, branch, school
# patrons) and the "already clean" pattern of each field (Oracle POSIX
# patterns restated for Java / RE2: a bracket holding '[' is written '[\[').
EXCLUDED_TYPES = (9, 19, 13, 21, 22, 23, 24, 25, 26, 27, 28, 29, 30, 31, 32, 33, 34, 35, 36, 37, 38, 40, 46, 47, 51)
CLEAN_PATTERNS = {
    "zip": r"^[0-9]{5}$",
    "state": r"^[A-Z]{2}$",
    "city": r"^([A-Z][a-z]+ )*(Ma?c)?[A-Z][a-z]*$",
    "street": (r"^([0-9]+[-A-Z]* )?([A-Z] )?([\[0-9]+[DHNRSTdhnrst]{2} )?([A-Z][a-z]+\.? ?)+"
               r"((, )?((Apt|Lot|No|Unit) )?#?[A-Z]*[- ]?[0-9]*)?$"),
    "first_name": r"^[A-Z][a-z]+$",
    "middle_name": r"(^[A-Z]$|^[A-Z][a-z]+$)",
    "last_name": r"^[A-Z][a-z]+$",
    "suffix": r"^[A-Z][a-z]+$",
}

STANDARDIZERS: dict[str, Callable[[Column], Column]] = {
    "zip": tx.std_zip,
    "state": tx.std_state,
    "city": tx.std_city,
    "street": tx.std_street,
    "first_name": tx.std_name,
    "middle_name": tx.std_name,
    "last_name": lambda c: tx.std_name(c, last_name=True),
    "suffix": tx.std_name,
}


def std_candidates(patron: DataFrame, marks: dict[str, str], *, patterns=CLEAN_PATTERNS,
                   excluded_types=EXCLUDED_TYPES, excluded_prefix: str = "B") -> DataFrame:
    """Long-form ``(patron_id, field, old, edit_date)`` rows needing work.

    Eligible: type not excluded, id not starting with ``excluded_prefix``,
    non-blank value failing the field pattern, edited after the field's mark.
    """
    fields = list(marks)
    base = patron.filter(~F.col("bty").isin(*excluded_types)
                         & ~F.col(KEY).startswith(excluded_prefix)
                         & (F.col("edit_date") > F.lit(min(marks.values())).cast("timestamp")))
    long = base.unpivot([KEY, "edit_date"], fields, "field", "old")
    mark = F.create_map(*[x for f in fields for x in (F.lit(f), F.lit(marks[f]).cast("timestamp"))])[F.col("field")]
    pat_ok = F.lit(False)
    for f in fields:
        pat_ok = F.when(F.col("field") == f, F.col("old").rlike(patterns[f])).otherwise(pat_ok)
    return long.filter((F.col("edit_date") > mark) & F.col("old").isNotNull() & (F.col("old") != "") & ~pat_ok)


def standardize_value(field: Column, old: Column, fields: list[str],
                      registry: dict[str, Callable[[Column], Column]] = STANDARDIZERS) -> Column:
    out = F.lit(None).cast("string")
    for f in fields:
        out = F.when(field == f, registry[f](old)).otherwise(out)
    return out


def std_changes(patron: DataFrame, marks: dict[str, str], *, run_ts: str,
                registry: dict[str, Callable[[Column], Column]] = STANDARDIZERS) -> tuple[DataFrame, DataFrame]:
    """Changed values ``(patron_id, field, old, new)`` and the new marks.

    Only values whose standardised form differs are emitted.  Every field's
    mark advances to ``run_ts``.
    """
    cand = std_candidates(patron, marks)
    new = standardize_value(F.col("field"), F.col("old"), list(marks), registry)
    changes = cand.select(KEY, "field", "old", new.alias("new")).filter(F.col("new") != F.col("old"))
    spark = patron.sparkSession
    new_marks = spark.createDataFrame([(f, run_ts) for f in marks], "field string, mark string")
    return changes, new_marks
