"""Registry of the named queries exposed through ``__spark_entry__``.

Each entry couples a Spark builder (``Views -> DataFrame``) with the DuckDB
SQL that computes the same table independently.  Builders only call library
jobs; the SQL is written from the job's specification, not generated.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterflow.plans.oracle_views import with_views
from rosterflow.sources.tables import Views


@dataclass(frozen=True)
class Query:
    key: str
    build: Callable[[Views], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def register(key: str, sql: str | None = None):
    def deco(fn: Callable[[Views], DataFrame]):
        if key in REGISTRY:
            raise ValueError(f"duplicate query key {key}")
        REGISTRY[key] = Query(key, fn, sql)
        return fn
    return deco


def to_edge(df: DataFrame) -> DataFrame:
    """Render dates, timestamps and decimals as ISO / plain text at the edge."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("string")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _load_all() -> None:
    # Importing the modules registers their queries.
    from rosterflow.plans import (  # noqa: F401
        q_circulation, q_roster, q_reconcile, q_notes, q_usage, q_eligibility,
        q_media, q_netrange, q_sinks, q_sources, q_streams, q_text, q_actions,
    )


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()

    def make(q: Query):
        return lambda spark, sf_dir: to_edge(q.build(Views(spark, sf_dir)))

    return {k: make(q) for k, q in REGISTRY.items()}


def oracle_queries() -> dict[str, str]:
    _load_all()
    return {k: with_views(q.sql) for k, q in REGISTRY.items() if q.sql}
