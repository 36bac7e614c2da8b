"""Order-dependent operators that stay balanced when one key is hot.

A window ``PARTITION BY key ORDER BY ts`` sends every row of a key to one
task; if one item or patron holds a third of the rows, that task does a
third of the work.  The operators here avoid it:

* ``previous_row`` (lag): rows are sorted within time buckets of a key, and a
  bucket that a burst fills is cut further, at quantiles of (time, tie-break);
  the first row of each piece takes its predecessor from a summary of one row
  per piece.
* ``joined_lists`` (ordered lists): the pieces of a key are sorted and joined on
  their own, then the texts of the pieces.
* ``first_per_key`` (keep-best): two aggregations with map-side partial
  combine (``min`` of a struct per value, ``max_by`` per key), never a
  per-key sort and no self-join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


# A bucket with more rows than HOT_ROWS, as a SAMPLE-th of them tells, is cut into PIECES.
HOT_ROWS = 200_000
SAMPLE = 32
PIECES = 256


def pieces(df: DataFrame, keys: list[str], ts: str, tiebreak: str, *, bucket_seconds: int = 60,
           hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add ``_bucket`` (of time) and ``_piece``: numbers that rise with (``ts``, ``tiebreak``) within a key.

    The place of a row in its bucket is the microsecond plus a fraction, which
    rises with the tie-break (a whole number); so events of one instant have
    places too.  Where a bucket is hot, quantiles of the places cut it.  The
    quantiles come from rows chosen by a hash; they decide how even the pieces
    are, and nothing else.
    """
    micros = F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', CAST({ts} AS TIMESTAMP_NTZ))")
    width = bucket_seconds * 1_000_000
    ends = df.agg(F.struct(F.min(tiebreak).cast("double").alias("lo"), F.max(tiebreak).cast("double").alias("hi"))).scalar()
    b = df.withColumn("_us", micros).withColumn("_bucket", F.floor(F.col("_us") / width).cast("bigint"))
    share = (F.col(tiebreak).cast("double") - F.col("_ends.lo")) / (F.col("_ends.hi") - F.col("_ends.lo") + 1)
    b = b.withColumn("_ends", ends).withColumn("_place", F.coalesce(F.pmod("_us", F.lit(width)) + share, F.lit(-1.0))).drop("_us", "_ends")
    part = [*keys, "_bucket"]
    levels = F.array(*[F.lit(i / PIECES) for i in range(1, PIECES)])
    chosen = b.where(F.pmod(F.xxhash64(tiebreak), F.lit(SAMPLE)) == 0).select(*part, "_place")
    names = [F.col(c).alias(f"_k{i}") for i, c in enumerate(part)]
    same = [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(part)]
    # Counted first: mostly no bucket is hot, and there is nothing to cut.
    hot = chosen.groupBy(*part).count().where(F.col("count") * SAMPLE > hot_rows).select(*names)
    cuts = (chosen.join(hot, same, "left_semi").groupBy(*part).agg(F.percentile_approx("_place", levels, 1000).alias("_cuts"))
            .select(*names, "_cuts"))
    piece = F.coalesce(F.size(F.filter("_cuts", lambda c: c <= F.col("_place"))), F.lit(0))
    return b.join(cuts, same, "left").select(*df.columns, "_bucket", F.when(F.col("_cuts").isNull(), 0).otherwise(piece).alias("_piece"))


def previous_row(df: DataFrame, keys: list[str], ts: str, tiebreak: str, values: list[str], *,
                 bucket_seconds: int = 60, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add ``prev_<v>`` = value of the preceding row of the same key in
    (``ts``, ``tiebreak``) order -- ``lag`` -- without sorting a hot key in
    one task.

    Every key is split into the ``pieces``; each is sorted on its own.  The last
    row of every piece (a ``max`` of a struct, combined map-side) forms a summary
    with one row per key and piece, on which a second window finds the closest
    earlier piece.  One plan for all sizes; building it starts no job.
    """
    b = pieces(df, keys, ts, tiebreak, bucket_seconds=bucket_seconds, hot_rows=hot_rows)
    part = [*keys, "_bucket", "_piece"]
    w = Window.partitionBy(*part).orderBy(ts, tiebreak)
    local = b.select("*", *[F.lag(v).over(w).alias(f"prev_{v}") for v in values],
                     (F.row_number().over(w) == 1).alias("_first"))
    summary = b.groupBy(*part).agg(F.max(F.struct(F.col(ts).alias("_o1"), F.col(tiebreak).alias("_o2"),
                                                  *[F.col(v).alias(f"v_{v}") for v in values])).alias("_last"))
    carry = summary.select(*part, F.lag("_last").over(Window.partitionBy(*keys).orderBy("_bucket", "_piece")).alias("_carry"))
    j = local.join(carry, part, "left")
    return j.select(*df.columns, *[F.when(F.col("_first"), F.col(f"_carry.v_{v}")).otherwise(F.col(f"prev_{v}"))
                                   .alias(f"prev_{v}") for v in values])


def first_per_key(df: DataFrame, key: str, best: str, *, descending: bool = True) -> DataFrame:
    """One row per ``key``: the greatest (or least) ``best`` value, NULLs
    last; ties are resolved by the whole row ascending.

    Two aggregations and no join: per (key, best) the least row (partial
    combine splits a hot key over its distinct ``best`` values), then per
    key the row of the best value (one row per distinct value remains).
    The input is read once.
    """
    rest = [c for c in df.columns if c not in (key, best)]
    per_value = df.groupBy(key, best).agg(F.min(F.struct(*[F.col(c) for c in rest])).alias("_row"))
    b = F.col(best)
    if descending:
        chosen = F.max_by(F.struct(b.alias(best), F.col("_row")), F.struct(b.isNotNull(), b))
    else:
        chosen = F.min_by(F.struct(b.alias(best), F.col("_row")), F.struct(b.isNull(), b))
    out = per_value.groupBy(key).agg(chosen.alias("_pick"))
    return out.select(key, F.col(f"_pick.{best}").alias(best), *[F.col(f"_pick._row.{c}").alias(c) for c in rest]) \
              .select(*df.columns)


def joined_lists(df: DataFrame, key: str, parts: list[str], order: list[str], value: str, name: str, *,
                 descending: bool = False) -> DataFrame:
    """Per ``key``, the texts of ``value`` in ``order``, joined by commas.

    ``parts`` are columns that rise with the order, such as those of ``pieces``:
    the values of one part are sorted and joined on their own, and what meets
    per key is one text for each part, in the order of the parts.
    """
    row = F.struct(*order, F.col(value).cast("string").alias("_value"))
    segment = F.array_join(F.transform(F.sort_array(F.collect_list(row), not descending), lambda x: x["_value"]), ",")
    segments = df.groupBy(key, *parts).agg(segment.alias("_text"))
    whole = F.sort_array(F.collect_list(F.struct(*parts, "_text")), not descending)
    return segments.groupBy(key).agg(F.array_join(F.transform(whole, lambda x: x["_text"]), ",").alias(name))
