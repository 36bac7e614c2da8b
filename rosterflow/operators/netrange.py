"""IP range maintenance lists (K31: J20 match, J21 new ranges).

Matching never compares every range with every target.  Values and targets are
posted under keys and met in one equi join:

* exact targets: the text itself;
* CIDR targets: the block size (at most 33 of them) and the number of the block;
* regex targets: a gram of a literal that the pattern requires, of the sizes that
  the list has.  Patterns are tried on the values that hold their gram only;
  one without any literal is posted under the empty gram, which every value has.

Both inputs are read once (the targets once more for the sizes of their keys).
Per range, the first target in list order wins (``min_by``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterflow.functions.net import cidr_bounds, ip_to_long
from rosterflow.functions.patterns import required_literals

REGEX_CHARS = r"[\^$*\[\]()\\|]"
GRAM_SIZES = (8, 4, 2, 1, 0)  # a literal is posted under its first characters, as many as it has of these
EXACT, BLOCK, GRAM = "=", "/", "~"  # kinds of keys


def range_values(ranges: DataFrame, fields=("start_ip", "end_ip")) -> DataFrame:
    """Long form (range_id, field, value, ip) of the address fields of each range."""
    long = ranges.unpivot(["range_id"], list(fields), "field", "value")
    v = F.trim("value")
    return long.select("range_id", "field", v.alias("value"), ip_to_long(v).alias("ip")) \
               .filter(F.col("value") != "")


def _key(kind: str, size, text) -> Column:
    return F.struct(F.lit(kind).alias("kind"), F.lit(size).cast("bigint").alias("size"), text.alias("key"))


def _target_keys(target: Column) -> Column:
    """The keys of a target: itself, its CIDR block, and a gram for each alternative of a pattern."""
    lo, hi = cidr_bounds(target)
    block = F.when(lo.isNotNull(), F.array(_key(BLOCK, hi - lo + 1, F.floor(lo / (hi - lo + 1)).cast("string"))))
    size = lambda s: F.coalesce(*[F.when(F.length(s) >= n, F.lit(n)) for n in GRAM_SIZES])
    grams = F.when(target.rlike(REGEX_CHARS),
                   F.transform(required_literals(target), lambda s: _key(GRAM, size(s), F.substring(s, F.lit(1), size(s)))))
    return F.array_distinct(F.flatten(F.array_compact(F.array(F.array(_key(EXACT, 0, target)), block, grams))))


def _value_keys(value: Column, ip: Column, blocks: Column, grams: Column) -> Column:
    """The keys that a value can share with a target, for the sizes that the targets have."""
    in_block = F.when(ip.isNotNull(), F.transform(blocks, lambda n: _key(BLOCK, n, F.floor(ip / n).cast("string"))))
    at = lambda n: F.sequence(F.lit(1), F.when(n == 0, 1).otherwise(F.length(value) - n + 1))
    held = F.flatten(F.transform(F.filter(grams, lambda n: n <= F.length(value)), lambda n: F.transform(
        at(n), lambda i: _key(GRAM, n, F.substring(value, i, n)))))
    return F.array_distinct(F.flatten(F.array_compact(F.array(F.array(_key(EXACT, 0, value)), in_block, held))))


def ip_match(ranges: DataFrame, targets: DataFrame) -> DataFrame:
    """First matching target (by ``target_order``) of every range (J20), for lists of any length.

    The join on a key of many ranges is an ordinary equi join, which AQE
    splits; the planner broadcasts the target side while it is small.
    """
    t = targets.where(F.col("target").isNotNull()).select("target_order", "target", F.explode(_target_keys(F.col("target"))).alias("k"))
    of = lambda kind: F.collect_set(F.when(F.col("k.kind") == kind, F.col("k.size")))
    sizes = t.agg(F.struct(of(BLOCK).alias("blocks"), of(GRAM).alias("grams"))).scalar()
    vals = (range_values(ranges).select("range_id", "value", "ip", sizes.alias("sizes"))
            .select("range_id", "value", F.explode(_value_keys(F.col("value"), F.col("ip"), F.col("sizes.blocks"), F.col("sizes.grams")))
                    .alias("k")))
    found = vals.join(t, "k").where((F.col("k.kind") != GRAM) | F.expr("value rlike target"))
    return found.groupBy("range_id").agg(F.min_by("target", "target_order").alias("target"))


def parse_range(text) -> tuple:
    """'a - b' | 'a b' | 'a-b' | 'a,b' | 'a' -> (start, end), first delimiter found wins."""
    s = F.col(text) if isinstance(text, str) else text
    out = None
    for delim, pat in ((" - ", " - "), (" ", " "), ("-", "-"), (",", ",")):
        parts = F.split(s, pat)
        pair = F.struct(F.trim(F.try_element_at(parts, F.lit(1))).alias("a"),
                        F.trim(F.try_element_at(parts, F.lit(2))).alias("b"))
        cond = s.contains(delim)
        out = F.when(cond, pair) if out is None else out.when(cond, pair)
    single = F.struct(F.trim(s).alias("a"), F.trim(s).alias("b"))
    pair = out.otherwise(single)
    return pair.getField("a"), pair.getField("b")


def ip_new_ranges(candidates: DataFrame, existing: DataFrame, *, range_col: str = "ip_range",
                  branch_col: str = "branch") -> DataFrame:
    """Candidate ranges to add (J21): parsed, rows without start or branch
    dropped, and (start, end) pairs already present removed (anti join)."""
    a, b = parse_range(range_col)
    c = (candidates.filter(F.col(range_col).isNotNull() & (F.trim(range_col) != ""))
         .select(a.alias("start_ip"), b.alias("end_ip"), F.trim(branch_col).alias("branch"))
         .filter((F.col("start_ip") != "") & F.col("branch").isNotNull() & (F.col("branch") != "")))
    have = existing.select("start_ip", "end_ip").distinct()
    return c.join(have, ["start_ip", "end_ip"], "left_anti")
