"""URL filter: host-suffix and path-prefix rules by hash join.

Every URL is expanded into the expressions (host suffix, path prefix) under
which a rule could stand.  The expressions meet the rules in an equi join on
the first 32 bits of their SHA-256; the whole digest is compared afterwards and
the longest rule wins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEP = " "  # between host and path in a digest; a host holds none after parsing rules


def url_parts(url):
    """(host, path) columns: host up to ``/ ? #`` with A-Z lowered, path up to ``? #``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), path


def _digest(host, path):
    return F.sha2(F.concat(host, F.lit(SEP), path), 256)


def url_verdicts(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """Judge every row of ``pages(page_id, url)`` by ``rules(host, path, verdict)``.

    A rule fits its host and every subdomain if the path of the URL starts with
    the rule's path.  The rule with most characters wins; among equals the
    longer host, then ``block``.  Without a rule the verdict is ``default``.

    Null URLs and URLs without ``://`` have an empty host and path; a URL
    without path has an empty path, which no rule path but the empty one
    begins.  Repeated rows each get a row.  Rules with a null field are ignored
    and repeated rules count once.  Other columns of either table are not read.

    The label counts of the rules' hosts and the lengths of their paths (numbers,
    one entry for each distinct value) are collected; they bound the expansion
    of a long URL.
    """
    r = (rules.select(F.lower("host").alias("r_host"), F.col("path").alias("r_path"),
                      F.col("verdict").alias("r_verdict"))
         .where("r_host IS NOT NULL AND r_path IS NOT NULL AND r_verdict IS NOT NULL").distinct())
    bounds = r.agg(F.collect_set(F.size(F.split("r_host", r"\."))).alias("labels"),
                   F.collect_set(F.length("r_path")).alias("lengths")).first()
    labels = F.array(*[F.lit(x) for x in sorted(bounds.labels)]).cast("array<int>")
    lengths = F.array(*[F.lit(x) for x in sorted(bounds.lengths)]).cast("array<int>")

    host, path = url_parts(F.col("url"))
    judged = pages.select("page_id", host.alias("host"), path.alias("path"))

    parts = F.split("host", r"\.")
    suffixes = F.transform(F.filter(labels, lambda n: n <= F.size(parts)),
                           lambda n: F.array_join(F.slice(parts, F.size(parts) - n + 1, n), "."))
    prefixes = F.transform(F.filter(lengths, lambda n: n <= F.length("path")),
                           lambda n: F.substring("path", 1, n))
    expressions = (judged.select("host", "path").distinct()
                   .select("host", "path", F.explode(suffixes).alias("suffix"), prefixes.alias("prefixes"))
                   .select("host", "path", "suffix", F.explode("prefixes").alias("prefix"))
                   .withColumn("digest", _digest(F.col("suffix"), F.col("prefix")))
                   .select("host", "path", "digest", F.substring("digest", 1, 8).alias("short")))
    rules_by_hash = (r.withColumn("r_digest", _digest(F.col("r_host"), F.col("r_path")))
                     .withColumn("r_short", F.substring("r_digest", 1, 8)))
    best = (expressions.join(rules_by_hash, F.col("short") == F.col("r_short"))
            .where(F.col("digest") == F.col("r_digest"))
            .groupBy("host", "path")
            .agg(F.max(F.struct((F.length("r_host") + F.length("r_path")).alias("n"),
                                F.length("r_host").alias("h"),
                                (F.col("r_verdict") == "block").alias("b"),
                                F.concat("r_host", "r_path").alias("rule"),
                                F.col("r_verdict").alias("verdict"))).alias("best")))
    return (judged.join(best, ["host", "path"], "left")
            .select("page_id", "host", "path", F.col("best.rule").alias("rule"),
                    F.coalesce("best.verdict", F.lit(default)).alias("verdict")))
