"""Near-duplicate documents: MinHash signatures in an inverted join.

Documents with equal shingle sets form a class with one signature.  A class is
posted under its (coordinate, value) pairs.  Two classes that are similar
enough share at least ``min_matches`` of the ``coordinates``, so

* a pair that only one class holds is dropped, and a class that is left with
  fewer than ``min_matches`` pairs has no partner (skip);
* the pairs of a class are put in one global order, rarest first; of ``m``
  pairs the first ``m - min_matches + 1`` are enough to meet every partner
  (prefix).

Collisions of the candidates are counted on the whole signatures, and what
passes is confirmed on the whole shingle sets.  Links only have to give the
connected components, so a posting list whose classes are already connected is
skipped, and none is expanded into all its pairs:

1. hubs: each class is tested against a few of the most central classes of its lists;
2. short lists: all pairs of classes of different components;
3. long lists: classes outside the list's largest component against the list,
   in blocks of bounded size, which return one link for each component they meet.
"""

from __future__ import annotations

import hashlib
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterflow.llm.common import bound_batches, one_row_per_id, slices, staged
from rosterflow.llm.shingles import shingle_set, signature

COORDINATES = 64
# A pair of Jaccard similarity 0.8 shares fewer than 34 of 64 coordinates with a probability of about 1e-6.
MIN_MATCHES = 34
HUBS = 3  # hubs that a class is tested against
SHORT_LIST = 32
BLOCK_SHINGLES = 250_000  # of the classes on either side of a block of a long list, about
# A worker's texts of candidate pairs, at two texts a row.
PAIR_ROWS = 256


def _signatures(docs: DataFrame, words: int, coordinates: int) -> DataFrame:
    """(doc_id, n_shingles, set_id, sig) of every row; set_id and sig are null for empty sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                sets = [shingle_set(t, words) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets],
                             pa.binary()),
                    pa.array([signature(s, coordinates).view(np.int32) if len(s) else None for s in sets],
                             pa.list_(pa.int32()))], ["doc_id", "n_shingles", "set_id", "sig"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_shingles bigint, set_id binary, sig array<int>")


def similar(a: int, b: int, both: int, percent: int) -> bool:
    return 100 * both >= percent * (a + b - both)


def _confirmed(pairs: DataFrame, classes: DataFrame, texts: DataFrame, words: int, percent: int,
               min_matches: int) -> DataFrame:
    """The pairs (a, b) whose collisions reach the threshold and whose whole sets are similar."""
    side = {s: classes.select(F.col("id").alias(s), F.col("n").alias(f"n_{s}"), F.col("sig").alias(f"sig_{s}"))
            for s in "ab"}
    matches = F.size(F.filter(F.zip_with("sig_a", "sig_b", lambda x, y: x == y), lambda x: x))
    near = (pairs.join(side["a"], "a").join(side["b"], "b")
            .where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
            .where(matches >= min_matches).select("a", "b"))
    both = (near.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
            .join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
            .select("a", "b", "text_a", "text_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recent: OrderedDict[int, np.ndarray] = OrderedDict()

        def shingles(key: int, text: str) -> np.ndarray:
            if key not in recent:
                recent[key] = shingle_set(text, words)
                if len(recent) > 64:
                    recent.popitem(last=False)
            return recent[key]

        for batch in batches:
            keep = []
            for a, b, x, y in zip(*(c.to_pylist() for c in batch.columns)):
                s, t = shingles(a, x), shingles(b, y)
                common = len(np.intersect1d(s, t, assume_unique=True))
                keep.append(similar(len(s), len(t), common, percent))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    id_type = pairs.schema["a"].dataType.simpleString()
    return both.mapInArrow(run, f"a {id_type}, b {id_type}")


def components(links: DataFrame, name: str = "labels") -> DataFrame:
    """(id, comp): the smallest id reachable from each id of ``links(a, b)``.

    Rounds of two steps until nothing changes: take the smallest label among
    the neighbours, then the label of one's label.
    """
    edges = staged(links.union(links.select("b", "a")).distinct(), f"{name}-edges")
    labels = staged(edges.groupBy(F.col("a").alias("id")).agg(F.least(F.min("a"), F.min("b")).alias("comp")), name)
    while True:
        heard = (edges.join(labels, edges.b == labels.id).groupBy("a").agg(F.min("comp").alias("heard")))
        lower = labels.join(heard, labels.id == heard.a).select(
            "id", F.col("comp").alias("was"), F.least("comp", "heard").alias("low"))
        jump = lower.select(F.col("id").alias("at"), F.col("low").alias("comp"))
        after = staged(lower.join(jump, F.col("low") == F.col("at")).select("id", "was", "comp"), name)
        if after.where("was <> comp").isEmpty():
            return after.select("id", "comp")
        labels = after.select("id", "comp")


def _with_components(postings: DataFrame, comps: DataFrame | None) -> DataFrame:
    if comps is None:
        return postings.withColumn("comp", F.col("id"))
    return postings.join(comps, "id", "left").withColumn("comp", F.coalesce("comp", "id"))


def _open_lists(postings: DataFrame) -> DataFrame:
    """(key, members, shingles) of the lists whose classes are not all connected yet."""
    return (postings.groupBy("key").agg(F.count("*").alias("members"), F.sum("n").alias("shingles"),
                                        F.min("comp").alias("lo"), F.max("comp").alias("hi"))
            .where("lo <> hi").select("key", "members", "shingles"))


def _long_list_links(postings: DataFrame, lists: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Links between the components of each long list, by blocks of its members."""
    members = postings.join(lists, "key")
    largest = (members.groupBy("key", "comp").agg(F.count("*").alias("n"))
               .groupBy("key").agg(F.max(F.struct("n", "comp")).alias("m")).select("key", F.col("m.comp").alias("main")))
    members = members.join(largest, "key").withColumn("blocks", F.ceil(F.col("shingles") / BLOCK_SHINGLES).cast("int"))
    members = members.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    rows = members.where("comp <> main").select("key", "id", "comp", F.col("block").alias("i"), every.alias("j"),
                                                F.lit(True).alias("row"))
    # A block of columns only goes where there are rows.
    asked = rows.select("key", "i").distinct()
    columns = (members.join(asked, "key").select("key", "id", "comp", "i", F.col("block").alias("j"),
                                                 F.lit(False).alias("row")))
    sides = rows.union(columns).join(texts, "id")
    id_type = postings.schema["id"].dataType.simpleString()

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")
        sets = {i: shingle_set(t, words) for i, t in pdf.drop_duplicates("id")[["id", "text"]].itertuples(index=False)}
        left, right = pdf[pdf["row"]], pdf[~pdf["row"]]
        out = []
        if len(left) and len(right):
            cols = [sets[i] for i in right["id"]]
            sizes = np.array([len(s) for s in cols])
            known, flat = np.unique(np.concatenate(cols), return_inverse=True)
            starts = np.cumsum(sizes) - sizes
            comp, ids = right["comp"].to_numpy(), right["id"].to_numpy()
            for i, c in left[["id", "comp"]].itertuples(index=False):
                s = sets[i]
                mark = np.zeros(len(known), np.int64)
                at = np.minimum(np.searchsorted(known, s), len(known) - 1)
                mark[at[known[at] == s]] = 1
                common = np.add.reduceat(mark[flat], starts)
                hit = (100 * common >= percent * (sizes + len(s) - common)) & (comp != c)
                met, first = np.unique(comp[hit], return_index=True)
                out += [(i, x) for x in ids[hit][first]]
        return pd.DataFrame(out, columns=["a", "b"])

    return sides.groupBy("key", "i", "j").applyInPandas(run, f"a {id_type}, b {id_type}").distinct()


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, coordinates: int = COORDINATES,
                    min_matches: int = MIN_MATCHES) -> DataFrame:
    """Components of near-duplicates of ``docs(doc_id, text)``, one row for each doc_id.

    Columns: ``doc_id``, ``n_shingles`` (distinct runs of ``words`` words; a
    shorter text is one shingle), ``component_id`` (smallest doc_id reachable
    over links of at least ``percent`` % Jaccard similarity) and ``kept``
    (``doc_id = component_id``).

    Null, empty and blank texts have no shingles and no links.  Of rows that
    repeat a doc_id the one with the smallest text counts.  Rows without doc_id
    each get a row with a null component and are kept.  Other columns are not
    read.  ``doc_id`` is a whole number.
    """
    spark = docs.sparkSession
    bound_batches(spark, PAIR_ROWS)
    docs = docs.select("doc_id", "text")
    unique = one_row_per_id(docs)
    sigs = staged(_signatures(unique.union(docs.where("doc_id IS NULL")), words, coordinates), "signatures")
    classes = staged(sigs.where("set_id IS NOT NULL AND doc_id IS NOT NULL").groupBy("set_id")
                     .agg(F.min("doc_id").alias("id"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig")), "classes")

    pairs = classes.select("id", F.posexplode("sig").alias("coordinate", "value")).select(
        "id", (F.col("value").cast("long") * coordinates + F.col("coordinate")).alias("key"))
    shared = pairs.groupBy("key").agg(F.count("*").alias("freq")).where("freq > 1")
    active = staged(
        pairs.join(shared, "key").groupBy("id")
        .agg(F.sort_array(F.collect_list(F.struct("freq", "key"))).alias("held"), F.sum("freq").alias("central"))
        .where(F.size("held") >= min_matches)
        .select("id", "central", F.slice("held", 1, F.size("held") - min_matches + 1).alias("prefix"))
        .join(classes.select("id", "n", "sig"), "id"), "active")
    wanted = staged(active.select(F.col("id").alias("doc_id")), "wanted")  # a known size, as in one_row_per_id
    texts = staged(unique.join(wanted, "doc_id", "left_semi")
                   .select(F.col("doc_id").alias("id"), "text"), "texts")
    postings = staged(active.select("id", "central", "n", F.explode("prefix").alias("p")).select("id", "central", "n", "p.key"), "postings")

    def confirm(candidates: DataFrame) -> DataFrame:
        return _confirmed(candidates, active, texts, words, percent, min_matches)

    hubs = (postings.groupBy("key").agg(F.max(F.struct("central", "id")).alias("hub"), F.count("*").alias("members"))
            .where("members > 1").select("key", "hub"))
    tested = staged(
        postings.join(hubs, "key").where(F.col("id") != F.col("hub.id"))
        .groupBy("id").agg(F.slice(F.sort_array(F.collect_set("hub"), asc=False), 1, HUBS).alias("hubs"))
        .select("id", F.explode("hubs.id").alias("hub"))
        .select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")).distinct(), "hub-pairs")
    links = staged(confirm(tested), "links")
    found = postings.drop("central")

    posted = staged(_with_components(found, components(links)), "posted")
    lists = _open_lists(posted)
    short = posted.join(lists.where(F.col("members") <= SHORT_LIST), "key")
    candidates = (short.select("key", F.col("id").alias("a"), F.col("comp").alias("comp_a"))
                  .join(short.select("key", F.col("id").alias("b"), F.col("comp").alias("comp_b")), "key")
                  .where("a < b AND comp_a <> comp_b").select("a", "b").distinct()
                  .join(tested, ["a", "b"], "left_anti"))
    links = staged(links.union(confirm(candidates)), "links")

    comps = components(links)
    posted = staged(_with_components(found, comps), "posted")
    lists = staged(_open_lists(posted).where(F.col("members") > SHORT_LIST), "long-lists")
    if not lists.isEmpty():
        links = links.union(staged(_long_list_links(posted, lists, texts, words, percent), "links"))
        comps = components(links)

    member = classes.select("set_id", F.col("id").alias("class_id"))
    return (sigs.drop("sig").join(member, "set_id", "left")
            .join(comps.select(F.col("id").alias("class_id"), "comp"), "class_id", "left")
            .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("comp", "class_id", "doc_id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def deduplicated(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row of each group of near-duplicates, with its columns (that of the smallest doc_id)."""
    gone = staged(near_duplicates(docs, words, percent).where("NOT kept").select("doc_id"), "gone")
    return one_row_per_id(docs, keep_null=True).join(gone, "doc_id", "left_anti").select(*[f"`{c}`" for c in docs.columns])
