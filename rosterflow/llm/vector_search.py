"""Exact top-k search by inner product with a pivot-distance index.

The inner product becomes a distance: every vector gets one more component that
fills its norm up to the greatest norm, every query a zero; then the nearest
vector is the one of greatest inner product.  The index keys each vector by its
nearest pivot and its distance to it.  By the triangle inequality a vector
cannot be nearer to a query than the difference of their distances to a pivot,
so a search goes through the annuli around the pivot outwards from the query's
own distance and stops where this bound passes the k-th best result so far.

The vectors of a pivot lie in chunks of bounded size, sorted by distance, and
the queries in blocks; a chunk and a block meet in an equi join on the chunk's
key.  Equal vectors stand in the index once, with their smallest ids.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rosterflow.llm.common import bound_batches, staged, with_fields

PIVOTS = 16
SAMPLE = 2000  # vectors (by a hash of the id) that the pivots are chosen from
CHUNK = 1024  # vectors of a chunk, about
BLOCK = 128  # queries of a block, about
ANNULUS = 128  # vectors that are scored at a time
JOINED_ROWS = 64  # of a chunk and a block, in a worker at a time
EXACT = 2.0**52  # products below are exact in float64
SLACK = 1e-6  # for rounding in the distances


def quantised(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, v): floor(scale * x) of each component.

    Vectors that are null, or have a null or non-finite component, take no
    part, nor do rows without vec_id.  Of rows that repeat a vec_id the one with
    the smallest vector counts.
    """
    good = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (vectors.where("vec_id IS NOT NULL AND embedding IS NOT NULL").where(good)
            .select("vec_id", F.transform("embedding", lambda x: F.floor(x.cast("double") * scale)).alias("v"))
            .groupBy("vec_id").agg(F.min("v").alias("v")))


def matrix(arrays, dim: int) -> np.ndarray:
    """Rows of the given width from arrays; shorter ones are filled with zeros."""
    out = np.zeros((len(arrays), dim), np.int64)
    for i, a in enumerate(arrays):
        out[i, :len(a)] = a
    return out


@dataclass
class Pivots:
    dim: int
    top: float  # greatest squared norm
    points: np.ndarray  # with the additional component

    def lifted(self, x: np.ndarray) -> np.ndarray:
        x = x.astype(np.float64)
        rest = np.sqrt(np.maximum(self.top - (x * x).sum(axis=1), 0))
        return np.concatenate([x, rest[:, None]], axis=1)

    def distances(self, x: np.ndarray) -> np.ndarray:
        """Distance of each row of ``x`` (with the additional component) to each pivot."""
        return np.stack([np.sqrt(((x - p) ** 2).sum(axis=1)) for p in self.points], axis=1)

    @classmethod
    def choose(cls, x: np.ndarray, top: float, n: int = PIVOTS) -> Pivots:
        """Each pivot is the sampled vector farthest from those before."""
        self = cls(x.shape[1], top, np.zeros((0, x.shape[1] + 1)))
        points = self.lifted(x)
        far, chosen = np.full(len(x), np.inf), [0]
        while len(chosen) < min(n, len(x)):
            far = np.minimum(far, np.sqrt(((points - points[chosen[-1]]) ** 2).sum(axis=1)))
            if far.max() == 0:
                break
            chosen.append(int(far.argmax()))
        self.points = points[chosen]
        return self


def _keyed(rows: DataFrame, pivots: Pivots) -> DataFrame:
    """Add the nearest pivot and the distance to it."""
    shared = rows.sparkSession.sparkContext.broadcast(pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value
        for batch in batches:
            if batch.num_rows:
                d = p.distances(p.lifted(matrix(batch.column("v").to_pylist(), p.dim)))
                near = d.argmin(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(near.astype(np.int32)), pa.array(d[np.arange(len(near)), near])],
                    [*batch.schema.names, "pivot", "distance"])

    return rows.mapInArrow(run, with_fields(rows, "pivot int, distance double"))


def _packs(keyed: DataFrame, size: int, dim: int) -> tuple[DataFrame, list[tuple[int, int]]]:
    """Rows (pivot, chunk, ids, vectors, distances) of about ``size`` vectors, sorted by distance.

    Also (pivot, number of chunks): at most one entry for each pivot.
    """
    counts = [(r.pivot, max(1, math.ceil(r.n / size))) for r in keyed.groupBy("pivot").agg(F.count("*").alias("n")).collect()]
    chunks = F.create_map(*[F.lit(x) for c in counts for x in c])
    dealt = keyed.withColumn("chunk", F.pmod(F.xxhash64(F.element_at("ids", 1)), F.element_at(chunks, F.col("pivot"))).cast("int"))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("distance", kind="stable")
        return pd.DataFrame({"pivot": pdf["pivot"].iloc[:1], "chunk": pdf["chunk"].iloc[:1], "ids": [[list(x) for x in pdf["ids"]]],
                             "vectors": [matrix(list(pdf["v"]), dim).tobytes()],
                             "distances": [pdf["distance"].to_numpy(np.float64).tobytes()]})

    packed = dealt.groupBy("pivot", "chunk").applyInPandas(
        pack, "pivot int, chunk int, ids array<array<bigint>>, vectors binary, distances binary")
    return packed, counts


class Best:
    """The ``k`` best vectors of each query so far: score, then smallest id."""

    def __init__(self, n: int, k: int):
        self.score = np.full((n, k), -np.inf)
        self.at = np.full((n, k), -1)

    def add(self, rows: np.ndarray, score: np.ndarray, at: np.ndarray, smallest: np.ndarray) -> None:
        k = self.score.shape[1]
        score = np.concatenate([self.score[rows], score], axis=1)
        at = np.concatenate([self.at[rows], np.broadcast_to(at, (len(rows), len(at)))], axis=1)
        order = np.lexsort((np.where(at >= 0, smallest[at], np.iinfo(np.int64).max), -score), axis=1)[:, :k]
        self.score[rows] = np.take_along_axis(score, order, 1)
        self.at[rows] = np.take_along_axis(at, order, 1)


def search_chunk(p: Pivots, pivot: int, queries: np.ndarray, bound: np.ndarray, vectors: np.ndarray, distances: np.ndarray,
                 smallest: np.ndarray, k: int) -> Best:
    """Best ``k`` vectors of a chunk for each query whose score may reach ``bound``."""
    best = Best(len(queries), k)
    if p.top < EXACT:
        queries, vectors = queries.astype(np.float64), vectors.astype(np.float64)
    norm = (queries.astype(np.float64) ** 2).sum(axis=1)
    lifted = np.concatenate([queries.astype(np.float64), np.zeros((len(queries), 1))], axis=1)
    dq = np.sqrt(((lifted - p.points[pivot]) ** 2).sum(axis=1))
    starts = np.arange(0, len(distances), ANNULUS)
    lo, hi = distances[starts], distances[np.minimum(starts + ANNULUS, len(distances)) - 1]
    least = np.maximum(0, np.maximum(dq[:, None] - hi, lo - dq[:, None]))  # by query and annulus
    for a in np.argsort(least.sum(axis=0), kind="stable"):
        reach = np.maximum(bound, best.score[:, -1])  # the score to reach: as a distance sqrt(norm + top - 2 score)
        limit = np.sqrt(np.maximum(norm + p.top - 2 * np.where(np.isfinite(reach), reach, 0), 0))
        live = np.flatnonzero(~np.isfinite(reach) | (least[:, a] <= limit * (1 + SLACK) + SLACK))
        if len(live):
            s = slice(starts[a], starts[a] + ANNULUS)
            best.add(live, queries[live] @ vectors[s].T, np.arange(len(distances))[s], smallest)
    return best


def top_k(vectors: DataFrame, k: int = 5, query_step: int = 50, scale: int = 256) -> DataFrame:
    """The ``k`` vectors of greatest integer inner product for every query.

    ``vectors`` has (vec_id, embedding); see ``quantised`` for what takes part.
    Queries are the vectors whose id is divisible by ``query_step``; candidates
    are all vectors but the query's own.  Returns query_id, rank (from 1),
    vec_id and score; ties go to the smaller vec_id.  With fewer candidates than
    ``k`` all are returned.  A vector that is shorter than others counts as
    filled up with zeros.  Scores have to fit into a long; above 2**52 they are
    computed in integers.  Other columns are not read.
    """
    spark = vectors.sparkSession
    bound_batches(spark, JOINED_ROWS)
    base = staged(quantised(vectors, scale), "vectors")
    first = Window.partitionBy("v").orderBy("vec_id")
    distinct = staged(base.withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1)
                      .groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "distinct")
    whole = distinct.agg(F.max(F.size("v")).alias("dim"),
                         F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)).alias("top")).first()
    if whole.dim is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    dim = max(1, whole.dim)
    sample = distinct.orderBy(F.xxhash64(F.element_at("ids", 1)), F.element_at("ids", 1)).limit(SAMPLE).select("v").collect()
    pivots = Pivots.choose(matrix([r.v for r in sample], dim), whole.top)
    shared = spark.sparkContext.broadcast(pivots)

    chunks, n_chunks = _packs(_keyed(distinct, pivots), CHUNK, dim)
    chunks = staged(chunks, "chunks")
    queries = base.where(F.col("vec_id") % query_step == 0).select("v", F.array("vec_id").alias("ids"))
    blocks, _ = _packs(_keyed(queries, pivots), BLOCK, dim)
    blocks = staged(blocks.select(F.monotonically_increasing_id().alias("block"), F.col("pivot").alias("home"),
                                  F.transform("ids", lambda x: x[0]).alias("query_ids"), F.col("vectors").alias("q")), "blocks")
    keep = k + 1  # a query's own vector may be among the best

    def searched(final: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            p = shared.value
            for batch in batches:
                for r in batch.to_pylist():
                    q = np.frombuffer(r["q"], np.int64).reshape(-1, p.dim)
                    v = np.frombuffer(r["vectors"], np.int64).reshape(-1, p.dim)
                    smallest = np.array([x[0] for x in r["ids"]], np.int64)
                    bound = np.frombuffer(r["bound"], np.float64) if final else np.full(len(q), -np.inf)
                    best = search_chunk(p, r["pivot"], q, bound, v, np.frombuffer(r["distances"], np.float64), smallest, keep)
                    if not final:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([r["block"]], pa.int64()), pa.array([best.score[:, -1].tobytes()], pa.binary())], ["block", "bound"])
                        continue
                    row, col = np.nonzero((best.at >= 0) & (best.score >= bound[:, None]))
                    if len(row):
                        at = best.at[row, col]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([r["query_ids"][i] for i in row], pa.int64()), pa.array([r["ids"][i] for i in at], pa.list_(pa.int64())),
                             pa.array([int(q[i] @ v[j]) for i, j in zip(row, at)], pa.int64())], ["query_id", "ids", "score"])
        return run

    # A first chunk of the query's own pivot gives a score that the result reaches at least.
    home = blocks.join(chunks.where("chunk = 0"), F.col("home") == F.col("pivot"))
    bounds = home.select("block", "q", "pivot", "ids", "vectors", "distances").mapInArrow(searched(False), "block bigint, bound binary")
    asked = (blocks.join(staged(bounds, "bounds"), "block", "left")
             .withColumn("bound", F.coalesce("bound", F.unhex(F.repeat(F.lit("000000000000F0FF"), F.size("query_ids")))))
             .withColumn("c", F.explode(F.array(*[F.struct(F.lit(p).alias("pivot"), F.lit(n).alias("n")) for p, n in n_chunks])))
             .select("block", "query_ids", "q", "bound", "c.pivot", F.explode(F.sequence(F.lit(0), F.col("c.n") - 1)).alias("chunk")))
    found = (asked.join(chunks, ["pivot", "chunk"])
             .select("query_ids", "q", "bound", "pivot", "ids", "vectors", "distances")
             .mapInArrow(searched(True), "query_id bigint, ids array<bigint>, score bigint"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.select("query_id", F.explode("ids").alias("vec_id"), "score").where("vec_id <> query_id")
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
