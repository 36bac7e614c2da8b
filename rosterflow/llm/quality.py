"""Quality classifier by compression with two zstandard dictionaries.

One dictionary is built from text labelled good, one from text labelled bad.  A
text is compressed with both, block by block.  The difference of the sizes over
the length of the text, put through a logistic curve fitted on further labelled
documents, is the probability that the text is good.  The length has a constant
added, and the curve knows how much of the sum is text: a text of a few bytes
gets about the share of good texts among such, whatever its sizes are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterflow.llm.common import bound_batches, crc_mod, slices, with_fields

# The classifier is fitted on at most so many labelled documents of either class, half for the
# dictionary and half for the curve, chosen by a hash of the id.
DOCS_PER_CLASS = 2000
PIECES, PIECE = 4, 1024  # samples that a document gives its dictionary, and their characters
DICTIONARY = 112_640  # bytes
BLOCK = 2048  # bytes that are compressed at a time
LEVEL = 3
SMOOTH = 256  # bytes that are added to the length of a text
THRESHOLD = 0.3


@dataclass
class Classifier:
    good: bytes  # dictionaries
    bad: bytes
    weights: tuple[float, float, float] = (0.0, 0.0, 0.0)  # of the difference, the share of text and one


def dictionary(samples: list[bytes], size: int = DICTIONARY) -> bytes:
    """A trained dictionary, or the samples' own bytes if they are too few to train on."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


class Compressor:
    """Normalised difference of the sizes of a text under the two dictionaries, and the share of text."""

    def __init__(self, c: Classifier):
        self.pair = []
        for raw in (c.good, c.bad):
            if raw:
                shared = zstandard.ZstdCompressionDict(raw)
                shared.precompute_compress(level=LEVEL)
                self.pair.append(zstandard.ZstdCompressor(dict_data=shared, write_content_size=False, write_checksum=False,
                                                          write_dict_id=False))
            else:
                self.pair.append(zstandard.ZstdCompressor(level=LEVEL, write_content_size=False))

    def __call__(self, text: str | None) -> tuple[float, float]:
        raw = text.encode() if text else b""
        good, bad = (sum(len(c.compress(raw[i:i + BLOCK])) for i in range(0, len(raw), BLOCK)) for c in self.pair)
        return (bad - good) / (len(raw) + SMOOTH), len(raw) / (len(raw) + SMOOTH)


def _labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, good, text, half) of the documents that the classifier is fitted on."""
    one = (labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("good")))
    order = F.xxhash64("doc_id")
    chosen = None
    for good in (0, 1):
        rows = one.where(F.col("good") == good).orderBy(order, "doc_id").limit(DOCS_PER_CLASS)
        chosen = rows if chosen is None else chosen.union(rows)
    return (docs.where("text IS NOT NULL").select("doc_id", "text").join(chosen, "doc_id")
            .withColumn("half", F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2))))


def _pieces(text, doc_id):
    """Up to ``PIECES`` stretches of a text, at places given by the id."""
    span = F.greatest(F.length(text) - PIECE, F.lit(0)) + 1
    return F.array_distinct(F.array(*[F.substring(text, F.pmod(F.xxhash64(F.lit(i), doc_id), span).cast("int") + 1, F.lit(PIECE))
                                      for i in range(PIECES)]))


def fit(docs: DataFrame, labels: DataFrame) -> Classifier:
    """Classifier of ``docs(doc_id, text)`` and ``labels(doc_id, quality)``, quality 1 good and 0 bad.

    Null labels, ids and texts are left out; a document with both labels counts
    as bad.  With one class only every score is 0.5.
    """
    labelled = _labelled(docs, labels)
    samples: dict[int, list[bytes]] = {0: [], 1: []}
    rows = (labelled.where("half = 0").select("doc_id", "good", _pieces(F.col("text"), F.col("doc_id")).alias("p"))
            .orderBy("doc_id", "p").limit(2 * DOCS_PER_CLASS).collect())
    for r in rows:
        samples[r.good] += [p.encode() for p in r.p if p]
    if not samples[0] or not samples[1]:
        return Classifier(b"", b"")
    found = Classifier(dictionary(samples[1]), dictionary(samples[0]))
    held = (add_difference(labelled.where("half = 1").select("doc_id", "good", "text"), found, "d")
            .select("d.difference", "d.share", "good").limit(2 * DOCS_PER_CLASS).collect())
    y = np.array([r.good for r in held], float)
    if len(set(y)) == 2:
        found.weights = logistic(np.array([[r.difference, r.share, 1.0] for r in held]), y)
    return found


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Weights of greatest likelihood (with a weak pull to zero), by Newton's steps."""
    scale = np.maximum(np.abs(x).max(axis=0), 1e-9)
    a = x / scale
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + 1e-2 * np.eye(len(w)), a.T @ (y - p) - 1e-2 * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return tuple((w / scale).tolist())


def add_difference(docs: DataFrame, classifier: Classifier, out: str) -> DataFrame:
    """Add ``out`` (struct of ``difference`` and ``share``) of every row's text (null and empty: 0 and 0)."""
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(classifier)
    result = pa.struct([("difference", pa.float64()), ("share", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        difference = Compressor(shared.value)
        for batch in batches:
            for part in slices(batch):
                got = [difference(t) for t in part.column("text").to_pylist()]
                column = pa.array([{"difference": a, "share": b} for a, b in got], result)
                yield pa.RecordBatch.from_arrays([*part.columns, column], [*part.schema.names, out])

    return docs.mapInArrow(run, with_fields(docs, f"`{out}` struct<difference: double, share: double>"))


def add_quality(docs: DataFrame, classifier: Classifier, out: str = "quality_score") -> DataFrame:
    """Add ``out``: the probability that the text is good.

    A null or empty text has about the score of very short texts.  Repeated rows each get a score; ``out`` must not be a column.
    """
    slope, of_share, shift = classifier.weights
    z = F.col(f"`{out}`.difference") * slope + F.col(f"`{out}`.share") * of_share + shift
    return add_difference(docs, classifier, out).withColumn(out, 1 / (1 + F.exp(-z)))


def train_labels(labels: DataFrame, folds: int = 5, held: int = 0) -> DataFrame:
    """The labels outside the held fold (crc32 of the decimal doc_id modulo ``folds``)."""
    return labels.where(crc_mod("doc_id", folds) != held)


def quality_scores(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0) -> DataFrame:
    """Score of every row of ``docs(doc_id, text)``, learnt from the labels outside the held fold.

    Columns ``doc_id``, ``held_out`` (in the held fold, or without doc_id),
    ``score`` and ``predicted`` (1 from ``THRESHOLD`` up).
    """
    classifier = fit(docs, train_labels(labels, folds, held))
    return (add_quality(docs.select("doc_id", "text"), classifier, "score")
            .select("doc_id", F.coalesce(crc_mod("doc_id", folds) == held, F.lit(True)).alias("held_out"), "score",
                    (F.col("score") >= THRESHOLD).cast("int").alias("predicted")))
