"""Language identification: known words first, then ever shorter character n-grams.

A word that the model knows adds its log frequency in each language.  Any other
word falls back to its longest n-grams of which the model knows at least one,
and adds the mean of their log frequencies.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rosterflow.llm.common import bound_batches, crc_mod, slices, staged, with_fields

UND = "und"
LONGEST = 5  # characters of an n-gram, word ends included
# The model is fitted on at most so many documents of a language (by a hash of the id) ...
DOCS_PER_LANG = 2000
# ... and keeps at most so many words, and n-grams of each length, of a language.
WORDS_PER_LANG, GRAMS_PER_LANG = 20_000, 5_000
CACHED_WORDS = 100_000

_WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def grams_of(word: str, n: int) -> list[str]:
    marked = f"<{word}>"
    return [marked[i:i + n] for i in range(len(marked) - n + 1)]


@dataclass
class Model:
    langs: list[str]
    at: list[dict[str, int]]  # row of each word (index 0) and of each n-gram (index n)
    logs: np.ndarray  # log frequency of each row in each language

    @classmethod
    def of(cls, rows: list[tuple[int, str, str, int]], totals: dict[tuple[int, str], tuple[int, int]]) -> Model:
        """``rows``: (kind, language, token, count); ``totals``: tokens and types of each kind and language."""
        langs = sorted({lang for _, lang in totals})
        column = {lang: i for i, lang in enumerate(langs)}
        at: list[dict[str, int]] = [{} for _ in range(LONGEST + 1)]
        kinds: list[int] = []
        for kind, _, token, _ in sorted(rows):
            if token not in at[kind]:
                at[kind][token] = len(kinds)
                kinds.append(kind)
        counts = np.zeros((len(kinds), len(langs)))
        for kind, lang, token, n in rows:
            counts[at[kind][token], column[lang]] = n
        scale = np.zeros((LONGEST + 1, len(langs)))
        for (kind, lang), (tokens, types) in totals.items():
            scale[kind, column[lang]] = math.log(tokens + 0.5 * (types + 1))
        return cls(langs, at, (np.log(counts + 0.5) - scale[kinds]).astype(np.float32) if kinds else counts)


class Identifier:
    """Applies a model; keeps the scores of some unseen words between texts."""

    def __init__(self, model: Model):
        self.m, self.unseen = model, {}

    def backoff(self, word: str) -> np.ndarray:
        if word not in self.unseen:
            if len(self.unseen) >= CACHED_WORDS:
                self.unseen.clear()
            score = np.zeros(len(self.m.langs), np.float32)
            for n in range(LONGEST, 0, -1):
                rows = [self.m.at[n][g] for g in grams_of(word, n) if g in self.m.at[n]]
                if rows:
                    score = self.m.logs[rows].mean(axis=0)
                    break
            self.unseen[word] = score
        return self.unseen[word]

    def __call__(self, text: str | None) -> tuple[str, float]:
        """Language and its posterior probability; ``und`` and 0 without letters or without a model."""
        counts = Counter(words_of(text))
        if not counts or not self.m.langs:
            return UND, 0.0
        get = self.m.at[0].get
        rows = [get(w, -1) for w in counts]
        n = np.fromiter(counts.values(), np.float64, len(counts))
        rows = np.array(rows)
        total = n[rows >= 0] @ self.m.logs[rows[rows >= 0]]
        for w, k, r in zip(counts, n, rows):
            if r < 0:
                total = total + k * self.backoff(w)
        best = int(np.argmax(total))
        return self.m.langs[best], float(1 / np.exp(total - total[best]).sum())


def fit(labelled: DataFrame) -> Model:
    """Model of ``labelled(doc_id, text, lang)``; rows with a null are left out.

    The documents are bounded by ``DOCS_PER_LANG`` for each language, the words
    and n-grams that are collected by ``WORDS_PER_LANG`` and ``GRAMS_PER_LANG``.
    """
    known = labelled.where("doc_id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL")
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = (known.select("doc_id", "lang").distinct().withColumn("n", F.row_number().over(order))
              .where(F.col("n") <= DOCS_PER_LANG).drop("n"))
    sample = known.join(chosen, ["doc_id", "lang"], "left_semi").select("lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                words: dict[str, Counter] = {}
                for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist()):
                    words.setdefault(lang, Counter()).update(words_of(text))
                for lang, seen in words.items():
                    kinds = [seen] + [Counter() for _ in range(LONGEST)]
                    for w, n in seen.items():
                        for k in range(1, LONGEST + 1):
                            for g in grams_of(w, k):
                                kinds[k][g] += n
                    for k, counts in enumerate(kinds):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([k] * len(counts), pa.int32()), pa.array([lang] * len(counts), pa.string()),
                             pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                            ["kind", "lang", "token", "n"])

    counted = staged(sample.mapInArrow(run, "kind int, lang string, token string, n bigint")
                     .groupBy("kind", "lang", "token").agg(F.sum("n").alias("n")), "language-counts")
    totals = {(r.kind, r.lang): (r.n, r.types)
              for r in counted.groupBy("kind", "lang").agg(F.sum("n").alias("n"), F.count("*").alias("types")).collect()}
    top = Window.partitionBy("kind", "lang").orderBy(F.desc("n"), "token")
    kept = (counted.withColumn("rank", F.row_number().over(top))
            .where(F.col("rank") <= max(WORDS_PER_LANG, GRAMS_PER_LANG))
            .where((F.col("kind") == 0) & (F.col("rank") <= WORDS_PER_LANG) | (F.col("rank") <= GRAMS_PER_LANG)))
    return Model.of([(r.kind, r.lang, r.token, r.n) for r in kept.select("kind", "lang", "token", "n").collect()], totals)


def add_language(docs: DataFrame, model: Model, out: str = "language") -> DataFrame:
    """Add ``out`` (struct of ``lang`` and ``score``) to every row of ``docs(text, ...)``.

    Texts that are null, empty or without a letter get ``und`` and 0; so does
    every text if the model knows no language.  Ties go to the language that
    sorts first.  Repeated rows each get a result; ``out`` must not be a column.
    """
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    result = pa.struct([("lang", pa.string()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        identify = Identifier(shared.value)
        for batch in batches:
            for part in slices(batch):
                got = [identify(t) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([{"lang": a, "score": b} for a, b in got], result)], [*part.schema.names, out])

    return docs.mapInArrow(run, with_fields(docs, f"`{out}` struct<lang: string, score: double>"))


def train_fold(docs: DataFrame, folds: int = 3, held: int = 1) -> DataFrame:
    """The labelled documents outside the held fold (crc32 of the decimal doc_id modulo ``folds``)."""
    return docs.where(crc_mod("doc_id", folds) != held).select("doc_id", "text", "lang")


def languages(docs: DataFrame, folds: int = 3, held: int = 1) -> DataFrame:
    """Predicted language of every row of ``docs(doc_id, text, lang)``.

    Columns ``doc_id``, ``held_out`` (in the held fold, or without doc_id),
    ``lang_pred`` and ``score``.  The model learns from the other folds only.
    """
    model = fit(train_fold(docs, folds, held))
    held_out = F.coalesce(crc_mod("doc_id", folds) == held, F.lit(True))
    found = add_language(docs.select("doc_id", "text"), model).drop("text")
    return found.select("doc_id", held_out.alias("held_out"), F.col("language.lang").alias("lang_pred"),
                        F.col("language.score").alias("score"))
