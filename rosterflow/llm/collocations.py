"""Phrase collocations by relational mining of sorted occurrences (SETM).

The occurrence relation R1 holds the words of a slice of texts in the order of
piece and position.  It is written once.  Each further length k is a
merge-join of R(k-1) with itself at the next position of the same piece, which
in sorted order is the next row; the groups are counted over all slices, and
what is frequent goes back to the slices (a semi join) before the next length
is extended:

    R(k)  = positions whose phrase of k-1 words and that of the next position are frequent
    C(k)  = groups of R(k) with at least ``at_least`` occurrences

A slice is some ``SLICE_BYTES`` of whole texts of one language.  What is
shuffled is one row for each distinct phrase of a slice, so that no phrase, as
frequent as it may be, has more rows than there are slices.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rosterflow.llm.common import SLICE_BYTES, bound_batches, staged

AT_LEAST = 10  # occurrences of a candidate
MAX_WORDS = 3
COVER = 50  # percent of a candidate's occurrences that a longer one has to hold to drop it
FIRST = 2000  # phrases of a language
HELD_BYTES = 4 * SLICE_BYTES  # of texts that a task holds over all languages
NO_LANGUAGE = "und"

_BLANK, _BREAK = 1, 2
_KIND = np.zeros(256, np.int8)
_KIND[[0x20, 0x09]] = _BLANK
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = _BREAK

# A slice has the number of the positions before it in its task, so slice + code names one phrase of one slice.
_TASK_BITS = 40
# In the written relations the row with this code holds the codes of all positions.
_CODES = -1


def occurrences(raw: bytes) -> tuple[np.ndarray, pa.Array]:
    """Codes of the words in order, -1 between pieces, and the words by code."""
    b = np.frombuffer(raw.lower(), np.uint8)
    kind = _KIND[b]
    inside = np.concatenate([[False], kind == 0, [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    first, end = edge[::2], edge[1::2]
    offsets = np.zeros(len(first) + 1, np.int32)
    np.cumsum(end - first, out=offsets[1:])
    words = pa.Array.from_buffers(pa.string(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(b[kind == 0])])
    found = words.dictionary_encode()
    breaks = np.concatenate([[0], np.cumsum(kind == _BREAK)])
    new_piece = np.zeros(len(first), np.int64)
    new_piece[1:] = breaks[first[1:]] > breaks[first[:-1]]
    codes = np.full(len(first) + int(new_piece.sum()), -1, np.int32)
    codes[np.arange(len(first)) + np.cumsum(new_piece)] = found.indices.to_numpy(zero_copy_only=False)
    return codes, found.dictionary


def extended(codes: np.ndarray, code: np.ndarray, ids: np.ndarray):
    """Merge-join of a relation with itself at the next position.

    ``code`` and ``ids`` list the frequent phrases of the relation.  Returns the
    codes of the longer phrases at their positions (-1 elsewhere), and of each
    distinct one the ids of its first and last part and its number.
    """
    size = int(codes.max(initial=-1)) + 1
    names = np.full(size + 1, -1, np.int64)  # the last one is for the positions without a phrase
    names[code] = ids
    name = names[codes]
    at = np.flatnonzero((name[:-1] >= 0) & (name[1:] >= 0))
    kinds, inverse, n = np.unique(codes[at].astype(np.int64) * size + codes[at + 1], return_inverse=True, return_counts=True)
    longer = np.full(len(codes), -1, np.int32)
    longer[at] = inverse
    head, tail = np.divmod(kinds, max(size, 1))
    return longer, names[head], names[tail], n


def _word_relation(docs: DataFrame) -> DataFrame:
    """R1 of every slice: a row with the codes of its positions, and one for each distinct word."""
    schema = pa.schema([("slice", pa.int64()), ("code", pa.int64()), ("lang", pa.string()), ("word", pa.string()),
                        ("n", pa.int64()), ("codes", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        size: dict[str, int] = {}
        name = TaskContext.get().partitionId() << _TASK_BITS

        def out(lang: str) -> pa.RecordBatch:
            nonlocal name
            codes, words = occurrences(b"\n".join(held.pop(lang)))
            del size[lang]
            n = np.bincount(codes[codes >= 0], minlength=len(words))
            rows = len(words) + 1
            batch = pa.RecordBatch.from_arrays([
                pa.array(np.full(rows, name)), pa.array(np.arange(_CODES, len(words))), pa.repeat(pa.scalar(lang), rows),
                pa.concat_arrays([pa.nulls(1, pa.string()), words]), pa.array(np.concatenate([[n.sum()], n])),
                pa.array([codes.tobytes(), *[None] * len(words)], pa.binary())], schema=schema)
            name += max(1, len(codes))
            return batch

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                raw = text.encode()
                if size.get(lang, 0) and size[lang] + len(raw) > SLICE_BYTES:
                    yield out(lang)
                held.setdefault(lang, []).append(raw)
                size[lang] = size.get(lang, 0) + len(raw) + 1
                while sum(size.values()) > HELD_BYTES:
                    yield out(max(size, key=size.get))
        for lang in list(held):
            yield out(lang)

    return docs.select(F.coalesce("lang", F.lit(NO_LANGUAGE)).alias("lang"), "text").where("text <> ''").mapInArrow(
        run, "slice bigint, code bigint, lang string, word string, n bigint, codes binary")


def _frequent(relation: DataFrame, by: list[str], at_least: int, name: str) -> DataFrame:
    """The groups of a relation that are frequent over all slices, in each slice that has them.

    ``f`` is the number of occurrences and ``id`` the first slice and code.
    """
    key = Window.partitionBy(*by)
    return staged(relation.where(F.col("code") != _CODES)
                  .select("slice", "code", *by, F.sum("n").over(key).alias("f"),
                          F.min(F.col("slice") + F.col("code")).over(key).alias("id")).where(F.col("f") >= at_least), name)


def _extended_relation(relation: DataFrame, frequent: DataFrame) -> DataFrame:
    """R(k) from R(k-1) and its frequent groups, slice by slice."""
    schema = pa.schema([("slice", pa.int64()), ("code", pa.int64()), ("head", pa.int64()), ("tail", pa.int64()),
                        ("n", pa.int64()), ("codes", pa.binary())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return schema.empty_table()
        codes = np.frombuffer(left.column("codes")[0].as_py(), np.int32)
        longer, head, tail, n = extended(codes, right.column("code").to_numpy(), right.column("id").to_numpy())
        if not len(n):
            return schema.empty_table()
        first = np.array([_CODES])
        return pa.table([
            pa.array(np.full(len(n) + 1, left.column("slice")[0].as_py())), pa.array(np.arange(_CODES, len(n))),
            pa.array(np.concatenate([first, head])), pa.array(np.concatenate([first, tail])),
            pa.array(np.concatenate([[n.sum()], n])), pa.array([longer.tobytes(), *[None] * len(n)], pa.binary())], schema=schema)

    whole = relation.where(F.col("code") == _CODES).select("slice", "codes")
    return (whole.groupBy("slice").cogroup(frequent.select("slice", "code", "id").groupBy("slice"))
            .applyInArrow(run, "slice bigint, code bigint, head bigint, tail bigint, n bigint, codes binary"))


def _groups(frequent: DataFrame) -> DataFrame:
    """Each frequent group once: the row of its first slice."""
    return frequent.where(F.col("slice") + F.col("code") == F.col("id")).drop("slice", "code")


def frequent_phrases(docs: DataFrame, max_words: int = MAX_WORDS, at_least: int = AT_LEAST) -> tuple[DataFrame, DataFrame]:
    """The frequent phrases of 1 to ``max_words`` words of ``docs(lang, text)``, and the number of words of each language.

    Phrases: ``words`` (their number), ``id``, ``head`` and ``tail`` (ids of the
    first and last words less one; null for single words; an id names one phrase of its length), ``lang``, ``phrase``,
    ``last`` (word), ``f`` (occurrences), ``firsts`` and ``rests`` (occurrences of
    the first k words and of the rest, k from 1).
    """
    bound_batches(docs.sparkSession)
    relation = staged(_word_relation(docs), "words")
    totals = relation.where(F.col("code") == _CODES).groupBy("lang").agg(F.sum("n").alias("n"))
    frequent = _frequent(relation, ["lang", "word"], at_least, "frequent")
    none = F.array().cast("array<bigint>")
    shorter = _groups(frequent).select(
        F.lit(1).alias("words"), "id", F.lit(None).cast("bigint").alias("head"), F.lit(None).cast("bigint").alias("tail"),
        "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "f", none.alias("firsts"), none.alias("rests"))
    every = shorter
    for k in range(2, max_words + 1):
        relation = staged(_extended_relation(relation, frequent), "phrases")
        frequent = _frequent(relation, ["head", "tail"], at_least, "frequent")
        head = shorter.select(F.col("id").alias("head"), "lang", F.col("phrase").alias("begin"), F.col("f").alias("f_head"), "firsts")
        tail = shorter.select(F.col("id").alias("tail"), "last", F.col("f").alias("f_tail"), "rests")
        shorter = staged(_groups(frequent).join(head, "head").join(tail, "tail").select(
            F.lit(k).alias("words"), "id", "head", "tail", "lang", F.concat_ws(" ", "begin", "last").alias("phrase"), "last", "f",
            F.concat("firsts", F.array("f_head")).alias("firsts"), F.concat(F.array("f_tail"), "rests").alias("rests")), "grown")
        every = every.union(shorter)
    return every, totals


def first_of_each(df: DataFrame, key: str, order: list, n: int, name: str) -> DataFrame:
    """The first ``n`` rows of each key, with their number ``name``.

    A hot key is ranked in parts first, and only the first ``n`` rows of each
    part meet in one task; the parts of the second turn are few.
    """
    columns = df.columns
    for parts in (512, 16, 1):
        at = F.pmod(F.xxhash64(*columns), F.lit(parts)) if parts > 1 else F.lit(0)
        ranked = df.select(*columns, at.alias("part"))
        ranked = ranked.withColumn(name, F.row_number().over(Window.partitionBy(key, "part").orderBy(*order)))
        df = ranked.where(F.col(name) <= n)
    return df.select(*columns, name)


def scored(phrases: DataFrame, cover: int = COVER) -> DataFrame:
    """Candidates of two words and more with the score of their weakest cut, without those that a longer one covers.

    The arithmetic is in whole numbers of 38 digits.  A candidate lies inside a
    longer one only if it is the first or last part of one with one word more,
    and that one occurs at least as often as any still longer one.
    """
    inside = (phrases.where("words > 2").select((F.col("words") - 1).alias("words"), "f", F.explode(F.array("head", "tail")).alias("id"))
              .groupBy("words", "id").agg(F.max("f").alias("f_longer")))
    whole = "cast({} as decimal(19, 0))".format
    cuts = F.expr(f"""transform(firsts, (l, i) -> struct(
        (1000000 * ({whole('f')} * {whole('f')})) div ({whole('l')} * {whole('rests[i]')}) as score, i as cut, l as l, rests[i] as r))""")
    return (phrases.where("words > 1").join(inside, ["words", "id"], "left")
            .where(F.col("f_longer").isNull() | (100 * F.col("f_longer") < cover * F.col("f")))
            .withColumn("cut", F.array_min(cuts))
            .select("lang", "phrase", F.col("f").alias("a"), "cut.l", "cut.r", "cut.score"))


def collocations(docs: DataFrame, max_words: int = MAX_WORDS, at_least: int = AT_LEAST, cover: int = COVER,
                 first: int = FIRST) -> DataFrame:
    """The ``first`` strongest phrases of each language of ``docs(lang, text)``.

    Columns ``lang`` (null: ``und``), ``rank`` (from 1; by score and occurrences,
    both falling, then phrase), ``phrase`` (words joined by a blank), ``a``, ``l``,
    ``r`` (occurrences of the phrase and of the two parts of its weakest cut),
    ``n`` (words of the language) and ``score``.  Null and empty texts hold no
    words; repeated rows count each time; other columns are not read.
    """
    phrases, totals = frequent_phrases(docs, max_words, at_least)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    best = first_of_each(scored(phrases, cover), "lang", order, first, "rank")
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
