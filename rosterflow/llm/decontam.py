"""Benchmark decontamination by suffix arrays over shards of the training texts.

A shard is a slice of documents of a few MB.  Its suffix array sorts the word
positions from which a benchmark passage could run (stretches of benchmark
words at least as long as the shortest window) by the words that follow.  Every
benchmark suffix is binary-searched in every shard's array; the matching range
gives the verbatim occurrences and their places.  Shards need nothing of each
other, so there is no shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterflow.llm.common import bound_batches, fresh, slices, with_fields

WINDOW = 10
# Characters of benchmark text that are searched in one pass over the documents.
BLOCK_CHARS = 16_000_000

_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
              for b in range(256))

LEAK = "struct<n_words: bigint, n_hit: bigint, spans: array<int>, items: array<string>>"
MATCH = "array<struct<item: string, doc_word: int, item_word: int, n_words: int>>"


def words_of(text: str | None) -> list[bytes]:
    """Words: A-Z lowered, runs of 0-9, a-z and non-ASCII characters."""
    return text.encode().translate(_FOLD).split() if text else []


@dataclass
class Passages:
    """The suffixes of a block of benchmark items, as long as the window."""

    size: int
    ids: dict[bytes, int] = field(default_factory=dict)  # word -> 1, 2, ...
    items: list[list[tuple[str, int]]] = field(default_factory=list)  # by window: (item, first word)
    lengths: np.ndarray | None = None
    low: np.ndarray | None = None  # search keys of the windows, and the last key that begins with each
    high: np.ndarray | None = None

    @classmethod
    def of(cls, rows: list[tuple[str, str]], size: int) -> Passages:
        self = cls(size)
        windows: dict[tuple[int, ...], int] = {}
        for item, text in rows:
            w = [self.ids.setdefault(x, len(self.ids) + 1) for x in words_of(text)]
            for i in range(max(1, len(w) - size + 1) if w else 0):
                at = windows.setdefault(tuple(w[i:i + size]), len(windows))
                if at == len(self.items):
                    self.items.append([])
                self.items[at].append((item, i))
        self.lengths = np.array([len(k) for k in windows], np.int64)
        low = np.zeros((len(windows), size), np.uint32)
        for k, at in windows.items():
            low[at, :len(k)] = k
        high = np.where(np.arange(size) < self.lengths[:, None], low, np.uint32(0xFFFFFFFF))
        self.low, self.high = sort_keys(low), sort_keys(high)
        return self

    def search(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(word position, window) of every occurrence in a shard; ``ids`` has 0 for other words."""
        if not len(self.items) or not len(ids):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        n = len(ids)
        stops = np.concatenate([np.nonzero(ids == 0)[0], [n]])
        run = stops[np.searchsorted(stops, np.arange(n))] - np.arange(n)
        at = np.nonzero(run >= self.lengths.min())[0]
        padded = np.concatenate([ids, np.zeros(self.size, ids.dtype)])
        rows = np.where(np.arange(self.size) < run[at][:, None], padded[at[:, None] + np.arange(self.size)], 0)
        keys = sort_keys(rows.astype(np.uint32))
        order = np.argsort(keys, kind="stable")
        suffixes, keys = at[order], keys[order]  # the shard's suffix array
        first = np.searchsorted(keys, self.low, "left")
        count = np.searchsorted(keys, self.high, "right") - first
        window = np.repeat(np.arange(len(first)), count)
        ends = np.cumsum(count)
        return suffixes[np.arange(len(window)) + np.repeat(first - (ends - count), count)], window


def sort_keys(rows: np.ndarray) -> np.ndarray:
    """Rows of word ids as byte strings that sort like the rows."""
    return np.ascontiguousarray(rows.astype(">u4")).view(f"S{4 * rows.shape[1]}").ravel()


def shard_ids(texts: list[str | None], ids: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word ids of a shard, a 0 after each document; the first position and the words of each document."""
    get, flat, counts = ids.get, [], []
    for text in texts:
        words = words_of(text)
        counts.append(len(words))
        flat += [get(w, 0) for w in words]
        flat.append(0)
    counts = np.array(counts, np.int64)
    return np.array(flat, np.int64), np.cumsum(counts + 1) - counts - 1, counts


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of half-open spans, sorted."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def blocks(benchmark: DataFrame, chars: int = BLOCK_CHARS) -> Iterator[list[tuple[str, str]]]:
    """The items as (id, text), in blocks of about ``chars`` characters by a hash of the id."""
    rows = (benchmark.where("item_id IS NOT NULL AND text IS NOT NULL")
            .select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text")).distinct())
    n = math.ceil((rows.agg(F.sum(F.length("text"))).first()[0] or 0) / chars)
    for b in range(n):
        yield [(r.item_id, r.text) for r in rows.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == b).collect()]


def add_leaks(docs: DataFrame, benchmark: DataFrame, out: str = "leak", size: int = WINDOW,
              block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Add ``out`` (see ``LEAK``) to every row of ``docs(text, ...)``.

    A benchmark item's windows are its runs of ``size`` words, or the whole item
    if it has fewer.  ``n_hit`` counts the document's words inside any
    occurrence of a window, ``spans`` has the hit stretches (first word, end,
    first word, ...), ``items`` the sorted ids of the items that occur.

    Null and empty documents have no words; null items, null ids and items
    without words are ignored; items that repeat an id add up; repeated
    documents each get a row.  Other columns stay as they are; ``out`` must not
    be one of them.  A benchmark above ``block_chars`` characters is searched
    block by block, so what is sent to the executors is bounded.
    """
    bound_batches(docs.sparkSession)
    found = docs.withColumn(out, F.lit(None).cast(LEAK))
    any_block = False
    for rows in blocks(benchmark, block_chars):
        found, any_block = _pass(found, Passages.of(rows, size), out), True
    return found if any_block else _pass(found, Passages.of([], size), out)


def _pass(df: DataFrame, passages: Passages, out: str) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(passages)
    leak_type = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("spans", pa.list_(pa.int32())),
                           ("items", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value
        for batch in batches:
            for part in slices(batch):
                ids, first, counts = shard_ids(part.column("text").to_pylist(), p.ids)
                at, window = p.search(ids)
                before = part.column(out).to_pylist()
                leaks = [{"n_words": int(n), "n_hit": 0, "spans": [], "items": []} if b is None else b
                         for n, b in zip(counts, before)]
                doc = np.searchsorted(first, at, "right") - 1
                order = np.argsort(doc, kind="stable")
                at, window, doc = at[order], window[order], doc[order]
                hit, begin = np.unique(doc, return_index=True)
                for d, a, b in zip(hit, begin, [*begin[1:], len(doc)]):
                    leak = leaks[d]
                    start = at[a:b] - first[d]
                    held = [*zip(leak["spans"][::2], leak["spans"][1::2])]
                    spans = merged([*held, *zip(start.tolist(), (start + p.lengths[window[a:b]]).tolist())])
                    leak["spans"] = [x for s in spans for x in s]
                    leak["n_hit"] = sum(y - x for x, y in spans)
                    leak["items"] = sorted({*leak["items"], *(i for w in set(window[a:b].tolist()) for i, _ in p.items[w])})
                columns = [pa.array(leaks, leak_type) if n == out else c for n, c in zip(part.schema.names, part.columns)]
                yield pa.RecordBatch.from_arrays(columns, part.schema.names)

    return df.mapInArrow(run, df.schema)


def longest_matches(docs: DataFrame, benchmark: DataFrame, out: str = "matches", size: int = WINDOW,
                    block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The longest verbatim matches of every document with every item, and their places.

    Rows are the documents with a match (once for each block of the benchmark),
    with ``out``: item, first word in the document and in the item, and words,
    of each stretch of at least ``size`` words (or a whole shorter item) that
    can't be extended.  Edge cases are those of ``add_leaks``.
    """
    bound_batches(docs.sparkSession)
    schema = with_fields(docs, f"`{out}` {MATCH}")
    match_type = pa.list_(pa.struct([("item", pa.string()), ("doc_word", pa.int32()), ("item_word", pa.int32()),
                                     ("n_words", pa.int32())]))
    found = None
    for rows in blocks(benchmark, block_chars):
        shared = docs.sparkSession.sparkContext.broadcast(Passages.of(rows, size))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            p = shared.value
            for batch in batches:
                for part in slices(batch):
                    ids, first, _ = shard_ids(part.column("text").to_pylist(), p.ids)
                    at, window = p.search(ids)
                    runs: dict[int, list[list]] = {}
                    ended: dict[tuple, list] = {}  # (document, item, diagonal) -> its last run
                    for a, w in sorted(zip(at.tolist(), window.tolist())):
                        d = int(np.searchsorted(first, a, "right") - 1)
                        a -= int(first[d])
                        n = int(p.lengths[w])
                        for item, i in p.items[w]:
                            last = ended.get((d, item, a - i))
                            if last and last[1] + last[3] - n + 1 == a:
                                last[3] += 1
                            else:
                                ended[d, item, a - i] = last = [item, a, i, n]
                                runs.setdefault(d, []).append(last)
                    if runs:
                        keep = part.take(pa.array(sorted(runs)))
                        got = [[dict(zip(("item", "doc_word", "item_word", "n_words"), m)) for m in sorted(runs[d])]
                               for d in sorted(runs)]
                        yield pa.RecordBatch.from_arrays([*keep.columns, pa.array(got, match_type)], [*part.schema.names, out])

        one = docs.mapInArrow(run, schema)
        found = one if found is None else found.unionByName(one)
    return found if found is not None else docs.withColumn(out, F.lit(None).cast(MATCH)).limit(0)


def decontaminated(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """The documents without any hit word, with their columns."""
    out = fresh(docs, "leak")
    return add_leaks(docs, benchmark, out, size).where(F.col(f"`{out}`.n_hit") == 0).drop(out)


def leak_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document: words, hit words, items that occur (as a digest) and the verdict."""
    leak = add_leaks(docs.select("doc_id", "text"), benchmark)
    return leak.select("doc_id", "leak.n_words", "leak.n_hit", F.size("leak.items").cast("long").alias("n_items"),
                       F.sha2(F.array_join("leak.items", ","), 256).alias("items_sha256"),
                       (F.col("leak.n_hit") > 0).alias("contaminated"))
