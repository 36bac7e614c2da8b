"""Spelling variants of a vocabulary by search schemes over FM-indexes in both directions.

Two words are near if one code point is inserted, deleted or replaced.  Cut a
word in two: a near word holds one half exactly and the error in the other.  So
there are two searches, each of which matches one half exactly and extends
across the other with one error:

* the first half, from the word's start to the right;
* the second half, from the word's end to the left.

A shard's vocabulary is indexed with a delimiter after each word, once as it is
and once mirrored, so that either search is a backward search (an interval of
suffix ranks that each step narrows).  Both searches start at a delimiter, so
an interval is followed in one of the two directions only.

The vocabulary is dealt into shards twice, by ranges of the words and by ranges
of the mirrored words; a word is asked of the shards whose range can hold the
half that it matches exactly, mostly one.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterflow.llm.common import bound_batches, slices, staged

DAMAGE_MOD = 199  # an occurrence loses a letter if this divides its hash
MIN_POINTS, MIN_COUNT = 6, 5
TIMES = 5  # a form is so many times as frequent as its variant
SHARD_WORDS = 20_000  # of a shard, about
QUERY_ROWS = 8192  # words that a shard is asked for at a time

# Code points of words, without A-Z; code 0 is the delimiter.
_ALPHABET = [*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)]
_CODE = np.zeros(0x100, np.int64)
_CODE[_ALPHABET] = np.arange(1, len(_ALPHABET) + 1)
_BITS = 7  # of a code


# --- vocabulary -----------------------------------------------------------


def _runs(raw: bytes) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Starts of the runs of letters (A-Z lowered), the code of each one's word, and the words."""
    b = np.frombuffer(raw.lower(), np.uint8)
    lead = b == 0xC3  # U+00C0 to U+00FF are 0xC3 and one more byte
    letter = ((b >= 0x61) & (b <= 0x7A)) | lead
    letter[1:] |= lead[:-1]
    inside = np.concatenate([[False], letter, [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    first, end = edge[::2], edge[1::2]
    offsets = np.zeros(len(first) + 1, np.int32)
    np.cumsum(end - first, out=offsets[1:])
    found = pa.Array.from_buffers(pa.string(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(b[letter])]).dictionary_encode()
    return first, found.indices.to_numpy(zero_copy_only=False), found.dictionary


def damaged_counts(ids: list, texts: list[bytes], mod: int = DAMAGE_MOD) -> dict[str, int]:
    """Occurrences of each word of the texts, after an occurrence whose hash ``mod`` divides has lost a letter.

    The hash is the crc32 of ``<id>:<word>``.  It is put together from those of
    the two parts: a prefix's crc moves on by the word's length, whatever the
    word is, and the word's own crc is added.  Without an id nothing is lost.
    """
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=starts[1:])
    first, code, found = _runs(b"\n".join(texts))
    words = found.to_pylist()
    if not words:
        return {}
    counts = np.bincount(code, minlength=len(words))
    length = np.array([len(w.encode()) for w in words])
    own = np.array([zlib.crc32(w.encode()) for w in words], np.int64)
    lengths, of_length = np.unique(length, return_inverse=True)
    text_of = np.searchsorted(starts, first, side="right") - 1
    pair, occurrence = np.unique(text_of * len(lengths) + of_length[code], return_inverse=True)
    prefix = [None if i is None else zlib.crc32(f"{i}:".encode()) for i in ids]
    zeros = {n: bytes(n) for n in lengths.tolist()}
    still = {n: zlib.crc32(z) for n, z in zeros.items()}
    moved = np.full(len(pair), -1, np.int64)
    for k, (text, n) in enumerate(zip((pair // len(lengths)).tolist(), lengths[pair % len(lengths)].tolist())):
        if prefix[text] is not None:
            moved[k] = zlib.crc32(zeros[n], prefix[text]) ^ still[n]
    moved = moved[occurrence]
    hashes = moved ^ own[code]
    hit = np.flatnonzero((moved >= 0) & (hashes % mod == 0))
    out = dict(zip(words, counts.tolist()))
    for c, h in zip(code[hit].tolist(), hashes[hit].tolist()):
        word = words[c]
        at = h % len(word)
        out[word] -= 1
        word = word[:at] + word[at + 1:]
        out[word] = out.get(word, 0) + 1
    return out


def vocabulary(docs: DataFrame, min_points: int = MIN_POINTS, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of ``docs(doc_id, text)``: words of at least ``min_points`` code points and ``min_count`` occurrences."""
    bound_batches(docs.sparkSession)
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted() -> pa.RecordBatch:
            rows = [(w, n) for w, n in damaged_counts(ids, texts).items() if n and len(w) >= min_points]
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in rows], t) for i, t in enumerate(schema.types)], schema=schema)

        ids, texts, held = [], [], 0
        for batch in batches:
            for part in slices(batch):
                ids += part.column("doc_id").to_pylist()
                new = [t or b"" for t in part.column("text").cast(pa.binary()).to_pylist()]
                texts, held = texts + new, held + sum(map(len, new))
                if held > 4 << 20:
                    yield counted()
                    ids, texts, held = [], [], 0
        yield counted()

    return (docs.select("doc_id", "text").mapInArrow(run, "word string, n bigint")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count))


# --- index ----------------------------------------------------------------


def _padded(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the words, one behind the other, and where each starts (and the end)."""
    starts = np.zeros(len(words) + 1, np.int64)
    np.cumsum([len(w) for w in words], out=starts[1:])
    return _CODE[np.frombuffer("".join(words).encode("latin-1"), np.uint8)], starts


class FMIndex:
    """Suffix ranks of words that are matched from their start on: the index holds them mirrored.

    Each mirrored word has a delimiter behind it.  ``step`` puts one more code
    before the suffixes of an interval of ranks, so the words are read from
    their first letter to the right.
    """

    def __init__(self, words: list[str]):
        codes, starts = _padded([w[::-1] for w in words])
        n, self.words = len(words), words
        length = np.diff(starts)
        # With delimiters: word i takes the places starts[i] + i to starts[i + 1] + i, the last one being 0.
        text = np.zeros(len(codes) + n, np.int64)
        place = np.arange(len(codes)) + np.repeat(np.arange(n), length)
        text[place] = codes
        ends = starts[1:] + np.arange(n)
        self.size = len(text)
        left = length + 1
        to_end = np.repeat(ends, left) - np.arange(self.size)  # codes up to the delimiter
        order = self._suffixes(text, to_end, int(length.max(initial=0)))
        before = np.zeros(self.size, np.int64)
        before[1:] = text[:-1]  # 0 where a word starts
        self.bwt = before[order]
        by_code = np.argsort(self.bwt, kind="stable")
        self._keys = self.bwt[by_code] * self.size + by_code
        owner = np.repeat(np.arange(n), left)
        self._owner = owner[order[by_code[:n]]]  # whole words by rank
        self._present = np.unique(self.bwt[self.bwt > 0])

    @staticmethod
    def _suffixes(text: np.ndarray, to_end: np.ndarray, longest: int) -> np.ndarray:
        """Places of the suffixes (up to their delimiter) in order; equal ones in the order of the words."""
        per = 8
        packed = np.zeros(len(text), np.int64)
        for i in range(per):
            at = np.minimum(np.arange(len(text)) + i, len(text) - 1)
            packed = (packed << _BITS) | np.where(to_end > i, text[at], 0)
        rank = np.unique(packed, return_inverse=True)[1]
        while per <= longest:
            at = np.minimum(np.arange(len(text)) + per, len(text) - 1)
            rest = np.where(to_end >= per, rank[at] + 1, 0)
            rank = np.unique(rank * (len(text) + 2) + rest, return_inverse=True)[1]
            per *= 2
        return np.argsort(rank, kind="stable")

    def start(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of ``n`` searches: the suffixes that are a delimiter."""
        return np.zeros(n, np.int64), np.full(n, len(self.words), np.int64)

    def step(self, code: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals after one more code, which is not the delimiter."""
        base = code * self.size
        return np.searchsorted(self._keys, base + lo), np.searchsorted(self._keys, base + hi)

    def whole(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which intervals hold a word that ends here, and the word's number (at most one each)."""
        a, b = np.searchsorted(self._keys, lo), np.searchsorted(self._keys, hi)
        has = np.flatnonzero(b > a)
        return has, self._owner[a[has]]

    def next_codes(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of the interval, code) of each code that can follow an interval."""
        wide = hi - lo > len(self._present)
        few = np.flatnonzero(~wide)
        size = (hi - lo)[few]
        row = np.arange(size.sum()) + np.repeat(lo[few] - (np.cumsum(size) - size), size)
        pairs = np.unique(np.repeat(few, size) << _BITS | self.bwt[row])
        pairs = pairs[(pairs & ((1 << _BITS) - 1)) > 0]
        many = np.flatnonzero(wide)
        who, code = np.repeat(many, len(self._present)), np.tile(self._present, len(many))
        a, b = self.step(code, lo[who], hi[who])
        return (np.concatenate([pairs >> _BITS, who[b > a]]),
                np.concatenate([pairs & ((1 << _BITS) - 1), code[b > a]]))


def one_error(index: FMIndex, queries: list[str], half: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, word) pairs: the word holds the first ``half`` letters of the query, and one error behind them.

    A pair may come up more than once.
    """
    codes, starts = _padded(queries)
    length = np.diff(starts)
    queries_out, words_out = [], []

    def finish(q, at, lo, hi):
        """Follow searches that have had their error to the end of the query."""
        while len(q):
            done = at == length[q]
            if done.any():
                has, word = index.whole(lo[done], hi[done])
                queries_out.append(q[done][has])
                words_out.append(word)
            q, at, lo, hi = q[~done], at[~done], lo[~done], hi[~done]
            lo, hi = index.step(codes[starts[q] + at], lo, hi)
            live = hi > lo
            q, at, lo, hi = q[live], at[live] + 1, lo[live], hi[live]

    q = np.arange(len(queries))
    lo, hi = index.start(len(q))
    at = np.zeros(len(q), np.int64)
    while len(q):
        free = np.flatnonzero(at >= half[q])  # the exact half is behind these
        if len(free):
            fq, fat = q[free], at[free]
            kinds, of = np.unique(lo[free] * (index.size + 1) + hi[free], return_inverse=True)
            klo, khi = np.divmod(kinds, index.size + 1)
            who, code = index.next_codes(klo, khi)
            order = np.argsort(who, kind="stable")
            who, code = who[order], code[order]
            elo, ehi = index.step(code, klo[who], khi[who])
            first = np.searchsorted(who, np.arange(len(kinds) + 1))
            number = np.diff(first)[of]
            source = np.repeat(np.arange(len(free)), number)
            ext = np.arange(number.sum()) + np.repeat(first[of] - (np.cumsum(number) - number), number)
            more = fat < length[fq]
            here = np.where(more, codes[np.minimum(starts[fq] + fat, max(len(codes) - 1, 0))], 0)
            finish(fq[source], fat[source], elo[ext], ehi[ext])  # one letter more
            other = more[source] & (code[ext] != here[source])
            finish(fq[source[other]], fat[source[other]] + 1, elo[ext[other]], ehi[ext[other]])  # another letter
            finish(fq[more], fat[more] + 1, lo[free][more], hi[free][more])  # one letter less
        more = at < length[q]
        q, at, lo, hi = q[more], at[more], lo[more], hi[more]
        lo, hi = index.step(codes[starts[q] + at], lo, hi)
        live = hi > lo
        q, at, lo, hi = q[live], at[live] + 1, lo[live], hi[live]
    if not queries_out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(queries_out), np.concatenate(words_out)


# --- search ---------------------------------------------------------------


def _half(length, mirrored: bool):
    """Letters of the half that a search matches exactly; the first half of an odd word is the shorter one."""
    return length - length // 2 if mirrored else length // 2


def _near_in_one_direction(words: DataFrame, mirrored: bool, shard_words: int) -> DataFrame:
    """(word, other, n_other) of the near pairs whose first half (mirrored: second half) is equal."""
    name = F.reverse("word") if mirrored else F.col("word")
    words = words.select(name.alias("word"), "n")
    shards = max(1, -(-words.count() // shard_words))
    dealt = staged(words.repartitionByRange(shards, "word").withColumn("shard", F.spark_partition_id()), "shards")
    # One row for each shard, however many words there are in it.
    bounds = sorted((r.low.encode(), r.high.encode(), r.shard)
                    for r in dealt.groupBy("shard").agg(F.min("word").alias("low"), F.max("word").alias("high")).collect())
    shared = words.sparkSession.sparkContext.broadcast(bounds)
    asked_schema = pa.schema([("word", pa.string()), ("shard", pa.int32())])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges = shared.value
        low, high = [x[0] for x in ranges], [x[1] for x in ranges]
        for batch in batches:
            rows = []
            for word in batch.column(0).to_pylist():
                half = word[:_half(len(word), mirrored)].encode()
                first = bisect.bisect_left(high, half)
                last = bisect.bisect_right(low, half + b"\xff")
                rows += [(word, ranges[i][2]) for i in range(first, last)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int32())],
                                             schema=asked_schema)

    schema = pa.schema([("word", pa.string()), ("other", pa.string()), ("n_other", pa.int64())])

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return schema.empty_table()
        index = FMIndex(left.column("word").to_pylist())
        queries = right.column("word").to_pylist()
        asked, found = [], []
        for i in range(0, len(queries), QUERY_ROWS):
            part = queries[i:i + QUERY_ROWS]
            q, w = one_error(index, part, np.array([_half(len(x), mirrored) for x in part]))
            pair = np.unique(q * len(index.words) + w)
            asked.append(pair // len(index.words) + i)
            found.append(pair % len(index.words))
        asked, found = pa.array(np.concatenate(asked)), pa.array(np.concatenate(found))
        return pa.table([right.column("word").take(asked), left.column("word").take(found), left.column("n").take(found)],
                        schema=schema)

    asked = words.select("word").mapInArrow(ask, "word string, shard int")
    found = dealt.groupBy("shard").cogroup(asked.groupBy("shard")).applyInArrow(search, "word string, other string, n_other bigint")
    if mirrored:
        found = found.select(F.reverse("word").alias("word"), F.reverse("other").alias("other"), "n_other")
    return found


def near_words(words: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(word, other, n_other) of all near pairs of ``words(word, n)``, both ways round, each once.

    ``words`` holds each word once, of letters a-z and U+00C0 to U+00FF.
    """
    found = [staged(_near_in_one_direction(words, mirrored, shard_words), "near") for mirrored in (False, True)]
    return found[0].union(found[1]).distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of ``forms(word, form)``: what is at the end of the forms.

    Every turn joins each word's end with that end's own one, so the paths
    halve.  A form is more frequent than its word, hence there is no circle.
    """
    ends = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        step = ends.select(F.col("word").alias("root"), F.col("root").alias("further"))
        after = staged(ends.join(step, "root", "left").select("word", F.coalesce("further", "root").alias("root"),
                                                              F.col("further").isNotNull().alias("moved")), "roots")
        if after.where("moved").isEmpty():
            return after.select("word", "root")
        ends = after.select("word", "root")


def spelling_variants(docs: DataFrame, times: int = TIMES, shard_words: int = SHARD_WORDS) -> DataFrame:
    """The vocabulary of ``docs(doc_id, text)`` with the form that each word is a variant of.

    Columns ``word``, ``n`` (occurrences), ``n_near`` (words at one inserted,
    deleted or replaced code point), ``form`` (the near word of largest ``n``, the
    smaller word in a tie, if it is at least ``times`` as frequent; else null),
    ``form_n`` and ``root`` (the end of the forms, the word itself if it has none).

    Null and empty texts hold no words, repeated rows count each time, and a row
    without doc_id loses no letters.  Other columns are not read.
    """
    words = staged(vocabulary(docs), "vocabulary")
    near = near_words(words, shard_words).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("n_other")).alias("n"), F.col("other").alias("word"))).alias("best"))
    enough = -F.col("best.n") >= times * F.col("n")
    judged = staged(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(enough, F.col("best.word")).alias("form"),
        F.when(enough, -F.col("best.n")).alias("form_n")), "judged")
    return (judged.join(_roots(judged.where("form IS NOT NULL")), "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
