"""Byte-level BPE encoding and decoding by a segment tree over pair ranks.

Every word keeps a segment tree whose leaves hold (rank, position) of the
adjacent pairs; the root is the leftmost pair of the lowest rank.  A merge
changes three leaves, so it costs three walks to the root.  Words of up to 64
bytes are merged together, one tree in each column of a numpy matrix; longer
ones have a tree of their own.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterflow.llm.common import bound_batches, slices, with_fields

# Fixed value: the pattern that byte-level BPE vocabularies of this kind split text with.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NONE = np.iinfo(np.int64).max
WIDEST = 64  # bytes of a word that is merged in a matrix
CACHED_WORDS = 200_000


def byte_alphabet() -> dict[str, int]:
    """Printable stand-ins of the 256 bytes, as byte-level vocabularies write them."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@dataclass
class Vocabulary:
    """Tables of a tokenizer file; a few MB, whatever the corpus."""

    byte_ids: np.ndarray  # id of each byte
    pair_keys: np.ndarray  # sorted (left << 32 | right)
    pair_ranks: np.ndarray  # rank of each key
    merged: np.ndarray  # id made by the merge of a rank
    token_bytes: list[bytes]  # by id
    added: dict[str, int]  # tokens cut out of the text before the pattern

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        """Read a byte-level BPE file of the tokenizers library (driver only)."""
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, alphabet = spec["model"], byte_alphabet()
        if model["type"] != "BPE" or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["normalizer"]:
            raise ValueError("only byte-level BPE files without normalizer are supported")
        vocab = model["vocab"]
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        token_bytes = [b""] * (max([*vocab.values(), *added.values()]) + 1)
        for token, i in vocab.items():
            token_bytes[i] = bytes(alphabet[c] for c in token)
        for token, i in added.items():
            token_bytes[i] = token.encode()
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        byte_ids = np.zeros(256, dtype=np.int64)
        for c, b in alphabet.items():
            byte_ids[b] = vocab[c]
        return cls(byte_ids, keys[order], order.astype(np.int64),
                   np.array([vocab[a + b] for a, b in pairs], dtype=np.int64), token_bytes, added)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NONE where it has none."""
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], NONE)


def merge_matrix(v: Vocabulary, words: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of ``words`` (2 to ``width`` bytes each; ``width`` a power of two), flat, and their counts."""
    n, shift = len(words), width.bit_length() - 1
    length = np.fromiter(map(len, words), np.int64, n)
    raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(n, width).T
    inside = np.arange(width)[:, None] < length
    tok = np.where(inside, v.byte_ids[raw], -1)
    nxt = np.tile(np.arange(1, width + 1)[:, None], n)
    nxt = np.where(nxt < length, nxt, width)
    prv = np.tile(np.arange(-1, width)[:, None], n)  # the last row takes writes for "no next"
    tree = np.full((2 * width, n), NONE)
    left, col = np.nonzero(inside[1:])
    rank = v.ranks(tok[left, col], tok[left + 1, col])
    tree[width + left, col] = np.where(rank == NONE, NONE, rank << shift | left)
    level = width
    while level > 1:
        tree[level // 2:level] = np.minimum(tree[level:2 * level:2], tree[level + 1:2 * level:2])
        level //= 2
    live = np.arange(n)
    while True:
        root = tree[1, live]
        live, root = live[root < NONE], root[root < NONE]
        if not len(live):
            break
        p, new = root & (width - 1), v.merged[root >> shift]
        q = nxt[p, live]
        r = nxt[q, live]
        before = prv[p, live]
        tok[p, live], tok[q, live], nxt[p, live], prv[r, live] = new, -1, r, p
        tree[width + q, live] = NONE
        has = r < width
        rank = v.ranks(new, np.where(has, tok[np.minimum(r, width - 1), live], -1))
        tree[width + p, live] = np.where(has & (rank < NONE), (rank & (NONE >> shift)) << shift | p, NONE)
        has = before >= 0
        rank = v.ranks(tok[before[has], live[has]], new[has])
        tree[width + before[has], live[has]] = np.where(rank < NONE, (rank & (NONE >> shift)) << shift | before[has], NONE)
        node, cols = np.concatenate([p, q, np.where(has, before, p)]) + width, np.concatenate([live] * 3)
        for _ in range(shift):
            node >>= 1
            tree[node, cols] = np.minimum(tree[2 * node, cols], tree[2 * node + 1, cols])
    kept = (tok >= 0).T
    return tok.T[kept], kept.sum(axis=1)


def merge_long(v: Vocabulary, word: bytes) -> list[int]:
    """Ids of one word of any length: the same tree in plain lists."""
    n = len(word)
    width = 1 << (n - 1).bit_length()
    tok = v.byte_ids[np.frombuffer(word, np.uint8)]
    tree = [NONE] * (2 * width)
    tree[width:width + n - 1] = v.ranks(tok[:-1], tok[1:]).tolist()
    tok = tok.tolist()
    # Ties go left: a parent takes the right child only if that is lower.
    best = [0] * (2 * width)
    best[width:] = range(width)
    for k in range(width - 1, 0, -1):
        c = 2 * k if tree[2 * k] <= tree[2 * k + 1] else 2 * k + 1
        tree[k], best[k] = tree[c], best[c]
    nxt, prv = list(range(1, n + 1)), list(range(-1, n))
    known: dict[tuple[int, int], int] = {}

    def put(i: int) -> None:
        j, rank = nxt[i], NONE
        if tok[i] >= 0 and j < n:
            pair = (tok[i], tok[j])
            if pair not in known:
                known[pair] = int(v.ranks(np.array([pair[0]]), np.array([pair[1]]))[0])
            rank = known[pair]
        k = width + i
        tree[k] = rank
        while k > 1:
            k >>= 1
            c = 2 * k if tree[2 * k] <= tree[2 * k + 1] else 2 * k + 1
            tree[k], best[k] = tree[c], best[c]

    while tree[1] < NONE:
        p = best[1]
        q = nxt[p]
        tok[p], tok[q] = int(v.merged[tree[1]]), -1
        nxt[p] = nxt[q]
        prv[nxt[q]] = p  # one slot past the end takes the last
        put(q)
        put(p)
        if prv[p] >= 0:
            put(prv[p])
    return [t for t in tok if t >= 0]


def encode_words(v: Vocabulary, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of non-empty words, flat in the order of ``words``, and the count of each."""
    length = np.fromiter(map(len, words), np.int64, len(words))
    parts, counts = [], np.zeros(len(words), np.int64)
    one = np.nonzero(length == 1)[0]
    if len(one):
        parts.append((one, v.byte_ids[np.array([words[i][0] for i in one])], np.ones(len(one), np.int64)))
    width = 2
    while width <= WIDEST:
        at = np.nonzero((length > width // 2) & (length <= width) & (length > 1))[0]
        if len(at):
            parts.append((at, *merge_matrix(v, [words[i] for i in at], width)))
        width *= 2
    for i in np.nonzero(length > WIDEST)[0]:
        ids = np.array(merge_long(v, words[i]), np.int64)
        parts.append((np.array([i]), ids, np.array([len(ids)])))
    for at, _, n in parts:
        counts[at] = n
    start = np.cumsum(counts) - counts
    flat = np.empty(counts.sum(), np.int64)
    for at, ids, n in parts:
        flat[ragged(start[at], n)] = ids
    return flat, counts


def ragged(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Indexes start[0], start[0]+1, ... (count[0] of them), then those of 1, and so on."""
    ends = np.cumsum(count)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - count), count)


class Encoder:
    """Encodes texts; keeps the ids of up to ``CACHED_WORDS`` words between calls."""

    def __init__(self, v: Vocabulary):
        self.v = v
        self.split = regex.compile(PATTERN).findall
        self.added = regex.compile("(" + "|".join(
            regex.escape(t) for t in sorted(v.added, key=len, reverse=True)) + ")") if v.added else None
        self.forget()

    def forget(self) -> None:
        self.at: dict[str, int] = {}
        self.flat, self.count = np.empty(0, np.int64), np.empty(0, np.int64)

    def words(self, text: str) -> list[str]:
        if not self.added or not self.added.search(text):
            return self.split(text)
        out: list[str] = []
        for i, part in enumerate(self.added.split(text)):
            out += ["\0" + part] if i % 2 else self.split(part)  # \0: an added token, not a word
        return out

    def learn(self, words: list[str]) -> None:
        plain = [w for w in words if not (w[0] == "\0" and w[1:] in self.v.added)]
        flat, count = encode_words(self.v, [w.encode() for w in plain]) if plain else (np.empty(0, np.int64),) * 2
        special = [w for w in words if w[0] == "\0" and w[1:] in self.v.added]
        ids = np.array([self.v.added[w[1:]] for w in special], np.int64)
        for w in [*plain, *special]:
            self.at[w] = len(self.at)
        self.flat = np.concatenate([self.flat, flat, ids])
        self.count = np.concatenate([self.count, count.astype(np.int64), np.ones(len(special), np.int64)])

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, flat, and the count of each (null: none)."""
        words = [self.words(t) if t else [] for t in texts]
        if len(self.at) > CACHED_WORDS:
            self.forget()
        new = list({w for ws in words for w in ws if w not in self.at})
        if new:
            self.learn(new)
        at = np.fromiter((self.at[w] for ws in words for w in ws), np.int64)
        count = self.count[at]
        start = (np.cumsum(self.count) - self.count)[at]
        ends = np.concatenate([[0], np.cumsum(count)])
        last = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        first = np.concatenate([[0], last[:-1]])
        return self.flat[ragged(start, count)], ends[last] - ends[first]


def encode(df: DataFrame, vocabulary: Vocabulary, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add ``ids`` (array<int>): the token ids of the whole text.

    Added tokens of the vocabulary are cut out first, as its library does; no
    other token is added.  Null and empty texts have an empty array.  All rows
    and columns stay; ``ids`` must not be among them.
    """
    spark = df.sparkSession
    bound_batches(spark)
    shared = spark.sparkContext.broadcast(vocabulary)
    schema = with_fields(df, f"`{ids}` array<int>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for batch in batches:
            for part in slices(batch, text):
                flat, count = encoder(part.column(text).to_pylist())
                offsets = pa.array(np.concatenate([[0], np.cumsum(count)]).astype(np.int32))
                column = pa.ListArray.from_arrays(offsets, pa.array(flat.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*part.columns, column], [*part.schema.names, ids])

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, vocabulary: Vocabulary, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add ``text``: the bytes of the ids as UTF-8, bad sequences replaced.

    Null arrays give an empty text; null and unknown ids are skipped.
    """
    spark = df.sparkSession
    bound_batches(spark)
    shared = spark.sparkContext.broadcast(vocabulary)
    schema = with_fields(df, f"`{text}` string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value.token_bytes
        known = range(len(table))
        for batch in batches:
            out = []
            for row in batch.column(ids):
                flat = row.values
                if flat is not None and flat.null_count:
                    flat = flat.drop_null()
                got = flat.to_numpy().tolist() if flat is not None else []
                try:
                    raw = b"".join([table[i] for i in got]) if not got or min(got) >= 0 else None
                except IndexError:
                    raw = None
                if raw is None:
                    raw = b"".join([table[i] for i in got if i in known])
                out.append(raw.decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], [*batch.schema.names, text])

    return df.mapInArrow(run, schema)


def bpe_round_trip(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Encode and decode ``docs(doc_id, text)``; digests of both, one row for each row.

    Columns ``doc_id``, ``n_tokens``, ``ids_sha256`` (decimal ids joined by
    commas), ``decoded_sha256``.  Null and empty texts: no tokens, digests of
    the empty string.  Repeated rows each get a row; other columns aren't read.
    """
    tokens = decode(encode(docs.select("doc_id", "text"), vocabulary).drop("text"), vocabulary)
    return tokens.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                         F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                         F.sha2("decoded", 256).alias("decoded_sha256"))


def default_vocabulary() -> Vocabulary:
    import public_tokenizers

    return Vocabulary.load(public_tokenizers.path("byte_bpe_50k.json"))
