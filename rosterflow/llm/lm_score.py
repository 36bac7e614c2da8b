"""Language-model scores by logistic mixing of context bit predictors.

The text of a document is its words in lower case, a blank after each, and an
end byte.  Every byte is spelt as the bits of a prefix code that the two bytes
before it choose, likely bytes shorter; a bit is predicted in four contexts:

* the two bytes before it in the word (they choose the code, so this is a
  count for each code node),
* the three bytes before it in the word,
* the word so far: as many contexts as the corpus has beginnings of words, up
  to ``DEPTH`` bytes,
* for the first two bytes of a word, the last byte of the word before.

All training documents give the codes, and the counts of zeros and ones of each
context and code node.  The predictions are mixed in the logistic domain; the
weights are chosen by a gate (how well the step before was predicted), start
from the weights that fit the decisions of all training documents best and are
refined by a gradient step after every ``STEP`` bytes of a document.  A
document's score depends on nothing but its text and the counts, so it is the
same however the rows are dealt out.

The first weights fit every decision of every training word, once for each
occurrence; the word so far is then counted without that occurrence, as in a
text that is new.  The decisions are counted by their log odds (in bins of
``BIN``), which is all that a fit needs.  Those of a word's first two bytes are
known by the byte before, as counts over the slices; no others look back
beyond their word.

The contexts of the word so far depend on the word alone.  So documents become
lists of word numbers, slice by slice.  The distinct words of each slice, one
row each, are dealt out once by ranges of their spelling; a range counts its
words and their beginnings (those that go over its border are counted over all
ranges) and answers every slice with the counts and the log odds on the paths of
its words, in one block.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterflow.llm.common import batch_rows, bound_batches, crc_mod, staged

ORDERS = 4
GATE_NATS = (0.2, 0.35, 0.5)  # by decision, of the step before; a gate lies between two of them
GATES = len(GATE_NATS) + 1
STEP = 16  # bytes between two refinements of the weights
DEPTH = 40  # bytes of the longest context
CODES = 512  # prefix codes, at most
CLASSES = 64  # of the bytes that are three back or end the word before
# Texts are scored window by window of so many bytes, many texts together: runs of about RUN_BYTES.
WINDOW, RUN_BYTES = 512, 1 << 18
SLICE_BYTES = 14 << 20  # bytes of text of a slice, about
RANGE_ROWS = 150_000  # words of slices in a range, about
WORD_ROWS = 20_000  # of an Arrow batch of words
SCALE = 127 / 8  # log odds up to 8 are kept in a byte
BIN = 4  # of scaled log odds, when decisions are counted for the first weights
BINS = 2 * (128 // BIN) + 1
FIRST_WEIGHT = 0.3  # of every context, if nothing is learnt
RATE = 0.01
END, BLANK = 10, 32
_END_WORD = b"\n"  # stands for the end in lists of words; no word is a line break
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_DOCS = -1  # in the table of slices, the code of a document's row


# --- words ----------------------------------------------------------------


def tokenised(texts: list[bytes]) -> tuple[list[np.ndarray], pa.Array]:
    """The word numbers of each text, ending with that of the end, and the words by number."""
    raw = b"\n".join(texts).lower() + b"\n"
    b = np.frombuffer(raw, np.uint8)
    gap = np.concatenate([[True], _IS_SPACE[b]])
    edge = np.flatnonzero(gap[1:] != gap[:-1])
    first, end = edge[::2], edge[1::2]
    offsets = np.zeros(len(first) + 1, np.int32)
    np.cumsum(end - first, out=offsets[1:])
    words = pa.Array.from_buffers(pa.string(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(b[~_IS_SPACE[b]])])
    found = words.dictionary_encode()
    codes = found.indices.to_numpy(zero_copy_only=False).astype(np.int32)
    ends = np.cumsum([len(t) + 1 for t in texts])
    last = np.int32(len(found.dictionary))
    cut = np.searchsorted(first, ends)
    out = [np.append(codes[a:b], last) for a, b in zip([0, *cut[:-1]], cut)]
    return out, pa.concat_arrays([found.dictionary.cast(pa.string()), pa.array([_END_WORD.decode()])])


def planes(codes: np.ndarray) -> bytes:
    """Word numbers byte by byte of all of them, which compresses well."""
    return zstandard.compress(codes.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 3)


def from_planes(raw: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(raw), np.uint8).reshape(4, -1).T.copy().view("<u4").ravel().astype(np.int32)


@dataclass
class Letters:
    """The bytes of words, the blank after each (the end has none), one word behind the other."""

    byte: np.ndarray
    place: np.ndarray  # in the word
    back: list[np.ndarray]  # the bytes one, two and three before, a blank before the word
    starts: np.ndarray  # of each word, and the end of all

    @classmethod
    def of(cls, words: pa.Array) -> Letters:
        words = words.cast(pa.binary())
        offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1].astype(np.int64)
        raw = np.frombuffer(words.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
        size = np.diff(offsets)
        ending = np.ones(len(size), np.int64)
        single = np.flatnonzero(size == 1)
        ending[single[raw[(offsets[:-1] - offsets[0])[single]] == END]] = 0
        starts = np.concatenate([[0], np.cumsum(size + ending)])
        byte = np.full(starts[-1], BLANK, np.uint8)
        place = np.arange(starts[-1]) - np.repeat(starts[:-1], size + ending)
        byte[place < np.repeat(size, size + ending)] = raw
        back = []
        for k in (1, 2, 3):
            b = np.full(len(byte), BLANK, np.uint8)
            b[k:] = byte[:-k]
            b[place < k] = BLANK
            back.append(b)
        return cls(byte, place, back, starts)


# --- code -----------------------------------------------------------------


@dataclass
class Code:
    """Prefix codes of the 256 bytes, chosen by the two bytes before."""

    of_pair: np.ndarray  # code of (second last, last) byte
    start: np.ndarray  # by code and byte
    length: np.ndarray
    step: np.ndarray  # 2 * node + bit of all decisions; nodes are numbered over all codes
    byte_class: np.ndarray

    @classmethod
    def fitted(cls, words: pa.Array, counts: np.ndarray) -> Code:
        """The codes of words that occur ``counts`` times."""
        return cls.of_triples(*triples(Letters.of(words), counts))

    @classmethod
    def of_triples(cls, triple: np.ndarray, n: np.ndarray) -> Code:
        """Huffman codes for the most frequent pairs of bytes, and one for all others.

        ``triple``: second last << 16 | last << 8 | byte, which occurs ``n`` times.
        """
        pair, byte, n = triple >> 8, triple & 255, n.astype(float)
        plain = np.bincount(byte, n, 256) + 1e-3
        plain /= plain.sum()
        seen = np.bincount(pair, n, 65536)
        own = np.argsort(-seen, kind="stable")[:CODES - 1]
        own = own[seen[own] >= 16]
        of_pair = np.zeros(65536, np.int64)
        of_pair[own] = 1 + np.arange(len(own))
        both = np.bincount(of_pair[pair] << 8 | byte, n, (len(own) + 1) << 8).reshape(-1, 256)
        byte_class = np.full(256, CLASSES - 1, np.int64)
        byte_class[np.argsort(-plain, kind="stable")[:CLASSES - 1]] = np.arange(CLASSES - 1)
        starts, lengths, steps, at = [], [], [], 0
        for k, row in enumerate(both):
            length, step = huffman(plain if k == 0 else row + 4 * plain)
            starts.append(at + np.cumsum(length) - length)
            lengths.append(length)
            steps.append(step + 512 * k)
            at += len(step)
        return cls(of_pair, np.array(starts), np.array(lengths), np.concatenate(steps).astype(np.int32), byte_class)

    @property
    def nodes(self) -> int:
        return 256 * len(self.start)

    def decisions(self, x: Letters) -> tuple[np.ndarray, np.ndarray]:
        """Decisions of each byte; 2 * node + bit of all decisions."""
        code = self.of_pair[x.back[1].astype(np.int64) << 8 | x.back[0]]
        length = self.length[code, x.byte]
        at = np.repeat(self.start[code, x.byte] - (np.cumsum(length) - length), length)
        at += np.arange(len(at))
        return length, self.step[at]


def triples(x: Letters, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (second last << 16 | last << 8 | byte) of words that occur ``counts`` times, and the occurrences."""
    used = np.flatnonzero(np.bincount(x.byte, minlength=256) + (np.arange(256) == BLANK))
    rank = np.zeros(256, np.int64)
    rank[used] = np.arange(k := len(used))
    n = np.bincount((rank[x.back[1]] * k + rank[x.back[0]]) * k + rank[x.byte], np.repeat(counts, np.diff(x.starts)), k ** 3)
    some = np.flatnonzero(n)
    return used[some // (k * k)] << 16 | used[some // k % k] << 8 | used[some % k], n[some].astype(np.int64)


def huffman(weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bits of each symbol, and 2 * node + bit on the paths from the root (node 0), symbol by symbol."""
    n = len(weights)
    heap = [(float(w), i) for i, w in enumerate(weights)]
    heapq.heapify(heap)
    parent, side = np.zeros(2 * n - 1, np.int64), np.zeros(2 * n - 1, np.int64)
    for new in range(n, 2 * n - 1):
        (a, left), (b, right) = heapq.heappop(heap), heapq.heappop(heap)
        parent[left] = parent[right] = new
        side[right] = 1
        heapq.heappush(heap, (a + b, new))
    at, levels = np.arange(n), []
    while True:
        going = at != 2 * n - 2
        if not going.any():
            break
        levels.append(np.where(going, (2 * n - 2 - parent[at]) * 2 + side[at], -1))
        at = np.where(going, parent[at], at)
    path = np.array(levels[::-1]).T
    return (path >= 0).sum(axis=1), path[path >= 0]


def odds_of(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log odds of a one, scaled to a byte."""
    return np.rint(np.clip(np.log((ones + 0.4) / (zeros + 0.4)), -8, 8) * SCALE).astype(np.int8)


def node_odds(slots: np.ndarray, n: np.ndarray, nodes: int) -> np.ndarray:
    """Log odds of all nodes from the counts of some slots (2 * node + bit); a node without counts has 0."""
    out = np.zeros(nodes, np.int8)
    seen, which = np.unique(slots >> 1, return_inverse=True)
    both = np.bincount(2 * which + (slots & 1), n, 2 * len(seen))
    out[seen] = odds_of(both[::2], both[1::2])
    return out


# --- contexts -------------------------------------------------------------


def node_counts(code: Code, x: Letters, n: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """(slots, zeros and ones) of the contexts of two (slot: node) and three bytes (class and node) of words that occur ``n`` times."""
    length, step = code.decisions(x)
    weight = np.repeat(np.repeat(n, np.diff(x.starts)), length)
    out = {}
    for order, slot in ((2, step), (3, np.repeat(code.byte_class[x.back[2]] * (2 * code.nodes), length) + step)):
        both = np.bincount(slot, weight)
        some = np.flatnonzero(both)
        out[order] = some, both[some].astype(np.int64)
    return out


class Beginnings:
    """The contexts of the word so far of the words of a range, which are distinct and in order."""

    def __init__(self, code: Code, words: pa.Array):
        self.code, self.words, self.x = code, words, Letters.of(words)
        x = self.x
        size = np.diff(x.starts)
        # Context number of each byte, level by level: a new one where the beginning differs from that of the word before.
        self.context = np.full(len(x.byte), -1, np.int64)
        self.count = 0
        alive, parent = np.arange(len(size)), np.zeros(len(size), np.int64)
        for level in range(DEPTH + 1):
            alive = alive[size[alive] > level]
            if not len(alive):
                break
            own = parent[alive]
            new = own[1:] != own[:-1]
            if level:
                byte = x.byte[x.starts[alive] + level - 1]
                new |= byte[1:] != byte[:-1]
            number = np.concatenate([[0], np.cumsum(new)]) + self.count
            self.context[x.starts[alive] + level] = parent[alive] = number
            self.count = int(number[-1]) + 1

        inside = self.context >= 0
        self.keys, self._edge = np.unique(self.context[inside] << 8 | x.byte[inside], return_inverse=True)
        self._inside, self._size = inside, size

    def edges(self, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(context << 8 | byte) in order, and the occurrences."""
        return self.keys, np.bincount(self._edge, np.repeat(n, self._size)[self._inside], len(self.keys)).astype(np.int64)

    def of(self, numbers) -> dict[int, bytes]:
        """The contexts of some words, by number: their beginnings."""
        out = {}
        for i in numbers:
            raw = self.words[i].as_py().encode()
            for level, number in enumerate(self.context[self.x.starts[i]:self.x.starts[i + 1]].tolist()):
                if number >= 0:
                    out[number] = raw[:level]
        return out

    def border(self) -> dict[int, bytes]:
        """The contexts that other ranges may have too: those of the first and the last word."""
        return self.of({0, len(self.words) - 1} if len(self.words) else ())

    def odds(self, n: np.ndarray, elsewhere: dict[int, dict[int, int]], asked: np.ndarray | None = None,
             but_one: bool = False) -> pa.Array:
        """Log odds of the word so far at every decision of the ``asked`` words (all), as bytes; no context: 0.

        ``elsewhere``: occurrences of the bytes after a context in other ranges.
        ``but_one``: for each word, of the counts without one of its occurrences.
        """
        keys, count = self.edges(n)
        words = np.arange(len(self.words)) if asked is None else np.flatnonzero(asked)
        letter = np.repeat(self.x.starts[words] - (np.cumsum(self._size[words]) - self._size[words]), self._size[words])
        letter += np.arange(len(letter))
        wanted = np.zeros(self.count, bool)
        wanted[self.context[letter][self.context[letter] >= 0]] = True
        more = [(c << 8 | b, k) for c, bytes_ in elsewhere.items() if wanted[c] for b, k in bytes_.items() if k]
        own = wanted[keys >> 8]
        every = np.concatenate([keys[own], np.array([k for k, _ in more], np.int64)])
        counts = np.concatenate([count[own], np.array([k for _, k in more], np.int64)])
        # The code of a context: that of the bytes before its place in any of its words.
        code_of = np.zeros(self.count, np.int64)
        pair = self.x.back[1].astype(np.int64) << 8 | self.x.back[0]
        code_of[self.context[self._inside]] = self.code.of_pair[pair[self._inside]]
        code, byte = code_of[every >> 8], every & 255
        length = self.code.length[code, byte]
        at = np.repeat(self.code.start[code, byte] - (np.cumsum(length) - length), length)
        at += np.arange(len(at))
        slot = np.repeat((every >> 8) << 9, length)
        slot |= self.code.step[at] & 511
        nodes, which = np.unique(slot >> 1, return_inverse=True)
        both = np.bincount(2 * which + (slot & 1), np.repeat(counts, length), 2 * len(nodes))
        # Of each decision of an edge; the words take those of their edges.
        if but_one:
            bit = slot & 1
            edge_odds = odds_of(np.maximum(both[2 * which] - 1 + bit, 0), np.maximum(both[2 * which + 1] - bit, 0))
        else:
            edge_odds = odds_of(both[::2], both[1::2])[which]
        edge_start = np.zeros(len(keys), np.int64)
        edge_start[own] = (np.cumsum(length) - length)[:int(own.sum())]
        edge_of = np.full(len(self.context), -1, np.int64)
        edge_of[self._inside] = self._edge
        code = self.code.of_pair[pair[letter]]
        size = self.code.length[code, self.x.byte[letter]]
        edge = edge_of[letter]
        begin = np.cumsum(size) - size
        at = np.repeat(np.where(edge >= 0, edge_start[edge] - begin, -1), size)
        out = np.zeros(len(at), np.int8)
        some = np.repeat(edge >= 0, size)
        out[some] = edge_odds[(at + np.arange(len(at)))[some]]
        ends = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(self._size[words])])].astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(words), [None, pa.py_buffer(ends), pa.py_buffer(out)])


# --- mixing ---------------------------------------------------------------


@dataclass
class Tables:
    """Log odds of the contexts that all tasks hold: by node, by class and node (three back), by class and node (word before)."""

    two: np.ndarray
    three: np.ndarray
    before: np.ndarray


class Mixer:
    """Scores lists of word numbers with weights that are refined within each text."""

    def __init__(self, code: Code, tables: Tables, words: pa.Array, word_odds: np.ndarray, weights: np.ndarray):
        """``words``: by number; ``word_odds``: of the words so far at all their decisions."""
        self.weights = weights.astype(np.float32)
        # The odds of a decision stand together, towards the bit that comes.
        odds = np.zeros((len(word_odds), ORDERS), np.int8)
        # The word before matters for the first two bytes of a word; other decisions have slot 0, which holds 0.
        self.slot = np.zeros(len(word_odds), np.int32)
        number, steps = np.zeros(2 * code.nodes, np.int32), [np.zeros(0, np.int64)]
        self.size, self.bytes, self.last_class = (np.zeros(len(words), np.int64) for _ in range(3))
        at = known = 0
        for lo in range(0, len(words), 20_000):
            x = Letters.of(words.slice(lo, 20_000))
            length, step = code.decisions(x)
            node, sign, here = step >> 1, (2 * (step & 1) - 1).astype(np.int8), slice(at, at + len(step))
            at += len(step)
            if at > len(word_odds):
                break
            three = tables.three[np.repeat(code.byte_class[x.back[2]] * code.nodes, length) + node]
            for k, column in enumerate((tables.two[node], three, word_odds[here])):
                np.multiply(column, sign, out=odds[here, k])
            begins = np.repeat(x.place < 2, length)
            fresh = np.unique(step[begins])
            fresh = fresh[number[fresh] == 0]
            number[fresh] = known + 1 + np.arange(len(fresh))
            known += len(fresh)
            steps.append(fresh)
            self.slot[here] = np.where(begins, number[step], 0)
            some = slice(lo, lo + len(x.starts) - 1)
            last = np.maximum(x.starts[1:] - 2, x.starts[:-1])  # a word's last byte: that before its blank
            self.size[some], self.bytes[some] = np.add.reduceat(length, x.starts[:-1]), np.diff(x.starts)
            self.last_class[some] = code.byte_class[x.byte[last]]
        if at != len(word_odds):
            raise ValueError(f"{len(word_odds)} log odds for other decisions")
        self.odds = odds.view(np.uint32).ravel()
        self.width, steps = known + 1, np.concatenate(steps)
        before = np.zeros((CLASSES, self.width), np.int8)
        before[:, 1:] = tables.before.reshape(CLASSES, -1)[:, steps >> 1] * (2 * (steps & 1) - 1)
        self.before = before.ravel()
        self.first = np.cumsum(self.size) - self.size
        self.blank_class = int(code.byte_class[BLANK])

    def losses(self, texts: list[np.ndarray], learn: bool = False) -> np.ndarray:
        """Nats of each text.  ``learn``: the weights go on from text to text and stay."""
        if learn:
            return np.array([self._losses([t], True)[0] for t in texts])
        return self._losses(texts, False)

    def _losses(self, texts: list[np.ndarray], learn: bool) -> np.ndarray:
        out = np.zeros(len(texts))
        if not len(texts):
            return out
        weights = np.repeat(self.weights[None], len(texts), 0) * np.float32(1 / SCALE)
        gate = np.zeros(len(texts), np.int64)
        words = np.concatenate(texts)
        counts = np.array([len(t) for t in texts])
        first = np.cumsum(counts) - counts
        text = np.repeat(np.arange(len(texts), dtype=np.int32), counts)
        previous = np.empty(len(words), np.int32)
        previous[1:] = self.last_class[words[:-1]]
        previous[first] = self.blank_class
        place = np.cumsum(self.bytes[words])
        place -= self.bytes[words]
        place = (place - np.repeat(place[first], counts)).astype(np.int32)
        order = np.argsort(place // WINDOW, kind="stable").astype(np.int32)
        # A run ends with a window, or with a text when it is full.
        window, whose = place[order] // WINDOW, text[order]
        new_window = window[1:] != window[:-1]
        may = np.append(np.flatnonzero((whose[1:] != whose[:-1]) | new_window) + 1, len(words))
        must = np.append(new_window[may[:-1] - 1], True)
        held = np.concatenate([[0], np.cumsum(np.add.reduceat(self.bytes[words[order]], np.concatenate([[0], may[:-1]])))])
        del window, whose, new_window
        a = begun = 0
        for k, b in enumerate(may.tolist()):
            if must[k] or held[k + 2] - held[begun] > RUN_BYTES:
                some = order[a:b]
                self._run(words[some], text[some], place[some] // STEP, previous[some], weights, gate, out)
                a, begun = b, k + 1
        if learn:
            self.weights = weights[0] * np.float32(SCALE)
        return out

    def _run(self, words, text, step, previous, weights, gate, out) -> None:
        """Adds the nats of words to ``out`` by text; ``weights`` (text, gate, order; for odds as they are kept) and ``gate`` go on."""
        # In the order of the steps that the words begin in, then of the texts.
        order = np.argsort(step, kind="stable")
        words, text, step, previous = words[order], text[order], step[order], previous[order]
        size = self.size[words]
        ends = np.cumsum(size)
        index = np.repeat((self.first[words] - (ends - size)).astype(np.int32), size)
        index += np.arange(len(index), dtype=np.int32)
        x = self.odds[index].view(np.int8).reshape(-1, ORDERS).astype(np.float32)
        slot = np.repeat((previous * self.width).astype(np.int32), size)
        slot += self.slot[index]
        x[:, ORDERS - 1] = self.before[slot]
        block = np.flatnonzero(np.concatenate([[True], (step[1:] != step[:-1]) | (text[1:] != text[:-1])]))  # of a text in a step
        begin = np.append((ends - size)[block], len(index))
        of, by_step = text[block], step[block]
        cuts = np.append(np.flatnonzero(np.concatenate([[True], by_step[1:] != by_step[:-1]])), len(block))
        rate, limits, ones = np.float32(RATE / SCALE ** 2), np.array(GATE_NATS), np.ones(ORDERS, np.float32)
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            lo, hi = begin[a], begin[b]
            who, segment = of[a:b], begin[a:b] - lo
            number = begin[a + 1:b + 1] - begin[a:b]
            own, xs = weights[who, gate[who]], x[lo:hi]
            part = np.repeat(own, number, axis=0)
            part *= xs
            total = part @ ones
            np.clip(total, -11, 11, out=total)
            np.exp(np.negative(total, out=total), out=total)
            total += 1  # one over the probability of the bit
            nats = np.add.reduceat(np.log(total), segment)
            part = np.repeat(rate - rate / total, ORDERS).reshape(-1, ORDERS)  # the step that each decision asks for
            part *= xs
            own += np.add.reduceat(part, segment, axis=0)
            weights[who, gate[who]] = own
            out[who] += nats
            gate[who] = np.searchsorted(limits, nats / number)


# --- job ------------------------------------------------------------------


def _sliced(docs: DataFrame) -> DataFrame:
    """Slices of documents: a row for each document (code -1) with its word numbers, and one for each distinct word
    with its occurrences in training documents.  With the first word's row, counts over the training documents of the
    slice: ``before``, of a word's first two bytes after the last byte of the word before (last << 16 | first two), and
    ``triples``, of a byte after two others."""
    fields = [f.name for f in docs.schema if f.name != "text"]
    names = ["slice", "code", "word", "n", "codes", "before", "triples"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, schema = [], 0, None

        def out() -> Iterator[pa.RecordBatch]:
            rows = pa.Table.from_batches(held)
            number = rows.column("row")[0].as_py()  # the first row's number, which no other slice has
            texts = [t or b"" for t in rows.column("text").cast(pa.binary()).to_pylist()]
            lists, words = tokenised(texts)
            train = [not h for h in rows.column("held_out").to_pylist()]
            n = np.zeros(len(words), np.int64)
            x = Letters.of(words)
            two = x.byte[x.starts[:-1]].astype(np.int64) << 8
            longer = np.diff(x.starts) > 1
            two[longer] |= x.byte[x.starts[:-1][longer] + 1]
            twos, two = np.unique(two, return_inverse=True)
            last = x.byte[np.maximum(x.starts[1:] - 2, x.starts[:-1])].astype(np.int64)
            pairs = np.zeros(len(twos) << 8, np.int64)
            learnt = [c for c, t in zip(lists, train) if t]
            for lo in range(0, len(learnt), 512):
                some = learnt[lo:lo + 512]
                codes = np.concatenate(some)
                n += np.bincount(codes, minlength=len(words))
                previous = np.empty(len(codes), np.int64)
                previous[1:] = last[codes[:-1]]
                previous[np.cumsum([0, *map(len, some[:-1])])] = BLANK
                pairs += np.bincount(two[codes] << 8 | previous, minlength=len(pairs))
            some = np.flatnonzero(pairs)
            empty = pa.nulls(rows.num_rows, pa.int64())
            yield from pa.Table.from_arrays(
                [*[rows.column(f) for f in fields], pa.array(np.full(rows.num_rows, number)), pa.array(np.full(rows.num_rows, _DOCS)),
                 pa.nulls(rows.num_rows, pa.string()), empty, pa.array([planes(c) for c in lists], pa.binary()),
                 *[pa.nulls(rows.num_rows, pa.binary())] * 2], [*fields, *names]).to_batches(256)
            k = len(words)
            told = [np.concatenate(c).tobytes() for c in (((some & 255) << 16 | twos[some >> 8], pairs[some]), triples(x, n))]
            yield pa.RecordBatch.from_arrays(
                [*[pa.nulls(k, schema.field(f).type) for f in fields], pa.array(np.full(k, number)), pa.array(np.arange(k)), words,
                 pa.array(n), pa.nulls(k, pa.binary()), *[pa.array([t, *[None] * (k - 1)], pa.binary()) for t in told]], [*fields, *names])

        for batch in batches:
            schema = batch.schema
            for lo in range(0, batch.num_rows, 64):
                part = batch.slice(lo, 64)
                held.append(part)
                size += pc.sum(pc.binary_length(part.column("text"))).as_py() or 0
                if size > SLICE_BYTES:
                    yield from out()
                    held, size = [], 0
        if held:
            yield from out()

    ddl = ", ".join(f"`{f}` {docs.schema[f].dataType.simpleString()}" for f in fields)
    return docs.mapInArrow(run, f"{ddl}, slice bigint, code bigint, word string, n bigint, codes binary, before binary, triples binary")


class Range:
    """The rows (slice, code, word, n) of a range of words, in order of the words."""

    def __init__(self, table: pa.Table):
        word = pa.concat_arrays([c.cast(pa.binary()) for c in table.column("word").chunks])
        fresh = np.ones(len(word), bool)
        if len(word) > 1:
            fresh[1:] = pc.not_equal(word.slice(1), word.slice(0, len(word) - 1)).to_numpy(zero_copy_only=False)
        begin = np.flatnonzero(fresh)
        self.table, self.word_of = table, np.cumsum(fresh) - 1
        self.words = word.take(pa.array(begin)).cast(pa.string())
        self.n = np.add.reduceat(table.column("n").to_numpy(), begin)

    def blocks(self, odds: pa.Array) -> Iterator[tuple[int, bytes]]:
        """What each slice gets: (code, n, word, odds) of its words, packed."""
        slices = self.table.column("slice").to_numpy()
        order = np.argsort(slices, kind="stable")
        cuts = np.flatnonzero(np.diff(slices[order])) + 1
        for rows in np.split(order, cuts):
            which = pa.array(self.word_of[rows])
            yield int(slices[rows[0]]), packed(pa.record_batch([
                pa.array(self.table.column("code").to_numpy()[rows]), pa.array(self.n[self.word_of[rows]]),
                self.words.take(which), odds.take(which)], names=["code", "n", "word", "odds"]))


def packed(batch: pa.RecordBatch) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(batch)
    return out.getvalue().to_pybytes()


def unpacked(blocks: list[bytes]) -> pa.Table:
    """The rows of several blocks in order of the code."""
    table = pa.concat_tables([pa.ipc.open_stream(b).read_all() for b in blocks])
    return table.take(pc.sort_indices(table.column("code")))


def by_range(batches: Iterator[pa.RecordBatch]) -> Iterator[Range]:
    """The ranges that a task reads, one after the other; each is written as one row group, so one task has it whole."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        part = batch.column("part").to_numpy()
        for a, b in zip([0, *(cuts := (np.flatnonzero(np.diff(part)) + 1).tolist())], [*cuts, len(part)]):
            if held and b > a and held[-1].column("part")[0].as_py() != part[a]:
                yield Range(pa.Table.from_batches(held))
                held = []
            if b > a:
                held.append(batch.slice(a, b - a))
    if held:
        yield Range(pa.Table.from_batches(held))


def _counted(dealt: DataFrame, code: Broadcast) -> pa.Table:
    """Counts over all ranges: of the contexts of two and three bytes, of the beginnings at the borders
    of ranges, and of the words (``n``: occurrences, ``distinct``: those that occur)."""
    schema = pa.schema([("kind", pa.int32()), ("begin", pa.binary()), ("slot", pa.int64()), ("n", pa.int64()), ("distinct", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in by_range(batches):
            for order, (slots, counts) in node_counts(code.value, Letters.of(r.words), r.n).items():
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(slots), order, np.int32)), pa.array([b""] * len(slots), pa.binary()),
                                                  pa.array(slots), pa.array(counts), pa.array(np.zeros(len(slots), np.int64))], schema=schema)
            begun = Beginnings(code.value, r.words)
            keys, count = begun.edges(r.n)
            rows = [(1, b"", 0, int(r.n.sum()), int((r.n > 0).sum()))]
            border = begun.border()
            wanted = np.zeros(begun.count, bool)
            wanted[list(border)] = True
            for i in np.flatnonzero(wanted[keys >> 8]).tolist():
                rows.append((0, border[int(keys[i] >> 8)], int(keys[i] & 255), int(count[i]), 0))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in rows], t) for i, t in enumerate(schema.types)], schema=schema)

    return (dealt.mapInArrow(run, "kind int, begin binary, slot bigint, n bigint, distinct bigint")
            .groupBy("kind", "begin", "slot").agg(F.sum("n").alias("n"), F.sum("distinct").alias("distinct")).toArrow())


def _elsewhere(begun: Beginnings, n: np.ndarray, border: dict[bytes, dict[int, int]]) -> dict[int, dict[int, int]]:
    """Occurrences in other ranges of what follows the contexts at the borders of this one."""
    keys, own = begun.edges(n)
    out = {}
    for number, begin in begun.border().items():
        a, b = np.searchsorted(keys, [number << 8, (number + 1) << 8])
        here = dict(zip((keys[a:b] & 255).tolist(), own[a:b].tolist()))
        out[number] = {byte: k - here.get(byte, 0) for byte, k in border.get(begin, {}).items()}
    return out


def _answered(dealt: DataFrame, code: Broadcast, border: Broadcast) -> DataFrame:
    """The blocks (slice, block) of every range.  ``border``: the counts of beginnings that other ranges may have too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in by_range(batches):
            begun = Beginnings(code.value, r.words)
            for number, block in r.blocks(begun.odds(r.n, _elsewhere(begun, r.n, border.value))):
                yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([block], pa.binary())], ["asked_by", "block"])

    return dealt.mapInArrow(run, "asked_by bigint, block binary")


def decision_bins(tables: Tables, begun: Beginnings, n: np.ndarray, elsewhere: dict[int, dict[int, int]]) -> np.ndarray:
    """Decisions after the second byte of words that occur ``n`` times, counted by the binned log odds of their contexts
    towards the bit that comes."""
    code, learnt = begun.code, n > 0
    x = Letters.of(begun.words.filter(pa.array(learnt)))
    length, step = code.decisions(x)
    later = np.repeat(x.place > 1, length)
    node, sign = step[later] >> 1, (2 * (step[later] & 1) - 1).astype(np.int16)
    third = np.repeat(code.byte_class[x.back[2]], length)[later]
    odds = _bytes_of(begun.odds(n, elsewhere, learnt, but_one=True))[later]
    bins = np.zeros(len(node), np.int32)
    for column in (tables.two[node], tables.three[third * code.nodes + node], odds):
        bins *= BINS
        bins += (column * sign + (128 + BIN // 2)) // BIN
    return np.bincount(bins, np.repeat(np.repeat(n[learnt], np.diff(x.starts)), length)[later], BINS ** 3).astype(np.int64)


def _decisions(dealt: DataFrame, code: Broadcast, tables: Broadcast, border: Broadcast) -> pa.Table:
    """The ``decision_bins`` (bin, n) of all ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BINS ** 3, np.int64)
        for r in by_range(batches):
            begun = Beginnings(code.value, r.words)
            total += decision_bins(tables.value, begun, r.n, _elsewhere(begun, r.n, border.value))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bin", "n"])

    return dealt.mapInArrow(run, "bin bigint, n bigint").groupBy("bin").agg(F.sum("n").alias("n")).toArrow()


def first_weights(odds: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The weights under which decisions with these scaled log odds, ``n`` times each, are likeliest (Newton's method); ever so
    little is kept of ``FIRST_WEIGHT``."""
    x, n = odds / SCALE, n.astype(float)

    def nats(w: np.ndarray) -> float:
        return float(n @ np.logaddexp(0, -(x @ w)) + 0.5 * ((w - FIRST_WEIGHT) ** 2).sum())

    w = np.full(ORDERS, FIRST_WEIGHT)
    for _ in range(50):
        p = 1 / (1 + np.exp(x @ w))  # of the other bit
        slope = (w - FIRST_WEIGHT) - x.T @ (n * p)
        move = np.linalg.solve(np.eye(ORDERS) + (x.T * (n * p * (1 - p))) @ x, slope)
        while nats(w - move) > nats(w) and np.abs(move).max() > 1e-9:
            move /= 2
        w = w - move
        if np.abs(move).max() < 1e-6:
            break
    return w


def _start_weights(code: Code, tables: Tables, pairs: np.ndarray, n: np.ndarray, later: pa.Table) -> np.ndarray:
    """The first weights, of every gate the same.  ``pairs``, ``n``: what follows a byte class; ``later``: decisions by bin."""
    bins, times = later.column("bin").to_numpy(), later.column("n").to_numpy()
    odds = [np.column_stack([*(((bins // BINS ** k % BINS) - 128 // BIN) * BIN for k in (2, 1, 0)), np.zeros(len(bins))])]
    counts = [times]
    previous, context, slots, length, both = _first_bytes(code, pairs, n)
    so_far = node_odds(np.repeat(context, length) * (2 * code.nodes) + slots, both, 257 * code.nodes)
    node, sign = slots >> 1, 2 * (slots & 1) - 1
    third = int(code.byte_class[BLANK]) * code.nodes
    columns = (tables.two[node], tables.three[third + node], so_far[np.repeat(context, length) * code.nodes + node],
               tables.before[np.repeat(previous, length) * code.nodes + node])
    odds.append(np.column_stack([c * sign for c in columns]))
    counts.append(both)
    return np.repeat(first_weights(np.concatenate(odds), np.concatenate(counts))[None], GATES, 0)


def _bytes_of(odds: pa.Array) -> np.ndarray:
    """The odds of all words, one after the other."""
    offsets = np.frombuffer(odds.buffers()[1], np.int32)[odds.offset:odds.offset + len(odds) + 1]
    return np.frombuffer(odds.buffers()[2] or b"", np.int8)[offsets[0]:offsets[-1]]


def _first_bytes(code: Code, pairs: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The first two bytes of words: class before, the word so far (0: nothing, else one more than the first byte); of their
    decisions: 2 * node + bit; decisions of each byte; occurrences of each decision.  ``pairs``: class << 16 | two bytes."""
    previous, one, two = pairs >> 16, pairs >> 8 & 255, pairs & 255
    first, parts = np.full(len(pairs), BLANK), []
    # The word after an end is in another text.
    for before1, byte, n_, context in ((first, one, n, np.zeros(len(pairs), np.int64)), (one, two, np.where(one == END, 0, n), 1 + one)):
        which = code.of_pair[first << 8 | before1]
        length = code.length[which, byte]
        at = np.repeat(code.start[which, byte] - (np.cumsum(length) - length), length)
        at += np.arange(len(at))
        parts.append((previous, context, code.step[at], length, np.repeat(n_, length)))
    return tuple(np.concatenate(p) for p in zip(*parts))


def _before_odds(code: Code, pairs: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Log odds by class of the last byte of the word before, and node, for the first two bytes of a word."""
    previous, _, slots, length, counts = _first_bytes(code, pairs, n)
    return node_odds(np.repeat(previous, length) * (2 * code.nodes) + slots, counts, CLASSES * code.nodes)


def lm_scores(docs: DataFrame, folds: int = 5, held: int = 1) -> DataFrame:
    """Scores of every row of ``docs(doc_id, text)``, learnt from the rows outside the held fold.

    The held fold has crc32 of the decimal doc_id modulo ``folds`` equal to
    ``held``.  Columns: ``doc_id``, ``held_out``, ``n_tokens`` (words and the
    end), ``n_known`` (tokens that occur in training), ``train_tokens``,
    ``base_score`` (log10 of a smoothed unigram model), ``score`` (log10 of the
    mixing model), ``n_bytes`` (of the words, a blank after each, and the end)
    and ``bits_per_byte``.

    Null texts are empty; an empty text is the end alone.  Rows without doc_id
    are held out.  Repeated rows each learn and each get a row.  Without any
    training row every bit has probability one half.  Other columns are not read.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    rows = staged(_sliced(docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id",
        F.coalesce(crc_mod("doc_id", folds) == held, F.lit(True)).alias("held_out"), "text")), "lm-slices")
    words = rows.where(F.col("code") != _DOCS)
    code = Code.of_triples(*_added(words, "triples"))
    shared = spark.sparkContext.broadcast(code)
    asked = words.select("slice", "code", "word", "n")
    ranges = max(spark.sparkContext.defaultParallelism, -(-asked.count() // RANGE_ROWS))
    with batch_rows(spark, WORD_ROWS):
        dealt = staged(asked.repartitionByRange(ranges, "word").sortWithinPartitions("word").withColumn("part", F.spark_partition_id()),
                       "lm-ranges", {"parquet.block.size": str(1 << 30)})
        told = _counted(dealt, shared)
    kind, slot, n = (told.column(c).to_numpy() for c in ("kind", "slot", "n"))
    two, three = (node_odds(slot[kind == order], n[kind == order], width) for order, width in ((2, code.nodes), (3, code.nodes * CLASSES)))
    border: dict[bytes, dict[int, int]] = {}
    at_border = told.filter(pc.equal(told.column("kind"), 0))
    for begin, byte, times in zip(*(at_border.column(c).to_pylist() for c in ("begin", "slot", "n"))):
        border.setdefault(begin, {})[byte] = times
    follows = _added(words, "before", code.byte_class)
    tables = Tables(two, three, _before_odds(code, *follows))
    total = told.filter(pc.equal(told.column("kind"), 1)).to_pylist()
    tokens, distinct = (total[0]["n"], total[0]["distinct"]) if total else (0, 0)
    shared_tables, shared_border = spark.sparkContext.broadcast(tables), spark.sparkContext.broadcast(border)
    with batch_rows(spark, WORD_ROWS):
        start = _start_weights(code, tables, *follows, _decisions(dealt, shared, shared_tables, shared_border))
    found = _answered(dealt, shared, shared_border)

    def run(part: pa.Table, found: pa.Table) -> pa.Table:
        found = unpacked(found.column("block").to_pylist())
        n = found.column("n").to_numpy()
        mixer = Mixer(shared.value, shared_tables.value, pa.concat_arrays(found.column("word").chunks),
                      _bytes_of(pa.concat_arrays(found.column("odds").chunks)), start)
        del found
        pa.default_memory_pool().release_unused()
        lists = [from_planes(c) for c in part.column("codes").to_pylist()]
        known, logs = (n > 0).astype(np.int64), np.log10(n + 0.5)
        return pa.Table.from_arrays(
            [part.column("doc_id"), part.column("held_out"), pa.array([len(c) for c in lists], pa.int64()),
             pa.array([int(known[c].sum()) for c in lists], pa.int64()), pa.array([float(logs[c].sum()) for c in lists], pa.float64()),
             pa.array(mixer.losses(lists)), pa.array([int(mixer.bytes[c].sum()) for c in lists], pa.int64())],
            ["doc_id", "held_out", "n_tokens", "n_known", "logs", "nats", "n_bytes"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    scored = (rows.where(F.col("code") == _DOCS).select("slice", "doc_id", "held_out", "codes").groupBy("slice")
              .cogroup(found.groupBy("asked_by"))
              .applyInArrow(run, f"doc_id {id_type}, held_out boolean, n_tokens bigint, n_known bigint, logs double, nats double, n_bytes bigint"))
    scale = float(np.log10(tokens + 0.5 * (distinct + 1)))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"),
                         (F.col("logs") - F.col("n_tokens") * scale).alias("base_score"),
                         (-F.col("nats") / float(np.log(10))).alias("score"), "n_bytes",
                         (F.col("nats") / float(np.log(2)) / F.col("n_bytes")).alias("bits_per_byte"))


def _added(words: DataFrame, column: str, classes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Keys and sums of the counts that slices hold in a column.  ``classes``: of bytes, to stand for the keys' first one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                key, n = np.frombuffer(raw, np.int64).reshape(2, -1)
                if classes is not None:
                    key = classes[key >> 16] << 16 | key & 65535
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], ["key", "n"])

    found = (words.where(F.col(column).isNotNull()).select(column).mapInArrow(run, "key bigint, n bigint")
             .groupBy("key").agg(F.sum("n").alias("n")).toArrow())
    return found.column("key").to_numpy(), found.column("n").to_numpy()
