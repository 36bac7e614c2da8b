"""Quality rules of whole texts, with compression bands as the last one.

The base rules count words, symbols, repeated lines and repeated runs of three
words.  The bands look at what zstandard makes of a text: the compressed size
over the size, of the whole text and of each fixed chunk of it.  Below the band
a text is repetitive, above it is noise.  Short texts compress worse, so every
length has limits of its own.  Each text is judged alone: no row leaves its
task, and there is no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from rosterflow.llm.common import bound_batches, fresh, slices, with_fields

# (length in bytes below which the band holds, least and most compressed size over size)
BANDS = [(256, 0.40, 1.20), (512, 0.36, 1.00), (1024, 0.33, 0.85), (2048, 0.30, 0.75), (8192, 0.27, 0.70),
         (float("inf"), 0.24, 0.66)]
CHUNK = 2048  # bytes
LEAST_CHUNK = 256  # a shorter rest of a text is judged with the chunk before it
MOST_OUTSIDE = 0.3  # share of a text's bytes that may lie in chunks outside their band
LEVEL = 3

MIN_WORDS = 50
MOST_REPEATED = 50  # percent of the words that may lie in repeated runs of three

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True

MEASURES = ("n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
            "ratio double, outside double, base_failed boolean, verdict string, kept boolean")


class Bands:
    """Compressed size over size, and the band of a length."""

    def __init__(self, bands=tuple(BANDS), chunk: int = CHUNK, level: int = LEVEL):
        self.bands, self.chunk = bands, chunk
        self._compress = zstandard.ZstdCompressor(level=level, write_content_size=False, write_checksum=False).compress

    def side(self, raw: bytes) -> tuple[float, int]:
        """Ratio of a stretch, and -1, 0 or 1: below, inside or above its band."""
        ratio = len(self._compress(raw)) / len(raw)
        low, high = next((lo, hi) for below, lo, hi in self.bands if len(raw) < below)
        return ratio, -1 if ratio < low else int(ratio > high)

    def judge(self, raw: bytes) -> tuple[float, float, str]:
        """Ratio of the whole text, share of its bytes in chunks outside their band, and the verdict."""
        if not raw:
            return 0.0, 0.0, "empty"
        ratio, whole = self.side(raw)
        cuts = [*range(0, len(raw), self.chunk), len(raw)]
        if len(cuts) > 2 and cuts[-1] - cuts[-2] < LEAST_CHUNK:
            del cuts[-2]
        low = high = 0
        if len(cuts) > 2:
            for a, b in zip(cuts, cuts[1:]):
                side = self.side(raw[a:b])[1]
                low, high = low + (b - a) * (side < 0), high + (b - a) * (side > 0)
        outside = (low + high) / len(raw)
        if whole < 0 or low > MOST_OUTSIDE * len(raw):
            return ratio, outside, "repetitive"
        if whole > 0 or high > MOST_OUTSIDE * len(raw):
            return ratio, outside, "incompressible"
        return ratio, outside, "mixed" if outside > MOST_OUTSIDE else "inside"


def _encoded(raw: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A number for each stretch of the bytes, equal for equal stretches; no two of them touch."""
    inside = np.zeros(len(raw) + 1, np.int8)
    inside[first], inside[end] = 1, -1
    offsets = np.zeros(len(first) + 1, np.int32)
    np.cumsum(end - first, out=offsets[1:])
    data = raw[np.cumsum(inside[:-1], dtype=np.int8).view(bool)] if len(first) else raw[:0]
    found = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])
    return found.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def base_counts(raw: list[bytes]) -> dict[str, np.ndarray]:
    """The counts of the base rules of each text."""
    n = len(raw)
    at = np.zeros(n + 1, np.int64)  # where each text starts; one line break stands after each
    np.cumsum([len(t) + 1 for t in raw], out=at[1:])
    b = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    text_of = np.repeat(np.arange(n), np.diff(at))

    space = _SPACE[b]
    gap = np.concatenate([[True], space])
    edge = np.flatnonzero(gap[1:] != gap[:-1])  # the text ends with a break, so every word has an end
    first, end = edge[::2], edge[1::2]
    of = text_of[first]
    points = ~space & ((b & 0xC0) != 0x80)
    out = {"n_words": np.bincount(of, minlength=n), "word_chars": np.bincount(text_of[points], minlength=n),
           "n_symbols": np.bincount(text_of[_SYMBOL[b]], minlength=n)}

    stop = np.flatnonzero(b == 0x0A)
    start = np.concatenate([[0], stop[:-1] + 1])
    words_before = np.concatenate([[0], np.cumsum(~space)])
    worded = words_before[stop] > words_before[start]
    start, stop = start[worded], stop[worded]
    line, line_of = _encoded(b, start, stop), text_of[start]
    kinds = np.unique(line_of * (len(line) + 1) + line) // (len(line) + 1)
    out["n_dup_lines"] = np.bincount(line_of, minlength=n) - np.bincount(kinds, minlength=n)

    repeated = np.zeros(len(first), bool)
    window = np.flatnonzero(of[2:] == of[:-2]) if len(of) > 2 else np.zeros(0, np.int64)
    if len(window):
        word = _encoded(b, first, end)
        size = int(word.max()) + 1
        _, pair = np.unique(word[window] * size + word[window + 1], return_inverse=True)
        _, triple = np.unique(pair * size + word[window + 2], return_inverse=True)
        _, same, count = np.unique(triple * n + of[window], return_inverse=True, return_counts=True)
        twice = window[count[same] > 1]
        for i in range(3):
            repeated[twice + i] = True
    out["n_repeat_words"] = np.bincount(of[repeated], minlength=n)
    return out


def add_measures(docs: DataFrame, out: str = "measures", column: str = "text") -> DataFrame:
    """Add ``out``, a struct of ``MEASURES`` of the whole text; a null text has those of an empty one.

    ``verdict`` is ``words`` or ``repeats`` for a failed base rule, else that of
    the bands: ``repetitive``, ``incompressible``, ``mixed`` (chunks of both kinds)
    or ``inside``.  ``kept`` holds for ``inside`` alone.  Rows are neither
    dropped nor joined, so repeated rows and ids each get a result.
    """
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands()
        for batch in batches:
            for part in slices(batch, column):
                raw = [t or b"" for t in part.column(column).cast(pa.binary()).to_pylist()]
                base = base_counts(raw)
                rows = []
                for i, text in enumerate(raw):
                    row = {k: int(v[i]) for k, v in base.items()}
                    few, repeats = row["n_words"] < MIN_WORDS, 100 * row["n_repeat_words"] > MOST_REPEATED * row["n_words"]
                    ratio, outside, verdict = bands.judge(text)
                    row |= {"ratio": ratio, "outside": outside, "base_failed": few or repeats,
                            "verdict": "words" if few else "repeats" if repeats else verdict}
                    rows.append(row | {"kept": row["verdict"] == "inside"})
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(rows, result)], [*part.schema.names, out])

    schema = with_fields(docs, f"`{out}` struct<{MEASURES.replace(' ', ': ').replace(',: ', ', ')}>")
    result = pa.struct([(name, {"bigint": pa.int64(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string()}[kind])
                        for name, kind in (x.split() for x in MEASURES.split(", "))])
    return docs.mapInArrow(run, schema)


def quality_rules(docs: DataFrame) -> DataFrame:
    """``MEASURES`` of every row of ``docs(doc_id, text)``, with its ``doc_id`` (which may be null)."""
    return add_measures(docs.select("doc_id", "text")).select("doc_id", "measures.*")


def passing(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that every rule keeps, with all their columns."""
    out = fresh(docs, "measures")
    return add_measures(docs, out).where(f"`{out}`.kept").drop(out)
