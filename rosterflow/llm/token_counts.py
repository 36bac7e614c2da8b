"""Token counts of the parts of a document by offset-mapped attribution.

A whole document is encoded once.  The tokens' character spans are met with the
spans of its parts (fields or sections), and every token that touches a part
counts there or not by the boundary rule:

* ``majority``: in the part that holds most of its characters, the earlier one in a tie;
* ``start``: in the part that holds its first character.

Encoding the parts one by one would give other tokens at their ends.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterflow.llm.bpe import PATTERN
from rosterflow.llm.common import bound_batches, slices, with_fields

RULES = ("majority", "start")
SPANS = "array<struct<part: string, begin: int, end: int>>"


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a tiktoken vocabulary file (driver only; a few MB)."""
    import base64

    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def char_bounds(text: str, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and end character of each token from the tokens' byte lengths.

    A token that holds a part of a character's bytes touches that character.
    """
    raw = np.frombuffer(text.encode(), np.uint8)
    char = np.cumsum((raw & 0xC0) != 0x80) - 1  # character of each byte
    end = np.cumsum(lengths)
    return char[end - lengths], char[end - 1] + 1


def attribute(first: np.ndarray, end: np.ndarray, begin: np.ndarray, stop: np.ndarray, rule: str) -> np.ndarray:
    """Part of each token, -1 for none.  Parts are sorted, apart from each other and not empty."""
    if not len(begin):
        return np.full(len(first), -1)
    at = np.searchsorted(begin, first, "right") - 1  # the part that the first character may lie in
    held = np.maximum(at, 0)
    inside = np.where((at >= 0) & (first < stop[held]), at, -1)
    if rule == "start":
        return inside
    # Later parts: a token rarely meets more than two, so step through them.
    best = inside.copy()
    most = np.where(inside >= 0, np.minimum(end, stop[held]) - first, 0)
    nxt = at + 1
    while True:
        more = nxt < len(begin)
        k = np.minimum(nxt, len(begin) - 1)
        more &= begin[k] < end
        if not more.any():
            return best
        size = np.minimum(end, stop[k]) - begin[k]
        better = more & (size > most)
        best[better], most[better] = nxt[better], size[better]
        nxt = np.where(more, nxt + 1, len(begin))


def add_token_counts(docs: DataFrame, ranks: dict[bytes, int], spans: str = "spans", rule: str = "majority",
                     out: str = "tokens", pattern: str = PATTERN) -> DataFrame:
    """Add ``out``: n_tokens, outside, crossing, and the tokens of each part in the order of ``spans``.

    ``spans`` is an array of (part, begin, end) character spans that don't
    overlap.  ``outside`` counts tokens that no part gets, ``crossing`` those
    that touch more than one part or leave one; parts and ``outside`` sum up to
    ``n_tokens``.  Spans are cut to the text; empty, null and reversed ones have
    no tokens.  Null and empty texts and null spans have counts of 0.  Repeated
    rows each get a result; ``out`` must not be a column.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    result = pa.struct([("n_tokens", pa.int64()), ("outside", pa.int64()), ("crossing", pa.int64()),
                        ("counts", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        ranks = shared.value
        encoding = tiktoken.Encoding("parts", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        size = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, i in ranks.items():
            size[i] = len(token)

        def one(text: str | None, parts: list[dict] | None) -> dict:
            parts, text = parts or [], text or ""
            ids = np.array(encoding.encode_ordinary(text), np.int64)
            counts = np.zeros(len(parts), np.int64)
            if not len(ids):
                return {"n_tokens": 0, "outside": 0, "crossing": 0, "counts": counts}
            first, end = char_bounds(text, size[ids])
            kept = sorted((max(0, p["begin"]), min(len(text), p["end"]), k) for k, p in enumerate(parts)
                          if p is not None and p["begin"] is not None and p["end"] is not None)
            kept = [x for x in kept if x[0] < x[1]]
            begin, stop, place = (np.array([x[i] for x in kept], np.int64) for i in range(3))
            part = attribute(first, end, begin, stop, rule)
            np.add.at(counts, place[part[part >= 0]], 1)
            cuts = np.unique(np.concatenate([begin, stop])) if len(kept) else np.empty(0, np.int64)
            crossing = int((np.searchsorted(cuts, first, "right") != np.searchsorted(cuts, end, "left")).sum())
            return {"n_tokens": len(ids), "outside": int((part < 0).sum()), "crossing": crossing, "counts": counts}

        for batch in batches:
            for rows in slices(batch):
                got = [one(t, s) for t, s in zip(rows.column("text").to_pylist(), rows.column(spans).to_pylist())]
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(got, result)], [*rows.schema.names, out])

    return docs.mapInArrow(run, with_fields(
        docs, f"`{out}` struct<n_tokens: bigint, outside: bigint, crossing: bigint, counts: array<bigint>>"))


def add_line_spans(docs: DataFrame, out: str = "spans") -> DataFrame:
    """Add ``out``: the spans of the lines of ``text`` (line breaks included), named by their number from 0.

    Null and empty texts have none; neither has the empty rest after a final break.
    """
    bound_batches(docs.sparkSession)
    kind = pa.list_(pa.struct([("part", pa.string()), ("begin", pa.int32()), ("end", pa.int32())]))

    def lines(text: str | None) -> list[dict]:
        got, at = [], 0
        for i, line in enumerate((text or "").split("\n")):
            got.append({"part": str(i), "begin": at, "end": at + len(line) + 1})
            at += len(line) + 1
        got[-1]["end"] -= 1
        return got if got[-1]["begin"] < got[-1]["end"] else got[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch):
                got = pa.array([lines(t) for t in rows.column("text").to_pylist()], kind)
                yield pa.RecordBatch.from_arrays([*rows.columns, got], [*rows.schema.names, out])

    return docs.mapInArrow(run, with_fields(docs, f"`{out}` {SPANS}"))


def join_fields(docs: DataFrame, fields: list[str], separator: str = "\n") -> DataFrame:
    """(doc_id, text, spans) with the text fields joined, each field a part (null: empty)."""
    texts = [F.coalesce(F.col(f"`{f}`").cast("string"), F.lit("")) for f in fields]
    spans, at = [], F.lit(0)
    for name, text in zip(fields, texts):
        spans.append(F.struct(F.lit(name).alias("part"), at.alias("begin"), (at + F.length(text)).alias("end")))
        at = at + F.length(text) + len(separator)
    return docs.select("doc_id", F.concat_ws(separator, *texts).alias("text"), F.array(*spans).alias("spans"))


def section_tokens(docs: DataFrame, ranks: dict[bytes, int], rule: str = "majority") -> DataFrame:
    """Tokens of every document of ``docs(doc_id, text)`` and of its lines.

    Columns ``doc_id``, ``n_tokens``, ``n_sections``, ``crossing`` (tokens that
    touch two lines) and ``section_tokens`` (tokens of each line in order, comma
    joined).  A line holds its line break; the empty text after a final break is
    no section.  Null and empty texts have no sections.
    """
    spans = add_line_spans(docs.select("doc_id", "text"))
    found = add_token_counts(spans, ranks, rule=rule).drop("text")
    return found.select("doc_id", "tokens.n_tokens", F.size("spans").cast("long").alias("n_sections"), "tokens.crossing",
                        F.array_join(F.col("tokens.counts").cast("array<string>"), ",").alias("section_tokens"))
