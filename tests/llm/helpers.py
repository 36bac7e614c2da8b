"""Small fixtures shared by the tests of the training-data operators."""

from __future__ import annotations

import re

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

# Null, empty, blank, no letters, one word, repeated rows, non-ASCII, a long line and a very long text.
TEXTS = [None, "", " \t\n ", "123 !!! 456", "Word", "the cat sat on the mat", "the cat sat on the mat",
         "Größe é漢字 😀 naïve ​x", "a" * 5000, "lorem ipsum dolor " * 20000]


def documents(spark, texts=TEXTS, first=1):
    """Documents with columns whose names clash with those the operators use."""
    rows = [(first + i, t, ["en", "de", None][i % 3], "src", i, "x", [1], 0.5, True) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, "
                                       "row string, ids array<int>, score double, kept boolean")


def shingle_words(text: str | None) -> list[str]:
    return re.findall("[^\x20\x09-\x0d]+", (text or "").translate(UPPER))


def alnum_words(text: str | None) -> list[str]:
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))
