"""Collocations, spelling variants and compression rules against plain brute force."""

from __future__ import annotations

import base64
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
import zstandard

from rosterflow.llm import collocations as col
from rosterflow.llm import compression_rules as rules
from rosterflow.llm import spelling
from tests.llm.helpers import TEXTS, UPPER, documents

SCHEMA = "doc_id bigint, text string, lang string"


# --- collocations ---------------------------------------------------------


def brute_collocations(rows, at_least=10, cover=50, first=2000, most=3):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(UPPER)):
            ws = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(ws)
            for k in range(1, most + 1):
                f.update((lang, *ws[i:i + k]) for i in range(len(ws) - k + 1))
    out = defaultdict(list)
    for (lang, *ws), a in f.items():
        if len(ws) < 2 or a < at_least:
            continue
        longer = [b for (g, *vs), b in f.items() if g == lang and b >= at_least and len(vs) > len(ws)
                  and any(vs[i:i + len(ws)] == ws for i in range(len(vs)))]
        if any(100 * b >= cover * a for b in longer):
            continue
        cuts = [(10**6 * a * a // (f[(lang, *ws[:k])] * f[(lang, *ws[k:])]), k) for k in range(1, len(ws))]
        score, k = min(cuts)
        out[lang].append((-score, -a, " ".join(ws).encode(), f[(lang, *ws[:k])], f[(lang, *ws[k:])]))
    return {(lang, i, p.decode(), -a, x, y, n[lang], -s) for lang, found in out.items()
            for i, (s, a, p, x, y) in enumerate(sorted(found)[:first], 1)}


def found_rows(df):
    return [tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()]


def phrase_rows(seed=1):
    rng = random.Random(seed)
    words = ["The", "cat", "sat", "ON", "mat", "é漢", "a\x00b", "#", "New", "York"]
    rows = []
    for i in range(120):
        text = "".join(rng.choice(words) + rng.choice([" ", "  ", "\t", " ", ". ", ", ", "\n", "New York City ", "!"]) for _ in range(40))
        rows.append((i, text, rng.choice(["en", "en", "de", None])))
    return rows + [(500, None, "en"), (501, "", "fr"), (502, " .;\n", "fr"), (1, rows[1][1], rows[1][2])]


@pytest.mark.parametrize("first,at_least,cover,most", [(2000, 10, 50, 3), (7, 10, 50, 3), (2000, 3, 90, 2), (50, 4, 60, 4)])
def test_collocations_equal_brute_force(spark, first, at_least, cover, most):
    rows = phrase_rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5, "doc_id")
    got = found_rows(col.collocations(df, most, at_least, cover, first))
    assert len(got) == len(set(got)) and set(got) == brute_collocations(rows, at_least, cover, first, most)


def test_collocations_of_odd_tables(spark):
    assert found_rows(col.collocations(spark.createDataFrame([], SCHEMA))) == []
    got = found_rows(col.collocations(documents(spark)))
    want = brute_collocations([(1 + i, t, ["en", "de", None][i % 3]) for i, t in enumerate(TEXTS)])
    assert set(got) == want and len(got) == len(want) and want


def test_collocation_scores_are_exact_beyond_64_bits(spark):
    big = 10**13 + 7
    rows = [(1, 1, None, None, "en", "x", "x", big + 1, [], []), (1, 2, None, None, "en", "y", "y", big + 3, [], []),
            (2, 3, 1, 2, "en", "x y", "y", big, [big + 1], [big + 3])]
    df = spark.createDataFrame(rows, "words int, id bigint, head bigint, tail bigint, lang string, phrase string, last string, "
                                     "f bigint, firsts array<bigint>, rests array<bigint>")
    (row,) = col.scored(df).collect()
    assert row.score == 10**6 * big * big // ((big + 1) * (big + 3)) == 999999


# --- spelling variants ----------------------------------------------------


def brute_counts(rows):
    n = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            if doc_id is not None:
                h = zlib.crc32(f"{doc_id}:{run}".encode())
                if h % 199 == 0:
                    run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return n


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_variants(rows):
    n = {w: c for w, c in brute_counts(rows).items() if len(w) >= 6 and c >= 5}
    form, count = {}, {}
    for w in n:
        others = [v for v in n if near(w, v)]
        count[w] = len(others)
        best = min(others, key=lambda v: (-n[v], v), default=None)
        if best is not None and n[best] >= 5 * n[w]:
            form[w] = best
    out = set()
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n[w], count[w], n[form[w]] if w in form else None))
    return out


def variant_rows(df):
    return [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]


def spelled_rows(seed=2):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdéÿ") for _ in range(rng.choice([6, 7, 8, 13, 30]))) for _ in range(30)]
    rows = []
    for i in range(300):
        words = []
        for _ in range(40):
            w = base[min(rng.randrange(30), rng.randrange(30))]
            for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
                at, kind = rng.randrange(len(w)), rng.randrange(3)
                w = w[:at] + rng.choice(["", "a", "b"]) + w[at + (kind > 0):]
            words.append(w.upper() if rng.random() < .1 and w.isascii() else w)
        rows.append((i, " ".join(words), "en"))
    return rows + [(None, "Wörtlich " * 9 + "x1y2", None), (7, None, "en"), (8, "", "en"), (3, rows[3][1], "en"),
                   (None, "kkkkkka " * 130 + "kkkkkkab " * 26 + "kkkkkkabc " * 5, "de"),
                   (9, ("a" * 900 + " ") * 60 + ("a" * 901 + " ") * 6, "en")]


@pytest.mark.parametrize("shard_words", [20_000, 40])
def test_spelling_variants_equal_brute_force(spark, shard_words):
    rows = spelled_rows()
    got = variant_rows(spelling.spelling_variants(spark.createDataFrame(rows, SCHEMA).repartition(4), shard_words=shard_words))
    want = brute_variants(rows)
    assert len(got) == len(want) and set(got) == want
    assert any(r[1] and r[1] != r[2] for r in want)  # forms of forms


def test_spelling_of_odd_tables(spark):
    assert variant_rows(spelling.spelling_variants(spark.createDataFrame([], SCHEMA))) == []
    got = variant_rows(spelling.spelling_variants(documents(spark)))
    assert set(got) == brute_variants([(1 + i, t) for i, t in enumerate(TEXTS)])


def test_fm_index_finds_words_behind_an_exact_half():
    words = ["abcdef", "abcdeg", "abcdefg", "abcdf", "bbcdef", "ÿbcdef", "abc"]
    index = spelling.FMIndex(words)
    q, w = spelling.one_error(index, ["abcdef"], spelling.np.array([3]))
    assert {words[i] for i in w} == {"abcdeg", "abcdefg", "abcdf"} and set(q) == {0}


# --- compression rules ----------------------------------------------------


def brute_rules(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    runs = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    times = Counter(runs)
    repeated = {i + j for i, r in enumerate(runs) if times[r] > 1 for j in range(3)}
    failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated), failed)


def prose(n, seed=0):
    rng = random.Random(seed)
    parts = ["tion", "the", "an", "re", "ing", "er", "on", "st", "en", "ou", "ed", "ha", "is", "or"]
    return " ".join("".join(rng.choice(parts) for _ in range(rng.choice([1, 1, 2, 3]))) + rng.choice(["", "", "", ".", ",", ".\n"])
                    for _ in range(n))


def noise(n, seed=0):
    raw = base64.b64encode(random.Random(seed).randbytes(n)).decode()
    return " ".join(raw[i:i + 40] for i in range(0, len(raw), 40))


def blocks(n):
    """Repeats of one long paragraph with a number each time: few equal runs of words, but little new."""
    words = prose(30, 5).split()
    return " ".join(f"{w}{i}" for i in range(n) for w in words)


RULE_TEXTS = [*TEXTS, "a b c\na b c\n\n  \na b c \nx", "One # two | three\n" * 60, prose(400), prose(20_000, 3), noise(6000), blocks(60),
              prose(400, 1) + " " + noise(3000, 1), "a\x0bb \x1cx", "é" * 3 + " 漢字\n"]


def test_compression_rules_equal_brute_force(spark):
    df = documents(spark, RULE_TEXTS).repartition(3)
    got = {r.doc_id: r for r in rules.quality_rules(df).collect()}
    assert len(got) == len(RULE_TEXTS)
    for i, text in enumerate(RULE_TEXTS, 1):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute_rules(text), i
        raw = (text or "").encode()
        sizes = [len(zstandard.ZstdCompressor(level=3, write_content_size=False).compress(raw)) / len(raw)] if raw else [0.0]
        assert abs(r.ratio - sizes[0]) < 1e-12
        assert r.kept == (r.verdict == "inside") and not (r.kept and r.base_failed)
    verdict = [got[i].verdict for i in range(1, len(RULE_TEXTS) + 1)]
    at = len(TEXTS)
    assert verdict[at + 2:at + 7] == ["inside", "inside", "incompressible", "repetitive", "incompressible"]


def test_compression_rules_keep_rows_and_columns(spark):
    df = documents(spark, [prose(100), None, prose(100)]).withColumnRenamed("source", "Measures")
    kept = rules.passing(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3]
    assert rules.quality_rules(spark.createDataFrame([], SCHEMA)).collect() == []
    twice = spark.createDataFrame([(1, prose(90), "en"), (1, prose(90), "en"), (None, prose(90), "en")], SCHEMA)
    assert [r.kept for r in rules.quality_rules(twice).collect()] == [True] * 3
