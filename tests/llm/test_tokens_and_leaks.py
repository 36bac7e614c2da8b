import hashlib
import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rosterflow.llm import bpe, decontam, token_counts
from tests.llm.helpers import TEXTS, alnum_words, documents

LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.default_vocabulary()


def test_ids_equal_the_library(vocabulary):
    rng = random.Random(5)
    letters = "abcXYZ  \n\t'sltre.,!0123éßñ漢字😀\u00a0\u2028\x1c\x85\u200b\0²½"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(80))) for _ in range(3000)]
    texts += ["<|endoftext|>a<|endoftext|><|endoftext|>", "x<|endoftext|", "\0<|endoftext|>", "a" * 5000, "ab" * 20000, " " * 3000, "=" * 70, ""]
    encoder = bpe.Encoder(vocabulary)
    flat, counts = encoder(texts)
    at = 0
    for text, n in zip(texts, counts):
        assert flat[at:at + n].tolist() == LIBRARY.encode(text, add_special_tokens=False).ids
        at += n


def test_round_trip_query(spark, vocabulary):
    rows = bpe.bpe_round_trip(documents(spark), vocabulary).collect()
    expected = set()
    for i, t in enumerate(TEXTS, 1):
        ids = LIBRARY.encode(t or "", add_special_tokens=False).ids
        expected.add((i, len(ids), sha(",".join(map(str, ids))), sha(LIBRARY.decode(ids, skip_special_tokens=False))))
    assert {tuple(r) for r in rows} == expected and len(rows) == len(TEXTS)
    assert bpe.bpe_round_trip(documents(spark).limit(0), vocabulary).count() == 0


def test_decode_edges(spark, vocabulary):
    rows = spark.createDataFrame([(1, [464, None, 999999, 3290, -1]), (2, None), (3, []), (4, [220, 109, 120])], "k int, ids array<int>")
    found = {r.k: r.decoded for r in bpe.decode(rows, vocabulary).collect()}
    assert found == {1: LIBRARY.decode([464, 3290]), 2: "", 3: "", 4: LIBRARY.decode([220, 109, 120])}


def brute_sections(text, spans, rule):
    """Tokens of each span by walking over the library's offsets."""
    counts, outside, crossing = [0] * len(spans), 0, 0
    offsets = LIBRARY.encode(text, add_special_tokens=False).offsets
    for a, b in offsets:
        held = [max(0, min(b, e) - max(a, s)) for s, e in spans]
        touched = sum(h > 0 for h in held)
        crossing += touched > 1 or 0 < sum(held) < b - a
        if rule == "start":
            best = next((k for k, (s, e) in enumerate(spans) if s <= a < e), None)
        else:
            best = held.index(max(held)) if touched else None
        if best is None:
            outside += 1
        else:
            counts[best] += 1
    return len(offsets), outside, crossing, counts


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_token_attribution(spark, rule):
    rng = random.Random(3)
    rows = []
    for i in range(60):
        text = "".join(rng.choice(["the ", "tokens", "ation", "é", "漢字", "😀", "\n", "  ", "12345", "."]) for _ in range(rng.randrange(1, 40)))
        cuts = sorted(rng.sample(range(len(text) + 1), min(len(text) + 1, rng.randrange(0, 9))))
        rows.append((i, text, [(str(k), a, b) for k, (a, b) in enumerate(zip(cuts, cuts[1:])) if k % 3]))
    docs = spark.createDataFrame(rows, "doc_id int, text string, spans array<struct<part:string,begin:int,end:int>>")
    ranks = token_counts.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    found = {r.doc_id: (r.t.n_tokens, r.t.outside, r.t.crossing, r.t.counts)
             for r in token_counts.add_token_counts(docs, ranks, rule=rule, out="t").collect()}
    assert found == {i: brute_sections(t, [(a, b) for _, a, b in s], rule) for i, t, s in rows}
    assert all(n == outside + sum(counts) for n, outside, _, counts in found.values())


def test_token_count_edges(spark):
    ranks = token_counts.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    rows = {r.doc_id: r for r in token_counts.section_tokens(documents(spark, [*TEXTS, "a\n\nb\n"]), ranks).collect()}
    assert [(rows[i].n_tokens, rows[i].n_sections, rows[i].section_tokens) for i in (1, 2)] == [(0, 0, "")] * 2
    assert rows[11].n_sections == 3 and rows[11].n_tokens == sum(map(int, rows[11].section_tokens.split(",")))
    assert token_counts.section_tokens(documents(spark).limit(0), ranks).count() == 0
    odd = spark.createDataFrame([(1, "some text", [None, ("a", None, 3), ("b", 5, 2), ("c", -4, 99)])],
                                "doc_id int, text string, spans array<struct<part:string,begin:int,end:int>>")
    assert token_counts.add_token_counts(odd, ranks).first().tokens.counts == [0, 0, 0, 2]
    fields = token_counts.join_fields(spark.createDataFrame([(1, "a title", None, "body text")], "doc_id int, t string, n string, b string"), ["t", "n", "b"])
    assert [text[s.begin:s.end] for text, spans in [fields.select("text", "spans").first()] for s in spans] == ["a title", "", "body text"]
    with pytest.raises(ValueError):
        token_counts.add_token_counts(odd, ranks, rule="other")


ITEM = "one two three four five six seven eight nine ten eleven twelve"
BENCHMARK = [(1, ITEM), (10, ITEM), (2, "short item"), (3, None), (4, ""), (None, "x y"), (5, "..!"), (2, "other words"),
             (6, "Ein Größe é漢字 item with quite some more words in it")]


def brute_leaks(text, items, size=10):
    w, windows = alnum_words(text), {}
    for i, t in items:
        v = alnum_words(t)
        if i is not None:
            for k in range(max(1, len(v) - size + 1) if v else 0):
                windows.setdefault(tuple(v[k:k + size]), set()).add(str(i))
    hit, found = set(), set()
    for v, ids in windows.items():
        for k in range(len(w) - len(v) + 1):
            if tuple(w[k:k + len(v)]) == v:
                hit |= set(range(k, k + len(v)))
                found |= ids
    return len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)


LEAKY = ["x " + ITEM.upper().replace(" ", "--") + " y", " ".join(ITEM.split()[1:11]) + " z " + " ".join(ITEM.split()[:10]),
         " ".join(ITEM.split()[:9]), "a short  item, short item other words", "short. ITEM" * 3, "x y",
         "ein größe é漢字 item with quite some more words in it", "ein Größe é漢字 item with quite some more words in it",
         " ".join(ITEM.split()[1:11] * 3)]


@pytest.mark.parametrize("block", [decontam.BLOCK_CHARS, 40])
def test_leaks_equal_brute_force(spark, block):
    items = spark.createDataFrame([(i, t, "z") for i, t in BENCHMARK], "item_id int, text string, leak string")
    docs = documents(spark, [*TEXTS, *LEAKY])
    found = decontam.add_leaks(docs, items, "found", block_chars=block)
    assert found.columns == [*docs.columns, "found"]
    got = {r.doc_id: (r.found.n_words, r.found.n_hit, len(r.found["items"]), sha(",".join(r.found["items"])), r.found.n_hit > 0)
           for r in found.collect()}
    assert got == {i: brute_leaks(t, BENCHMARK) for i, t in enumerate([*TEXTS, *LEAKY], 1)}


def test_leak_report_and_filter(spark):
    items = spark.createDataFrame(BENCHMARK, "item_id int, text string")
    docs = documents(spark, [*TEXTS, *LEAKY])
    report = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in decontam.leak_report(docs, items).collect()}
    assert report == {i: brute_leaks(t, BENCHMARK) for i, t in enumerate([*TEXTS, *LEAKY], 1)}
    kept = decontam.decontaminated(docs, items)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, r in report.items() if not r[-1]}
    assert decontam.leak_report(docs, items.limit(0)).where("contaminated OR n_items > 0").count() == 0
    assert decontam.leak_report(docs.limit(0), items).count() == 0


def test_longest_matches(spark):
    items = spark.createDataFrame([(1, ITEM)], "item_id int, text string")
    words = ITEM.split()
    docs = spark.createDataFrame([(1, "a b " + ITEM + " c " + " ".join(words[2:])), (2, "none"), (3, " ".join(words[:11] + words[1:11]))],
                                 "doc_id int, text string")
    rows = decontam.longest_matches(docs, items).select("doc_id", F.inline("matches")).collect()
    assert sorted(tuple(r) for r in rows) == [(1, "1", 2, 0, 12), (1, "1", 15, 2, 10), (3, "1", 0, 0, 11), (3, "1", 11, 1, 10)]
