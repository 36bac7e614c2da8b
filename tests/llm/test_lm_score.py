"""Language-model scores against models spelt out byte by byte."""

import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from rosterflow.llm import lm_score as lm
from tests.llm.helpers import TEXTS, documents


def vocabulary(seed=1, size=400):
    rng = random.Random(seed)
    words = {"".join(rng.choice("abcé") for _ in range(rng.randint(1, 7))) for _ in range(size)} | {"x" * 60, "x" * 61, "\n"}
    words = sorted(words, key=lambda w: w.encode())
    return words, np.array([rng.randint(0, 9) for _ in words])


def spelt(word):
    raw = word.encode()
    return raw if raw == b"\n" else raw + b" "


def path(code, before, byte):
    """(node, bit) of a byte after two others."""
    c = code.of_pair[before[0] << 8 | before[1]]
    steps = code.step[code.start[c, byte]:code.start[c, byte] + code.length[c, byte]]
    return [(int(x) >> 1, int(x) & 1) for x in steps]


def two_before(raw, i):
    padded = b"  " + raw[:i]
    return padded[-2], padded[-1]


def brute_word_odds(code, words, n, asked):
    """Log odds of the word so far, from dictionaries of all beginnings."""
    counts = Counter()
    for w, k in zip(words, n):
        raw = spelt(w)
        for i in range(min(len(raw), lm.DEPTH + 1)):
            for node, bit in path(code, two_before(raw, i), raw[i]):
                counts[raw[:i], node, bit] += int(k)
    out = []
    for w in asked:
        raw = spelt(w)
        for i in range(len(raw)):
            for node, _ in path(code, two_before(raw, i), raw[i]):
                both = [counts[raw[:i], node, b] if i <= lm.DEPTH else 0 for b in (0, 1)]
                out.append(lm.odds_of(np.array(both[:1]), np.array(both[1:]))[0])
    return np.array(out, np.int8)


def test_codes_are_prefix_codes():
    length, step = lm.huffman(np.arange(256) + 0.5)
    starts = np.cumsum(length) - length
    assert sum(2.0 ** -length) == 1 and len(set((step >> 1).tolist())) == 255
    assert len({tuple(step[a:a + n].tolist()) for a, n in zip(starts, length)}) == 256
    assert length[255] < length[0] and all(step[a] >> 1 == 0 for a in starts)


def test_odds_of_the_word_so_far_equal_brute_force_for_any_ranges():
    words, n = vocabulary()
    code = lm.Code.fitted(pa.array(words), n)
    want = brute_word_odds(code, words, n, words)
    for parts in (1, 3, 50, len(words)):
        ranges = [r for r in np.array_split(np.arange(len(words)), parts) if len(r)]
        begun = [lm.Beginnings(code, pa.array([words[i] for i in r])) for r in ranges]
        border = {}
        for r, b in zip(ranges, begun):
            keys, count = b.edges(n[r])
            for number, begin in b.border().items():
                for i in np.flatnonzero(keys >> 8 == number):
                    border.setdefault(begin, Counter())[int(keys[i] & 255)] += int(count[i])
        found = []
        for r, b in zip(ranges, begun):
            keys, count = b.edges(n[r])
            own = {number: {int(k & 255): int(c) for k, c in zip(keys, count) if k >> 8 == number} for number in b.border()}
            elsewhere = {number: {x: k - own[number].get(x, 0) for x, k in border[begin].items()} for number, begin in b.border().items()}
            odds = b.odds(n[r], elsewhere)
            some = np.arange(len(r)) % 3 == 0
            assert b.odds(n[r], elsewhere, some).to_pylist() == [x for x, s in zip(odds.to_pylist(), some) if s]
            found.append(lm._bytes_of(odds))
        assert (np.concatenate(found) == want).all()


def test_contexts_grow_with_the_corpus():
    """As many contexts as there are beginnings of words, each with its own counts."""
    small, large = (vocabulary(3, size) for size in (100, 3000))
    code = lm.Code.fitted(pa.array(small[0]), small[1])
    numbers = [len(lm.Beginnings(code, pa.array(w)).keys) for w, _ in (small, large)]
    brute = [len({(spelt(x)[:i], spelt(x)[i]) for x in w for i in range(min(len(spelt(x)), lm.DEPTH + 1))}) for w, _ in (small, large)]
    assert numbers == brute and numbers[1] > 5 * numbers[0]


def refined(code, tables, word_odds, words, weights, text, rate):
    """Nats of a list of words, decision by decision: the weights move after the word that ends a step."""
    w, gate, nats, at, previous = weights.astype(float).copy(), 0, 0.0, 0, code.byte_class[lm.BLANK]
    k = 0
    while k < len(text):
        step, move, loss, number = at // lm.STEP, 0, 0.0, 0
        move = np.zeros(lm.ORDERS)
        while k < len(text) and at // lm.STEP == step:
            raw, odds = spelt(words[text[k]]), iter(word_odds[text[k]])
            for i, byte in enumerate(raw):
                third = (b"   " + raw[:i])[-3]
                for node, bit in path(code, two_before(raw, i), byte):
                    x = np.array([tables.two[node], tables.three[code.byte_class[third] * code.nodes + node], next(odds),
                                  tables.before[previous * code.nodes + node] if i < 2 else 0]) / lm.SCALE * (2 * bit - 1)
                    p = 1 / (1 + np.exp(-np.clip(w[gate] @ x, -11, 11)))
                    loss -= np.log(p)
                    move += rate * (1 - p) * x
                    number += 1
            previous = code.byte_class[raw[-2] if len(raw) > 1 else raw[0]]
            at += len(raw)
            k += 1
        w[gate] += move
        nats += loss
        gate = int(np.searchsorted(lm.GATE_NATS, loss / number))
    return nats


def test_weights_are_refined_within_texts(monkeypatch):
    words, n = vocabulary(5, 200)
    code = lm.Code.fitted(pa.array(words), n)
    rng = np.random.default_rng(0)
    tables = lm.Tables(*(rng.integers(-100, 100, size * code.nodes).astype(np.int8) for size in (1, lm.CLASSES, lm.CLASSES)))
    odds = lm.Beginnings(code, pa.array(words)).odds(n, {})
    weights = rng.random((lm.GATES, lm.ORDERS))
    texts = [rng.integers(0, len(words), size) for size in (3, 700, 1, 60)]
    by_word = [np.frombuffer(x, np.int8) for x in odds.to_pylist()]
    want = [refined(code, tables, by_word, words, weights, t, lm.RATE) for t in texts]
    for window, run in ((2048, 1 << 19), (64, 200)):  # neither windows nor runs show in the scores
        monkeypatch.setattr(lm, "WINDOW", window)
        monkeypatch.setattr(lm, "RUN_BYTES", run)
        found = lm.Mixer(code, tables, pa.array(words), lm._bytes_of(odds), weights).losses(texts)
        assert found == pytest.approx(want, rel=2e-4)
    fixed = [refined(code, tables, by_word, words, weights, t, 0) for t in texts]
    assert abs(want[3] - fixed[3]) > 0.01 * fixed[3]


def base_scores(rows):
    """The base columns from plain dictionaries."""
    lower = [(i, (t or "").encode().lower().split()) for i, t in rows]
    learnt = [i is not None and zlib.crc32(str(i).encode()) % 5 != 1 for i, _ in rows]
    c = Counter(w for (_, ws), t in zip(lower, learnt) if t for w in [*ws, None])
    total, distinct = sum(c.values()), len(c)
    out = []
    for (i, ws), t in zip(lower, learnt):
        tokens = [*ws, None]
        score = sum(np.log10((c[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in tokens)
        out.append((i, not t, len(tokens), sum(c[w] > 0 for w in tokens), total, pytest.approx(score, rel=1e-9)))
    return out


def test_base_columns_equal_brute_force(spark):
    texts = [*TEXTS, *[f"The cat {i % 3} sat on\tthe {'mat' * (i % 4)}" for i in range(60)]]
    got = lm.lm_scores(documents(spark, texts).repartition(4)).collect()
    want = base_scores([(1 + i, t) for i, t in enumerate(texts)])
    key = lambda r: r[0]
    assert sorted([tuple(r)[:6] for r in got], key=key) == sorted(want, key=key)
    assert all(r.score < 0 and r.n_bytes == sum(len(w) + 1 for w in (t or "").encode().split()) + 1
               for r, t in zip(sorted(got, key=key), texts))


def test_scores_do_not_depend_on_ranges_and_slices(spark, monkeypatch):
    docs = documents(spark, [f"the cat {i} sat on mat {i % 7} " * (1 + i % 5) for i in range(80)])
    first = {r.doc_id: r.score for r in lm.lm_scores(docs).collect()}
    monkeypatch.setattr(lm, "RANGE_ROWS", 20)
    again = {r.doc_id: r.score for r in lm.lm_scores(docs.repartition(5)).collect()}
    assert len(first) == 80 and again == {k: pytest.approx(v, rel=1e-5) for k, v in first.items()}


def test_learning_helps_and_repeated_rows_count(spark):
    words = "one two three four five six seven eight nine ten".split()
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(words) for _ in range(60))) for i in range(200)] + [(None, "zzz qqq"), (3, "again"), (3, "again")]
    got = lm.lm_scores(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert len(got) == 203 and sum(r.doc_id == 3 for r in got) == 3
    held = [r for r in got if r.held_out and r.n_tokens > 10]
    assert held and max(r.bits_per_byte for r in held) < 1.2
    assert next(r for r in got if r.doc_id is None).bits_per_byte > 3


def test_nothing_to_learn_from(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert lm.lm_scores(empty).collect() == []
    (row,) = lm.lm_scores(spark.createDataFrame([(None, "ab")], "doc_id bigint, text string")).collect()
    assert row.held_out and (row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (2, 0, 0, 0.0)
    assert row.score == pytest.approx(row.n_bytes * 8 * np.log10(0.5))  # every bit has probability one half


def test_a_very_long_text_and_its_parts(spark):
    """A long text is scored with its own weights going on: the more of the same, the cheaper each byte."""
    part = "some words that go on and on "
    rows = [(i, part * n) for i, n in enumerate([3, 3, 3, 30, 9000, 3, 3, 3])] + [(100, "other words here")]
    got = {r.doc_id: r for r in lm.lm_scores(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got[4].n_tokens == 9000 * 7 + 1 and got[4].bits_per_byte < got[3].bits_per_byte < got[0].bits_per_byte < got[100].bits_per_byte


def learnt_decisions(code, tables, texts):
    """Scaled log odds towards the bit that comes, at every decision of all texts; the word so far is counted without the
    word's own occurrence after its second byte."""
    counts = Counter()
    for text in texts:
        for w in [*text, "\n"]:
            raw = spelt(w)
            for i in range(min(len(raw), lm.DEPTH + 1)):
                counts.update((raw[:i], node, bit) for node, bit in path(code, two_before(raw, i), raw[i]))
    out = []
    for text in texts:
        previous = code.byte_class[lm.BLANK]
        for w in [*text, "\n"]:
            raw = spelt(w)
            for i, byte in enumerate(raw):
                third = (b"   " + raw[:i])[-3]
                for node, bit in path(code, two_before(raw, i), byte):
                    both = [counts[raw[:i], node, b] - (i > 1 and b == bit) if i <= lm.DEPTH else 0 for b in (0, 1)]
                    x = [tables.two[node], tables.three[code.byte_class[third] * code.nodes + node],
                         lm.odds_of(np.array(both[:1]), np.array(both[1:]))[0], tables.before[previous * code.nodes + node] if i < 2 else 0]
                    x = np.array(x, int) * (2 * bit - 1)
                    out.append((x + 128 + lm.BIN // 2) // lm.BIN * lm.BIN - 128 if i > 1 else x)
            previous = code.byte_class[raw[-2] if len(raw) > 1 else raw[0]]
    return np.array(out, float)


def test_codes_and_first_weights_come_from_all_training_documents(spark, monkeypatch):
    """Documents of every id, and what comes late in a long one, count."""
    used, start = [], lm._start_weights
    monkeypatch.setattr(lm, "_start_weights", lambda code, tables, *a: used.extend((code, tables, start(code, tables, *a))) or used[2])
    monkeypatch.setattr(lm, "RANGE_ROWS", 40)
    rng = random.Random(8)
    texts = [" ".join("".join(rng.choice("abcdefgé"[i % 4:]) for _ in range(rng.randint(1, 5))) for _ in range(30)) for i in range(30)]
    texts[0] = "ab " * 4000 + "quixotic " * 30 + "x" * 60
    lm.lm_scores(documents(spark, texts).repartition(3)).collect()
    train = [t.lower().split() for i, t in enumerate(texts) if zlib.crc32(str(1 + i).encode()) % 5 != 1]
    assert "quixotic" in train[0]
    n = Counter(w for t in train for w in [*t, "\n"])
    words = sorted(n)
    code, tables, weights = used
    want = lm.Code.fitted(pa.array(words), np.array([n[w] for w in words]))
    assert all(np.array_equal(getattr(code, f), getattr(want, f)) for f in ("of_pair", "start", "length", "step", "byte_class"))
    odds = learnt_decisions(code, tables, train)
    assert weights == pytest.approx(np.repeat(lm.first_weights(odds, np.ones(len(odds)))[None], lm.GATES, 0), abs=1e-6)


def test_first_weights_are_the_likeliest():
    rng = np.random.default_rng(2)
    odds, n = rng.integers(-60, 90, (500, lm.ORDERS)), rng.integers(1, 2000, 500)
    found = lm.first_weights(odds, n)
    nats = lambda w: n @ np.log1p(np.exp(-odds @ w / lm.SCALE))
    assert all(nats(found) < nats(found + d) for k in range(lm.ORDERS) for d in (np.eye(lm.ORDERS)[k] * 0.01, -np.eye(lm.ORDERS)[k] * 0.01))
    assert lm.first_weights(odds[:0], n[:0]) == pytest.approx(lm.FIRST_WEIGHT)
