import random

import pytest

from rosterflow.llm import near_dup
from rosterflow.llm.near_dup import components, deduplicated, near_duplicates
from rosterflow.llm.shingles import shingle_set
from tests.llm.helpers import TEXTS, documents, shingle_words


def reference(rows, size, percent=80):
    """Shingle counts and components by comparing all pairs."""
    sets = {}
    for i, t in rows:
        w = shingle_words(t)
        sets[i] = {tuple(w[k:k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            both, union = len(sets[a] & sets[b]), len(sets[a] | sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * union:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def checked(found):
    rows = found.collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    assert len({r.doc_id for r in rows}) == len(rows)
    return {r.doc_id: (r.n_shingles, r.component_id) for r in rows}


def cluster(seed, n, edits, words=120):
    """Copies of a base text, each with some words changed: many are alike, many are not."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits)):
            w[rng.randrange(words)] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("size", [4, 5])
def test_components_equal_all_pairs(spark, size):
    rng = random.Random(1)
    texts = [*TEXTS, *cluster(1, 60, 12), *cluster(2, 5, 3), *[" ".join(str(rng.randrange(50)) for _ in range(30)) for _ in range(40)]]
    texts += [texts[20]] * 5 + [texts[20].upper(), texts[20].replace(" ", "\n\t")]
    found = near_duplicates(documents(spark, texts), words=size, percent=80)
    assert checked(found) == reference(list(enumerate(texts, 1)), size)


def test_long_lists_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "SHORT_LIST", 4)
    monkeypatch.setattr(near_dup, "HUBS", 1)
    monkeypatch.setattr(near_dup, "BLOCK_SHINGLES", 2000)
    texts = cluster(3, 90, 14)
    assert checked(near_duplicates(documents(spark, texts), words=4)) == reference(list(enumerate(texts, 1)), 4)


def test_ids(spark):
    rows = [(3, "a b c d e f"), (3, "A b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (None, None), (-5, "z")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = sorted(tuple(r) for r in near_duplicates(docs, words=5).collect() if r.doc_id is not None)
    assert found == [(-5, 1, -5, True), (1, 2, 1, True), (3, 2, 1, False)]
    assert near_duplicates(docs).where("doc_id IS NULL AND kept AND component_id IS NULL").count() == 2
    kept = deduplicated(docs)
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, -5), (False, 1), (True, 0), (True, 0)]
    assert near_duplicates(docs.limit(0)).count() == 0 and deduplicated(docs.limit(0)).count() == 0


def test_columns_stay(spark):
    docs = documents(spark)
    kept = deduplicated(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 4, 5, 6, 8, 9, 10]


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (100, 102), (7, 3)], "a bigint, b bigint")
    found = {r.id: r.comp for r in components(links).collect()}
    assert found == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}


def test_shingle_sets_are_told_apart():
    sets = {"a b c": 1, "a b c d": 1, "a b c d e": 2, "a b c d a b c d": 4, "ab c d e": 1, "a bc d e": 1}
    assert {t: len(shingle_set(t, 4)) for t in sets} == sets
    assert len({int(shingle_set(t, 4)[0]) for t in ("ab c d e", "a bc d e", "a b c", "a b c d")}) == 4
    assert (shingle_set("X\x0by\u00a0z É", 4) == shingle_set("x y\u00a0z É", 4)).all()
