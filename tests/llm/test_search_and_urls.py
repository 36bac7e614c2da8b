import math
import random

import numpy as np
import pytest

from rosterflow.llm.license_scan import KNOWN, MIT, known_licences, license_scan
from rosterflow.llm.url_filter import url_verdicts
from rosterflow.llm.vector_search import Pivots, search_chunk, top_k

SCHEMA = "vec_id bigint, embedding array<float>, score int, v string"


def brute(rows, k, step):
    vectors = {}
    for i, e, *_ in rows:
        if i is None or e is None or any(x is None or not math.isfinite(x) for x in e):
            continue
        v = [math.floor(256 * float(np.float32(x))) for x in e]
        vectors[i] = min(vectors.get(i, v), v)
    out = []
    for q in vectors:
        if q % step == 0:
            scored = sorted((-sum(a * b for a, b in zip(vectors[q], vectors[c])), c) for c in vectors if c != q)[:k]
            out += [(q, n + 1, c, -s) for n, (s, c) in enumerate(scored)]
    return sorted(out)


@pytest.mark.parametrize("n,dim", [(0, 3), (1, 3), (3, 3), (400, 8)])
def test_top_k_is_exact(spark, n, dim):
    rng = random.Random(n)
    rows = [(i, [rng.gauss(0, 1) for _ in range(dim)], 1, "x") for i in range(n)]
    if n > 100:
        rows += [(1000 + i, rows[7][1], 1, "x") for i in range(60)]  # copies: ties
        rows += [(10, rows[10][1], 2, "y"), (11, [9.0] * dim, 1, None), (None, [1.0] * dim, 1, "x"), (2000, None, 1, "x")]
        rows += [(2001, [1.0, None], 1, "x"), (2002, [float("nan")], 1, "x"), (2003, [float("inf")], 1, "x"), (2004, [0.5], 1, "x"),
                 (2050, [], 1, "x"), (2100, [0.0] * dim, 1, "x"), (2150, [1e6] * dim, 1, "x")]
    found = top_k(spark.createDataFrame(rows, SCHEMA), k=5, query_step=10)
    assert sorted(tuple(r) for r in found.select("query_id", "rank", "vec_id", "score").collect()) == brute(rows, 5, 10)


def test_annuli_are_skipped():
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.integers(-5, 5, (500, 4)), rng.integers(-5, 5, (500, 4)) + 1000])
    p = Pivots.choose(x, float((x * x).sum(axis=1).max()), 2)
    d = p.distances(p.lifted(x))[:, 0]
    order = np.argsort(d, kind="stable")
    best = search_chunk(p, 0, x[900:901], np.array([-np.inf]), x[order], d[order], order, 3)
    assert sorted(best.score[0]) == sorted((x @ x[900]).astype(float))[-3:]


def test_url_rules(spark):
    rules = spark.createDataFrame(
        [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
         ("net", "/", "block"), (None, "/", "block"), ("x.org", "", "block"), ("y.org", "/a", "block"), ("org", "/a/bc", "allow")],
        "host string, path string, verdict string")
    urls = {
        "http://a.example.NET/en/1?q#f": ("a.example.net", "/en/1", "example.net/en/", "allow"),
        "http://example.net/EN/": ("example.net", "/EN/", "net/", "block"),
        "http://example.net": ("example.net", "", None, "allow"),
        "http://notexample.com/de/": ("notexample.com", "/de/", None, "allow"),
        "https://m.example.com/de/?x": ("m.example.com", "/de/", "example.com/de/", "block"),
        "http://example.com?/de/": ("example.com", "", None, "allow"),
        "x://b.x.org": ("b.x.org", "", "x.org", "block"),
        "x://y.org/abc://z": ("y.org", "/abc://z", "y.org/a", "block"),
        "no scheme": ("", "", None, "allow"), "": ("", "", None, "allow"), None: ("", "", None, "allow"),
        "http://" + "a." * 3000 + "net/" + "x/" * 3000: ("a." * 3000 + "net", "/" + "x/" * 3000, "net/", "block"),
    }
    pages = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate([*urls, None])],
                                  "page_id bigint, url string, host string, rule string")
    found = {r.page_id: tuple(r)[1:] for r in url_verdicts(pages, rules).collect()}
    assert found == dict(enumerate([*urls.values(), ("", "", None, "allow")]))
    assert url_verdicts(pages.limit(0), rules).count() == 0
    assert {r.verdict for r in url_verdicts(pages, rules.limit(0), "block").collect()} == {"block"}


def test_licences(spark):
    texts = [None, "", "Copyright (c) 2020 Somebody\n\n" + MIT.upper().replace("\n", "  "), "x\nreleased UNDER the mit licence!\ny",
             "Released under the MIT License. Really", "Licensed under CC BY-NC 4.0.\r\nLicensed under CC BY NC 4.0\nReleased under the MIT License.",
             "Copyright only", MIT + " more"]
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate([*texts, texts[2]])],
                                 "doc_id bigint, text string, licence string, row string")
    found = {}
    for r in license_scan(docs, known_licences(spark)).collect():
        found[r.doc_id] = (r.text_licence, r.line_licences, r.n_lines)
    assert found == {0: (None, "", 0), 1: (None, "", 0), 2: ("MIT", "", 0), 3: (None, "MIT", 1), 4: (None, "", 0),
                     5: (None, "CC-BY-NC-4.0,MIT", 3), 6: (None, "", 0), 7: (None, "", 0), 8: ("MIT", "", 0)}
    assert license_scan(docs.limit(0), known_licences(spark)).count() == 0
    empty = spark.createDataFrame([(None, "line", "x"), ("A", "line", None), ("A", "line", "!!")], "licence string, unit string, text string")
    assert {r.n_lines for r in license_scan(docs, empty).collect()} == {0}
    assert all(text and unit in ("document", "line") for _, unit, text in KNOWN)
