import zlib

import numpy as np
import pytest

from rosterflow.llm import language_id, quality
from rosterflow.llm.common import table
from tests.conftest import SF
from tests.llm.helpers import TEXTS, documents


def fold(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def test_languages_on_held_out_documents(spark):
    docs = table(spark, SF, "documents")
    truth = {r.doc_id: r.lang for r in docs.collect()}
    rows = language_id.languages(docs).collect()
    assert len(rows) == len(truth) and all(r.held_out == (fold(r.doc_id, 3) == 1) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)


def test_language_edges(spark):
    docs = documents(spark)
    rows = {r.doc_id: r for r in language_id.languages(docs.drop("score")).collect()}
    assert [(rows[i].lang_pred, rows[i].score) for i in (1, 2, 3, 4)] == [("und", 0.0)] * 4
    assert all(rows[i].lang_pred in ("en", "de") for i in (5, 6, 7, 8, 9, 10))
    assert language_id.languages(docs.limit(0)).count() == 0
    unlabelled = language_id.languages(docs.selectExpr("doc_id", "text", "cast(null as string) lang"))
    assert {r.lang_pred for r in unlabelled.collect()} == {"und"}


def test_word_first_then_shorter_grams():
    rows = [(0, "a", "known", 5), (0, "b", "other", 5), (2, "b", "xy", 9), (1, "a", "x", 9), (1, "b", "q", 1)]
    totals = {(k, lang): (10, 2) for k in range(6) for lang in "ab"}
    identify = language_id.Identifier(language_id.Model.of(rows, totals))
    assert identify("known")[0] == "a" and identify("other")[0] == "b"
    assert identify("Xyz")[0] == "b"  # the two-character n-gram comes before the one-character one
    assert identify("zx")[0] == "a" and identify("known known other")[0] == "a"
    assert identify("ß")[1] == 0.5  # nothing known: all languages alike, the first one is named
    assert identify("²½ 1") == ("und", 0.0)


def test_quality_on_held_out_labels(spark):
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    rows = quality.quality_scores(table(spark, SF, "documents"), table(spark, SF, "labels")).collect()
    assert all(r.held_out == (fold(r.doc_id, 5) == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out and labels.get(r.doc_id) is not None]
    assert sum(r.predicted == labels[r.doc_id] for r in held) >= 0.9 * len(held)


def test_quality_edges(spark):
    docs = documents(spark)
    labels = spark.createDataFrame([(i, i % 2, "x") for i in range(1, 11)] + [(1, 0, "x"), (None, 1, "x"), (2, None, "x")],
                                   "doc_id bigint, quality int, text string")
    rows = quality.quality_scores(docs, labels).collect()
    assert len(rows) == len(TEXTS) and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in quality.quality_scores(docs, labels.limit(0)).collect()} == {0.5}
    one = quality.add_quality(docs, quality.fit(docs, labels.where("quality = 1")), "extra")
    assert {r.extra for r in one.collect()} == {0.5} and one.columns == [*docs.columns, "extra"]
    assert quality.quality_scores(docs.limit(0), labels).count() == 0


def test_logistic_fit():
    x = np.stack([np.linspace(-1, 1, 400), np.ones(400)], axis=1)
    y = (np.random.default_rng(0).random(400) < 1 / (1 + np.exp(-(3 * x[:, 0] + 0.5)))).astype(float)
    slope, shift = quality.logistic(x, y)
    assert 2 < slope < 4 and 0 < shift < 1
