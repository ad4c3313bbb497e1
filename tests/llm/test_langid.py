"""Language identification: held-out accuracy, rejection, odd rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderflow.llm.common import id_remainder
from orderflow.llm.langid import cluster, fit_languages, gram_counts, keep_recognised, letters_only, predict_languages

from .helpers import docs


def test_gram_counts_match_a_plain_count():
    texts = [letters_only(t.encode()) for t in ("Hello, wörld 42!", "a", "", "x y")]
    got = gram_counts(texts, 256)
    for t, row in zip(texts, got, strict=True):
        assert row.sum() == sum(max(0, len(t) - w + 1) for w in (2, 3))
    alone = gram_counts(texts[:1], 256)
    assert (alone[0] == got[0]).all()


def test_clusters_are_unit_and_not_empty():
    rng = np.random.default_rng(1)
    v = np.abs(rng.normal(size=(50, 8)))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    c = cluster(v, 4)
    assert 1 <= len(c) <= 4 and np.allclose(np.linalg.norm(c, axis=1), 1)
    assert len(cluster(np.tile(v[:1], (5, 1)), 4)) == 1


def test_held_out_accuracy(spark):
    frame = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = fit_languages(frame, id_remainder("doc_id", 3) != 1)
    assert len(model.langs) > len(set(model.langs))  # several centroids a language
    found = predict_languages(frame, model).join(frame.select("doc_id", "lang"), "doc_id").where(id_remainder("doc_id", 3) == 1)
    share = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.min("score"), F.max("score")).first()
    assert share[0] > 0.97 and share[1] >= 0 and share[2] <= 1


def test_odd_rows(spark):
    train = spark.createDataFrame([(i, t, lang) for i in range(20) for t, lang in (("the cat and the dog sat there", "en"), ("der Hund und die Katze saßen dort", "de"))] + [(1, "x", None), (None, None, "en")], "doc_id long, text string, lang string")
    model = fit_languages(train)
    odd = docs(spark, [(1, None), (2, ""), (3, "12 34 !?"), (4, "the dog and the cat"), (4, "die Katze und der Hund"), (None, "the dog " * 30_000), (5, "ქართული ენა")])
    got = sorted((r.doc_id or 0, r.lang_pred, r.rejected) for r in predict_languages(odd, model).collect())
    assert got[:6] == [(0, "en", False), (1, "und", True), (2, "und", True), (3, "und", True), (4, "de", False), (4, "en", False)]
    assert got[6][2]  # no n-gram of it is known
    kept = keep_recognised(odd, model)
    assert kept.columns == odd.columns and kept.count() == 3
    empty = fit_languages(train.limit(0))
    assert {r.lang_pred for r in predict_languages(odd, empty).collect()} == {"und"}
    assert predict_languages(docs(spark, []), model).count() == 0


def test_no_language_is_left_out(spark):
    rows = [(i, f"words of language number {chr(97 + i % 26) * 9} {chr(97 + i // 26) * 9}", f"l{i}") for i in range(1_100)]
    model = fit_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string"), dims=64, centroids=1, max_rows=1)
    assert list(model.langs) == sorted(lang for _, _, lang in rows)
    assert model.centroids.shape == (64, 1_100) and len(model.radius) == 1_100


def plain_vector(text, idf, dims):
    """TF-IDF of one text without numpy's help."""
    grams = {}
    for width in (2, 3):
        for i in range(len(text) - width + 1):
            cell = ((int.from_bytes(text[i : i + width], "big") * 2654435761 + width * 0x9E3779B1) & 0xFFFFFFFF) >> (32 - (dims - 1).bit_length())
            grams[cell] = grams.get(cell, 0) + 1
    v = {c: math.log(1 + n) * float(idf[c]) for c, n in grams.items()}
    norm = math.sqrt(sum(x * x for x in v.values()))
    return {c: x / norm for c, x in v.items()}


def test_predictions_match_plain_cosines(spark):
    frame = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = fit_languages(frame)
    rows = frame.collect()
    found = {r.doc_id: r for r in predict_languages(frame, model).collect()}
    for r in rows[:120]:
        text = letters_only((r.text or "").encode())
        if not text:
            continue
        v = plain_vector(text, model.idf, len(model.idf))
        cosines = [sum(x * float(model.centroids[c, k]) for c, x in v.items()) for k in range(len(model.langs))]
        best = max(cosines)
        got = found[r.doc_id]
        assert abs(got.score - best) < 1e-4 and max(c for c, lang in zip(cosines, model.langs, strict=True) if lang == got.lang_pred) > best - 1e-4
        least = model.radius[model.langs.index(got.lang_pred)] * (0.5 + min(len(text), 200) / 400)
        assert got.rejected == (got.score < least) or abs(got.score - least) < 1e-4


def test_document_frequencies_count_all_rows(spark):
    frame = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("lang is not null")
    texts = [t for t in (letters_only((r.text or "").encode()) for r in frame.collect()) if t]
    df = np.zeros(64)
    for t in texts:
        df += gram_counts([t], 64)[0] > 0
    idf = fit_languages(frame, dims=64, max_rows=3).idf
    assert np.allclose(idf, np.log((1 + len(texts)) / (1 + df)) + 0.1, atol=1e-5)


@pytest.mark.parametrize("withheld", ["de", "en", "es", "fr"])
def test_a_withheld_language_is_rejected_and_learned_ones_are_not(spark, withheld):
    frame = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = fit_languages(frame, F.col("lang") != withheld)
    shares = {r.lang: r.share for r in predict_languages(frame, model).join(frame.select("doc_id", "lang"), "doc_id").groupBy("lang").agg(F.avg(F.col("rejected").cast("int")).alias("share")).collect()}
    assert shares.pop(withheld) >= 0.9
    assert max(shares.values()) <= 0.02


def test_rows_without_an_id_are_learned_and_copies_count_once(spark):
    rows = [(None, f"the cat {i} and the dog sat there", "en") for i in range(30)] + [(7, "der Hund und die Katze dort", "de")] * 500
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = fit_languages(frame, max_rows=20)
    assert set(model.langs) == {"de", "en"}
    again = fit_languages(frame.repartition(7), max_rows=20)
    assert np.allclose(model.centroids, again.centroids) and np.allclose(model.radius, again.radius)
