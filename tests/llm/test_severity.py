"""Ordinal regression: ordered grades are learned, odd rows are harmless."""

import math
import random

import numpy as np

from orderflow.llm.severity import fit_cumulative_link, fit_severity, keep_clean, label_grades, score_severity, word_features

from .helpers import SF, by_id, docs


def corpus(n=400):
    rng = random.Random(2)
    rows, grades = [], []
    for i in range(n):
        grade = i % 4 if i % 3 == 0 else 0
        text = [f"w{rng.randrange(300)}" for _ in range(rng.randint(5, 60))]
        text += rng.sample(["vilest", "awful", "rotten", "nasty", "hateful", "wretched"], 2 * grade)
        rng.shuffle(text)
        rows.append((i, " ".join(text)))
        grades.append((i, grade))
    return rows, grades


def test_grades_are_ordered_and_learned(spark):
    rows, grades = corpus()
    frame, labels = docs(spark, rows), spark.createDataFrame(grades, "doc_id long, grade int")
    model = fit_severity(frame, labels)
    assert len(model.thresholds) == 3 and list(model.thresholds) == sorted(model.thresholds)
    got = by_id(score_severity(frame, model))
    assert np.mean([got[i].grade == g for i, g in grades]) > 0.95
    mean = [np.mean([got[i].severity for i, g in grades if g == k]) for k in range(4)]
    assert mean == sorted(mean)
    kept = keep_clean(frame, model)
    assert kept.columns == frame.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if not r.rejected}


def test_fit_lowers_the_loss_and_keeps_the_order():
    rng = np.random.default_rng(0)
    x = rng.random((300, 2)) * 4
    grades = (x[:, 0] > 1).astype(int) + (x[:, 0] > 2.5)
    r, c = np.repeat(np.arange(300), 2), np.tile([0, 1], 300)
    w, theta = fit_cumulative_link(r, c, x.ravel(), grades, 2, l1=0.01)
    assert w[0] > 3 * w[1] >= 0 and theta[0] < theta[1]


def test_odd_rows_and_missing_labels(spark):
    rows, grades = corpus()
    frame, labels = docs(spark, rows), spark.createDataFrame([*grades, (None, 2), (3, None), (9999, 1)], "doc_id long, grade int")
    model = fit_severity(frame, labels)
    odd = docs(spark, [(1, None), (2, ""), (None, "vilest awful rotten nasty hateful wretched"), (4, "VILEST! awful, rotten " + "w1 " * 50_000), (4, "fine")])
    got = score_severity(odd, model).collect()
    assert sorted((r.doc_id or 0, r.rejected) for r in got) == [(0, True), (1, False), (2, False), (4, False), (4, True)]
    none = fit_severity(frame, labels.limit(0))
    assert {r.grade for r in score_severity(frame, none).collect()} == {0}
    assert score_severity(docs(spark, []), model).count() == 0 and keep_clean(docs(spark, []), model).count() == 0


def test_label_grades(spark):
    rows = [(1, 1, 0), (2, 0, 1), (3, 1, 1), (4, None, 1), (5, 0, None)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    assert sorted(map(tuple, label_grades(labels).collect())) == [(1, 0), (2, 2), (3, 1), (4, 1)]
    assert label_grades(spark.read.parquet(f"{SF}/labels.parquet")).count() > 0


def test_grades_follow_from_the_thresholds(spark):
    """Scores against sums by hand: chances, expected grade and grade."""
    rows, grades = corpus()
    model = fit_severity(docs(spark, rows), spark.createDataFrame(grades, "doc_id long, grade int"))
    got = by_id(score_severity(docs(spark, rows), model))
    for i, text in rows:
        z = sum(model.weights.get(f, 0.0) for w in set(text.encode().split()) for f in word_features(w))
        above = [1 / (1 + math.exp(t - z)) for t in model.thresholds]
        assert abs(got[i].severity - sum(above)) < 1e-9 and abs(got[i].p_toxic - above[0]) < 1e-9
        assert got[i].grade == sum(z >= t for t in model.thresholds) and got[i].rejected == (got[i].p_toxic >= 0.5)


def test_fit_matches_plain_gradient_descent():
    """The proximal fit reaches the loss of a plain, slow descent."""
    rng = np.random.default_rng(4)
    x = (rng.random((200, 4)) < 0.4).astype(float)
    z = x @ [2.0, 1.0, 0.0, 0.0] + rng.normal(scale=0.7, size=200)
    grades = (z > 1).astype(int) + (z > 2.2)
    above = (grades[:, None] >= np.arange(1, 3)).astype(float)

    def loss(w, theta):
        m = (x @ w)[:, None] - theta
        return float(np.sum(np.logaddexp(0, m) - above * m) + 0.1 * w.sum())

    w, theta = np.zeros(4), np.zeros(2)
    for _ in range(30_000):
        error = 1 / (1 + np.exp(theta - (x @ w)[:, None])) - above
        w = np.maximum(w - 0.003 * (x.T @ error.sum(axis=1) + 0.1), 0)
        theta = theta + 0.003 * error.sum(axis=0)
    r, c = np.nonzero(x)
    fast, cuts = fit_cumulative_link(r, c, x[r, c], grades, 4, l1=0.1)
    assert abs(loss(fast, cuts) - loss(w, theta)) < 1e-3
    assert np.allclose(fast, w, atol=1e-2) and np.allclose(cuts, theta, atol=1e-2)


def test_a_repeated_id_counts_once(spark):
    rows, grades = corpus()
    labels = spark.createDataFrame(grades, "doc_id long, grade int")
    again = docs(spark, rows + [rows[5]] * 300 + [(9, "zzz later text")])
    assert fit_severity(again, labels) == fit_severity(docs(spark, rows), labels)
