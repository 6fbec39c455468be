"""Cumulative-link regression: gradient, order of grades, held-out accuracy."""

import math
import os
import random
import re

import numpy as np
import pytest

from tessera.llm import toxicity as T

SF = "/root/testdata/sf0.1"


def test_fit_orders_grades():
    rng = np.random.default_rng(1)
    weight = np.array([1.5, -1.0, 2.5, 0.0])
    rows = [sorted(np.nonzero(rng.random(4) < 0.5)[0].tolist()) for _ in range(4000)]
    score = np.array([weight[r].sum() for r in rows])
    grades = (score[:, None] + rng.logistic(size=(4000, 1)) > np.array([0.5, 2.0, 3.5])[None, :]).sum(1)
    w, cuts = T.fit_ordinal(rows, grades, 4, np.ones(4000), l2=0.0)
    assert np.all(np.diff(cuts) > 0)
    assert np.abs(w - weight).max() < 0.35 and np.abs(cuts - [0.5, 2.0, 3.5]).max() < 0.35


def test_probabilities_fall_and_severity_is_their_sum(spark):
    model = T.OrdinalModel({"scum": 0, "scu~": 1}, np.array([4.0, 0.5]), np.array([2.0, 3.0, 5.0]))
    p = model.at_least("You SCUM!")
    assert list(p) == sorted(p, reverse=True)
    df = spark.createDataFrame([(1, "You SCUM!", 9)], "doc_id long, text string, severity int")
    r = T.score(df, model).first()
    assert r.severity == pytest.approx(p.sum()) and r.p_toxic == pytest.approx(p[0]) and r.toxic


def test_grades_from_doses():
    rows = [[0], [], [0, 1, 2], [0, 1], [3]]
    grades = T.dose_grades(rows, np.array([1, 0, 1, 1, 0]), np.array([True, True, True, False]))
    assert grades.tolist() == [1, 0, 3, 2, 0]
    assert T.dose_grades([[0], [0]], np.array([1, 1]), np.array([True])).tolist() == [1, 1]


def _plain_score(text, model):
    """Severity by the definition: expected grade over all grades, features found by a regular expression."""
    found = set()
    for w in re.findall(r"[a-z\u0080-\U0010ffff]+", (text or "").lower()):
        found |= {w} | {w[:n] + "~" for n in (4, 5) if len(w.encode()) > n}
    x = sum(model.weights[model.vocabulary[f]] for f in found if f in model.vocabulary)
    below = [1 / (1 + math.exp(-(c - x))) for c in model.cuts] + [1.0]
    p = [b - a for a, b in zip([0.0, *below], below)]
    return sum(k * v for k, v in enumerate(p)), 1 - p[0] if len(p) > 1 else 0.0


def test_scores_match_plain_python(spark):
    docs, labels = _tables(spark)
    model = T.fit(docs, labels)
    assert len(model.cuts) > 1 and len(model.vocabulary) > 3
    text = {}
    for r in docs.collect():
        text.setdefault(r.doc_id, r.text)
    for r in T.score(docs, model).collect():
        severity, p = _plain_score(text[r.doc_id], model)
        assert r.severity == pytest.approx(severity, abs=1e-9) and r.p_toxic == pytest.approx(p, abs=1e-9) and r.toxic == (p >= 0.5)


def test_fit_is_where_the_likelihood_is_flat():
    """The gradient of the penalised likelihood, by differences, at what the fit returns."""
    rng = np.random.default_rng(2)
    rows = [sorted(np.nonzero(rng.random(3) < 0.5)[0].tolist()) for _ in range(300)]
    grades = np.minimum(2, rng.integers(0, 2, 300) + np.array([len(r) > 1 for r in rows]))
    w, cuts = T.fit_ordinal(rows, grades, 3, np.ones(300), steps=4000)

    def loss(theta):
        total = 0.0
        for r, g in zip(rows, grades):
            x = sum(theta[i] for i in r)
            below = [0.0, *(1 / (1 + math.exp(-(c - x))) for c in theta[3:]), 1.0]
            total -= math.log(below[g + 1] - below[g]) / 300
        return total + 1e-3 / 300 * 10 / 2 * sum(v * v for v in theta[:3])

    at = np.concatenate([w, cuts])
    for i in range(5):
        step = np.eye(5)[i] * 1e-4
        assert abs(loss(at + step) - loss(at - step)) / 2e-4 < 2e-3


def _tables(spark, n=400):
    rng = random.Random(7)
    words = ["w%s" % "".join(rng.choices("abcdefgh", k=4)) for _ in range(80)]
    docs, labels = [], []
    for i in range(n):
        body = [rng.choice(words) for _ in range(rng.randrange(5, 120))]
        if i % 4 == 0:
            for _ in range(rng.randrange(1, 5)):
                body.insert(rng.randrange(len(body)), rng.choice(["vilex", "vilexes", "grossy"]))
        docs.append((i, " ".join(body), "e"))
        if i % 3:
            labels.append((i, 1, int(i % 4 == 0)))
    docs += [(None, "wxx vilex", "e"), (1000, None, "e"), (1001, "", "e"), (1002, "waaaa " * 60_000 + "vilex", "e"), (4, docs[4][1], "e")]
    labels += [(None, 1, 1), (1, 1, None), (2000, 1, 1)]
    return (spark.createDataFrame(docs, "doc_id long, text string, toxic string"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_learns_words_and_leaves_clean_documents(spark):
    docs, labels = _tables(spark)
    got = T.score(docs, T.fit(docs, labels)).collect()
    assert len(got) == docs.count()
    for r in got:
        if r.doc_id is not None and r.doc_id < 1000:
            assert r.toxic == (r.doc_id % 4 == 0), r
    by_id = {r.doc_id: r for r in got}
    assert by_id[1002].toxic and by_id[None].toxic and not by_id[1000].toxic and not by_id[1001].toxic
    kept = T.without_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(
        r.doc_id for r in got if not r.toxic and r.doc_id is not None)


def test_no_labels_no_documents(spark):
    docs, labels = _tables(spark, 20)
    assert not any(r.toxic for r in T.score(docs, T.fit(docs, labels.limit(0))).collect())
    assert T.score(docs.limit(0), T.fit(docs.limit(0), labels)).collect() == []


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_held_out_labels(spark):
    """Fitted on two thirds of the labels, judged on the rest."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = T.fit(docs, labels.where("doc_id % 3 <> 0"))
    truth = {r.doc_id: r.toxic for r in labels.where("doc_id % 3 = 0").collect()}
    got = [r for r in T.score(docs, model).collect() if r.doc_id in truth]
    caught = [r.toxic for r in got if truth[r.doc_id] == 1]
    false = [r.toxic for r in got if truth[r.doc_id] == 0]
    assert np.mean(caught) > 0.85 and np.mean(false) < 0.01
