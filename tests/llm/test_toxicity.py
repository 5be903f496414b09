from __future__ import annotations

import numpy as np
import pytest

from wardlens.llm.queries import QUERIES
from wardlens.llm.toxicity import OrdinalModel, features_of, fit, grades, labelled_sample, score_toxicity

LABELS = "doc_id long, toxic int"


def test_probabilities_come_from_one_score_and_ordered_thresholds():
    model = OrdinalModel(np.array([-1.0, 0.5, 2.0]))
    score = np.linspace(-6, 6, 50)
    p = model.probabilities(score)
    assert p.sum(axis=1) == pytest.approx(1)
    below = 1 / (1 + np.exp(score[:, None] - model.thresholds))
    assert np.cumsum(p, axis=1)[:, :3] == pytest.approx(below)
    assert (np.diff(p @ np.arange(4)) > 0).all()


def made(n, seed=3):
    rng = np.random.default_rng(seed)
    bad = [f"insult{i}" for i in range(6)]
    docs, toxic = [], []
    for i in range(n):
        words = [f"w{rng.integers(400)}" for _ in range(60)]
        t = i % 5 == 0
        if t:
            words += list(rng.choice(bad, rng.integers(1, 6), replace=False))
        docs.append(" ".join(words))
        toxic.append(t)
    return docs, np.array(toxic)


def test_held_out_accuracy_and_severity_by_number_of_insults():
    docs, toxic = made(1500)
    model = fit([features_of(d) for d in docs[:1000]], toxic[:1000])
    p = model.probabilities(model.score(docs[1000:]))
    assert ((p[:, 0] < 0.5) == toxic[1000:]).mean() > 0.99
    one, many = model.probabilities(model.score(["w1 insult0", "w1 insult0 insult1 insult2 insult3 insult4"])) @ np.arange(4)
    assert 0.5 < one < many
    assert (np.diff(model.thresholds) > 0).all()


def test_grades_split_toxic_documents_by_telling_words():
    docs, toxic = made(600)
    g = grades([features_of(d) for d in docs], toxic)
    assert (g[~toxic] == 0).all() and set(g[toxic]) == {1, 2, 3}


def test_query_on_labelled_documents(spark, small_docs):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = score_toxicity(docs, labels).join(labels.withColumnRenamed("toxic", "label"), "doc_id").collect()
    caught = [r.toxic for r in rows if r.label]
    assert sum(caught) / len(caught) > 0.65  # 51 toxic examples in four languages
    assert not any(r.toxic for r in rows if not r.label)


def test_edge_cases(spark, make_docs):
    docs = make_docs([(1, None), (2, ""), (3, "x " * 200_000), (None, "a"), (4, "b"), (4, "b")])
    docs = docs.withColumnsRenamed({"lang": "toxic", "source": "grade"})
    for labels in ([], [(1, 0), (2, 0)], [(1, None), (None, 1), (77, 1)]):
        rows = score_toxicity(docs, spark.createDataFrame(labels, LABELS)).collect()
        assert len(rows) == 6 and not any(r.toxic for r in rows)
    assert score_toxicity(make_docs([]), spark.createDataFrame([(1, 1), (2, 0)], LABELS)).count() == 0


def test_query_equals_plain_code(spark):
    """Features, grades and fit once more over collected rows, without Spark."""
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    known = {}
    for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect():
        if r.toxic is not None and r.doc_id in docs:
            known[r.doc_id] = max(r.toxic, known.get(r.doc_id, 0))
    model = fit([set(features_of(docs[i])) for i in known], np.array([known[i] > 0 for i in known]))
    p = model.probabilities(model.score(list(docs.values())))
    got = {r.doc_id: r for r in QUERIES["op5_toxicity"](spark, "/root/testdata/sf0.01").collect()}
    assert set(got) == set(docs)
    for i, row in zip(docs, p):
        r = got[i]
        assert (r.expected_severity, r.p_toxic) == pytest.approx((row @ np.arange(4), 1 - row[0]), abs=1e-6)
        assert r.toxic == (row[0] < 0.5) and (r.grade == row.argmax() or abs(row[r.grade] - row.max()) < 1e-6)


def test_an_id_that_repeats_is_learnt_from_once(spark, make_docs):
    docs = make_docs([(1, "b a"), (1, "b a"), (1, "c d"), (2, "e f"), (None, "g")])
    found = labelled_sample(docs, spark.createDataFrame([(1, 1), (2, 0)], LABELS), 10, "doc_id", "text", "doc_id", "toxic")
    assert sorted(label for label, _ in found) == [0, 1]
