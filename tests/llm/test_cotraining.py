from __future__ import annotations

import numpy as np
import pytest

from wardlens.llm.cotraining import (
    META,
    N_TEXT,
    CoTrained,
    co_train,
    drop_low_quality,
    meta_features,
    score_quality,
    text_features,
)
from wardlens.llm.queries import QUERIES

LABELS = "doc_id long, quality int"


def test_text_features_by_hand():
    f = text_features(b"AB ab\nab ab!")
    assert len(f) == N_TEXT
    assert f[0] == pytest.approx(2 / 12) and f[1] == pytest.approx(6 / 12)
    assert f[-5] == pytest.approx(1 / 4)  # ab ab over the line break
    assert f[-4] == pytest.approx(3 / 4) and f[-2] == 0 and f[-1] == 2
    assert all(np.isfinite(text_features(b""))) and all(np.isfinite(text_features(b" \n")))


def test_metadata_buckets_keep_nulls_apart():
    m = meta_features([["a", None, "a"], [0.0, 100.0, None]])
    assert m[0, 0] == m[2, 0] != m[1, 0] == 0
    assert len(set(m[:, 1])) == 3 and m[:, 1].min() >= 64


def test_each_view_teaches_the_other():
    """Few labels, two independent views of the same truth: the rounds must help."""
    rng = np.random.default_rng(0)
    n = 3000
    y = rng.integers(0, 2, n)
    text = rng.normal(size=(n, N_TEXT))
    text[:, :5] += 1.4 * y[:, None]
    meta = np.stack([c * 64 + np.where(rng.random(n) < 0.88, y, 1 - y) * 10 + rng.integers(0, 5, n) for c in range(3)], axis=1)
    label = np.where(np.arange(n) < 80, y, -1)
    held = np.arange(n) % 4 == 0
    alone = co_train(text, meta, label, held, rounds=0)
    taught = co_train(text, meta, label, held, rounds=8)
    fresh = np.arange(n) >= 80

    def right(model):
        return ((model.probability(text, meta)[2] >= 0.5) == y)[fresh].mean()

    assert right(taught) > 0.9 and right(taught) >= right(alone) - 0.005


def test_held_out_accuracy_on_the_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    half = labels.filter("doc_id % 2 = 0")
    rows = score_quality(docs, half).join(labels.filter("doc_id % 2 = 1"), "doc_id").select("keep", labels.quality.alias("y")).collect()
    assert sum(r.keep == bool(r.y) for r in rows) / len(rows) > 0.93
    kept_good = [r.keep for r in rows if r.y]
    assert sum(kept_good) / len(kept_good) > 0.98


def test_edge_cases(spark, make_docs):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "a", "en", "s", 1), (3, "x " * 200_000, "en", "s", None), (3, "b", "en", "s", 1)]
    docs = make_docs(rows)
    for labels in ([], [(1, 1), (2, 1)], [(1, None), (None, 0), (99, 0)], [(1, 0), (2, 1)]):
        table = spark.createDataFrame(labels, LABELS)
        got = score_quality(docs, table).collect()
        assert len(got) == 5 and all(0 <= r.quality <= 1 for r in got)
        kept = drop_low_quality(docs, table)
        assert kept.columns == docs.columns and kept.count() == sum(r.keep for r in got)
    assert score_quality(make_docs([]), spark.createDataFrame([], LABELS)).count() == 0
    clash = docs.withColumn("keep", docs.lang).withColumn("quality", docs.source)
    assert drop_low_quality(clash, spark.createDataFrame([], LABELS)).columns == clash.columns
    assert META == ("lang", "source", "n_chars")


def test_query_equals_plain_code(spark):
    """Bins, rounds and calibration once more over collected rows, without Spark."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = sorted(docs.collect())
    text = np.array([text_features((r.text or "").encode()) for r in rows])
    meta = meta_features([[r[c] for r in rows] for c in META])
    known = {}
    for r in labels.collect():
        if r.quality is not None:
            known[r.doc_id] = min(r.quality, known.get(r.doc_id, 1))
    ids = spark.createDataFrame([(r.doc_id,) for r in rows], "id long").selectExpr("id", "pmod(xxhash64(id, 1), 4) = 0 AS held")
    held = {r.id: r.held for r in ids.collect()}
    ordered = np.sort(text, axis=0)
    at = [max(0, int(np.ceil(q * len(rows))) - 1) for q in (0.02, 0.1, 0.3, 0.5, 0.7, 0.9, 0.95, 0.98)]
    model = co_train(
        text, meta, np.array([known.get(r.doc_id, -1) for r in rows]), np.array([held[r.doc_id] for r in rows]), cuts=ordered[at].T
    )
    expected = np.column_stack(model.probability(text, meta))
    got = QUERIES["op2_quality_classifier"](spark, "/root/testdata/sf0.01").orderBy("doc_id").collect()
    assert [r.doc_id for r in got] == [r.doc_id for r in rows]
    assert np.array([[r.p_text, r.p_meta, r.quality] for r in got]) == pytest.approx(expected, abs=1e-6)
    assert [r.keep for r in got] == (expected[:, 2] >= 0.5).tolist()


def test_repeated_ids_and_labels_beyond_the_sample(spark, make_docs, monkeypatch):
    from wardlens.llm import cotraining

    seen = []
    monkeypatch.setattr(cotraining, "co_train", lambda text, meta, label, held, pool, **_: seen.append((len(label), pool)) or CoTrained(np.zeros((N_TEXT, 8))))
    rows = [(i % 50, f"text number {i}", "en", "s", i) for i in range(200)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], LABELS)
    cotraining.fit(make_docs(rows), labels, sample=30)
    n, pool = seen[0]
    assert n == 30  # one row of four for each label
    free = [c.cell_contents for c in pool.__closure__ if hasattr(c.cell_contents, "count")]
    assert free[0].count() == 20 * 4  # ten labelled ids beyond the sample, ten without a label


def test_every_unlabelled_document_takes_part(spark, make_docs, monkeypatch):
    from wardlens.llm import cotraining

    seen = []
    real = cotraining.co_train

    def spy(*args, pool, **options):
        def counted(*a):
            seen.append(pool(*a)[:2])
            return pool(*a)

        return real(*args, pool=counted, **options)

    monkeypatch.setattr(cotraining, "co_train", spy)
    good, bad = "A plain and even sentence of words, number {}.", "$$$ || {} @@@ %%% ### !!! ~~~"
    rows = [(i, (good if i % 2 else bad).format(i) * 3, "en", "ab"[i % 2], 50 + 900 * (i % 2)) for i in range(9500)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], LABELS)
    cotraining.fit(make_docs(rows), labels)
    assert seen and seen[-1].tolist() == [9100, 9100]
