"""Toxicity by cumulative-link ordinal regression on sparse text features.

Grades 0 (clean) to 3 come from the labels: a toxic document's grade is the third, among toxic ones, of
its number of different telling words, those at least `TELLING` times as frequent in toxic documents.
The model has one weight a feature, shared by all thresholds, and ordered thresholds t1 < t2 < t3:

    P(grade <= k | x) = 1 / (1 + exp(w.x - t_{k+1}))

It is fitted by proximal gradient steps with an L1 penalty, so few features keep a weight. Features are
a text's words in lower case and the first four letters of longer ones, present or not, if at least
`MIN_DOCS` documents of the sample have them and their number among toxic ones is `SIGMAS` standard
deviations from what chance gives. The sample is the `sample` labelled documents with the
least hash of their id, a bound that does not grow with the table; every text is scored whole.

Returned are the expected grade, the most likely one and whether a grade above 0 is likelier than not.
Null texts count as empty; labels that are null or name no document are left out; without both kinds of
labels every document is clean. A document labelled twice counts as toxic if any label says so.
Repeated rows stay. Only the id and text columns are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlens.llm.staging import ship_package
from wardlens.llm.tiling import words_of

SAMPLE = 8_000
MIN_DOCS = 4
TELLING = 8.0
SIGMAS = 4.0
GRADES = 4


def features_of(text: str | None) -> set[bytes]:
    words = set(words_of(text))
    return words | {b"^" + w[:4] for w in words if len(w) > 4}


@dataclass
class OrdinalModel:
    thresholds: np.ndarray
    weights: dict[bytes, float] = field(default_factory=dict)

    def probabilities(self, score: np.ndarray) -> np.ndarray:
        """Probability of each grade, by row."""
        below = 1 / (1 + np.exp(np.clip(score[:, None] - self.thresholds[None, :], -60, 60)))
        ends = np.concatenate([np.zeros((len(score), 1)), below, np.ones((len(score), 1))], axis=1)
        return np.maximum(np.diff(ends, axis=1), 0)

    def score(self, texts: list[str | None]) -> np.ndarray:
        weight, known = self.weights, self.weights.keys()
        return np.array([sum(weight[f] for f in known & features_of(t)) for t in texts])


def grades(documents: list[set[bytes]], toxic: np.ndarray) -> np.ndarray:
    seen = [Counter(), Counter()]
    for features, t in zip(documents, toxic):
        seen[int(t)].update(f for f in features if f[:1] != b"^")
    n_toxic, n_clean = max(1, int(toxic.sum())), max(1, int((~toxic).sum()))
    telling = {
        f for f, n in seen[1].items() if n >= MIN_DOCS and n / n_toxic >= TELLING * (seen[0][f] + 0.5) / n_clean
    }
    counts = np.array([len(telling & d) for d in documents])
    cuts = np.quantile(counts[toxic], [1 / 3, 2 / 3]) if toxic.any() else [0, 0]
    return np.where(toxic, 1 + (counts > cuts[0]) + (counts > cuts[1]), 0)


def fit(documents: list[set[bytes]], toxic: np.ndarray, steps: int = 300, rate: float = 1.0, penalty: float = 5e-5) -> OrdinalModel:
    if not toxic.any() or toxic.all():
        return OrdinalModel(np.full(GRADES - 1, 50.0))
    grade = grades(documents, toxic)
    spread = Counter(f for d in documents for f in d)
    in_toxic = Counter(f for d, t in zip(documents, toxic) if t for f in d)
    base = toxic.mean()
    names = sorted(
        f
        for f, n in spread.items()
        if n >= MIN_DOCS and abs(in_toxic[f] - n * base) >= SIGMAS * (n * base * (1 - base)) ** 0.5
    )
    number = {f: i for i, f in enumerate(names)}
    rows = [sorted(number[f] for f in d if f in number) for d in documents]
    column = np.fromiter((i for r in rows for i in r), np.int64)
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    n, every = len(rows), np.arange(len(rows))
    share = np.clip(np.cumsum(np.bincount(grade, minlength=GRADES))[:-1] / n, 0.001, 0.999)
    thresholds = np.maximum.accumulate(np.log(share / (1 - share)) + 1e-3 * np.arange(GRADES - 1))
    w, seen = np.zeros(len(names)), np.full(len(names), 1e-8)
    seen_t = np.full(GRADES - 1, 1e-8)
    for _ in range(steps):
        score = np.bincount(row, weights=w[column], minlength=n)
        ends = np.concatenate([np.full((n, 1), -60.0), np.clip(thresholds - score[:, None], -60, 60), np.full((n, 1), 60.0)], axis=1)
        level = 1 / (1 + np.exp(-ends))
        slope = level * (1 - level)
        p = np.maximum(level[every, grade + 1] - level[every, grade], 1e-12)
        up, down = slope[every, grade + 1] / p, slope[every, grade] / p
        gradient = np.bincount(column, weights=((up - down) / n)[row], minlength=len(names))
        to_threshold = np.zeros(GRADES + 1)
        np.add.at(to_threshold, grade + 1, -up / n)
        np.add.at(to_threshold, grade, down / n)
        seen += gradient**2
        step = rate / np.sqrt(seen)
        w = w - step * gradient
        w = np.sign(w) * np.maximum(np.abs(w) - step * penalty, 0)
        g = to_threshold[1:-1]
        seen_t += g**2
        thresholds = np.maximum.accumulate(thresholds - rate * g / np.sqrt(seen_t) + 1e-6 * np.arange(GRADES - 1))
    return OrdinalModel(thresholds, {names[i]: float(w[i]) for i in np.flatnonzero(w)})


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int, id_col: str, text_col: str, label_id: str, label_col: str) -> list:
    """At most `sample` labels, with their documents' texts' features."""
    picked = (
        labels.filter(F.col(label_col).isNotNull() & F.col(label_id).isNotNull())
        .groupBy(F.col(label_id).cast("long").alias("labelled_id"))
        .agg(F.max(F.col(label_col).cast("int")).alias("label"))
        .orderBy(F.xxhash64("labelled_id"), "labelled_id")
        .limit(sample)
    )
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            found = [list(features_of(t.as_py())) for t in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(found, pa.list_(pa.binary()))], names=["label", "features"])

    # At most `sample` ids, so every task may have all of them; and one row for each, however often it occurs.
    joined = texts.join(F.broadcast(picked), F.col("doc_id") == F.col("labelled_id"))
    one = joined.groupBy("doc_id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    rows = one.select("label", "text").mapInArrow(batches, "label int, features array<binary>").toArrow()
    return [(label, set(features)) for label, features in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist())]


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_id: str = "doc_id",
    label_col: str = "toxic",
    sample: int = SAMPLE,
    model: OrdinalModel | None = None,
) -> DataFrame:
    """A row per document: doc_id, expected_severity, grade, p_toxic, toxic."""
    ship_package(docs.sparkSession)
    if model is None:
        rows = labelled_sample(docs, labels, sample, id_col, text_col, label_id, label_col)
        model = fit([r[1] for r in rows], np.array([r[0] > 0 for r in rows], bool))

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            p = model.probabilities(model.score(batch.column(1).to_pylist()))
            yield pa.record_batch(
                [
                    batch.column(0),
                    pa.array(p @ np.arange(GRADES)),
                    pa.array(p.argmax(axis=1).astype(np.int32)),
                    pa.array(1 - p[:, 0]),
                    pa.array(p[:, 0] < 0.5),
                ],
                names=["doc_id", "expected_severity", "grade", "p_toxic", "toxic"],
            )

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return picked.mapInArrow(batches, "doc_id long, expected_severity double, grade int, p_toxic double, toxic boolean")
