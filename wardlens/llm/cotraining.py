"""Quality classification by co-training on two views of a document.

One view is the text itself (shares of character classes, repetition, line structure), the other the
page's metadata (category and size columns). Each view has its own logistic classifier over binned
features. They start from the labels; in each round each labels all unlabelled documents that it is
sure of, at least `SURE`, for the other to learn from (Blum and Mitchell, "Combining labeled and
unlabeled data with co-training"). A document keeps the first label that a view is told. Every unlabelled
document takes part in every round: its features are staged once, and what it adds to a view's gradient and
Hessian is summed in Spark for each Newton step. Bins are quantiles over all documents. Afterwards each view is calibrated on labels it has not seen, and the
calibrated log-odds are combined by weights fitted there, into one probability for every document.

Labels for training are a sample of at most `sample` ids, those with the least hashes; documents with
other labels count as unlabelled. Of an id that occurs more than once, one row is learnt from. All documents are scored from their whole
texts. Null metadata is a category of its own, null text counts as empty. Labels that are null or name
no document are left out; a document labelled twice is good only if all its labels say so. Without both
kinds of labels nothing is rejected. Repeated rows stay; other columns are passed through unread.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlens.llm.staging import ship_package, staged, unused

SAMPLE = 8_000
ROUNDS = 5
NEWTON = 4
SURE = 0.97
META = ("lang", "source", "n_chars")
_QUANTILES = (0.02, 0.1, 0.3, 0.5, 0.7, 0.9, 0.95, 0.98)
_BUCKETS = 64

_CLASSES = [
    bytes(range(65, 91)), bytes(range(97, 123)), bytes(range(128, 256)), bytes(range(48, 58)), b" \t\n\r\x0b\x0c",
    b".,;:'\"-()", b"!?", b"%$#&*@^~", b"|/\\<>[]{}=_+`",
]


def text_features(text: bytes) -> list[float]:
    size = len(text) or 1
    words = text.split()
    n = len(words) or 1
    counts = Counter(words)
    lines = [line for line in text.split(b"\n") if line]
    return [
        *((len(text) - len(text.translate(None, c))) / size for c in _CLASSES),
        math.log2(1 + len(words)),
        sum(map(len, words)) / n,
        sum(map(eq, words, words[1:])) / n,
        len(counts) / n,
        max(counts.values(), default=0) / n,
        1 - len(set(lines)) / (len(lines) or 1),
        len(words) / (len(lines) or 1),
    ]


N_TEXT = len(_CLASSES) + 7


def meta_features(columns: list[list]) -> np.ndarray:
    """A bucket for each column: categories by hash, sizes by power of two; nulls apart."""
    out = np.empty((len(columns[0]) if columns else 0, len(columns)), np.int64)
    for c, values in enumerate(columns):
        for r, v in enumerate(values):
            if v is None:
                bucket = 0
            elif isinstance(v, str):
                bucket = 1 + zlib.crc32(v.encode()) % (_BUCKETS - 1)
            else:
                bucket = min(_BUCKETS - 1, 1 + int(math.log2(1 + abs(v)) * 2))
            out[r, c] = c * _BUCKETS + bucket
    return out


@dataclass
class View:
    """Logistic regression over indicator columns."""

    weights: np.ndarray
    bias: float = 0.0
    slope: float = 1.0
    shift: float = 0.0

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, width: int, steps: int = 150, rate: float = 1.0, penalty: float = 2.0) -> View:
        view = cls(np.zeros(width))
        seen, seen_bias, n = np.full(width, 1e-8), 1e-8, len(y)
        for _ in range(steps):
            error = (1 / (1 + np.exp(-view.raw(x))) - y) / n
            g = np.bincount(x.ravel(), weights=np.repeat(error, x.shape[1]), minlength=width) + penalty * view.weights / n
            seen += g**2
            seen_bias += error.sum() ** 2
            view.weights -= rate * g / np.sqrt(seen)
            view.bias -= rate * error.sum() / math.sqrt(seen_bias)
        return view

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.weights[x].sum(axis=1) + self.bias, -30, 30)

    def logit(self, x: np.ndarray) -> np.ndarray:
        """Calibrated log-odds."""
        return np.clip(self.slope * self.raw(x) + self.shift, -30, 30)


def _platt(columns: np.ndarray, y: np.ndarray, steps: int = 60, ridge: float = 1.0) -> np.ndarray:
    """Newton's method for a logistic fit of few columns with smoothed targets; the last weight is the shift."""
    x = np.column_stack([columns, np.ones(len(y))])
    good, bad = y.sum(), len(y) - y.sum()
    target = np.where(y > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = x.T @ (x * (p * (1 - p))[:, None]) + ridge * 1e-3 * np.eye(len(w))
        move = np.linalg.solve(hessian, x.T @ (p - target) + ridge * 1e-3 * w)
        w = w - np.clip(move, -2, 2)
    return w


@dataclass
class CoTrained:
    cuts: np.ndarray  # of the text features, by column
    text: View | None = None
    meta: View | None = None
    mix: np.ndarray | None = None

    def bins(self, x: np.ndarray) -> np.ndarray:
        # A share of zero stays apart from small ones.
        each = [np.searchsorted(self.cuts[c], x[:, c], side="left") for c in range(x.shape[1])]
        return np.stack(each, axis=1) + np.arange(x.shape[1]) * (len(_QUANTILES) + 1)

    def probability(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of good quality: by text, by metadata, combined."""
        if self.mix is None:
            ones = np.ones(len(text))
            return ones, ones, ones
        a, b = self.text.logit(self.bins(text)), self.meta.logit(meta)
        both = np.column_stack([a, b, np.ones(len(a))]) @ self.mix
        return tuple(1 / (1 + np.exp(-np.clip(z, -30, 30))) for z in (a, b, both))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-z))


def _sums(x: np.ndarray, y: np.ndarray, view: View) -> np.ndarray:
    """Gradient and Hessian of a view's loss over these rows, the bias last, end to end."""
    width = len(view.weights)
    out = np.zeros((width + 2, width + 1))
    for i in range(0, len(x), 4096):
        part = x[i : i + 4096]
        p = _sigmoid(view.raw(part))
        ones = np.zeros((len(part), width + 1))
        ones[np.arange(len(part))[:, None], part] = 1
        ones[:, width] = 1
        out[0] += ones.T @ (p - y[i : i + 4096])
        out[1:] += ones.T @ (ones * (p * (1 - p))[:, None])
    return out.ravel()


def told_sums(views: list[np.ndarray], history: list[list[View]], now: list[View]) -> np.ndarray:
    """Of unlabelled rows: how many each view was told, and its sums over them."""
    told, sums = [], []
    for v in (0, 1):
        y = np.full(len(views[v]), -1)
        for models in history:
            p = _sigmoid(models[1 - v].raw(views[1 - v]))
            y = np.where(y >= 0, y, np.where(p >= SURE, 1, np.where(1 - p >= SURE, 0, -1)))
        known = y >= 0
        told.append(known.sum())
        sums.append(_sums(views[v][known], y[known], now[v]))
    return np.concatenate([told, *sums])


def _cuts(text: np.ndarray) -> np.ndarray:
    return np.quantile(text, _QUANTILES, axis=0).T if len(text) else np.zeros((N_TEXT, len(_QUANTILES)))


def co_train(
    text: np.ndarray,
    meta: np.ndarray,
    label: np.ndarray,
    held: np.ndarray,
    rounds: int = ROUNDS,
    cuts: np.ndarray | None = None,
    pool: Callable[[CoTrained, list[list[View]], list[View]], np.ndarray] | None = None,
) -> CoTrained:
    """`label`: 1, 0, or -1 where there is none; `held`: labels kept for calibration.

    `pool` gives `told_sums` over further unlabelled rows, `cuts` the bins of all.
    """
    out = CoTrained(_cuts(text) if cuts is None else cuts)
    learn = (label >= 0) & ~held
    if len(set(label[learn].tolist())) < 2 or len(set(label[held & (label >= 0)].tolist())) < 2:
        return out
    views = [out.bins(text), meta]
    widths = [N_TEXT * (len(_QUANTILES) + 1), meta.shape[1] * _BUCKETS]
    free = [v[label < 0] for v in views]
    models = [View.fit(views[v][learn], label[learn].astype(float), widths[v]) for v in (0, 1)]
    history: list[list[View]] = []
    before = np.zeros(2)
    for _ in range(rounds):
        history.append(models)
        for step in range(NEWTON):
            sums = told_sums(free, history, models)
            if pool is not None:
                sums = sums + pool(out, history, models)
            if step == 0 and (sums[:2] == before).all():
                history.pop()
                break
            before, at, moved = sums[:2], 2, []
            for v in (0, 1):
                n = widths[v] + 1
                own = _sums(views[v][learn], label[learn], models[v]) + sums[at : at + n * (n + 1)]
                at += n * (n + 1)
                gradient, hessian = own[:n], own[n:].reshape(n, n)
                penalty = np.append(np.full(widths[v], 2.0), 1e-3)
                w = np.append(models[v].weights, models[v].bias)
                w = w - np.clip(np.linalg.solve(hessian + np.diag(penalty), gradient + penalty * w), -2, 2)
                moved.append(View(w[:-1], float(w[-1])))
            models = moved
        else:
            continue
        break
    fold = held & (label >= 0)
    for v in (0, 1):
        models[v].slope, models[v].shift = _platt(models[v].raw(views[v])[fold][:, None], label[fold])
    out.text, out.meta = models
    logits = np.column_stack([models[v].logit(views[v])[fold] for v in (0, 1)])
    out.mix = _platt(logits, label[fold])
    return out


def _features(batch: pa.RecordBatch, meta: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray]:
    at = batch.num_columns - 1 - len(meta)  # the views are the last columns
    text = [text_features((t.as_py() or "").encode()) for t in batch.column(at)]
    columns = [[v.as_py() for v in batch.column(at + 1 + i)] for i in range(len(meta))]
    return np.array(text, float).reshape(len(batch), N_TEXT), meta_features(columns).reshape(len(batch), len(meta))


def _views(text_col: str, meta: tuple[str, ...], docs: DataFrame) -> list:
    kinds = dict(docs.dtypes)
    size = ("int", "bigint", "smallint", "tinyint", "double", "float")
    names = unused(docs, "view_text", *(f"view_meta{i}" for i in range(len(meta))))
    return [
        F.col(text_col).cast("string").alias(names[0]),
        *(F.col(c).cast("double" if kinds[c] in size else "string").alias(n) for n, c in zip(names[1:], meta)),
    ]


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    meta: tuple[str, ...] = META,
    label_id: str = "doc_id",
    label_col: str = "quality",
    sample: int = SAMPLE,
) -> CoTrained:
    ship_package(docs.sparkSession)
    known = (
        labels.filter(F.col(label_col).isNotNull() & F.col(label_id).isNotNull())
        .groupBy(F.col(label_id).cast("long").alias("__id"))
        .agg(F.min(F.col(label_col).cast("int")).alias("__label"))
    )
    by_hash = [F.xxhash64("__id"), "__id"]
    picked = staged(known.orderBy(*by_hash).limit(sample), "quality-labels")

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            text, m = _features(batch, meta)
            yield pa.record_batch(
                [batch.column(0), pa.array(list(text), pa.list_(pa.float64())), pa.array(list(m), pa.list_(pa.int64()))],
                names=["id", "text", "meta"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), *_views(text_col, meta, docs))
    rows = staged(rows.mapInArrow(batches, "id long, text array<double>, meta array<bigint>"), "quality-features")
    cuts = rows.agg(
        *(F.percentile_approx(F.col("text")[c], F.array(*map(F.lit, _QUANTILES)), F.lit(10_000)) for c in range(N_TEXT))
    ).first()
    cuts = None if cuts[0] is None else np.array([list(c) for c in cuts])
    # One row per label, however often its id occurs: at most `sample` rows of fixed width.
    found = (
        rows.join(F.broadcast(picked), F.col("id") == F.col("__id"))
        .groupBy("id", F.col("__label").alias("label"))
        .agg(F.min(F.struct("text", "meta")).alias("least"))
        .select("label", (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(4)) == 0).alias("held"), "least.text", "least.meta")
        .toArrow()
    )
    # Documents whose label is beyond the sample take part as unlabelled ones.
    free = rows.join(F.broadcast(picked), F.col("id") == F.col("__id"), "left_anti").select("text", "meta")
    free = staged(free, "quality-unlabelled")

    def pool(model: CoTrained, history: list[list[View]], now: list[View]) -> np.ndarray:
        n = 2 + sum((len(v.weights) + 1) * (len(v.weights) + 2) for v in now)

        def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros(n)
            for batch in it:
                text = batch.column(0).flatten().to_numpy().reshape(len(batch), N_TEXT)
                m = batch.column(1).flatten().to_numpy().reshape(len(batch), len(meta))
                sums += told_sums([model.bins(text), m], history, now)
            at = np.flatnonzero(sums)
            yield pa.record_batch([pa.array(at), pa.array(sums[at])], names=["at", "value"])

        added = free.mapInArrow(batches, "at long, value double").groupBy("at").agg(F.sum("value").alias("value")).toArrow()
        out = np.zeros(n)
        out[added.column("at").to_numpy()] = added.column("value").to_numpy()
        return out

    n = found.num_rows
    return co_train(
        np.array(found.column("text").to_pylist(), float).reshape(n, N_TEXT),
        np.array(found.column("meta").to_pylist(), np.int64).reshape(n, len(meta)),
        np.array(found.column("label").to_pylist(), np.int64),
        np.array(found.column("held").to_pylist(), bool),
        cuts=cuts,
        pool=pool,
    )


def score_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", meta: tuple[str, ...] = META, **options
) -> DataFrame:
    """A row per document: doc_id, p_text, p_meta, quality (combined), keep."""
    model = fit(docs, labels, id_col, text_col, meta, **options)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            a, b, both = model.probability(*_features(batch, meta))
            yield pa.record_batch(
                [batch.column(0), pa.array(a), pa.array(b), pa.array(both), pa.array(both >= 0.5)],
                names=["doc_id", "p_text", "p_meta", "quality", "keep"],
            )

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), *_views(text_col, meta, docs))
    return picked.mapInArrow(batches, "doc_id long, p_text double, p_meta double, quality double, keep boolean")


def drop_low_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", meta: tuple[str, ...] = META, **options
) -> DataFrame:
    """The documents that are not rejected, with all their columns."""
    model = fit(docs, labels, id_col, text_col, meta, **options)
    width = len(docs.columns)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            keep = pa.array(model.probability(*_features(batch, meta))[2] >= 0.5)
            own = pa.record_batch(batch.columns[:width], names=batch.schema.names[:width])
            yield own.filter(keep)

    marked = docs.select("*", *_views(text_col, meta, docs))
    return marked.mapInArrow(batches, T.StructType(docs.schema.fields))
