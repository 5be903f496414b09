"""The pipeline against plain code, stage by stage, each on its predecessor's rows."""

from __future__ import annotations

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.test_simhash import plain_fingerprint, plain_groups
from tests.llm.test_tiling import plain_tiles
from wardlens.llm.tiling import words_of

SF = "/root/testdata/sf0.001"


def kept_by_quality(spark, docs):
    from wardlens.llm.cotraining import score_quality

    good = {r.doc_id for r in score_quality(docs, spark.read.parquet(f"{SF}/labels.parquet")).filter("keep").collect()}
    return {r.doc_id: r.text for r in docs.collect() if r.doc_id in good}


def kept_by_exact(docs):
    last = {}
    for i, t in docs.items():
        key = "".join(c.lower() if c.isascii() else c for c in t or "")
        last[key] = max(last.get(key, i), i)
    return {i: docs[i] for i in last.values()}


def kept_by_simhash(docs):
    rows = [(i, plain_fingerprint(t, 4)) for i, t in docs.items()]
    return {i: docs[i] for i in set(plain_groups(rows, 4))}


def kept_by_tiling(docs, items):
    def covered(text, item):
        known = {w: k for k, w in enumerate(dict.fromkeys(item))}
        doc, seeds = words_of(text), {tuple(item[i : i + 5]) for i in range(len(item) - 4)}
        if not any(tuple(doc[i : i + 5]) in seeds for i in range(len(doc) - 4)):
            return False
        return sum(plain_tiles([known[w] for w in item], [known.get(w, -1) for w in doc], 5)) >= 0.5 * len(item)

    return {i: t for i, t in docs.items() if not any(covered(t, item) for item in items)}


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        from wardlens.llm.staging import staged

        out.append(staged(stage(spark, out[-1], SF), "test-stage"))
    return out


def test_stages_equal_plain_code(spark, stages):
    def rows(df):
        return {r.doc_id: r.text for r in df.collect()}

    assert all(s.columns == stages[0].columns for s in stages[:-1])
    docs = kept_by_quality(spark, stages[0])
    assert rows(stages[1]) == docs and 0 < len(docs) < stages[0].count()
    docs = kept_by_exact(docs)
    assert rows(stages[2]) == docs
    docs = kept_by_simhash(docs)
    assert rows(stages[3]) == docs
    items = [words_of(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    docs = kept_by_tiling(docs, items)
    assert rows(stages[4]) == docs
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = {r.doc_id: (r.ids, r.n_tokens) for r in stages[5].collect()}
    assert set(got) == set(docs)
    for i, t in docs.items():
        ids = library.encode(t, add_special_tokens=False).ids
        assert got[i] == (ids, len(ids))


def test_run_applies_them_all(spark, stages):
    got = {(r.doc_id, tuple(r.ids)) for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == {(r.doc_id, tuple(r.ids)) for r in stages[-1].collect()}


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns
        assert stage(spark, docs, SF).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == 0


def test_columns_with_the_names_of_helpers(spark):
    names = ["view_text", "view_meta0", "hit_id", "hit_hash", "own_digest", "kept_id", "gone_id", "several_id", "fp", "doc"]
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id < 60")
    more = docs.selectExpr("*", *(f"'x' AS {n}" for n in names))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, more, SF)
        assert got.columns == more.columns
        assert {r.doc_id for r in got.collect()} == {r.doc_id for r in stage(spark, docs, SF).collect()}


def test_five_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "exact dedup", "SimHash near-dedup", "benchmark decontamination", "BPE encoding",
    ]
