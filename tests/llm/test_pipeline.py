"""Each stage of the pipeline on what the one before kept, against plain Python."""

import os

import pytest
from test_simhash import by_definition, reachable

import corpus_pipeline
from logweir.llm import secret_scan

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not at hand")


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    made = [docs.collect()]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, SF)
        if i < 4:
            assert docs.columns == COLUMNS
        docs.write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        made.append(docs.collect())
    whole, good, single, clean, copies, sequences = made
    by_id = {r.doc_id: r for r in whole}

    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert all(by_id[r.doc_id] == r for r in good)
    kept = {r.doc_id for r in good}
    right = sum((i in kept) == bool(q) for i, q in labels.items())
    assert right / len(labels) > 0.97

    good.sort(key=lambda r: r.doc_id)
    low = reachable([by_definition(r.text) for r in good], 4)
    assert sorted(r.doc_id for r in single) == sorted({good[i].doc_id for i in low})
    assert all(by_id[r.doc_id] == r for r in single)

    assert len(clean) == len(single)
    for r in clean:
        before = by_id[r.doc_id]
        if r.text != before.text:
            assert r.text.count("[SECRET]") and secret_scan.candidates(before.text)
            assert r.n_chars == len(r.text)
    cleaned = {r.doc_id: r for r in clean}
    assert copies and all(cleaned[r.doc_id] == r for r in copies)

    tokens = {}
    for r in sequences:
        tokens.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sum(r.piece == 0 for r in sequences) == len(copies)
    total = sum(r.length for r in sequences)
    assert len(tokens) <= -(-total // 4096) + 1


def test_empty_documents(spark, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
