import os
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from rows import docs

from logweir.llm.quality import FEATURES, accepted, features, fit, quality_scores
from logweir.llm.queries import op1_quality

SF = "/root/testdata/sf0.01"
LABELS = "doc_id bigint, quality int, toxic int"


def corpus():
    good = "Some words of a sentence, in order. Then others follow number {}.\n"
    bad = "BUY!! BUY!! ### *** word{} word word word word !!!"
    rows = [(i, (bad if i % 4 == 0 else good).format(i) * (1 + i % 5)) for i in range(160)]
    labels = [(i, 0 if i % 4 == 0 else 1, 0) for i in range(120)]
    return rows, labels


def test_features_have_one_length_and_are_finite():
    for text in [b"", b" \n", b"a", b"|", b"\xff\xfe", "é漢 字\n\n".encode(), b"x " * 5000, b"aaa"]:
        x = features(text)
        assert len(x) == FEATURES and np.isfinite(x).all()


def test_ranking_and_cut():
    draw = np.random.default_rng(0)
    y = np.r_[np.zeros(50, int), np.ones(250, int)]
    x = draw.standard_normal((300, 3)) + 4 * y[:, None]
    model = fit(x, y)
    strength = x @ model["weights"] - model["shift"]
    assert ((strength > 0) == (y == 1)).mean() > 0.98
    assert (strength < 0).sum() == 50  # the quantile at the share of label 0
    assert fit(x[:50], y[:50]) is None


def test_defined_results(spark):
    rows, labels = corpus()
    odd = [(200, None), (201, ""), (202, "x y " * 20000), (None, "Some words."), (5, rows[5][1])]
    labels += [(None, 0, 0), (300, 1, 0), (7, None, 0), (8, 1, 0), (8, 1, 0)]
    label_rows = spark.createDataFrame(labels, LABELS)
    df = docs(spark, rows + odd, clashes=True)
    found = quality_scores(df, label_rows).collect()
    assert len(found) == len(rows + odd)
    for r in found:
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    # Document 8 is labelled both ways and moves the quantile by one.
    wrong = [r for r in found if r.doc_id is not None and r.doc_id < 160]
    wrong = [r for r in wrong if r.predicted != (r.doc_id % 4 != 0)]
    assert len(wrong) <= 2
    scores = {r.doc_id: r.score for r in found}
    assert scores[200] == scores[201]
    kept = accepted(df, label_rows)
    assert kept.columns == df.columns
    assert kept.count() == sum(r.predicted for r in found)


def test_held_out_labels_change_nothing(spark):
    rows, labels = corpus()
    df = docs(spark, rows)
    turned = [
        (i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q, t) for i, q, t in labels
    ]
    a, b = (
        sorted(map(tuple, quality_scores(df, spark.createDataFrame(x, LABELS)).collect()))
        for x in (labels, turned)
    )
    assert a == b


def test_without_both_classes_or_rows(spark):
    rows, labels = corpus()
    one = spark.createDataFrame([x for x in labels if x[1] == 1], LABELS)
    assert {r.score for r in quality_scores(docs(spark, rows), one).collect()} == {0.5}
    none = spark.createDataFrame([], LABELS)
    assert accepted(docs(spark, rows), none).count() == len(rows)
    assert quality_scores(docs(spark, []), one).collect() == []


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not at hand")
def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    found = op1_quality(spark, SF).where("held_out").join(labels, "doc_id")
    right, total = found.select(
        F.sum((F.col("quality") == F.col("predicted")).cast("int")), F.count("*")
    ).first()
    assert right / total > 0.95
