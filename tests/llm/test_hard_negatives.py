import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from logweir.llm.hard_negatives import SuffixIndex, hard_negatives, shifted

VECTORS = "vec_id bigint, embedding array<double>, label int"
LOW, HIGH = -(2**63), 2**63 - 1


def brute_force(rows, divisor=50):
    kept = {}
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or not vector:
            continue
        if any(x is None or not math.isfinite(x) for x in vector):
            continue
        ints = [min(max(math.floor(256 * x), LOW), HIGH) for x in vector]
        row = (label, ints)
        kept[vec_id] = min(kept.get(vec_id, row), row)
    by_dim = defaultdict(list)
    for vec_id, (label, ints) in kept.items():
        by_dim[len(ints)].append((vec_id, label, ints))
    out = []
    for group in by_dim.values():
        for anchor, label, ints in group:
            if anchor % divisor:
                continue
            scored = [
                (-min(max(sum(a * b for a, b in zip(ints, v)), LOW), HIGH), i, other)
                for i, other, v in group
                if i != anchor
            ]
            positives = sorted(s[:2] for s in scored if s[2] == label)[:5]
            others = sorted(s[:2] for s in scored if s[2] != label)
            for p, positive in positives:
                fits = [(n, i) for n, i in others if 50 * -p <= 100 * -n <= 95 * -p][:3]
                out += [(anchor, positive, r + 1, i, -p, -n) for r, (n, i) in enumerate(fits)]
    return sorted(out)


def _got(spark, rows, divisor=50, **options):
    table = spark.createDataFrame(rows, VECTORS)
    found = hard_negatives(table, F.col("vec_id") % divisor == 0, **options)
    assert found.columns == [
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score",
    ]
    return sorted(map(tuple, found.collect()))


@pytest.mark.parametrize("spread", [0.0, 0.3, 1.0])
def test_random_vectors(spark, spread):
    draw = np.random.default_rng(7)
    centres = draw.standard_normal((6, 20)) * (1 - spread)
    rows = []
    for i in range(900):
        vector = (centres[i % 6] + spread * draw.standard_normal(20)) * draw.choice([0.01, 0.2, 1.0])
        rows.append((i, [float(x) for x in vector], int(draw.integers(0, 5))))
    assert _got(spark, rows, shard_rows=60) == brute_force(rows)


def test_few_rows_ties_and_negative_scores(spark):
    rows = [(i, [1.0, 0.0] if i % 3 else [-1.0, 0.5], i % 2) for i in range(40)]
    assert _got(spark, rows, 5) == brute_force(rows, 5)
    lonely = [(0, [1.0], 0), (1, [1.0], 0), (2, [0.6], 1), (50, [0.0], 1)]
    assert _got(spark, lonely) == brute_force(lonely)


def test_special_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.5], 1), (0, [0.9, 0.5], 1), (0, [5.0, 5.0], 2), (None, [1.0, 1.0], 1),
        (1, [1.0, 0.4], None), (2, None, 1), (3, [], 1), (4, [1.0, None], 1), (5, [nan, 1.0], 1),
        (6, [inf, 1.0], 1), (7, [1.0, 0.4], 1), (7, [1.0, 0.4], 1), (8, [0.5, 0.5], 0),
        (9, [0.6, 0.1], 3), (10, [0.5, 0.5, 1.0], 0), (11, [1.0, 2.0, 3.0], 1),
        (100, [0.0, 0.0], 1), (150, [1e300, -1e300], 1), (151, [1e17, 1.0], 1), (152, [1e14, 3.0], 2),
    ]
    assert _got(spark, rows) == brute_force(rows)


def test_empty_table_and_other_columns(spark):
    assert _got(spark, []) == []
    rows = [(i, [float(i % 4), 1.0], i % 3) for i in range(60)]
    table = spark.createDataFrame(rows, VECTORS)
    clashing = table.withColumns(
        {c: F.lit("z") for c in ("shard", "dim", "pool", "kind", "v", "x", "p", "windows", "n")}
    )
    found = hard_negatives(clashing, F.col("vec_id") % 50 == 0)
    assert sorted(map(tuple, found.collect())) == brute_force(rows)


def test_shifted(spark):
    table = spark.createDataFrame([(7, [1.0], 9), (8, [1.0], 9), (14, [1.0], None)], VECTORS)
    assert {r.vec_id: r.label for r in shifted(table).collect()} == {7: 0, 8: 9, 14: None}


def test_a_search_verifies_a_part_of_clustered_rows():
    """The bounds prune: few exact scores are needed where vectors have near neighbours."""
    draw = np.random.default_rng(1)
    centres = draw.standard_normal((50, 64))
    rows = np.floor(256 * (centres[draw.integers(0, 50, 5000)] + 0.2 * draw.standard_normal((5000, 64))))
    index = SuffixIndex(np.arange(5000), np.zeros(5000, int), rows.astype(np.int64))
    verified = []

    def full(i, places, scores, threshold):
        return (scores >= threshold).sum() >= 6

    for query, (places, scores) in zip(rows[:40], index.join(rows[:40].astype(np.int64), full)):
        verified.append(len(places))
        exact = np.sort(rows @ query)[::-1][:6]
        assert (np.sort(scores)[::-1][:6] == exact).all()
    assert np.mean(verified) < 500
