import numpy as np
from pyspark.sql import functions as F

from logweir.llm.ann import CollisionIndex, nearest

VECTORS = "vec_id bigint, embedding array<float>, score double, rank int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1.0, 2) for i, v in rows], VECTORS)


def by_definition(rows, k):
    good = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            v = [float(np.float32(x)) for x in v]
            good[i] = min(good.get(i, v), v)
    result = {}
    for q, x in good.items():
        if q % 5 == 0:
            near = sorted(
                (float(np.sqrt(((np.array(v) - np.array(x)) ** 2).sum())), i)
                for i, v in good.items()
                if i != q and len(v) == len(x)
            )
            result[q] = near[:k]
    return result


def check(spark, rows, k=10, **options):
    found = {}
    for r in nearest(table(spark, rows), F.col("vec_id") % 5 == 0, k, **options).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.score, r.vec_id))
    expected = {q: near for q, near in by_definition(rows, k).items() if near}
    assert found.keys() == expected.keys()
    hits = total = 0
    for q, near in expected.items():
        got = sorted(found[q])
        assert [rank for rank, _, _ in got] == list(range(1, len(near) + 1))
        assert [(s, i) for _, s, i in got] == sorted((s, i) for _, s, i in got)
        hits += len({i for _, _, i in got} & {i for _, i in near})
        total += len(near)
    return hits / total if total else 1.0


def test_recall_against_brute_force(spark):
    draw = np.random.default_rng(0)
    centres = draw.standard_normal((12, 32))
    rows = [
        (i, (centres[i % 12] + 0.4 * draw.standard_normal(32)).astype(np.float32).tolist())
        for i in range(1500)
    ]
    assert check(spark, rows) >= 0.99
    assert check(spark, rows, shard_rows=40) >= 0.99


def test_unusual_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, float(i % 3), 0.5]) for i in range(40)]  # many ties
    rows += [(100, None), (105, []), (110, [0.0, 0.0, 0.0]), (115, [nan, 1.0, 1.0])]
    rows += [(120, [inf, 1.0, 1.0]), (125, [None, 1.0, 1.0]), (None, [1.0, 1.0, 1.0])]
    rows += [(5, rows[5][1]), (10, [9.0, 9.0, 9.0]), (130, [1.0, 2.0]), (131, [2.0, 2.0])]
    rows += [(135, [1e30, 1e30, 1.0]), (140, [1.0])]
    assert check(spark, rows) == 1.0
    assert check(spark, rows[:3]) == 1.0
    assert check(spark, []) == 1.0


def test_share_of_verified_vectors():
    """On clustered vectors few are verified; every query's neighbours are the true ones."""
    class Counting(CollisionIndex):
        verified = 0

        def distances(self, query, which):
            found = super().distances(query, which)
            self.verified += len(found)
            return found

    draw = np.random.default_rng(2)
    centres = draw.standard_normal((200, 64))
    rows = centres[draw.integers(0, 200, 8000)] + 0.1 * draw.standard_normal((8000, 64))
    index = Counting(np.arange(8000), rows, 40, 0.6)
    index.verified, hits, queries = 0, 0, range(0, 8000, 200)
    for i in queries:
        found, _ = index.search(int(index.ids[i]), index.rows[i], 10)
        exact = np.linalg.norm(index.rows - index.rows[i], axis=1)
        exact[i] = np.inf
        hits += len(set(found) & set(index.ids[np.argsort(exact)[:10]]))
    assert hits >= 0.95 * 10 * len(queries)
    assert index.verified < 0.05 * 8000 * len(queries)
