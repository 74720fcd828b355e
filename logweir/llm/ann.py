"""Nearest neighbours by collision-counting hashing.

Every vector is projected on `projections` random directions, and each projection is kept as a
sorted array. A query opens a window around its own projection in each array. Virtual rehashing
widens all windows level by level; only the newly reached ends are counted. A vector that has
collided in at least `threshold` of the arrays is verified by its exact distance. A query ends
when its k-th verified distance is within the radius the windows stand for, as a vector nearer
than that has, but for a small chance, collided often enough.

The vectors are dealt by id into shards of about `shard_rows`, each an index of its own, built
and held by one task. A shard's queries follow its vectors in the same sorted stream, so any
number of queries passes through one batch at a time. Each shard returns k candidates a query, of
which the k nearest remain.

Defined results: rows whose id is null, or whose vector is null, empty, zero or holds null or
non-finite components, take no part. Of rows with one id the smallest vector counts, once.
Vectors are compared with those of their own dimension. Ties go to the smaller id. Columns other
than id and vector are not read; an empty table gives an empty result.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

WIDTH = 2.7  # of a window, in radii: a vector one radius away collides with chance 0.82
GROWTH = 1.5


class CollisionIndex:
    """Sorted projections of the vectors of one shard."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, projections: int, share: float) -> None:
        order = np.lexsort([*rows.T[::-1], ids])
        ids, rows = ids[order], rows[order]
        first = np.r_[True, ids[1:] != ids[:-1]]
        self.ids, self.rows = ids[first], np.ascontiguousarray(rows[first])
        draw = np.random.default_rng(5)
        self.directions = draw.standard_normal((rows.shape[1], projections))
        projected = (self.rows @ self.directions).T
        self.order = projected.argsort(axis=1, kind="stable")
        self.sorted = np.take_along_axis(projected, self.order, axis=1)
        self.threshold = int(np.ceil(share * projections))
        self.start = self._first_radius()

    def _first_radius(self) -> float:
        """Half of the usual nearest distance, from a few vectors; any positive value is right."""
        found = []
        for at in np.linspace(0, len(self.rows) - 1, min(16, len(self.rows))).astype(int):
            distance = self.distances(self.rows[at], slice(None))
            distance = distance[distance > 0]
            if len(distance):
                found.append(distance.min())
        return 0.5 * float(np.median(found)) if found else 1.0

    def distances(self, query: np.ndarray, which) -> np.ndarray:
        return np.sqrt(((self.rows[which] - query) ** 2).sum(axis=1))

    def search(self, own: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and distances of the k nearest but the query itself, nearest first."""
        n, m = len(self.ids), len(self.sorted)
        centre = query @ self.directions
        low = [row.searchsorted(c) for row, c in zip(self.sorted, centre)]
        high = list(low)
        counts = np.zeros(n, np.int64)
        verified = self.ids == own
        best_ids, best = np.empty(0, self.ids.dtype), np.empty(0)
        radius = self.start
        while True:
            reached = []
            for j in range(m):
                a = self.sorted[j].searchsorted(centre[j] - WIDTH / 2 * radius, "left")
                b = self.sorted[j].searchsorted(centre[j] + WIDTH / 2 * radius, "right")
                reached += [self.order[j, min(a, low[j]) : low[j]], self.order[j, high[j] : b]]
                low[j], high[j] = min(a, low[j]), max(b, high[j])
            counts += np.bincount(np.concatenate(reached), minlength=n)
            new = np.flatnonzero((counts >= self.threshold) & ~verified)
            if len(new):
                verified[new] = True
                best_ids = np.concatenate([best_ids, self.ids[new]])
                best = np.concatenate([best, self.distances(query, new)])
                order = np.lexsort([best_ids, best])[:k]
                best_ids, best = best_ids[order], best[order]
            if len(best) == k and best[-1] <= radius or verified.all():
                return best_ids, best
            radius *= GROWTH


def usable(vector: Column) -> Column:
    """Whether a vector takes part."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def nearest(
    vectors: DataFrame,
    queries: Column,
    k: int = 10,
    projections: int = 40,
    share: float = 0.6,
    shard_rows: int = 100_000,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id, score (distance); `queries` picks the query rows by `vec_id`."""
    rows = vectors.select(
        F.col(id_col).cast("bigint").alias("vec_id"),
        F.col(vector_col).cast("array<double>").alias("v"),
    ).where(F.col("vec_id").isNotNull() & usable(F.col("v")))
    spark = vectors.sparkSession
    shards = max(-(-rows.count() // shard_rows), spark.sparkContext.defaultParallelism)
    dealt = rows.select(
        F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(shards)).cast("int").alias("shard"),
        F.size("v").alias("dim"),
        F.lit(0).alias("kind"),
        "vec_id",
        "v",
    )
    asked = rows.where(queries).groupBy("vec_id").agg(F.min("v").alias("v"))
    asked = asked.select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
        F.size("v").alias("dim"),
        F.lit(1).alias("kind"),
        "vec_id",
        "v",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, index = None, None
        ids: list[np.ndarray] = []
        held: list[np.ndarray] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            shard, dim, kind, vec = (batch.column(c).to_numpy() for c in ("shard", "dim", "kind", "vec_id"))
            vectors_, offsets = batch.column("v"), batch.column("v").offsets.to_numpy()
            values = vectors_.values.to_numpy()
            parts = np.stack([shard, dim, kind])
            cuts = np.flatnonzero((parts[:, 1:] != parts[:, :-1]).any(axis=0)) + 1
            found = []
            for s, e in zip(np.r_[0, cuts], np.r_[cuts, batch.num_rows]):
                if key != (shard[s], dim[s]):
                    key, index, ids, held = (shard[s], dim[s]), None, [], []
                matrix = values[offsets[s] : offsets[e]].reshape(e - s, dim[s])
                if kind[s] == 0:
                    ids.append(vec[s:e].copy())
                    held.append(matrix.copy())
                    continue
                if index is None and held:
                    index = CollisionIndex(
                        np.concatenate(ids), np.concatenate(held), projections, share
                    )
                    ids, held = [], []
                if index is not None:
                    found += [(q, *index.search(q, x, k)) for q, x in zip(vec[s:e], matrix)]
            if found:
                queries_, near, score = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(np.array(queries_), [len(x) for x in near])),
                        pa.array(np.concatenate(near)),
                        pa.array(np.concatenate(score)),
                    ],
                    ["query_id", "vec_id", "score"],
                )

    candidates = (
        dealt.unionByName(asked)
        .repartition("shard")
        .sortWithinPartitions("shard", "dim", "kind")
        .mapInArrow(run, "query_id bigint, vec_id bigint, score double")
    )
    place = F.row_number().over(W.partitionBy("query_id").orderBy("score", "vec_id"))
    return (
        candidates.withColumn("rank", place)
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
