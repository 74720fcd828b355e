"""Hard negatives by threshold joins with suffix-norm bounds (after L2AP).

The vectors are dealt by id into shards of about `shard_rows`, each an inverted index held by one
task. The dimensions of a shard are ordered by their energy and cut into groups; a posting list
holds one group's values of those rows that are indexed that far. For a threshold, a row's
trailing dimensions are left out as long as their norm times the query's stays below it: they
alone cannot reach the threshold. A search adds up partial scores over the postings, drops rows
whose partial score and product of the remaining norms stay below the threshold, and takes the
exact integer score of the rest. If the windows are not full yet the threshold is lowered: the
posting lists grow by the dimensions that are no longer covered, and the partial scores go on from
where they were. The last threshold is below any score, so a search always ends exactly.

Two such joins give the result. The first fills one window per anchor, the best rows of its label,
in shards that hold one label. The second fills one window per positive, the best rows of other
labels between two shares of the positive's score. Shards return what each window can use at most,
the best of all shards remain. Rows and queries come in one sorted stream, rows first, so that
any number of queries passes a batch at a time.

Defined results: rows of a null id, of a null label, of a null or empty vector, or with a null or
non-finite component take no part. Of rows with one id that of the smallest label, then vector,
counts, once. Only vectors of the same dimension have a score. Scores beyond the range of 64 bits
end at its limits. A shift of labels is the query's, not the operator's. Other columns are not
read. An empty table gives an empty result.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logweir.sources.staging import stage

#: Dimensions of a posting list, share by which a threshold is lowered, share of the greatest
#: possible score below which the next threshold is under any score, queries side by side.
GROUP = 8
LOWER = 0.75
LEAST = 0.001
BLOCK = 64
_EXACT = 2.0**53


class SuffixIndex:
    """Posting lists of the rows of one shard that grow while the threshold is lowered."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray) -> None:
        order = np.argsort(-(rows.astype(np.float64) ** 2).sum(axis=0), kind="stable")
        self.ids, self.labels, self.exact_rows = ids, labels, rows
        self.order, self.rows = order, rows[:, order].astype(np.float64)
        self.groups = range(0, rows.shape[1], GROUP)
        self.norms = self._suffix_norms(self.rows)
        self.longest = float(self.norms[:, 0].max())

    def _suffix_norms(self, rows: np.ndarray) -> np.ndarray:
        """Norm of each row from each group on; the last column is zero."""
        squares = np.add.reduceat(rows**2, list(self.groups), axis=1)
        rest = np.cumsum(squares[:, ::-1], axis=1)[:, ::-1]
        return np.sqrt(np.c_[rest, np.zeros(len(rows))])

    def scores(self, query: np.ndarray, which: np.ndarray) -> np.ndarray:
        """Exact integer scores."""
        top = float(np.abs(query).max(initial=0)) * len(query)
        rows = self.exact_rows[which]
        if top * float(np.abs(rows).max(initial=0)) < _EXACT:
            return (rows.astype(np.float64) @ query.astype(np.float64)).astype(np.int64)
        low, high = -(2**63), 2**63 - 1
        whole = [int(x) for x in query]
        return np.array(
            [min(max(sum(int(a) * b for a, b in zip(row, whole)), low), high) for row in rows],
            np.int64,
        )

    def join(self, queries: np.ndarray, full) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query, places and scores of rows that hold every row above its last threshold.

        `full(i, places, scores, threshold)` says whether query i needs no lower threshold.
        """
        asked = queries[:, self.order].astype(np.float64)
        asked_norms = self._suffix_norms(asked)
        n, last = len(self.ids), len(self.groups)
        indexed = np.zeros(n, np.int64)  # groups of each row that are in the posting lists
        partial = np.zeros((len(asked), n))
        verified = np.zeros((len(asked), n), bool)
        found = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in asked]
        active = np.arange(len(asked))
        share = 1.0
        while True:
            share *= LOWER
            final = share < LEAST
            covered = self.norms < share * self.longest
            until = np.full(n, last) if final else np.maximum(indexed, covered.argmax(axis=1))
            for g in range(last):
                new = (indexed <= g) & (g < until)
                if new.any():
                    dims, rows = slice(g * GROUP, (g + 1) * GROUP), slice(None) if new.all() else new
                    partial[:, rows] += asked[active, dims] @ self.rows[rows, dims].T
            indexed = until
            left = self.norms[np.arange(n), indexed]
            # Rounding of the partial scores is far below this.
            slack = 1e-9 * self.longest + 1e-6
            going = []
            for at, i in enumerate(active):
                norms = asked_norms[i]
                threshold = -np.inf if final else share * norms[0] * self.longest
                bound = partial[at] + (left + slack) * norms[indexed] + slack * norms[0]
                near = np.flatnonzero((bound >= threshold) & ~verified[at])
                if len(near):
                    verified[at, near] = True
                    places, scores = found[i]
                    found[i] = (
                        np.concatenate([places, near]),
                        np.concatenate([scores, self.scores(queries[i], near)]),
                    )
                if not final and not full(i, *found[i], threshold):
                    going.append(at)
            if not going:
                return found
            active, partial, verified = active[going], partial[going], verified[going]


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties by the smaller id."""
    if len(scores) > k:
        floor = np.partition(scores, len(scores) - k)[-k]
        keep = np.flatnonzero(scores >= floor)
    else:
        keep = np.arange(len(scores))
    return keep[np.lexsort([ids[keep], ~scores[keep]])[:k]]


def fill_positives(index: SuffixIndex, ids: np.ndarray, queries: np.ndarray, k: int) -> list:
    """(query, place in the index, score) of the k best rows but the query itself."""
    def full(i, places, scores, threshold):
        return ((scores >= threshold) & (index.ids[places] != ids[i])).sum() >= k

    rows = []
    for i, (places, scores) in enumerate(index.join(queries, full)):
        other = index.ids[places] != ids[i]
        places, scores = places[other], scores[other]
        best = _best(index.ids[places], scores, k)
        rows += [(i, places[b], scores[b]) for b in best]
    return rows


def fill_negatives(
    index: SuffixIndex, labels: np.ndarray, queries: np.ndarray, windows: list, k: int
) -> list:
    """(query, window, place in the index, score) of the k best rows of other labels in each of
    the query's windows (low, high), bounds included."""
    def inside(i, places, scores):
        other = index.labels[places] != labels[i]
        return [other & (scores >= low) & (scores <= high) for low, high in windows[i]]

    def full(i, places, scores, threshold):
        above = scores >= threshold
        return all(
            low > threshold or (mask & above).sum() >= k
            for (low, _), mask in zip(windows[i], inside(i, places, scores))
        )

    rows = []
    for i, (places, scores) in enumerate(index.join(queries, full)):
        for w, mask in enumerate(inside(i, places, scores)):
            kept, got = places[mask], scores[mask]
            rows += [(i, w, kept[b], got[b]) for b in _best(index.ids[kept], got, k)]
    return rows


def _by_shard(batches: Iterator[pa.RecordBatch], search) -> Iterator[list]:
    """Feed a stream sorted by (shard, dim, pool, kind) into one index after the other, and its
    queries in blocks through `search(index, batch, places, matrix)`."""
    key, index, held = None, None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        names = ("shard", "dim", "pool", "kind", "vec_id", "label")
        shard, dim, pool, kind, ids, labels = (batch.column(c).to_numpy() for c in names)
        vectors = batch.column("v")
        offsets, values = vectors.offsets.to_numpy(), vectors.values.to_numpy()
        parts = np.stack([shard, dim, pool, kind])
        cuts = np.flatnonzero((parts[:, 1:] != parts[:, :-1]).any(axis=0)) + 1
        for s, e in zip(np.r_[0, cuts], np.r_[cuts, batch.num_rows]):
            if key != (shard[s], dim[s], pool[s]):
                key, index, held = (shard[s], dim[s], pool[s]), None, []
            matrix = values[offsets[s] : offsets[e]].reshape(e - s, dim[s])
            if kind[s] == 0:
                held.append((ids[s:e].copy(), labels[s:e].copy(), matrix.copy()))
                continue
            if index is None and held:
                index, held = SuffixIndex(*(np.concatenate(part) for part in zip(*held))), []
            if index is not None:
                for b in range(s, e, BLOCK):
                    stop = min(b + BLOCK, e)
                    yield search(index, batch, slice(b, stop), matrix[b - s : stop - s])


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & (F.size(vector) > 0), F.lit(False))


def _streamed(rows: DataFrame, queries: DataFrame, pool: Column, shards: int) -> DataFrame:
    """Rows (kind 0) and queries (kind 1) of each shard and pool side by side, the rows first."""
    joined = rows.withColumn("kind", F.lit(0)).unionByName(
        queries.withColumn("kind", F.lit(1)), allowMissingColumns=True
    ).withColumn("pool", pool.cast("bigint"))
    # As many tasks as shards; the shards of one pool are in different ones.
    task = F.pmod(F.xxhash64("pool") + F.col("shard"), F.lit(shards)).cast("int")
    return joined.repartitionById(shards, task).sortWithinPartitions(
        "shard", "dim", "pool", "kind"
    )


def _one_each(rows: DataFrame) -> DataFrame:
    """`rows` (vec_id, label, v) with one row for each id: of the smallest label, then vector."""
    twice = rows.groupBy("vec_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    twice = stage(twice.select("vec_id"), "twice")
    chosen = rows.join(twice, "vec_id").groupBy("vec_id").agg(
        F.min(F.struct("label", "v")).alias("row")
    )
    return rows.join(twice, "vec_id", "left_anti").unionByName(
        chosen.select("vec_id", "row.label", "row.v")
    )


def hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    shard_rows: int = 100_000,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    `anchors` picks the anchors by `vec_id`. Components are floor(256 * x). A negative n of the
    positive p has low * p <= 100 * n <= high * p.
    """
    vector = F.col(vector_col).cast("array<double>")
    rows = vectors.select(
        F.col(id_col).cast("bigint").alias("vec_id"),
        F.col(label_col).cast("bigint").alias("label"),
        vector.alias("x"),
    ).where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("x")))
    # Spark's floor of a double ends at the limits of 64 bits.
    rows = rows.select("vec_id", "label", F.transform("x", lambda x: F.floor(x * 256)).alias("v"))
    spark = vectors.sparkSession
    shards = max(-(-rows.count() // shard_rows), spark.sparkContext.defaultParallelism)
    all_shards = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
    shard = F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(shards)).cast("int").alias("shard")
    rows = _one_each(rows)
    dealt = rows.select(shard, F.size("v").alias("dim"), "vec_id", "label", "v")
    asked = stage(rows.where(anchors), "anchors")
    queries = asked.select(all_shards, F.size("v").alias("dim"), "vec_id", "label", "v")

    def positives_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def search(index, batch, block, matrix):
            ids = batch.column("vec_id").to_numpy()[block]
            found = fill_positives(index, ids, matrix, positives)
            return [(ids[i], index.ids[place], score) for i, place, score in found]

        for found in _by_shard(batches, search):
            if found:
                yield _batch(found, ("anchor_id", "positive_id", "positive_score"))

    found = _streamed(dealt, queries, F.col("label"), shards).mapInArrow(
        positives_of, "anchor_id bigint, positive_id bigint, positive_score bigint"
    )
    place = F.row_number().over(
        W.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    )
    found = stage(found.withColumn("p", place).where(F.col("p") <= positives), "positives")

    # 128 bits of decimal hold the products of any score.
    score = F.col("positive_score").cast("decimal(20,0)")
    least, most = F.ceil(score * low / 100), F.floor(score * high / 100)
    ranges = found.withColumns({"low": least.cast("bigint"), "high": most.cast("bigint")})
    windows = ranges.where("low <= high").groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.sort_array(
            F.collect_list(F.struct("p", "positive_id", "positive_score", "low", "high"))
        ).alias("windows")
    )
    # At most `positives` windows an anchor.
    windowed = asked.join(windows, "vec_id").select(
        all_shards, F.size("v").alias("dim"), "vec_id", "label", "v", "windows"
    )

    def negatives_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def search(index, batch, block, matrix):
            ids = batch.column("vec_id").to_numpy()[block]
            labels = batch.column("label").to_numpy()[block]
            windows_ = batch.column("windows")[block.start : block.stop].to_pylist()
            bounds = [[(w["low"], w["high"]) for w in ws] for ws in windows_]
            found_ = fill_negatives(index, labels, matrix, bounds, negatives)
            return [
                (
                    ids[i], windows_[i][w]["positive_id"], index.ids[place],
                    windows_[i][w]["positive_score"], score_,
                )
                for i, w, place, score_ in found_
            ]

        for found_ in _by_shard(batches, search):
            if found_:
                yield _batch(found_, names)

    names = ("anchor_id", "positive_id", "negative_id", "positive_score", "negative_score")
    candidates = _streamed(dealt, windowed, F.lit(0), shards).mapInArrow(
        negatives_of, ", ".join(f"{name} bigint" for name in names)
    )
    rank = F.row_number().over(
        W.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    )
    return candidates.withColumn("rank", rank).where(F.col("rank") <= negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def _batch(rows: list, names: tuple) -> pa.RecordBatch:
    columns = [pa.array([int(x) for x in column], pa.int64()) for column in zip(*rows)]
    return pa.RecordBatch.from_arrays(columns, list(names))


def shifted(vectors: DataFrame) -> DataFrame:
    """The rows with label (label + 1) % 10 where `vec_id` is divisible by 7."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return vectors.select("vec_id", "embedding", moved.alias("label"))


ORACLE_SQL = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: coalesce(isfinite(x), false))) = len(embedding)
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM r a JOIN r b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), p AS (
  SELECT * FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.other_id AS positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, p.other_id
                          ORDER BY n.score DESC, n.other_id)::INTEGER AS rank,
       n.other_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
QUALIFY rank <= 3
"""
