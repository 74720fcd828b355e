"""SimHash near-duplicates by a byte-position inverted index with count filtering.

Two 64-bit fingerprints that differ in at most `max_bits` bits differ in at most as many of
their 8 bytes, so at least `8 - max_bits` bytes are equal at equal positions. The index lists
fingerprints by their bytes; candidates share a list, their equal positional bytes are tallied,
pairs that reach the guaranteed number are kept and their differing bits counted.

A list for one byte would hold 1/256 of all fingerprints. The lists are therefore kept for sets
of up to three positions, chosen so that every possible set of guaranteed equal positions holds
one of them: no pair is lost, and a list holds about 1/2**24 of all fingerprints.

Equal fingerprints are one entry of the index however many documents share them. A list longer
than `block` is dealt into blocks, and every two blocks meet in one unit of work, so no task
holds more than two blocks. A unit gives back a spanning forest of its links, never all pairs.

Defined results: a null or empty text, or one of white space only, has fingerprint zero and is
linked like any other. Repeated rows give repeated results. Null ids get a component like other
rows, never name it, and a component of null ids only has a null component id. Columns other
than id and text are not read. An empty table gives an empty result.
"""

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweir.llm.common import binary_column, components, fresh
from logweir.sources.staging import stage

BYTES = 8


def fingerprint(text: bytes, words: int) -> int:
    """The SimHash of a text: a bit is 1 if it is set in over half of the shingles' XXH64."""
    tokens = text.lower().split()  # on bytes: A-Z only, and space and \t to \r only
    n = len(tokens)
    if n == 0:
        return 0
    joined = b" ".join(tokens)
    digest = xxhash.xxh64_intdigest
    if n <= words:
        return digest(joined, 42)
    sizes = np.fromiter(map(len, tokens), np.int64, n)
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[: n - words + 1].tolist()
    hashes = np.fromiter(
        (digest(joined[s:e], 42) for s, e in zip(starts, ends[words - 1 :].tolist())),
        np.uint64,
        len(starts),
    )
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)]
        bits = np.unpackbits(part.view(np.uint8), bitorder="little").reshape(-1, 64)
        counts += bits.sum(axis=0, dtype=np.int64)
    set_bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(set_bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, words: int = 4) -> DataFrame:
    """(doc_id, fp) of every row; fp is the fingerprint as a signed BIGINT."""
    source = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("binary").alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(text, words) for text in binary_column(batch, "text")]
            fp = pa.array(np.array(values, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), fp], ["doc_id", "fp"])

    return source.mapInArrow(run, "doc_id bigint, fp bigint")


def position_sets(matches: int) -> list[tuple[int, ...]]:
    """Sets of at most three byte positions of which every set of `matches` positions holds one."""
    size = min(3, matches)
    uncovered = set(combinations(range(BYTES), matches))
    chosen = []
    while uncovered:
        best = max(
            combinations(range(BYTES), size),
            key=lambda c: (sum(set(c) <= set(u) for u in uncovered), c),
        )
        chosen.append(best)
        uncovered = {u for u in uncovered if not set(best) <= set(u)}
    return chosen


def links(fps: DataFrame, max_bits: int, block: int = 2048) -> DataFrame:
    """(a, b): edges that connect the distinct fingerprints `fp` which differ in few bits."""
    matches = BYTES - max_bits
    if matches < 1:
        raise ValueError("at 8 or more differing bits no byte is guaranteed to be equal")
    sets = position_sets(matches)
    masks = [sum(0xFF << (8 * p) for p in s) for s in sets]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keys = [
        F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(m))) for i, m in enumerate(signed)
    ]
    postings = fps.select("fp", F.explode(F.array(*keys)).alias("list"))
    lengths = postings.groupBy("list").count().where("count > 1")
    blocks = F.ceil(F.col("count") / block).cast("int")
    own = F.pmod(F.xxhash64("fp", F.lit(7)), F.col("blocks")).cast("int")
    units = (
        postings.join(lengths, "list")
        .select("list", "fp", blocks.alias("blocks"))
        .withColumn("own", own)
        .withColumn(
            "other",
            F.explode(
                F.when(F.col("blocks") == 1, F.array(F.lit(0))).otherwise(
                    F.array_remove(F.sequence(F.lit(0), F.col("blocks") - 1), F.col("own"))
                )
            ),
        )
        .select(
            F.xxhash64("list", F.least("own", "other"), F.greatest("own", "other")).alias("unit"),
            "fp",
        )
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_unit, held = np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in batches:
            unit = np.concatenate([held_unit, batch.column("unit").to_numpy()])
            fp = np.concatenate([held, batch.column("fp").to_numpy()])
            last = np.searchsorted(unit, unit[-1]) if len(unit) else 0
            held_unit, held = unit[last:], fp[last:]
            yield from found(unit[:last], fp[:last])
        yield from found(held_unit, held)

    def found(unit: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(unit):
            return
        edges = []
        starts = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1]])
        for s, e in zip(starts, np.r_[starts[1:], len(unit)]):
            if e - s > 1:
                edges += forest(fp[s:e].view(np.uint64), matches, max_bits)
        if edges:
            a, b = (np.concatenate(side).view(np.int64) for side in zip(*edges))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return (
        units.repartition("unit")
        .sortWithinPartitions("unit")
        .mapInArrow(run, "a bigint, b bigint")
    )


def forest(fp: np.ndarray, matches: int, max_bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Edges of a spanning forest over the fingerprints of one unit, found breadth first."""
    edges, rest = [], np.unique(fp)
    queue: list[np.uint64] = []
    while len(rest):
        if not queue:
            queue, rest = [rest[0]], rest[1:]
        at = queue.pop()
        differing = rest ^ at
        tally = (differing.view(np.uint8).reshape(-1, BYTES) == 0).sum(axis=1)
        enough = np.flatnonzero(tally >= matches)
        near = enough[np.bitwise_count(differing[enough]) <= max_bits]
        if len(near):
            reached = rest[near]
            edges.append((np.full(len(reached), at), reached))
            queue.extend(reached)
            rest = np.delete(rest, near)
    return edges


def _classes(rows: DataFrame, max_bits: int) -> DataFrame:
    """One row per fingerprint: fp, first (its smallest doc_id), root (of its component)."""
    fps = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "fingerprints")
    # Node ids in random order: XXH64 of eight bytes is one to one.
    edges = links(fps, max_bits).select(F.xxhash64("a").alias("a"), F.xxhash64("b").alias("b"))
    roots = components(edges, "a", "b")
    return (
        fps.withColumn("node", F.xxhash64("fp"))
        .join(roots, "node", "left")
        .select("fp", "first", F.coalesce("root", "node").alias("root"))
    )


def simhash_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 4,
    max_bits: int = 4,
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row of `docs`."""
    rows = stage(fingerprints(docs, id_col, text_col, words), "simhash")
    classes = stage(_classes(rows, max_bits), "classes")
    named = classes.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = classes.join(named, "root").select("fp", "component_id")
    return rows.join(classes, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _has_map(kind: T.DataType) -> bool:
    """Whether a type holds a map or a variant, which have no order."""
    if isinstance(kind, T.StructType):
        return any(_has_map(f.dataType) for f in kind)
    if isinstance(kind, T.ArrayType):
        return _has_map(kind.elementType)
    return isinstance(kind, (T.MapType, T.VariantType))


def simhash_dedup(docs: DataFrame, words: int = 4, max_bits: int = 4) -> DataFrame:
    """`docs` with one row left of each component: that of the smallest doc_id.

    Of repeated rows with that id the first by text, source and the other columns' order stays;
    null ids count as larger than others. All columns of `docs` are returned unchanged.
    """
    rows = stage(fingerprints(docs, "doc_id", "text", words), "simhash")
    nulls_last = F.struct(F.col("first").isNull().alias("n"), "first", "fp")
    kept = _classes(rows, max_bits).groupBy("root").agg(F.min(nulls_last).alias("k"))
    keep, keep_fp, place, own_fp, text_bytes = (
        fresh(c, docs) for c in ("_keep", "_keep_fp", "_place", "_fp", "_bytes")
    )
    kept = stage(kept.select(F.col("k.first").alias(keep), F.col("k.fp").alias(keep_fp)), "kept")
    # The named columns first, then all that can be ordered: equal rows alone are exchangeable.
    columns = docs.columns
    first = [c for c in ("text", "source", "lang", "n_chars") if c in columns]
    rest = [f.name for f in docs.schema if f.name not in first and not _has_map(f.dataType)]
    order = [F.col(f"`{c}`") for c in (*first, *rest)]

    def first_of(found: DataFrame, *key: str) -> DataFrame:
        number = F.row_number().over(W.partitionBy(*key).orderBy(*order))
        return found.withColumn(place, number).where(F.col(place) == 1).select(*columns)

    # An id that stands on texts with different fingerprints does not say which row is meant:
    # for those, if there are any, the fingerprint is computed again and joined as well.
    per_id = rows.groupBy("doc_id").agg(F.min("fp").alias("low"), F.max("fp").alias("high"))
    unclear = stage(per_id.where("low <> high or doc_id is null").select("doc_id"), "unclear")
    own = docs["doc_id"].eqNullSafe(F.col(keep))
    if unclear.isEmpty():
        return first_of(docs.join(kept, own, "left_semi"), "doc_id")
    clear = kept.join(unclear, F.col(keep).eqNullSafe(unclear["doc_id"]), "left_anti")
    either = unclear.withColumnRenamed("doc_id", keep)
    again = docs.join(either, own, "left_semi")
    again = again.withColumn(text_bytes, F.col("text").cast("binary"))
    schema = again.drop(text_bytes).schema.add(own_fp, T.LongType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(t, words) for t in binary_column(batch, text_bytes)]
            fp = pa.array(np.array(values, np.uint64).view(np.int64))
            rest = batch.drop_columns([text_bytes])
            yield pa.RecordBatch.from_arrays(
                [*rest.columns, fp], [*rest.schema.names, own_fp]
            )

    again = again.mapInArrow(run, schema)
    same = again["doc_id"].eqNullSafe(F.col(keep)) & (F.col(own_fp) == F.col(keep_fp))
    return first_of(docs.join(clear, own, "left_semi"), "doc_id").unionByName(
        first_of(again.join(kept, same, "left_semi"), "doc_id", own_fp)
    )
