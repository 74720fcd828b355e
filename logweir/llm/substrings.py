"""Removal of repeated passages: Rabin-Karp hashes of every window of `window` words.

A window is removed if its word sequence also starts in a document with a smaller id; removed
windows merge into maximal intervals. Windows are judged on the input.

1. Each text is read once. Its windows are hashed by prefix sums of a polynomial over word
   hashes, and each window is also given an anchor: the smallest hash of the short grams in it.
   Equal windows have equal anchors, and consecutive windows mostly share one, so a text has
   about one anchor in twenty words. Documents of equal word sequences are one entry from here
   on (the smallest id stands for all), however many copies there are.
2. Anchors are counted. A window whose anchor stands in one text only occurs once in the whole
   corpus; it is counted thereby and needs no row of its own. This loses nothing.
3. All other windows are rows: hash, document, place. The smallest document of each hash is an
   aggregate that combines before its shuffle, joined back by hash. AQE can split a hot hash in
   the join, as every row needs the joined value only.
4. The places found are gathered per document (bounded by its own length), merged into
   intervals, and the words outside are kept.

Hashes have 64 bits, word sequences of whole texts 128.

Defined results: null text has no words. Text below `window` words is kept whole. Rows of a null
id keep all words and remove nothing elsewhere. Repeated rows have the same id, so none removes
the other. Columns other than id and text are not read; an empty table gives an empty result.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweir.llm.common import binary_column
from logweir.sources.staging import stage

GRAM = 8
_BASE = 0x9E3779B97F4A7C15
_ROWS = 1 << 17


class RollingHash:
    """Polynomial hashes modulo 2**64 of all windows of a sequence, by prefix sums."""

    def __init__(self) -> None:
        self.powers = self.inverses = np.empty(0, np.uint64)

    def prefix(self, words: list[bytes]) -> np.ndarray:
        n = len(words)
        if n > len(self.powers):
            size = max(1024, 2 * n)
            one = np.ones(1, np.uint64)
            base, inverse = np.uint64(_BASE), np.uint64(pow(_BASE, -1, 1 << 64))
            self.powers = np.cumprod(np.r_[one, np.full(size, base)])
            self.inverses = np.cumprod(np.r_[one, np.full(size, inverse)])
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, n)
        return np.r_[np.zeros(1, np.uint64), np.cumsum(hashes * self.powers[:n])]

    def windows(self, prefix: np.ndarray, size: int) -> np.ndarray:
        sums = (prefix[size:] - prefix[:-size]) * self.inverses[: len(prefix) - size]
        sums ^= sums >> np.uint64(31)
        sums *= np.uint64(0xBF58476D1CE4E5B9)
        return sums ^ (sums >> np.uint64(29))


def anchors(grams: np.ndarray, span: int) -> np.ndarray:
    """The minimum of every `span` consecutive values."""
    low, width = grams, 1
    while 2 * width <= span:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < span:
        more = span - width
        low = np.minimum(low[:-more], low[more:])
    return low


def covered(places: np.ndarray, window: int, n: int) -> list[tuple[int, int]]:
    """Maximal intervals [start, end) of the words that windows at `places` cover."""
    places = np.unique(places)
    cut = np.flatnonzero(places[1:] > places[:-1] + window)
    starts = places[np.r_[0, cut + 1]]
    ends = places[np.r_[cut, len(places) - 1]] + window
    return [(int(s), min(int(e), n)) for s, e in zip(starts, ends)]


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50
) -> DataFrame:
    """doc_id, n_words, n_removed, spans (word intervals removed), kept_sha256, one row per row.

    `kept_sha256` is the SHA-256 of the kept words joined by one space. `cut_spans` cuts spans
    out of a text.
    """
    gram = min(GRAM, window)
    source = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("binary").alias("text")
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = RollingHash()
        for batch in batches:
            counts, seqs, shas, found = [], [], [], []
            for text in binary_column(batch, "text"):
                words = text.split()
                joined = b" ".join(words)
                counts.append(len(words))
                seqs.append(xxhash.xxh3_128_digest(joined))
                shas.append(hashlib.sha256(joined).hexdigest())
                if len(words) < window:
                    found.append(np.empty(0, np.int64))
                    continue
                grams = rolling.windows(rolling.prefix(words), gram)
                found.append(np.unique(anchors(grams, window - gram + 1)).view(np.int64))
            offsets = np.cumsum([0, *map(len, found)]).astype(np.int32)
            values = pa.array(np.concatenate(found) if found else np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(counts, pa.int64()),
                    pa.array(seqs, pa.binary()),
                    pa.array(shas, pa.string()),
                    pa.ListArray.from_arrays(offsets, values),
                ],
                ["doc_id", "n_words", "seq", "sha", "anchors"],
            )

    scanned = stage(
        source.mapInArrow(
            scan, "doc_id bigint, n_words bigint, seq binary, sha string, anchors array<bigint>"
        ),
        "scanned",
    )
    # One entry per word sequence; its copies are removed whole and bring no windows.
    entries = (
        scanned.where(F.col("doc_id").isNotNull() & (F.col("n_words") >= window))
        .groupBy("seq")
        .agg(F.min(F.struct("doc_id", "anchors")).alias("e"))
        .select("seq", "e.doc_id", "e.anchors")
    )
    entries = stage(entries, "entries")
    listed = entries.select("doc_id", "seq", F.explode("anchors").alias("anchor"))
    shared = listed.groupBy("anchor").count().where("count > 1").select("anchor")
    wanted = (
        listed.join(shared, "anchor")
        .groupBy("doc_id", "seq")
        .agg(F.collect_list("anchor").alias("wanted"))
    )
    texts = source.join(wanted, "doc_id").withColumn("key", F.xxhash64("seq"))
    texts = stage(texts, "texts")

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = RollingHash()
        for batch in batches:
            ids, keys = batch.column("doc_id").to_pylist(), batch.column("key").to_pylist()
            seqs, chosen = batch.column("seq").to_pylist(), batch.column("wanted")
            held, size = [], 0
            for i, text in enumerate(binary_column(batch, "text")):
                words = text.split()
                if xxhash.xxh3_128_digest(b" ".join(words)) != seqs[i]:
                    continue  # another text of the same id
                prefix = rolling.prefix(words)
                low = anchors(rolling.windows(prefix, gram), window - gram + 1).view(np.int64)
                place = np.flatnonzero(np.isin(low, chosen[i].values.to_numpy()))
                hashes = rolling.windows(prefix, window)[place].view(np.int64)
                held.append((hashes, ids[i], keys[i], place.astype(np.int32)))
                size += len(place)
                if size > _ROWS:
                    yield rows(held)
                    held, size = [], 0
            if held:
                yield rows(held)

    def rows(held: list) -> pa.RecordBatch:
        hashes, ids, keys, places = zip(*held)
        sizes = [len(p) for p in places]
        columns = [
            np.concatenate(hashes),
            np.repeat(np.array(ids, np.int64), sizes),
            np.repeat(np.array(keys, np.int64), sizes),
            np.concatenate(places),
        ]
        return pa.RecordBatch.from_arrays(
            [pa.array(c) for c in columns], ["h", "doc_id", "key", "place"]
        )

    windows = stage(
        texts.mapInArrow(emit, "h bigint, doc_id bigint, key bigint, place int"), "windows"
    )
    # Written, so that the join reads two plain shuffles, in which AQE can split a hot hash.
    first = windows.groupBy("h").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    first = stage(first.where("first < last").drop("last"), "first")
    repeated = (
        windows.join(first, "h")
        .where("doc_id > first")
        .groupBy("doc_id", "key")
        .agg(F.collect_list("place").alias("places"))
    )
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seqs, places = batch.column("seq").to_pylist(), batch.column("places")
            keep, spans, shas = [], [], []
            for i, text in enumerate(binary_column(batch, "text")):
                words = text.split()
                if xxhash.xxh3_128_digest(b" ".join(words)) != seqs[i]:
                    continue
                found = covered(places[i].values.to_numpy(), window, len(words))
                keep.append(i)
                spans.append([{"start": s, "end": e} for s, e in found])
                shas.append(hashlib.sha256(b" ".join(kept_words(words, found))).hexdigest())
            kept = batch.select(["doc_id", "seq"]).take(pa.array(keep, pa.int64()))
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(spans, kind), pa.array(shas, pa.string())],
                ["doc_id", "seq", "found", "cut_sha"],
            )

    spans_type = "array<struct<start:bigint,end:bigint>>"
    changed = (
        texts.join(repeated, ["doc_id", "key"])
        .select("doc_id", "seq", "text", "places")
        .mapInArrow(cut, f"doc_id bigint, seq binary, found {spans_type}, cut_sha string")
        .distinct()
    )
    copies = entries.select("seq", F.col("doc_id").alias("first"))
    none = F.sha2(F.lit("").cast("binary"), 256)
    whole = F.array(F.struct(F.lit(0).cast("bigint").alias("start"), F.col("n_words").alias("end")))
    is_copy = F.col("doc_id") > F.col("first")
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return (
        scanned.drop("anchors")
        .join(copies, "seq", "left")
        .join(changed, ["doc_id", "seq"], "left")
        .withColumn(
            "spans",
            F.when(is_copy, whole).otherwise(F.coalesce("found", F.array().cast(spans_type))),
        )
        .withColumn("kept_sha256", F.when(is_copy, none).otherwise(F.coalesce("cut_sha", "sha")))
        .select("doc_id", "n_words", removed.alias("n_removed"), "spans", "kept_sha256")
    )


def kept_words(words: list[bytes], spans: list[tuple[int, int]]) -> list[bytes]:
    kept, at = [], 0
    for start, end in spans:
        kept += words[at:start]
        at = end
    return kept + words[at:]


def cut_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The words of `text` outside of `spans`, joined by one space."""
    return b" ".join(kept_words(text.split(), spans))
