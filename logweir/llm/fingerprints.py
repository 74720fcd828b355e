"""Document fingerprints by Order MinHash, in built-in functions only.

A text's k-mers are runs of `K` words (a code point of a script written without spaces is a word
of its own). Equal k-mers are numbered by occurrence, and each numbered k-mer has a hash. The hash
deals it to one of `BINS` and ranks it there; each bin selects its `TUPLE` smallest, puts them
back into text order and hashes that tuple. The tuples are the signature: moving, inserting or
replacing text changes the order or the choice in the bins concerned, as edit distance does,
where plain MinHash sees sets only.

One hash per k-mer serves all bins, so the work is linear in the text. K-mers whose hash is small
for the text's length, `_SPARE` per bin on average, are looked at first; if a bin has fewer of them
than `TUPLE`, about once in 1,000 long texts, all k-mers are. A bin to which a text deals fewer
k-mers than `TUPLE` hashes those it has, and one without any is no part of the signature. Likeness
is the share of bins with equal tuples among the bins that either text fills.

Everything stays inside one row: arrays are sorted and folded, nothing is exploded. The next
document in descending order of id comes from a window over ranges of ids of like size; the first
document of every range is also put behind the last of the range before, so that no range needs
another. That is one shuffle of the texts.

Defined results: null text is empty. Texts without words have an empty fingerprint and are alike.
Null ids come last in the order, rows of one id in descending order of text. A single row is its
own next document. Repeated rows follow each other. Columns other than id and text are not read;
an empty table gives an empty result. Word places count modulo 2**24.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

K = 3
TUPLE = 2
BINS = 64
_SPARE = 14
_PLACE_BITS = 24
_PLACE = (1 << _PLACE_BITS) - 1
_RANK_BITS = 57  # a hash of 63 bits is 6 bits of bin, then its rank; the lowest 24 give way
# Scripts without spaces between words: CJK, kana and Hangul blocks, Thai to Myanmar, Khmer.
_ALONE = r"\x{E00}-\x{EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{2E80}-\x{D7FF}\x{F900}-\x{FAFF}\x{20000}-\x{3FFFF}"
# One range around all of them, as a quick test.
_MAY_STAND_ALONE = r"[\x{E00}-\x{3FFFF}]"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _long(value: int) -> Column:
    return F.lit(value).cast("bigint")


def _words(text: Column) -> Column:
    """Runs between white space, and each code point of a script without spaces."""
    apart = F.regexp_replace(text, f"([{_ALONE}])", " $1 ")
    spaced = F.when(text.rlike(_MAY_STAND_ALONE), apart).otherwise(text)
    return F.array_remove(F.split(spaced, r"\s+"), "")


def _kmers(words: Column) -> Column:
    """Hashes of all runs of K words; of a shorter text, the hash of all its words."""

    def runs(hashes: Column) -> Column:
        count = F.size(hashes) - (K - 1)
        joined = F.slice(hashes, 1, count)
        for i in range(1, K):
            joined = F.zip_with(joined, F.slice(hashes, i + 1, count), lambda a, b: F.xxhash64(a, b))
        return (
            F.when(count > 0, joined)
            .when(F.size(hashes) > 0, F.array(F.xxhash64(hashes)))
            .otherwise(F.array().cast("array<bigint>"))
        )

    return _let(F.transform(words, lambda w: F.xxhash64(w)), runs)


def _number(packed: Column, i: Column, kmer: Callable[[Column], Column]) -> Column:
    """How many equal k-mers stand right before place `i` of a sorted array.

    Mostly none; else found bit by bit, as equal ones are neighbours.
    """
    own = kmer(F.get(packed, i))

    def equal(distance: Column) -> Column:
        return (distance <= i) & (kmer(F.get(packed, i - distance)) == own)

    bits = F.array(*[F.lit(1 << b) for b in range(_PLACE_BITS, -1, -1)])
    found = F.aggregate(
        bits, F.lit(0), lambda n, bit: F.when(equal(n + bit), n + bit).otherwise(n)
    )
    return F.when(equal(F.lit(1)), found).otherwise(F.lit(0))


def _candidates(kmers: Column) -> Column:
    """Bin, rank and place of numbered k-mers, sorted: `TUPLE` of the smallest ranks in each bin,
    and more."""
    mask = _long((1 << 63 - _PLACE_BITS) - 1)
    count = F.greatest(F.lit(1), F.size(kmers))
    share = F.least(F.lit(1.0), F.lit(float(_SPARE * BINS)) / count)
    limit = F.floor(share * float(1 << _RANK_BITS)).cast("bigint")
    packed = F.sort_array(
        F.transform(
            kmers,
            lambda h, i: F.shiftleft(h.bitwiseAND(mask), _PLACE_BITS).bitwiseOR(
                i.cast("bigint").bitwiseAND(_long(_PLACE))
            ),
        )
    )

    def kmer(x: Column) -> Column:
        return F.shiftrightunsigned(x, _PLACE_BITS)

    # Sorted by k-mer, then place: equal neighbours are numbered along the text.
    def entries(ordered: Column) -> Column:
        return F.transform(
            ordered,
            lambda x, i: F.xxhash64(kmer(x), _number(ordered, i, kmer))
            .bitwiseAND(_long((1 << 63) - 1 - _PLACE))
            .bitwiseOR(x.bitwiseAND(_long(_PLACE))),
        )

    rank = _long((1 << _RANK_BITS) - 1)

    def enough(small: Column, every: Column) -> Column:
        """`small` sorted if it fills every bin or leaves nothing out, else all."""
        def fills(x: Column, i: Column) -> Column:
            own = _bin(x)
            last = (i >= TUPLE - 1) & (_bin(F.get(small, i - (TUPLE - 1))) == own)
            return last & ((i < TUPLE) | (_bin(F.get(small, i - TUPLE)) != own))

        whole = (F.size(small) == F.size(every)) | (F.size(F.filter(small, fills)) == BINS)
        return F.when(whole, small).otherwise(F.sort_array(every))

    def chosen(every: Column) -> Column:
        small = _let(limit, lambda most: F.filter(every, lambda e: e.bitwiseAND(rank) < most))
        return _let(F.sort_array(small), lambda s: enough(s, every))

    return _let(_let(packed, entries), chosen)


def _bin(x: Column) -> Column:
    return F.shiftrightunsigned(x, _RANK_BITS)


def signature(text: Column) -> Column:
    """array<int> of bin * 65536 + tuple hash, by bin, for the bins that the text fills."""

    def smallest(found: Column) -> Column:
        chosen = F.filter(
            found, lambda x, i: (i < TUPLE) | (_bin(F.get(found, i - TUPLE)) != _bin(x))
        )
        # Bin, place, rank: in each bin, text order.
        rank_bits = _RANK_BITS - _PLACE_BITS
        return F.sort_array(
            F.transform(
                chosen,
                lambda x: F.shiftleft(_bin(x), _RANK_BITS)
                .bitwiseOR(F.shiftleft(x.bitwiseAND(_long(_PLACE)), rank_bits))
                .bitwiseOR(
                    F.shiftrightunsigned(x, _PLACE_BITS).bitwiseAND(_long((1 << rank_bits) - 1))
                ),
            )
        )

    def tuples(ordered: Column) -> Column:
        rank = _long((1 << _RANK_BITS - _PLACE_BITS) - 1)

        def hashed(x: Column, i: Column) -> Column:
            rest = [F.get(ordered, i + j) for j in range(1, TUPLE)]
            own = [F.when(_bin(r) == _bin(x), r.bitwiseAND(rank)) for r in rest]
            low = F.xxhash64(x.bitwiseAND(rank), *own).bitwiseAND(_long(0xFFFF))
            first = (i == 0) | (_bin(F.get(ordered, i - 1)) != _bin(x))
            return F.when(first, (_bin(x) * 65536 + low).cast("int"))

        return F.array_compact(F.transform(ordered, hashed))

    found = _let(_words(text), lambda w: _let(_kmers(w), _candidates))
    return _let(found, lambda c: _let(smallest(c), tuples))


def as_text(sig: Column) -> Column:
    """The fingerprint: six hexadecimal digits per filled bin, the first two its number."""
    digits = F.transform(sig, lambda s: F.lpad(F.hex(s), 6, "0"))
    return F.lower(F.array_join(digits, ""))


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of common text, 0 to 1; 1 if both are empty.

    The share of equal tuples among the bins that either fills is about J ** TUPLE, where J is the
    Jaccard likeness of the k-mers; texts of one length with the share s in common have
    J = s / (2 - s).
    """
    bins = F.array_union(
        F.transform(a, lambda s: F.shiftright(s, 16)), F.transform(b, lambda s: F.shiftright(s, 16))
    )
    filled = F.greatest(F.lit(1), F.size(bins))
    equal = F.size(F.array_intersect(a, b)).cast("double") / filled
    jaccard = F.pow(equal, F.lit(1.0 / TUPLE))
    return F.when(F.size(bins) == 0, F.lit(1.0)).otherwise(2 * jaccard / (1 + jaccard))


def with_next(rows: DataFrame, ranges: int) -> DataFrame:
    """`rows` (doc_id, text) with sig, next_text and next_sig of the next smaller id.

    The smallest's next is the largest. `ranges` bounds the literal array of range limits.
    """
    limits = rows.approxQuantile("doc_id", [i / ranges for i in range(1, ranges)], 0.25 / ranges)
    limits = F.lit(sorted({int(x) for x in limits})) if limits else F.array().cast("array<bigint>")
    part = F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(
        F.size(F.filter(limits, lambda x: x < F.col("doc_id")))
    )
    rows = rows.withColumn("part", part)
    # One row per range: its largest id, and the range before it, whose last row it follows.
    firsts = rows.groupBy("part").agg(F.max("doc_id").alias("id"))
    order = W.orderBy("part")
    before = F.coalesce(F.lead("part").over(order), F.min("part").over(W.partitionBy()))
    firsts = firsts.select("id", before.alias("to"), F.col("part").alias("of"))
    behind = (
        rows.join(
            F.broadcast(firsts),  # `ranges` rows and one for null ids at most
            (F.col("of") == F.col("part")) & F.col("doc_id").eqNullSafe(F.col("id")),
        )
        .select("doc_id", "text", F.col("to").alias("part"))
        .withColumn("behind", F.lit(True))
    )
    both = rows.withColumn("behind", F.lit(False)).unionByName(behind)
    both = both.withColumn("sig", signature(F.col("text")))
    along = W.partitionBy("part").orderBy("behind", F.desc("doc_id"), F.desc("text"))
    return (
        both.withColumn("next_text", F.lead("text").over(along))
        .withColumn("next_sig", F.lead("sig").over(along))
        .where("not behind")
        .drop("behind", "part")
    )


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likeness.

    The edited text has the last half of the code points replaced by the first of the next text.
    """
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    kept = (F.col("n_chars") - half).cast("int")
    return (
        with_next(rows, 2 * partitions)
        .withColumn("n_chars", F.char_length("text").cast("bigint"))
        .withColumn(
            "edited",
            F.concat(
                F.substring(F.col("text"), F.lit(1), kept),
                F.substring(F.col("next_text"), F.lit(1), half),
            ),
        )
        .withColumn("edited_sig", signature(F.col("edited")))
        .select(
            "doc_id",
            "n_chars",
            F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
            as_text(F.col("sig")).alias("fingerprint"),
            as_text(F.col("edited_sig")).alias("edited_fingerprint"),
            likeness(F.col("sig"), F.col("edited_sig")).alias("near_edited"),
            likeness(F.col("sig"), F.col("next_sig")).alias("near_next"),
        )
    )
