"""Quality classifier: Bradley-Terry ranking of documents, cut at a score quantile.

A document's strength is linear in features of its whole text. It is learned from preference
pairs, a document labelled 1 over one labelled 0, by logistic loss on the difference of their
features. The cut is the quantile of the strengths of all learnable labelled documents at their
share of label 0, by an exact rank; the score is the logistic function of the strength above the
cut, shifted so that the cut stands at `CUT`.

The weights are fitted on the driver from features (not texts) of at most `sample` labelled
documents, those of the smallest hashes, and of `pairs` preference pairs of them, drawn with
replacement from a fixed seed; these bounds are the parameters. Strengths are one pass over the
texts without a shuffle; they are written, and only numbers are joined and sorted for the cut.

Defined results: null text is scored as empty. Null ids are scored and not held out; labels
without id or quality are left out, contradicting labels count one each. Without labels of both
classes every score is 0.5. Repeated rows are scored each. An empty table gives an empty result.
"""

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweir.llm.common import crc32_remainder, fresh
from logweir.sources.staging import stage, stage_numbered

CUT = 0.3
_UPPER = bytes(range(65, 91))
_DIGITS = b"0123456789"
_MARKS = b"!#$%&*+<=>@[\\]^_`{|}~/"
_STOPS = b".,;:?'\"()-"
_HIGH = bytes(range(128, 256))
_LETTER_RUN = re.compile(rb"([a-z\x80-\xff])\1\1")


def features(text: bytes) -> list[float]:
    """Shares between 0 and 1, with their roots, and logarithms of sizes."""
    words = text.split()
    n, size = len(words), len(text)
    if not n:
        return [0.0] * FEATURES
    lower = [w.lower() for w in words]
    distinct = len(set(lower))
    lines = [line for line in text.split(b"\n") if line.strip()]

    def share(chars: bytes) -> float:
        return 1.0 - len(text.translate(None, chars)) / size

    repeats = sum(map(bytes.__eq__, lower[1:], lower)) / n
    shouted = sum(map(bytes.isupper, words)) / n
    marked = sum(w[-1] in _MARKS for w in words) / n
    bare = sum(w in b"|-=*#~" for w in words) / n
    shares = [
        repeats,
        shouted,
        marked,
        bare,
        share(_UPPER),
        share(_DIGITS),
        share(_MARKS),
        share(_STOPS),
        share(_HIGH),
        1.0 - len(set(lines)) / len(lines),
        distinct / n,
        distinct / max(n, 1) ** 0.75 / (1 + distinct / max(n, 1) ** 0.75),
        len(lines) / n,
        min(1.0, len(_LETTER_RUN.findall(text)) / n),
    ]
    long = sum(len(w) > 20 for w in words) / n
    return [
        *shares,
        *map(math.sqrt, shares),
        long,
        math.log1p(n) / 10,
        math.log1p(size / n) / 5,
        math.log1p(size / len(lines)) / 10,
    ]


FEATURES = 32


def fit(x: np.ndarray, y: np.ndarray, pairs: int = 40_000, ridge: float = 1e-3) -> dict | None:
    """Weights and the cut of these rows, from features and labels; None without both classes.

    At most `pairs` pairs of one row of each class are compared, drawn with replacement.
    """
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return None
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = (x - mean) / spread
    draw = np.random.default_rng(0)
    count = min(pairs, len(good) * len(bad))
    difference = z[draw.choice(good, count)] - z[draw.choice(bad, count)]
    weights = np.zeros(x.shape[1])
    for _ in range(25):  # Newton steps on the logistic loss of the differences
        p = 1.0 / (1.0 + np.exp(-np.clip(difference @ weights, -30, 30)))
        gradient = difference.T @ (p - 1.0) / count + ridge * weights
        curvature = (difference * (p * (1.0 - p))[:, None]).T @ difference / count
        weights -= np.linalg.solve(curvature + ridge * np.eye(len(weights)), gradient)
    strength = np.sort(z @ weights)
    cut = strength[len(bad) - 1 : len(bad) + 1].mean()
    return {"weights": weights / spread, "shift": float(mean / spread @ weights + cut)}


def strength(model: dict, text: Column) -> Column:
    """The strength of a text column."""

    @F.arrow_udf("double")
    def run(texts: pa.Array) -> pa.Array:
        if not len(texts):
            return pa.array([], pa.float64())
        x = np.array([features(t or b"") for t in texts.to_pylist()])
        return pa.array(x @ model["weights"])

    return run(text.cast("binary"))


def score(strength_: Column, cut: float) -> Column:
    """The score of a strength, between 0 and 1."""
    above = strength_ - F.lit(cut) + F.lit(math.log(CUT / (1.0 - CUT)))
    return 1.0 / (1.0 + F.exp(-F.greatest(F.lit(-700.0), F.least(F.lit(700.0), above))))


def learnable(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """_id and _quality of labels whose id's crc32 as text is not divisible by 5, each pair once."""
    return (
        labels.select(F.col(id_col).alias("_id"), F.col("quality").cast("int").alias("_quality"))
        .where("_id is not null and _quality in (0, 1)")
        .where(crc32_remainder("_id", 5) != 0)
        .distinct()
    )


def cut_of(strengths: DataFrame, labels: DataFrame) -> float:
    """The strength between the n-th and the next of all learnable labelled documents in rising
    order, n being those of label 0. `strengths` has _id and strength."""
    ranked = strengths.join(learnable(labels), "_id").select("strength", "_quality")
    ranked = stage_numbered(ranked.orderBy("strength"), "ranked", "place")
    bad = ranked.where("_quality = 0").count()
    return ranked.where(F.col("place").isin(bad, bad + 1)).agg(F.avg("strength")).first()[0]


def learn(
    docs: DataFrame,
    labels: DataFrame,
    sample: int = 20_000,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> dict | None:
    """A model from `labels` (id, quality), of ids whose crc32 as text is not divisible by 5."""
    known = learnable(labels, id_col).orderBy(F.xxhash64("_id"), "_id", "_quality").limit(sample)

    @F.arrow_udf("array<double>")
    def measured(texts: pa.Array) -> pa.Array:
        return pa.array([features(t or b"") for t in texts.to_pylist()], pa.list_(pa.float64()))

    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("binary").alias("_text"))
    # At most `sample` pairs of id and label, hence a broadcast of proven size.
    rows = (
        texts.join(F.broadcast(known), "_id")
        .select("_id", "_quality", measured("_text").alias("x"))
        .orderBy(F.xxhash64("_id"), "_id", "_quality", "x")
        .limit(2 * sample)
        .toArrow()
    )
    if not len(rows):
        return None
    x = np.array(rows.column("x").to_pylist())
    return fit(x, rows.column("_quality").to_numpy())


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from a score of CUT on) of every row of `docs`."""
    model = learn(docs, labels)
    if model is None:
        rows = docs.select(F.col("doc_id").alias("_id"), F.lit(0.5).alias("score"))
    else:
        rows = docs.select(
            F.col("doc_id").alias("_id"), strength(model, F.col("text")).alias("strength")
        )
        rows = stage(rows, "strengths")
        rows = rows.select("_id", score(F.col("strength"), cut_of(rows, labels)).alias("score"))
    held_out = F.coalesce(crc32_remainder("_id", 5) == 0, F.lit(False))
    return rows.select(
        F.col("_id").alias("doc_id"), held_out.alias("held_out"), "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"),
    )


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs` that the classifier does not reject, unchanged."""
    model = learn(docs, labels)
    if model is None:
        return docs
    # Strengths are computed twice: once as numbers for the cut, and again beside the rows, so
    # that the texts are not written once more.
    strengths = docs.select(
        F.col("doc_id").alias("_id"), strength(model, F.col("text")).alias("strength")
    )
    cut = cut_of(stage(strengths, "strengths"), labels)
    own = fresh("strength", docs)
    scored = docs.withColumn(own, strength(model, F.col("text")))
    return scored.where(score(F.col(own), cut) >= CUT).select(*docs.columns)
