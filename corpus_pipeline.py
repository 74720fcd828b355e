"""The corpus pipeline: five operators of logweir.llm, each over all that the one before kept."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from logweir.llm.mixing import mixed
from logweir.llm.packing import packed, tokenized
from logweir.llm.quality import accepted
from logweir.llm.secret_scan import redacted
from logweir.llm.simhash import simhash_dedup
from logweir.sources.staging import stage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash_dedup(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of each secret."""
    return redacted(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of documents by their source's rate; a copy has its document's id and columns."""
    return mixed(docs).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all copies in sequences of at most 4096 tokens."""
    return packed(tokenized(docs))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_duplicates),
    ("secret scans", secrets),
    ("mixing sources to target weights", mixture),
    ("best-fit packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stage(docs, f"stage-{i}")
    return docs


#: Word hashes, tokenizers and packing cannot be said in SQL; tests/llm holds a brute force.
ORACLE_SQL = None
