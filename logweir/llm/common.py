"""What several operators share: worker state, batches of numpy columns, connected components."""

import sys
import types

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweir.sources.staging import stage


def worker_state() -> dict:
    """A dictionary that lives as long as the Python worker, across its tasks."""
    name = "logweir_worker_state"
    return vars(sys.modules.setdefault(name, types.ModuleType(name)))


def binary_column(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """A binary column as Python bytes, nulls as empty."""
    return [value or b"" for value in batch.column(name).to_pylist()]


def fresh(name: str, *tables: DataFrame) -> str:
    """A column name that none of the tables has: `name`, with underscores behind it if need be."""
    taken = {column.lower() for table in tables for column in table.columns}
    while name.lower() in taken:
        name += "_"
    return name


def crc32_remainder(column: str, divisor: int):
    """crc32 of the value written as text, modulo `divisor`; null for a null value."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % divisor


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of an edge list: equal roots mean connected nodes.

    Each round every node moves to the smallest of its closed neighbourhood, and the edges are
    rewritten between those. Ids should be in random order (hashes are): then a constant share
    of the nodes goes in each round, however long the chains, and the rounds are few. Aggregates
    combine before the shuffle, joins are plain equi-joins that AQE can split, and each round is
    a table in the shared folder.
    """
    edges = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
    edges = stage(
        edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        "edges",
    )
    mapping = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lower = both.groupBy("a").agg(F.min("b").alias("low"))
        lower = stage(
            lower.select(F.col("a").alias("node"), F.least("a", "low").alias("parent")), "lower"
        )
        if mapping is None:
            mapping = lower.withColumnRenamed("parent", "root")
        else:
            mapping = mapping.join(
                lower.withColumnRenamed("node", "root"), "root", "left"
            ).select("node", F.coalesce("parent", "root").alias("root"))
        edges = (
            edges.join(lower.select(F.col("node").alias("a"), F.col("parent").alias("pa")), "a")
            .join(lower.select(F.col("node").alias("b"), F.col("parent").alias("pb")), "b")
            .where("pa <> pb")
            .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
            .distinct()
        )
        edges = stage(edges, "edges")
        if edges.isEmpty():
            return stage(mapping, "components")
