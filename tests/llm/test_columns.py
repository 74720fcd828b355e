"""Stages of the pipeline leave a caller's columns alone, whatever their names."""

import pytest
from pyspark.sql import functions as F
from rows import docs

from logweir.llm.mixing import mixed
from logweir.llm.quality import accepted
from logweir.llm.secret_scan import findings, redacted
from logweir.llm.simhash import simhash_dedup

INNER = [
    "cdf", "_source", "_rate", "_draw", "_copies", "keep", "_keep", "_keep_fp", "_place", "_fp",
    "_bytes", "_quality_score", "strength", "_id", "findings", "Findings_", "size", "weight", "f",
]
ROWS = [
    (i, f"the text number {i} of {i % 7} words in a row {'and more ' * (i % 5)}", "en", f"s{i % 3}")
    for i in range(40)
]


def _labels(spark):
    rows = [(i, i % 2, 0) for i in range(40)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


STAGES = {
    "quality": lambda spark, table: accepted(table, _labels(spark)),
    "near-duplicates": lambda spark, table: simhash_dedup(table),
    "secrets": lambda spark, table: redacted(table),
    "mixing": lambda spark, table: mixed(table).drop("rate", "copy", "shuffle_key"),
}


@pytest.mark.parametrize("name", list(STAGES))
def test_clashing_columns(spark, name):
    rows = ROWS + [(7, "another text of one id", "en", "s1"), (None, None, None, None)]
    plain = docs(spark, rows)
    clashing = plain.withColumns({c: F.lit(f"own {c}") for c in INNER})
    got = STAGES[name](spark, clashing)
    assert got.columns == clashing.columns
    for row in got.select(*INNER).distinct().collect():
        assert list(row) == [f"own {c}" for c in INNER]
    want = STAGES[name](spark, plain)
    assert sorted(map(str, got.select(*plain.columns).collect())) == sorted(
        map(str, want.collect())
    )


def test_findings_beside_a_column_of_that_name(spark):
    table = docs(spark, [(1, "token = 'k9Xb2LqP7wZr4TnY8sVd'")]).withColumn("findings", F.lit("own"))
    (row,) = findings(table).collect()
    assert row.doc_id == 1 and row.start == 9


def test_weights_of_one_source_add_up(spark):
    table = docs(spark, ROWS)
    schema = "source string, weight double"
    whole = spark.createDataFrame([("s0", 3.0), ("s1", 1.0), ("s2", 1.0)], schema)
    parts = spark.createDataFrame([("s0", 1.0), ("s0", 2.0), ("s1", 1.0), ("s2", 1.0)], schema)
    a, b = (sorted(map(str, mixed(table, w).collect())) for w in (whole, parts))
    assert a == b


def test_ties_are_broken_by_all_columns(spark):
    rows = [(1, "same text of some words", "en", "s")] * 6
    table = docs(spark, rows).withColumn("note", F.lit("z"))
    for note in ("c", "a", "b"):
        table = table.unionByName(docs(spark, rows).withColumn("note", F.lit(note)))
    for partitions in (1, 5):
        (kept,) = simhash_dedup(table.repartition(partitions)).collect()
        assert kept.note == "a"
