"""What the physical plans must and must not hold."""

import os

import pytest

from checks.queries import QUERIES
from logweir import model as m
from logweir.operators.runs import tail_lines
from logweir.sources.staging import stage

SF = "/root/testdata/sf0.001"
# Queries that run jobs while they are built are covered by the last one named here.
NAMES = [
    "normalize_lines", "normalize_documents", "reject_counts", "line_number_blocks",
    "last_line_date_reset", "history_fold", "exclude_anti_join", "schedule_calendar", "due_at",
    "collect_end_to_end",
]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not at hand")
@pytest.mark.parametrize("name", NAMES)
def test_no_cross_join_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for operator in ("CartesianProduct", "NestedLoop", "EvalPython", "InPandas"):
        assert operator not in text


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not at hand")
@pytest.mark.parametrize(
    "name", ["normalize_lines", "normalize_documents", "reject_reasons", "schedule_calendar"]
)
def test_no_shuffle(spark, name):
    assert "Exchange" not in plan(QUERIES[name](spark, SF))


def test_large_run_tables_are_not_broadcast(spark, tmp_path):
    """Beyond the threshold the staged side is shuffled, with the same result."""
    runs = stage(spark.range(2000).selectExpr("id", "id % 7 AS k"), "runs")
    lines = stage(spark.range(5000).selectExpr("id % 2000 AS id", "id AS n"), "lines")
    assert "BroadcastHashJoin" in plan(lines.join(runs, "id"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    try:
        joined = lines.join(runs, "id")
        assert "SortMergeJoin" in plan(joined)
        assert joined.count() == 5000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_hot_file_is_split_in_the_join_with_the_runs(spark):
    """A third of all lines in one file, and more runs than are broadcast."""
    facts = spark.range(3000).selectExpr(
        "'s' AS server_id", "concat('/f', id) AS source_file_path", "concat('run', id) AS run_key",
        "1L AS start_line", f"'{m.READING}' AS collect_status",
    )
    lines = spark.range(90_000).selectExpr(
        "'s' AS server_id",
        "concat('/f', CASE WHEN id % 3 = 0 THEN 7 ELSE id % 3000 END) AS source_file_path",
        "id + 1 AS line_number", "repeat(md5(cast(id AS string)), 3) AS line",
    )
    facts, lines = stage(facts, "facts"), stage(lines, "lines")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "1k",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.files.maxPartitionBytes": "256k",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        tail = tail_lines(lines, facts)
        assert len(tail.collect()) == 90_000
        assert "skew=true" in plan(tail)
    finally:
        for name in settings:
            spark.conf.unset(name)
