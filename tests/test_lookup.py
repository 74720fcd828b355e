"""The lookup reads the pages of a day's files that can hold its rows."""

import datetime as dt
import glob

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from logweir import model as m
from logweir.operators.lookup import find_logs
from logweir.sources.store import create_store, read_table, write_table


def _scanned(df) -> int:
    """Rows that the scan of a finished query gave; 0 where Spark found nothing to go on with."""
    plan = df._jdf.queryExecution().executedPlan()
    while plan.children().size():
        plan = plan.children().apply(0)
    if "AdaptiveSparkPlan" in plan.getClass().getSimpleName():
        plan = plan.executedPlan()
    while plan.getClass().getSimpleName() != "FileSourceScanExec":
        if plan.getClass().getSimpleName() in ("EmptyRelationExec", "LocalTableScanExec"):
            return 0
        if plan.children().size():
            plan = plan.children().apply(0)
        else:
            plan = plan.plan()
    return plan.metrics().apply("numOutputRows").value()


def test_lookups_read_a_part_of_a_day(spark, tmp_path):
    store = str(tmp_path)
    create_store(spark, store)
    rows = spark.range(200_000, numPartitions=2).selectExpr(
        "id AS collect_log_id", "concat('srv', id % 20) AS server_id", "'ip' AS server_ip",
        "'/a.log' AS source_file_path", "CASE WHEN id % 3 = 0 THEN '수치' ELSE '정보' END AS log_type",
        "concat('ID_', id % 977) AS log_id",
        "timestamp_ntz'2031-11-23 04:56:07' + make_dt_interval(0, 0, 0, id % 999) AS log_timestamp",
        "sha1(string(id)) AS log_content", "sha1(string(id)) AS raw_log", "id AS line_number",
        "'20311123' AS collect_date", "'r' AS run_id",
    )
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", "1024")
    try:
        write_table(rows, store, "collect_log")
        logs = read_table(spark, store, "collect_log")
        # Pages of 20,000 rows: two in each of two files at the most, of five.
        for log_id, most in ((None, 80_000), ("ID_7", 80_000), ("ID_NONE", 0)):
            found = find_logs(logs, "20311123", "srv3", m.NUMERIC, log_id)
            got = sorted(r.collect_log_id for r in found.collect())
            want = rows.where((F.col("server_id") == "srv3") & (F.col("log_type") == m.NUMERIC))
            if log_id:
                want = want.where(F.col("log_id") == log_id)
            assert got == sorted(r.collect_log_id for r in want.collect())
            assert _scanned(found) <= most
    finally:
        spark.conf.unset("spark.sql.parquet.columnarReaderBatchSize")
    for name in glob.glob(f"{store}/collect_log/collect_date=20311123/run_id=r/*.parquet"):
        table = pq.read_table(name, columns=["server_id", "log_type", "log_id"])
        keys = list(zip(*(c.to_pylist() for c in table.columns)))
        assert keys == sorted(keys, key=lambda k: tuple(x.encode() for x in k))
