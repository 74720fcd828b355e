"""The tables of a collection, as Parquet folders under one root.

Each run job owns one partition of every table, named after its run time, and writes it with
dynamic partition overwrite: a job that is run again after a crash replaces what it had written.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from logweir import model as m
from logweir.sources.staging import exists, folders

CLOSE = "close"
OPEN = "open"

TABLES = {
    "collect_log": (m.COLLECT_LOG, ["collect_date", "run_id"]),
    "collect_reject": (m.COLLECT_REJECT, ["collect_date", "run_id"]),
    "collect_exclude": (m.COLLECT_EXCLUDE, ["exclude_date", "run_id"]),
    "segments": (m.SEGMENTS, ["collect_date", "run_id"]),
    "polls": (m.POLLS, ["collect_date", "run_id"]),
    "history_events": (m.HISTORY_EVENTS, ["collect_date", "run_id", "stage"]),
}


# Order of a table's rows within a file, and columns with a Bloom filter: what lookups ask for
# stands together, so that a lookup reads a few pages of a day's files. Rows stay in their tasks.
SORTED = {"collect_log": ["server_id", "log_type", "log_id", "log_timestamp"]}
BLOOM = {"collect_log": ["log_id"]}


def create_store(spark: SparkSession, root: str) -> None:
    """Make the folders of tables that do not exist yet."""
    for name, (schema, _) in TABLES.items():
        if not exists(spark, f"{root}/{name}"):
            spark.createDataFrame([], schema).write.mode("append").parquet(f"{root}/{name}")


def read_table(
    spark: SparkSession, root: str, name: str, since: str | None = None
) -> DataFrame:
    """A table; with `since` only its days from then on, and no older folder is looked at."""
    reader = spark.read.schema(TABLES[name][0])
    if since is None:
        return reader.parquet(f"{root}/{name}")
    day = f"{TABLES[name][1][0]}="
    days = [n for n in folders(spark, f"{root}/{name}") if n.startswith(day) and n >= day + since]
    if not days:
        return spark.createDataFrame([], TABLES[name][0])
    return reader.option("basePath", f"{root}/{name}").parquet(*[f"{root}/{name}/{n}" for n in days])


def read_logs(spark: SparkSession, root: str) -> DataFrame:
    """Logs of finished jobs; what a crashed job left behind waits for its rerun."""
    closed = read_table(spark, root, "history_events").where(F.col("stage") == CLOSE)
    closed = closed.select("collect_date", "run_id").distinct()
    return read_table(spark, root, "collect_log").join(
        closed, ["collect_date", "run_id"], "left_semi"
    )


def write_table(df: DataFrame, root: str, name: str) -> None:
    """Write the partitions that `df` has rows for, in place of what they held."""
    schema, partitions = TABLES[name]
    full = df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in StructType.fromDDL(schema).fields
        ]
    )
    if name in SORTED:
        # The partition columns first, as Spark's own sort before a partitioned write has them.
        full = full.sortWithinPartitions(*partitions, *SORTED[name])
    writer = full.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    for column in BLOOM.get(name, []):
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
        writer = writer.option(f"parquet.bloom.filter.adaptive.enabled#{column}", "true")
    writer.partitionBy(*partitions).parquet(f"{root}/{name}")
