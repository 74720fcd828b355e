"""Files that are blocked from collection until an operator restores them."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweir import model as m
from logweir.functions.times import day_text

FILE_COLUMNS = ["server_id", "source_file_path"]


def active_exclusions(exclude: DataFrame) -> DataFrame:
    """Number of active exclusions per file; files without one have no row."""
    return (
        exclude.where(F.col("restore_yn") == m.NO)
        .groupBy(*FILE_COLUMNS)
        .agg(F.count(F.lit(1)).alias("active_count"))
    )


def not_excluded(runs: DataFrame, exclude: DataFrame) -> DataFrame:
    """Runs whose file is free; exclusions are counted per file before they meet the runs."""
    return runs.join(active_exclusions(exclude), FILE_COLUMNS, "left_anti")


def exclusion_rows(outcomes: DataFrame, run_ts: Column) -> DataFrame:
    """Exclusions to register for runs that ended over a size limit, without their id.

    The flag that frees a file is N unless the row says otherwise.
    """
    reason = F.when(F.col("fail_reason") == m.INIT_SIZE_EXCEEDED, m.INIT_SIZE).when(
        F.col("fail_reason") == m.PART_SIZE_EXCEEDED, m.PART_SIZE
    )
    flag = F.col("restore_yn") if "restore_yn" in outcomes.columns else F.lit(None).cast("string")
    return (
        outcomes.withColumn("exclude_reason", reason)
        .where(F.col("exclude_reason").isNotNull())
        .select(
            "server_id", "server_ip", "source_file_path", "exclude_reason",
            F.col("file_size_bytes").alias("exclude_file_size"),
            F.when(F.col("exclude_reason") == m.INIT_SIZE, m.INIT_SIZE_DETAIL)
            .otherwise(m.PART_SIZE_DETAIL)
            .alias("exclude_detail"),
            F.coalesce(flag, F.lit(m.NO)).alias("restore_yn"),
            F.lit(None).cast("timestamp_ntz").alias("restore_at"),
            F.lit(None).cast("string").alias("restore_memo"),
            day_text(run_ts).alias("exclude_date"),
            run_ts.alias("created_at"),
            run_ts.alias("updated_at"),
        )
    )
