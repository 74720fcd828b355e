"""Schedule files."""

from pyspark.sql import DataFrame, SparkSession

from logweir.operators.schedules import parse_schedules


def read_schedules(spark: SparkSession, path) -> DataFrame:
    """Valid schedules of a schedule file; comments, blank and malformed lines are left out."""
    return parse_schedules(spark.read.text(path).withColumnRenamed("value", "line"))
