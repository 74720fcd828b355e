"""Tables written once in the middle of a job, in the cluster's shared folder.

A staged table cuts the lineage, so a lost executor costs a re-read of a file and not the job
from its start. It also has an exact size: whether a join with it is broadcast is then Spark's
own decision against `spark.sql.autoBroadcastJoinThreshold`, with a shuffled join beyond it.
"""

import contextlib
import contextvars
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

_CHECKPOINT_DIR = "spark.checkpoint.dir"
_job: contextvars.ContextVar[str | None] = contextvars.ContextVar("job", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder the session names for checkpoints; every executor must reach it."""
    folder = spark.conf.get(_CHECKPOINT_DIR, None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {_CHECKPOINT_DIR} to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="logweir-")
        spark.conf.set(_CHECKPOINT_DIR, folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    parent = _job.get() or f"{shared_folder(spark)}/logweir"
    return f"{parent}/{name}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def job_folder(spark: SparkSession):
    """Keep what is staged inside the block in one folder, and delete it when the block ends."""
    folder = new_folder(spark, "job")
    token = _job.set(folder)
    try:
        yield
    finally:
        _job.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def folders(spark: SparkSession, parent: str) -> list[str]:
    """Names of the folders in a folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(parent)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(path) if s.isDirectory())


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write `df` and give it back as a table read from what was written."""
    spark = df.sparkSession
    folder = new_folder(spark, name)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def stage_numbered(
    df: DataFrame, name: str, column: str, after: int = 0, small: bool = False
) -> DataFrame:
    """Stage `df` with a unique BIGINT, `after + 1` and up without gaps, in place of a sequence.

    A row's number is its place in its written file plus the rows of the files before, both
    fixed on disk: every read of the staged table gives the same numbers. The only rows that
    are shuffled are the per-file counts. They are staged as well, to be joined by their true
    size, unless the table is called `small`.
    """
    staged = stage(df, name)
    rows = staged.select(
        "*",
        F.col("_metadata.file_name").alias("_file"),
        F.col("_metadata.row_index").alias("_place"),
    )
    counts = rows.groupBy("_file").count()
    before = _running_total(counts, "_file", "count", "_before")
    if not small:
        before = stage(before, name + "-files")
    return rows.join(before, "_file").select(
        (F.lit(after) + F.col("_before") + F.col("_place") + 1).alias(column), *df.columns
    )


def _running_total(counts: DataFrame, order: str, count: str, total: str) -> DataFrame:
    """Sum of `count` over the rows that come earlier; one row per written file comes in."""
    earlier = W.orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    return counts.select(order, F.coalesce(F.sum(count).over(earlier), F.lit(0)).alias(total))
