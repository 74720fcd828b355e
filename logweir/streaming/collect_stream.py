"""Collection whenever something has landed, as a stream of arrived segments.

The stream only notes which files have new segments; the job then reads the landed files by their
history, as a scheduled job does. A file over a limit or excluded therefore loses nothing: it
stays where it landed and is read after its restore. Segments land under new names (see
`sources.lines`), and those read to their end are not opened again. With `growing`, segments may
also grow: `streaming.growth` notes files whose bytes have changed.

A file belongs to a periodic schedule whose template can stand for it on any date, so that a
segment which arrives after midnight still finds its schedule. Of several such schedules it is
that whose day and hours hold when the batch runs, or else the first by key: a batch has one run
per file. A file that no schedule names is recorded as failed, for that reason.

Runs are named after the query's id in its checkpoint and the number of the batch: a replayed
batch meets its own runs, with the time of its first try, and a new checkpoint meets none. No
watermark: records are taken whatever their time.
"""

import datetime as dt
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from logweir import model as m
from logweir.functions.paths import resolved_path
from logweir.operators.exclusions import active_exclusions
from logweir.operators.runs import FILE_COLUMNS
from logweir.operators.schedules import SCHEDULE_COLUMNS, open_at, schedule_key, with_rules
from logweir.plans.collect import collect_landed
from logweir.plans.compact import past
from logweir.sources.lines import LISTING
from logweir.sources.staging import job_folder, stage
from logweir.sources.store import CLOSE, OPEN, create_store, read_table
from logweir.streaming.growth import growth_stream


def segment_stream(spark: SparkSession, landed: str) -> DataFrame:
    """FILE_COLUMNS of every segment that arrives; no segment is opened."""
    return spark.readStream.format("binaryFile").schema(LISTING).load(landed).select(*FILE_COLUMNS)


def collect_stream(
    spark: SparkSession,
    landed: str,
    store: str,
    schedules: DataFrame,
    checkpoint: str,
    clock: Callable[[], dt.datetime] = dt.datetime.now,
    options: dict | None = None,
    growing: bool = False,
    **trigger,
) -> StreamingQuery:
    """Start the stream. `options` go to `collect_landed`, `trigger` to the stream's trigger,
    which is `availableNow=True` unless given. A checkpoint is for one kind of `growing`."""
    periodic = with_rules(schedules.select(*SCHEDULE_COLUMNS))
    periodic = periodic.where(F.col("schedule_type") == m.PERIODIC)

    def collect_batch(batch: DataFrame, batch_id: int) -> None:
        run_id = f"{_query_id(spark, checkpoint)}-{batch_id}"
        create_store(spark, store)
        run_ts = _first_try(spark, store, run_id) or clock()
        with job_folder(spark):
            files = batch.distinct().unionByName(_restored(spark, store)).distinct()
            due = stage(files_due(stage(files, "files"), periodic, run_ts), "due")
            collect_landed(
                spark, store, landed, due, run_ts, run_id=run_id, clock=clock, **(options or {})
            )

    if growing:
        arrived = growth_stream(spark, landed, checkpoint)
    else:
        arrived = segment_stream(spark, landed)
    return (
        arrived.writeStream.foreachBatch(collect_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def files_due(files: DataFrame, schedules: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """One row per file, with `landed_path` and the schedule that names it on some date.

    A schedule whose day and hours hold at `run_ts` goes before the others, then the smallest key
    counts. Files without a schedule have a row without type and expression.
    """
    # Equal for a template and all paths it stands for, whatever digits stand beside the date.
    def shape(path):
        return F.regexp_replace(path, rf"(\d|{m.DATE_PLACEHOLDER})+", "#")

    bare = resolved_path(F.col("source_file_path"), F.lit(m.DATE_PLACEHOLDER))
    named = schedules.select(
        *SCHEDULE_COLUMNS, "schedule_type", shape(bare).alias("shape"),
        (~open_at(run_ts)).alias("closed"),
    )
    landed = files.select(
        F.col("server_id"), F.col("source_file_path").alias("landed_path"),
        shape(F.col("source_file_path")).alias("shape"),
    )
    dates = F.concat(
        F.array(F.lit("")), F.regexp_extract_all("landed_path", F.lit(r"(?=(\d{8}))"), F.lit(1))
    )
    fits = F.exists(
        dates, lambda d: resolved_path(F.col("source_file_path"), d) == F.col("landed_path")
    )
    matched = landed.join(named, ["server_id", "shape"]).where(fits)
    # Aggregated before the shuffle, so that many schedules of one file are no burden.
    schedule = F.struct("closed", schedule_key(), *SCHEDULE_COLUMNS[1:], "schedule_type")
    matched = matched.groupBy("server_id", "landed_path").agg(F.min(schedule).alias("first"))
    matched = matched.select(
        "server_id", "landed_path", *[f"first.{c}" for c in (*SCHEDULE_COLUMNS[1:], "schedule_type")]
    )
    unnamed = (
        landed.join(matched, ["server_id", "landed_path"], "left_anti")
        .drop("shape")
        .withColumn("source_file_path", F.col("landed_path"))
    )
    return matched.unionByName(unnamed, allowMissingColumns=True)


def _query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark keeps in the checkpoint for as long as that lives."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first().value)["id"]


def _first_try(spark: SparkSession, store: str, run_id: str) -> dt.datetime | None:
    """The time of a batch that had begun before, from its opening rows."""
    opened = past(spark, store).events.where(
        (F.col("run_id") == run_id) & (F.col("stage") == OPEN)
    )
    return opened.agg(F.min("created_at")).first()[0]


def _restored(spark: SparkSession, store: str) -> DataFrame:
    """Files whose newest run was skipped and which no exclusion blocks any more."""
    known = past(spark, store)
    ended = known.events.where(
        (F.col("stage") == CLOSE) & F.col("collect_start_at").isNotNull()
    ).unionByName(known.ended(), allowMissingColumns=True)
    newest = ended.groupBy(*FILE_COLUMNS).agg(
        F.max_by("collect_status", F.struct("collect_start_at", "collect_history_id")).alias("s")
    )
    blocked = active_exclusions(read_table(spark, store, "collect_exclude"))
    skipped = newest.where(F.col("s") == m.SKIP).select(*FILE_COLUMNS)
    return skipped.join(blocked, FILE_COLUMNS, "left_anti")
