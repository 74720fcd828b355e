"""The state of a store: what a job needs of its past, for the days before a given one.

A job asks the history for the last line of each file, how far segments were read, the newest
outcome of each file and the highest ids. These grow with every job, while their answer has one
row per file or segment. `compact` folds closed days into that answer, beside the one before:

    <store>/state/until=<day>/{files,segments,totals}

A state is written under a temporary name and becomes visible by one rename; readers take the one
of the latest day and add the days from then on (`Past`). Days on which a run was opened and not
closed are not folded, so that a crashed job still finds its own rows when it is run again.
"""

import datetime as dt
import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweir import model as m
from logweir.sources.lease import writing
from logweir.sources.staging import folders
from logweir.sources.store import CLOSE, OPEN, create_store, read_table

FILE_COLUMNS = ["server_id", "source_file_path"]
#: `last_*` are of the newest successful run, `status*` of the newest run that ended.
FILES = (
    "server_id string, source_file_path string, last_line_number bigint, "
    "last_start_at timestamp_ntz, last_history_id bigint, collect_status string, "
    "status_start_at timestamp_ntz, status_history_id bigint"
)
TOTALS = "last_history_id bigint, issued_ids bigint"
_TABLES = {"files": FILES, "segments": m.SEGMENTS, "totals": TOTALS}


class Past(NamedTuple):
    """The state and the days after it."""

    until: str | None
    files: DataFrame
    segments: DataFrame
    totals: DataFrame
    events: DataFrame

    def successes(self) -> DataFrame:
        """Rows like history's that hold the last line of every file of the state."""
        return self.files.where(F.col("last_history_id").isNotNull()).select(
            *FILE_COLUMNS, "last_line_number", F.col("last_start_at").alias("collect_start_at"),
            F.col("last_history_id").alias("collect_history_id"),
            F.lit(m.SUCCESS).alias("collect_status"), F.lit("").alias("collect_date"),
        )

    def ended(self) -> DataFrame:
        """Rows like history's that hold the newest outcome of every file of the state."""
        return self.files.where(F.col("status_history_id").isNotNull()).select(
            *FILE_COLUMNS, "collect_status", F.col("status_start_at").alias("collect_start_at"),
            F.col("status_history_id").alias("collect_history_id"),
        )


def past(spark: SparkSession, store: str, day: str | None = None) -> Past:
    """What a job of `day` (yyyyMMdd) has to know; a job of a folded day reads all days."""
    until = _until(spark, store)
    if until is not None and day is not None and day < until:
        until = None
    events = read_table(spark, store, "history_events", until)
    segments = read_table(spark, store, "segments", until)
    if until is None:
        empty = {name: spark.createDataFrame([], schema) for name, schema in _TABLES.items()}
        return Past(None, empty["files"], segments, empty["totals"], events)
    state = {
        name: spark.read.schema(schema).parquet(f"{store}/state/until={until}/{name}")
        for name, schema in _TABLES.items()
    }
    return Past(
        until, state["files"], state["segments"].unionByName(segments), state["totals"], events
    )


def compact(spark: SparkSession, store: str, before: dt.date) -> str | None:
    """Fold the days before `before` into the state; the day that the state now reaches."""
    create_store(spark, store)
    with writing(spark, store, f"compact {before:%Y%m%d}"):
        known = past(spark, store)
        closed = known.events.where(F.col("stage") == CLOSE).select("run_key")
        waiting = known.events.where(F.col("stage") == OPEN).join(closed, "run_key", "left_anti")
        earliest = waiting.agg(F.min("collect_date")).first()[0]
        until = min(f"{before:%Y%m%d}", earliest or "99999999")
        if known.until is not None and until <= known.until:
            return known.until
        folded = F.col("collect_date") < until
        ended = known.events.where(
            folded & (F.col("stage") == CLOSE) & F.col("collect_start_at").isNotNull()
        )
        new = f"{store}/state/_new-{uuid.uuid4().hex}"
        _files(known.files, ended).write.parquet(f"{new}/files")
        newest = F.max_by(
            F.struct(*[c for c in known.segments.columns if c not in (*FILE_COLUMNS, "segment")]),
            F.struct("modified", "length"),
        )
        segments = known.segments.where(folded).groupBy(*FILE_COLUMNS, "segment")
        segments.agg(newest.alias("s")).select(*FILE_COLUMNS, "segment", "s.*").write.parquet(
            f"{new}/segments"
        )
        totals = known.events.where(folded).select(
            F.col("collect_history_id").alias("last_history_id"), "issued_ids"
        )
        known.totals.unionByName(totals).agg(
            F.max("last_history_id").alias("last_history_id"),
            F.sum("issued_ids").alias("issued_ids"),
        ).write.parquet(f"{new}/totals")
        path = spark._jvm.org.apache.hadoop.fs.Path
        source, target = path(new), path(f"{store}/state/until={until}")
        files = source.getFileSystem(spark._jsc.hadoopConfiguration())
        if not files.rename(source, target):
            raise OSError(f"{target} could not be put in place")
        return until


def _files(state: DataFrame, ended: DataFrame) -> DataFrame:
    """One row per file, of the state before and the runs that ended since."""
    run = F.struct("collect_start_at", "collect_history_id")
    done = F.col("collect_status") == m.SUCCESS
    fresh = ended.groupBy(*FILE_COLUMNS).agg(
        F.max(F.when(done, F.struct("collect_start_at", "collect_history_id", "last_line_number")))
        .alias("last"),
        F.max_by(F.struct("collect_status", *("collect_start_at", "collect_history_id")), run)
        .alias("status"),
    )
    fresh = fresh.select(
        *FILE_COLUMNS, F.col("last.last_line_number"),
        F.col("last.collect_start_at").alias("last_start_at"),
        F.col("last.collect_history_id").alias("last_history_id"),
        F.col("status.collect_status"), F.col("status.collect_start_at").alias("status_start_at"),
        F.col("status.collect_history_id").alias("status_history_id"),
    )
    last = F.when(
        F.col("last_history_id").isNotNull(),
        F.struct("last_start_at", "last_history_id", "last_line_number"),
    )
    status = F.struct("status_start_at", "status_history_id", "collect_status")
    both = state.unionByName(fresh).groupBy(*FILE_COLUMNS)
    return both.agg(F.max(last).alias("l"), F.max(status).alias("s")).select(
        *FILE_COLUMNS, "l.last_line_number", "l.last_start_at", "l.last_history_id",
        "s.collect_status", "s.status_start_at", "s.status_history_id",
    )


def _until(spark: SparkSession, store: str) -> str | None:
    days = [n[6:] for n in folders(spark, f"{store}/state") if n.startswith("until=")]
    return max(days, default=None)
