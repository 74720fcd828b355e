"""Jobs for whatever has come due since the poll before.

A poll stands for the time since the last one, and the store keeps that stretch by the job's name.
So a poll that comes late, after a long job or an outage, loses no run, one that comes early takes
none twice, and a job that is run again after a crash has the same runs as before.
"""

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweir import model as m
from logweir.operators.schedules import due_between, missed_runs
from logweir.plans.collect import TAKEN_COLUMNS, collect_landed
from logweir.sources.staging import job_folder, stage
from logweir.sources.store import CLOSE, OPEN, create_store, read_table, write_table


def open_poll(
    spark: SparkSession, store: str, run_ts: dt.datetime, run_id: str
) -> tuple[dt.datetime, dt.datetime]:
    """The stretch (after, until] that the poll of `run_id` stands for, noted in the store.

    It goes on where the latest poll of another job ended. The first poll of a store looks back
    for the window of a single poll.
    """
    create_store(spark, store)
    polls = read_table(spark, store, "polls")
    own, last = polls.agg(
        F.max(F.when(F.col("run_id") == run_id, F.struct("polled_after", "polled_until"))),
        F.max(F.when(F.col("run_id") != run_id, F.col("polled_until"))),
    ).first()
    if own is not None:
        return own.polled_after, own.polled_until
    after = last or run_ts - dt.timedelta(seconds=m.DUE_WINDOW_SECONDS)
    until = max(after, run_ts)
    row = (after, until, f"{run_ts:%Y%m%d}", run_id)
    write_table(spark.createDataFrame([row], m.POLLS), store, "polls")
    return after, until


def collect_polled(
    spark: SparkSession,
    store: str,
    landed: str,
    schedules: DataFrame,
    run_ts: dt.datetime,
    run_id: str | None = None,
    **options,
) -> None:
    """Collect all runs that came due since the last poll; `options` go to `collect_landed`."""
    run_id = run_id or f"{run_ts:%Y%m%dT%H%M%S}"
    after, until = open_poll(spark, store, run_ts, run_id)
    with job_folder(spark):
        due = stage(due_between(schedules, after, until), "due")
        collect_landed(spark, store, landed, due, run_ts, run_id=run_id, **options)


def gaps(
    spark: SparkSession, store: str, schedules: DataFrame, first: dt.date, last: dt.date
) -> DataFrame:
    """Runs that the calendar asks for from `first` to `last` and that no job has ended."""
    events = read_table(spark, store, "history_events").where(
        F.col("collect_date") >= f"{first:%Y%m%d}"
    )
    ended = events.where(F.col("stage") == CLOSE).select("run_key").distinct()
    opened = events.where((F.col("stage") == OPEN) & F.col("run_index").isNotNull())
    closed = opened.join(ended, "run_key", "left_semi").select(*TAKEN_COLUMNS)
    return missed_runs(schedules, closed, first, last)
