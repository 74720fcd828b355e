"""Run history: events that are folded into one row per run, and the last line read per file."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweir import model as m
from logweir.functions.times import day_text

FILE_COLUMNS = ["server_id", "source_file_path"]
_ID = "collect_history_id"
_RUN_COLUMNS = ("path_template", "run_key", "schedule_key", "run_date", "run_index")


def fold_history(events: DataFrame, order: str = "seq") -> DataFrame:
    """Latest value per column and run.

    An event changes the columns it sets and leaves the others; an empty status changes nothing;
    every event sets `updated_at`. Partial aggregation keeps one row per run on each side of the
    shuffle.
    """
    folded = []
    for column in events.columns:
        if column in (_ID, order):
            continue
        value = F.col(column)
        counts = F.lit(True) if column == "updated_at" else value.isNotNull()
        if column == "collect_status":
            counts = counts & (value != "")
        folded.append(F.max_by(value, F.when(counts, F.col(order))).alias(column))
    return events.groupBy(_ID).agg(*folded)


def opening_events(runs: DataFrame, run_ts: Column) -> DataFrame:
    """The row written before a run starts: failed until proven otherwise."""
    return runs.select(
        _ID, "server_id", "server_ip", "source_file_path", "schedule_type",
        F.lit(m.FAIL).alias("collect_status"),
        F.lit(0).cast("bigint").alias("retry_count"),
        F.lit(m.IN_PROGRESS).alias("fail_reason"),
        run_ts.alias("collect_start_at"),
        day_text(run_ts).alias("collect_date"),
        run_ts.alias("created_at"),
        run_ts.alias("updated_at"),
        F.lit(0).alias("seq"),
        *[c for c in (*_RUN_COLUMNS, "run_id", "stage") if c in runs.columns],
    )


def last_lines(history: DataFrame, collect_date: str | Column) -> DataFrame:
    """Per file, the last line of its newest successful run: of any day, and of `collect_date`.

    `last_any` serves paths that keep their position over days, `last_today` all others. The
    kind of run plays no part.
    """
    date = F.lit(collect_date) if isinstance(collect_date, str) else collect_date
    newest = F.struct("collect_start_at", _ID)
    return (
        history.where(F.col("collect_status") == m.SUCCESS)
        .groupBy(*FILE_COLUMNS)
        .agg(
            F.max_by("last_line_number", newest).alias("last_any"),
            F.max_by("last_line_number", F.when(F.col("collect_date") == date, newest))
            .alias("last_today"),
        )
    )
