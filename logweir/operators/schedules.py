"""Schedules: text lines to rules, rules to due runs and run calendars."""

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweir import model as m
from logweir.functions.rows import finish
from logweir.functions.text import edge_trim
from logweir.functions.times import seconds_of_day, weekday_digit

SCHEDULE_COLUMNS = ["server_id", "server_ip", "source_file_path", "schedule_expression"]
RULE_COLUMNS = ["schedule_type", "day_from", "day_to", "start_sec", "interval_min", "end_sec"]
_DAYS = r"\A(\*|[0-6]|[0-6]-[0-6])\z"
_HHMMSS = r"\A([01]\d|2[0-3])[0-5]\d[0-5]\d\z"
_COUNT = r"\A\+?\d+\z"


def parse_schedules(lines: DataFrame) -> DataFrame:
    """Lines `[server][ip][path][expression]` to schedules with their rule columns.

    Other columns of `lines` are kept. Lines that are no valid schedule give no row.
    """
    carried = [c for c in lines.columns if c != "line"]
    brackets = F.col("_brackets")
    texts = finish(lines, carried, edge_trim(F.col("line")).alias("_text"))
    cut = texts.where((F.col("_text") != "") & ~F.startswith("_text", F.lit("#"))).select(
        *carried,
        F.regexp_extract_all("_text", F.lit(r"\[([^\]]*)\]"), F.lit(1)).alias("_brackets"),
    )
    fields = finish(
        cut, carried, F.size(brackets).alias("_n"),
        *[edge_trim(F.get(brackets, i)).alias(c) for i, c in enumerate(SCHEDULE_COLUMNS)],
    )
    complete = F.col("_n") == 4
    for column in SCHEDULE_COLUMNS:
        complete = complete & (F.col(column) != "")
    return with_rules(fields.where(complete).drop("_n"))


def with_rules(schedules: DataFrame) -> DataFrame:
    """Add the rule columns to rows with a `schedule_expression`; drop rows without a valid one."""
    carried = schedules.columns
    parts, days, start, every, end = (
        F.col(c) for c in ("_parts", "_days", "_start", "_every", "_end")
    )
    split = schedules.withColumn("_parts", F.split("schedule_expression", r"\|", -1))
    cut = finish(
        split, carried, F.size(parts).alias("_n"),
        *[
            edge_trim(F.get(parts, i)).alias(c)
            for i, c in enumerate(("schedule_type", "_days", "_start", "_every", "_end"))
        ],
    )
    batch, periodic = (F.col("schedule_type") == t for t in (m.BATCH, m.PERIODIC))
    rules = finish(
        cut, [*carried, "schedule_type"],
        F.when(days == "*", 0).otherwise(F.left(days, F.lit(1)).try_cast("int"))
        .alias("day_from"),
        F.when(days == "*", 6).otherwise(F.right(days, F.lit(1)).try_cast("int"))
        .alias("day_to"),
        seconds_of_day(start).alias("start_sec"),
        F.when(periodic & every.rlike(_COUNT), every.try_cast("int")).alias("interval_min"),
        F.when(periodic, seconds_of_day(end)).alias("end_sec"),
        (
            days.rlike(_DAYS)
            & start.rlike(_HHMMSS)
            & (
                (batch & (F.col("_n") == 3))
                | (periodic & (F.col("_n") == 5) & end.rlike(_HHMMSS))
            )
        ).alias("_well_formed"),
    )
    valid = (
        F.col("_well_formed")
        & (F.col("day_from") <= F.col("day_to"))
        & (F.col("start_sec") >= 1)
        & (batch | (F.col("interval_min") > 0))
    )
    return rules.where(valid).select(*carried, *RULE_COLUMNS)


def schedule_key() -> Column:
    return F.concat_ws("::", *SCHEDULE_COLUMNS)


def open_at(run_ts: dt.datetime) -> Column:
    """Whether day and hours of a periodic schedule hold."""
    second = F.lit(run_ts.hour * 3600 + run_ts.minute * 60 + run_ts.second)
    weekday = F.lit((run_ts.weekday() + 1) % 7)
    return weekday.between(F.col("day_from"), F.col("day_to")) & second.between(
        F.col("start_sec"), F.col("end_sec")
    )


def due_runs(schedules: DataFrame, run_ts: dt.datetime, taken: DataFrame | None = None) -> DataFrame:
    """Schedules that are due at `run_ts`, with `schedule_key`, `run_date` and `run_index`.

    `taken(schedule_key, run_date, run_index)` holds the runs that were already started; each run
    is taken once.
    """
    second = run_ts.hour * 3600 + run_ts.minute * 60 + run_ts.second
    weekday = (run_ts.weekday() + 1) % 7
    passed = F.lit(second) - F.col("start_sec")
    interval = F.col("interval_min").cast("bigint") * 60
    batch = (F.col("schedule_type") == m.BATCH) & (passed < m.DUE_WINDOW_SECONDS)
    periodic = (
        (F.col("schedule_type") == m.PERIODIC)
        & (F.col("end_sec") >= second)
        & (passed % interval < m.DUE_WINDOW_SECONDS)
    )
    due = schedules.where(
        F.lit(weekday).between(F.col("day_from"), F.col("day_to"))
        & (passed >= 0)
        & (batch | periodic)
    ).select(
        "*",
        schedule_key().alias("schedule_key"),
        F.lit(run_ts.date()).alias("run_date"),
        F.when(F.col("schedule_type") == m.BATCH, F.lit(0).cast("bigint"))
        .otherwise(F.floor(passed / interval))
        .alias("run_index"),
    )
    if taken is None:
        return due
    return due.join(taken, ["schedule_key", "run_date", "run_index"], "left_anti")


def due_between(schedules: DataFrame, after: dt.datetime, until: dt.datetime) -> DataFrame:
    """Schedules that fired after `after` and not after `until`, however late the poll is.

    One row for each schedule and date, with `schedule_key`, `run_date`, the `run_index` and
    `run_at` of the last firing and the number of `firings` that it stands for: a run reads all
    that is there, so those before it are made good by it.
    """
    days = F.explode(F.sequence(F.lit(after.date()), F.lit(until.date()))).alias("run_date")
    rows = schedules.select("*", days).where(
        weekday_digit(F.col("run_date")).between(F.col("day_from"), F.col("day_to"))
    )

    def seconds(moment: dt.datetime) -> Column:
        """From the start of the run's date."""
        second = moment.hour * 3600 + moment.minute * 60 + moment.second
        return F.date_diff(F.lit(moment.date()), F.col("run_date")).cast("bigint") * 86400 + second

    start, batch = F.col("start_sec"), F.col("schedule_type") == m.BATCH
    step = F.when(batch, F.lit(1).cast("bigint")).otherwise(F.col("interval_min").cast("bigint") * 60)
    end = F.when(batch, start).otherwise(F.col("end_sec"))
    first = F.greatest(F.lit(0).cast("bigint"), F.floor((seconds(after) - start) / step) + 1)
    last = F.floor((F.least(seconds(until), end) - start) / step)
    rows = finish(
        rows, rows.columns, first.alias("_first"), last.alias("run_index"), step.alias("_step")
    ).where(F.col("run_index") >= F.col("_first"))
    run_at = F.col("run_date").cast("timestamp_ntz") + F.make_dt_interval(
        secs=F.col("start_sec") + F.col("run_index") * F.col("_step")
    )
    return rows.select(
        *schedules.columns, schedule_key().alias("schedule_key"), "run_date", "run_index",
        run_at.alias("run_at"), (F.col("run_index") - F.col("_first") + 1).alias("firings"),
    )


def missed_runs(
    schedules: DataFrame, closed: DataFrame, first: dt.date, last: dt.date
) -> DataFrame:
    """Runs of the calendar that no closed run has made good.

    `closed(schedule_key, run_date, run_index)` holds the runs that ended. A run makes good the
    earlier ones of its schedule and date.
    """
    done = closed.groupBy("schedule_key", "run_date").agg(F.max("run_index").alias("_done"))
    calendar = run_calendar(schedules, first, last).withColumn("schedule_key", schedule_key())
    open_ = F.col("_done").isNull() | (F.col("run_index") > F.col("_done"))
    return calendar.join(done, ["schedule_key", "run_date"], "left").where(open_).drop("_done")


def run_calendar(schedules: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Every expected run from `first` to `last`: one row per schedule and firing time."""
    dates = F.sequence(F.lit(first), F.lit(last))
    matching = F.filter(
        dates, lambda d: weekday_digit(d).between(F.col("day_from"), F.col("day_to"))
    )
    start, end = F.col("start_sec"), F.col("end_sec")
    # A step of a day or more fires once a day, however long it is.
    step = F.least(F.col("interval_min").cast("bigint") * 60, F.lit(86400)).cast("int")
    firings = (
        F.when(F.col("schedule_type") == m.BATCH, F.array(start))
        .when(end >= start, F.sequence(start, F.greatest(start, end), step))
        .otherwise(F.array().cast("array<int>"))
    )
    rows = schedules.select("*", F.explode(matching).alias("run_date"))
    return rows.select("*", F.posexplode(firings).alias("_index", "_second")).select(
        *schedules.columns,
        "run_date",
        F.col("_index").cast("bigint").alias("run_index"),
        (
            F.col("run_date").cast("timestamp_ntz")
            + F.make_dt_interval(secs=F.col("_second"))
        ).alias("run_at"),
    )
