"""Facts about due runs: path, start line, what was read, outcome."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logweir import model as m
from logweir.functions.paths import keeps_position, resolved_path
from logweir.operators.exclusions import active_exclusions
from logweir.operators.history import last_lines
from logweir.operators.normalize import marked

FILE_COLUMNS = ["server_id", "source_file_path"]


def resolve_paths(runs: DataFrame, collect_date: str | Column) -> DataFrame:
    """Replace the path template by the path of that date.

    The template stays as `path_template`, its plus sign becomes `keeps_position`.
    """
    date = F.lit(collect_date) if isinstance(collect_date, str) else collect_date
    template = F.col("source_file_path")
    return runs.withColumns(
        {
            "path_template": template,
            "keeps_position": keeps_position(template),
            "source_file_path": resolved_path(template, date),
        }
    )


def settle_runs(
    runs: DataFrame,
    sizes: DataFrame,
    history: DataFrame,
    exclude: DataFrame,
    collect_date: str | Column,
    init_limit: int = m.INIT_LIMIT_BYTES,
) -> DataFrame:
    """What is known of a run before its file is opened.

    Adds `file_size_bytes`, `start_line`, `collect_status` and `fail_reason`. The status is
    READING for runs that go on to read their file, and final for all others. A run without a
    schedule type stands for a file that no schedule names.
    """
    found = (
        runs.join(active_exclusions(exclude), FILE_COLUMNS, "left")
        .join(sizes.select(*FILE_COLUMNS, "file_size_bytes"), FILE_COLUMNS, "left")
        .join(last_lines(history, collect_date), FILE_COLUMNS, "left")
    )
    size = F.col("file_size_bytes")
    periodic = F.col("schedule_type") == m.PERIODIC
    last = F.when(F.col("keeps_position"), F.col("last_any")).otherwise(F.col("last_today"))
    unnamed = F.col("schedule_type").isNull()
    reason = (
        F.when(unnamed, m.NO_SCHEDULE)
        .when(F.col("active_count") > 0, m.EXCLUDED)
        .when(size.isNull(), F.concat(F.lit("file missing: "), "source_file_path"))
        .when(~periodic & (size >= init_limit), m.INIT_SIZE_EXCEEDED)
    )
    status = (
        F.when(unnamed, m.FAIL)
        .when(F.col("active_count") > 0, m.SKIP)
        .when(size.isNull(), m.FAIL)
        .when(~periodic & (size >= init_limit), m.SKIP)
        .otherwise(m.READING)
    )
    return found.select(
        *runs.columns,
        # The size of an excluded file is never looked up.
        F.when(F.col("active_count").isNull(), size).alias("file_size_bytes"),
        (F.when(periodic, F.coalesce(last, F.lit(0))).otherwise(0) + 1).cast("bigint")
        .alias("start_line"),
        status.alias("collect_status"),
        reason.alias("fail_reason"),
    )


def one_reader(facts: DataFrame) -> DataFrame:
    """Let one run read each file; other runs of the file become BEHIND, with its `reader_key`.

    Schedules that name one file may be due together. A batch run reads before a periodic one, as
    it reads the whole file, then that which starts first, then the first by key.
    """
    reading = F.col("collect_status") == m.READING
    order = F.struct(F.col("schedule_type") != m.BATCH, "start_line", "run_key")
    # One window over rows of the schedule file; a second use of the facts would settle them twice.
    first = F.min(F.when(reading, order)).over(W.partitionBy(*FILE_COLUMNS))
    behind = reading & (F.col("_first.run_key") != F.col("run_key"))
    return facts.withColumn("_first", first).select(
        *[c for c in facts.columns if c != "collect_status"],
        F.when(behind, m.BEHIND).otherwise(F.col("collect_status")).alias("collect_status"),
        F.when(behind, F.col("_first.run_key")).alias("reader_key"),
    )


def slim_lines(lines: DataFrame) -> DataFrame:
    """Add `line_bytes` and blank out plain lines, of which only number and length matter."""
    line = F.col("line")
    return lines.withColumns(
        {"line_bytes": F.octet_length(line), "line": F.when(marked(line), line)}
    )


def tail_lines(lines: DataFrame, facts: DataFrame) -> DataFrame:
    """Lines each run has to read: from its start line on, with the run's `run_key`.

    `facts` of runs that read nothing give no lines. Kept free of hints: with a staged run table
    Spark broadcasts the runs by their exact size, or splits a hot file's partition otherwise.
    """
    reading = facts.where(F.col("collect_status") == m.READING).select(
        "run_key", *FILE_COLUMNS, "start_line"
    )
    return (
        lines.join(reading, FILE_COLUMNS)
        .where(F.col("line_number") >= F.col("start_line"))
        .drop("start_line")
    )


def read_totals(tail: DataFrame) -> DataFrame:
    """Lines, bytes (line ends not counted) and last line read, per run."""
    return tail.groupBy("run_key").agg(
        F.count(F.lit(1)).alias("line_count"),
        F.sum("line_bytes").alias("tail_bytes"),
        F.max("line_number").alias("max_line"),
    )


def run_outcomes(
    facts: DataFrame, totals: DataFrame, part_limit: int = m.PART_LIMIT_BYTES
) -> DataFrame:
    """Settle the runs that read their file: tail limit, last line, success."""
    settled = F.col("collect_status") != m.READING
    tail_bytes = F.coalesce("tail_bytes", F.lit(0))
    exceeded = (F.col("schedule_type") == m.PERIODIC) & (tail_bytes >= part_limit)
    last = F.greatest(F.coalesce("max_line", F.lit(0)), F.col("start_line") - 1)
    return facts.join(totals, "run_key", "left").select(
        *[c for c in facts.columns if c not in ("collect_status", "fail_reason")],
        F.coalesce("line_count", F.lit(0)).alias("line_count"),
        tail_bytes.alias("tail_bytes"),
        F.when(~settled & ~exceeded, last).alias("last_line_number"),
        F.when(settled, F.col("collect_status"))
        .when(exceeded, m.SKIP)
        .otherwise(m.SUCCESS)
        .alias("collect_status"),
        F.when(settled, F.col("fail_reason"))
        .when(exceeded, m.PART_SIZE_EXCEEDED)
        .otherwise("")
        .alias("fail_reason"),
    )


def follow_readers(outcomes: DataFrame) -> DataFrame:
    """Settle the runs BEHIND another: they go on at its last line and find nothing there.

    Where that run went over its limit, the file is excluded for them.
    """
    group = W.partitionBy(F.coalesce("reader_key", "run_key"))
    behind = F.col("collect_status") == m.BEHIND
    last = F.max(F.when(F.col("collect_status") == m.SUCCESS, F.col("last_line_number"))).over(group)
    read = behind & F.col("_last").isNotNull()
    settled = {
        "start_line": F.when(read, F.col("_last") + 1),
        "last_line_number": F.when(read, F.col("_last")),
        "file_size_bytes": F.when(read, F.col("file_size_bytes")),
        "collect_status": F.when(read, m.SUCCESS).otherwise(m.SKIP),
        "fail_reason": F.when(read, "").otherwise(m.EXCLUDED),
    }
    return outcomes.withColumn("_last", last).select(
        *[
            F.when(behind, settled[c]).otherwise(F.col(c)).alias(c) if c in settled else c
            for c in outcomes.columns
            if c != "reader_key"
        ]
    )


def with_id_ranges(outcomes: DataFrame, after: int = 0) -> DataFrame:
    """Give every successful run a range of log ids as long as the lines it read.

    `first_id` goes to the run's first line, `issued_ids` is the length. Ids beyond `after` are
    unique without any exchange of records, and the same when a job is run again. Runs are
    summed up in 4,096 buckets, and only the bucket totals, never more rows than that, are summed
    up in one place and broadcast.
    """
    def before(window: W) -> Column:
        earlier = window.rowsBetween(W.unboundedPreceding, -1)
        return F.coalesce(F.sum("issued_ids").over(earlier), F.lit(0))

    read = F.col("last_line_number") - F.col("start_line") + 1
    issued = F.when(F.col("collect_status") == m.SUCCESS, read).otherwise(0).cast("bigint")
    runs = outcomes.withColumns(
        {"issued_ids": issued, "_bucket": F.left(F.md5("run_key"), F.lit(3))}
    )
    buckets = runs.groupBy("_bucket").agg(F.sum("issued_ids").alias("issued_ids"))
    buckets = buckets.select("_bucket", before(W.orderBy("_bucket")).alias("_bucket_start"))
    in_bucket = before(W.partitionBy("_bucket").orderBy("run_key"))
    first = F.col("_bucket_start") + in_bucket + F.lit(after + 1)
    return (
        runs.join(F.broadcast(buckets), "_bucket")
        .withColumn("first_id", first.cast("bigint"))
        .drop("_bucket", "_bucket_start")
    )


def record_totals(parsed: DataFrame) -> DataFrame:
    """Saved records and rejects per run."""
    return parsed.groupBy("run_key").agg(
        F.count_if(F.col("reason_code").isNull()).alias("saved_count"),
        F.count_if(F.col("reason_code").isNotNull()).alias("reject_count"),
    )


def with_record_totals(outcomes: DataFrame, totals: DataFrame) -> DataFrame:
    """Add `collected_count` and `reject_count` of successful runs."""
    done = F.col("collect_status") == m.SUCCESS

    def count(column: str) -> Column:
        return F.when(done, F.coalesce(column, F.lit(0))).cast("bigint")

    return outcomes.join(totals, "run_key", "left").select(
        *outcomes.columns,
        count("saved_count").alias("collected_count"),
        count("reject_count").alias("reject_count"),
    )
