"""The collect job: due runs in, logs, rejects, exclusions and history out.

All runs of one job go through together. Lines are read once and staged, records are parsed once
and staged, and everything else is counted from what is staged.
"""

import datetime as dt
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logweir import model as m
from logweir.operators.exclusions import exclusion_rows
from logweir.operators.history import fold_history, opening_events
from logweir.operators.normalize import accepted, parse_lines, rejected
from logweir.operators.numbering import block_offsets, number_lines
from logweir.operators.runs import (
    FILE_COLUMNS,
    follow_readers,
    one_reader,
    read_totals,
    record_totals,
    resolve_paths,
    run_outcomes,
    settle_runs,
    slim_lines,
    tail_lines,
    with_id_ranges,
    with_record_totals,
)
from logweir.operators.schedules import schedule_key
from logweir.plans.compact import past
from logweir.sources.lease import writing
from logweir.sources.lines import BLOCK_COLUMNS, file_sizes, landed_segments
from logweir.sources.ranges import (
    BLOCK_BYTES,
    block_totals,
    blocks_of,
    read_blocks,
    same_edges,
    with_edges,
)
from logweir.sources.staging import job_folder, stage, stage_numbered
from logweir.sources.store import CLOSE, OPEN, create_store, read_table, write_table


TAKEN_COLUMNS = ["schedule_key", "run_date", "run_index"]


class Collected(NamedTuple):
    """What a job found; nothing is committed yet."""

    outcomes: DataFrame
    logs: DataFrame
    rejects: DataFrame


def prepare_runs(due: DataFrame, run_ts: dt.datetime, run_id: str) -> DataFrame:
    """Due schedules as runs of this job, with `run_key` and the path of the day.

    Schedules that stand twice in the file have one key and give one run. A column `landed_path`
    names the file where it is known already; reading goes on where it was left, on any day. So it
    does for a run whose `run_date` is an earlier day, which has the path of that day.
    """
    landed = [c for c in due.columns if c == "landed_path"]
    dated = "run_date" in due.columns
    late = F.lit(False)
    if dated:
        late = F.coalesce(F.col("run_date") != F.lit(run_ts.date()), F.lit(False))
    day = F.when(late, F.date_format("run_date", "yyyyMMdd")) if dated else F.lit(None).cast("string")
    runs = due.select(
        "server_id", "server_ip", "source_file_path", "schedule_expression", "schedule_type",
        F.concat_ws("::", schedule_key(), F.lit(run_id), *landed, day).alias("run_key"),
        F.lit(run_id).alias("run_id"),
        schedule_key().alias("schedule_key"),
        *[c for c in ("run_date", "run_index", *landed) if c in due.columns],
    ).dropDuplicates(["run_key"])
    today = F.lit(f"{run_ts:%Y%m%d}")
    runs = resolve_paths(runs, F.coalesce(day, today) if dated else today)
    if not landed:
        return runs.withColumn("keeps_position", F.col("keeps_position") | late)
    return runs.withColumns(
        {"source_file_path": F.col("landed_path"), "keeps_position": F.lit(True)}
    ).drop("landed_path")


def not_taken(runs: DataFrame, events: DataFrame, run_ts: dt.datetime, run_id: str) -> DataFrame:
    """Runs that no other job has opened for the same date and index.

    Runs that were not chosen by `due_runs` or `due_between` have no index and are always taken.
    """
    if "run_index" not in runs.columns:
        return runs
    earliest = runs.agg(F.min("run_date")).first()[0] or run_ts.date()
    others = events.where(
        F.col("collect_date").between(f"{earliest:%Y%m%d}", f"{run_ts:%Y%m%d}")
        & (F.col("run_id") != run_id)
        & (F.col("stage") == OPEN)
        & F.col("run_index").isNotNull()
    )
    return runs.join(others.select(*TAKEN_COLUMNS).distinct(), TAKEN_COLUMNS, "left_anti")


class LandedReader:
    """Numbered lines of the landed files that runs read.

    `known` are rows of the store's segment table. A segment stays shut if it was read to its end
    before and a run starts behind it. One that has grown since is opened at the byte where it was
    left, if its first bytes and those before that place are still the same; one that was
    rewritten or cut is opened at its start. What is opened is staged and counted; `counted` then
    holds its rows for the segment table, and `opened` the blocks that were read.

    `part_limit` is the limit of a periodic run. A file with more bytes than that behind its start
    line is opened as far as the limit can need, and whole only if the lines there (whose ends do
    not count) are still below it. With `drop_unterminated` the last line of a file waits until it
    has a line end; else it is taken as complete and its rest is never read.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        known: DataFrame | None = None,
        encoding: str = "UTF-8",
        part_limit: int = m.PART_LIMIT_BYTES,
        drop_unterminated: bool = False,
        block_bytes: int = BLOCK_BYTES,
    ) -> None:
        self.spark, self.root, self.known, self.encoding = spark, root, known, encoding
        self.part_limit, self.drop_unterminated = part_limit, drop_unterminated
        self.block_bytes = block_bytes
        self.counted: DataFrame | None = None
        self.opened: DataFrame | None = None

    def _listed(self, facts: DataFrame) -> DataFrame:
        """Segments of the files that a run reads, with what is known of each."""
        reading = facts.where(F.col("collect_status") == m.READING)
        starts = reading.groupBy(*FILE_COLUMNS).agg(
            F.min("start_line").alias("start_line"),
            F.min(F.col("schedule_type") == m.PERIODIC).alias("limited"),
        )
        segments = landed_segments(self.spark, self.root).join(starts, FILE_COLUMNS)
        left = F.struct(
            F.col("length").alias("read"), F.col("modified").alias("then"), "lines",
            F.col("head").alias("known_head"), F.col("tail").alias("known_tail"),
        )
        if self.known is None:
            known = self.spark.createDataFrame([], m.SEGMENTS)
        else:
            known = self.known
        known = known.groupBy(*FILE_COLUMNS, "segment").agg(
            F.max_by(left, F.struct("modified", "length")).alias("left")
        )
        known = known.select(*FILE_COLUMNS, "segment", "left.*")
        return segments.join(known, [*FILE_COLUMNS, "segment"], "left")

    def _wanted(self, facts: DataFrame) -> DataFrame:
        """Listed segments with the byte and line from which each has to be read."""
        as_left = (F.col("read") == F.col("length")) & (F.col("then") == F.col("modified"))
        asked = F.when(~as_left & (F.col("read") <= F.col("length")), F.col("read"))
        rows = with_edges(self._listed(facts).withColumn("asked", asked), "asked")
        same = same_edges(*(F.col(c) for c in ("head", "tail", "known_head", "known_tail")))
        rows = rows.withColumn("kept", F.coalesce(as_left, F.lit(False)) | same)
        change = (
            F.when(F.col("read").isNull(), m.NEW_SEGMENT)
            .when(F.col("kept") & (F.col("read") < F.col("length")), m.APPENDED)
            .when(F.col("kept"), m.REREAD)
            .when(F.col("read") > F.col("length"), m.SHRUNK)
            .otherwise(m.REWRITTEN)
        )
        whole = F.col("kept") & (F.col("read") == F.col("length"))
        file = W.partitionBy(*FILE_COLUMNS)
        before = file.orderBy("segment").rowsBetween(W.unboundedPreceding, -1)
        # A segment can be left alone, or in part, if all lines before are counted and not wanted.
        counted = F.coalesce(F.min(whole).over(before), F.lit(True))
        passed = F.coalesce(F.sum("lines").over(before), F.lit(0)) + F.col("lines")
        resumes = F.col("kept") & counted & (passed < F.col("start_line"))
        rows = rows.withColumns(
            {"change": change, "resumes": F.coalesce(resumes, F.lit(False)), "whole": whole}
        )
        rows = rows.withColumns(
            {
                "shut": F.col("resumes") & F.col("whole"),
                "resume_at": F.when(F.col("resumes"), F.col("read")).otherwise(0),
                "resume_lines": F.when(F.col("resumes"), F.col("lines")).otherwise(0),
                "hold": F.lit(self.drop_unterminated)
                & (F.col("segment") == F.max("segment").over(file)),
            }
        )
        # Only behind the very start line do the listed bytes tell what a run will read.
        exact = F.sum("resume_lines").over(file) + 1 == F.col("start_line")
        tail = F.sum(F.col("length") - F.col("resume_at")).over(file)
        limited = F.col("limited") & exact & (tail >= self.part_limit)
        return stage(rows.withColumn("limited", limited), "segments")

    def _read(self, wanted: DataFrame) -> DataFrame:
        """Lines of the segments that are not shut, of files over the limit a part."""
        blocks = blocks_of(wanted.where("not shut"), self.block_bytes).select(
            *FILE_COLUMNS, "segment", "path", "start", "stop", "length", "hold", "limited"
        )
        found = blocks.agg(*block_totals(), F.max("limited").alias("limited")).first()
        if not found.limited:
            self.opened = blocks
            return self._staged_lines(blocks, found)
        limited = blocks.where("limited")
        # A quarter is for line ends, which do not count.
        along = W.partitionBy(*FILE_COLUMNS).orderBy("segment", "start")
        ahead = F.coalesce(
            F.sum(F.col("stop") - F.col("start")).over(along.rowsBetween(W.unboundedPreceding, -1)),
            F.lit(0),
        )
        limited = limited.withColumn("first", ahead < self.part_limit + self.part_limit // 4)
        limited = stage(limited, "limited")
        first = stage(
            blocks.where("not limited").unionByName(limited.where("first").drop("first")), "first"
        )
        lines = self._staged_lines(first, first.agg(*block_totals()).first())
        over = lines.groupBy(*FILE_COLUMNS).agg(F.sum("line_bytes").alias("bytes"))
        over = stage(over.where(F.col("bytes") >= self.part_limit).select(*FILE_COLUMNS), "over")
        rest = stage(
            limited.where("not first").drop("first").join(over, FILE_COLUMNS, "left_anti"), "rest"
        )
        self.opened = first.unionByName(rest)
        found = rest.agg(*block_totals()).first()
        return lines.unionByName(self._staged_lines(rest, found)) if found.n else lines

    def _staged_lines(self, blocks: DataFrame, found: Row) -> DataFrame:
        return stage(slim_lines(read_blocks(blocks, found.n, found.bytes, self.encoding)), "lines")

    def __call__(self, facts: DataFrame) -> DataFrame:
        wanted = self._wanted(facts)
        rows = self._read(wanted)
        # A line that is held back has no length.
        lines = rows.where("line_bytes is not null").drop("open_bytes")
        before = wanted.groupBy(*FILE_COLUMNS).agg(F.sum("resume_lines").alias("before"))
        offsets = block_offsets(lines, FILE_COLUMNS, BLOCK_COLUMNS).join(
            before, FILE_COLUMNS, "left"
        )
        shift = F.col("_shift") + F.coalesce("before", F.lit(0))
        offsets = stage(offsets.withColumn("_shift", shift).drop("before"), "blocks")
        key = [*FILE_COLUMNS, "segment"]
        counts = rows.groupBy(*key).agg(
            F.count("line_bytes").alias("n"),
            F.sum(F.when(F.col("line_bytes").isNull(), F.col("open_bytes"))).alias("held"),
        )
        # Segments that were read to their end only.
        ends = self.opened.groupBy(*key).agg(F.max("stop").alias("stop"), F.sum(F.col("stop") - F.col("start")).alias("opened"))
        opened = wanted.where("not shut").join(ends, key).where(
            (F.col("stop") == F.col("length")) & (F.col("opened") == F.col("length") - F.col("resume_at"))
        )
        counted = opened.join(counts, key, "left").select(
            *key, "path", (F.col("length") - F.coalesce("held", F.lit(0))).alias("length"),
            "modified", (F.col("resume_lines") + F.coalesce("n", F.lit(0))).alias("lines"), "change",
        )
        self.counted = with_edges(counted, "length").drop("path")
        return number_lines(lines, offsets, FILE_COLUMNS, BLOCK_COLUMNS)


def collect_run(
    runs: DataFrame,
    sizes: DataFrame,
    read_lines: Callable[[DataFrame], DataFrame],
    history: DataFrame,
    exclude: DataFrame,
    run_ts: dt.datetime,
    ids_issued: int = 0,
    init_limit: int = m.INIT_LIMIT_BYTES,
    part_limit: int = m.PART_LIMIT_BYTES,
) -> Collected:
    """Collect the files of `runs`.

    `read_lines(facts)` gives `server_id, source_file_path, line_number, line_bytes, line` for
    the files whose status in `facts` is READING. It is read twice, for the totals and for the
    records, and should come from something written. `history` may hold more rows than needed:
    successful runs are picked out. Of several runs of one file one reads it.
    """
    stamp = F.lit(run_ts).cast("timestamp_ntz")
    collect_date = f"{run_ts:%Y%m%d}"
    settled = settle_runs(runs, sizes, history, exclude, collect_date, init_limit)
    facts = stage(one_reader(settled), "facts")
    tail = tail_lines(read_lines(facts), facts)
    # One row per run, written: the lines are scanned once for totals and once for records.
    totals = stage(read_totals(tail), "totals")
    outcomes = follow_readers(run_outcomes(facts, totals, part_limit))
    outcomes = stage(with_id_ranges(outcomes, ids_issued), "outcomes")
    good = outcomes.where(F.col("collect_status") == m.SUCCESS).select(
        "run_key", "server_ip", "schedule_type", "run_id",
        (F.col("first_id") - F.col("start_line")).alias("_id_shift"),
    )
    tail = tail.select("run_key", *FILE_COLUMNS, "line_number", "line").join(good, "run_key")
    tail = tail.withColumn("collect_log_id", F.col("line_number") + F.col("_id_shift"))
    parsed = stage(parse_lines(tail.drop("_id_shift")), "parsed")
    dated = parsed.withColumn("collect_date", F.lit(collect_date))
    return Collected(
        with_record_totals(outcomes, record_totals(parsed)),
        accepted(dated).withColumns({"collect_datetime": stamp, "created_at": stamp}),
        rejected(dated),
    )


def closing_events(
    outcomes: DataFrame, run_ts: dt.datetime, ended_at: dt.datetime, attempt: int = 0
) -> DataFrame:
    """History updates of a run in their order: attempt, size of an excluded file, outcome.

    The last one repeats what `last_lines` needs, so that the next job reads it on its own.
    """
    stamp, end = (F.lit(t).cast("timestamp_ntz") for t in (run_ts, ended_at))
    base = [
        "collect_history_id", "run_key", "run_id",
        F.lit(f"{run_ts:%Y%m%d}").alias("collect_date"),
        F.lit(CLOSE).alias("stage"),
    ]
    done = F.col("collect_status") == m.SUCCESS
    over_limit = F.col("fail_reason").isin(m.INIT_SIZE_EXCEEDED, m.PART_SIZE_EXCEEDED)
    attempts = outcomes.select(
        *base, F.lit(attempt).cast("bigint").alias("retry_count"),
        stamp.alias("updated_at"), F.lit(1).alias("seq"),
    )
    sizes = outcomes.where(over_limit).select(
        *base, "file_size_bytes", end.alias("updated_at"), F.lit(2).alias("seq")
    )
    ends = outcomes.select(
        *base, *FILE_COLUMNS, "collect_status", "fail_reason", "last_line_number",
        F.when(done, F.col("collected_count")).alias("collected_count"),
        F.when(done, F.col("file_size_bytes")).alias("file_size_bytes"),
        stamp.alias("collect_start_at"), end.alias("collect_end_at"), end.alias("updated_at"),
        "issued_ids",
        F.lit(3).alias("seq"),
    )
    return attempts.unionByName(sizes, allowMissingColumns=True).unionByName(
        ends, allowMissingColumns=True
    )


def run_job(
    spark: SparkSession,
    store: str,
    due: DataFrame,
    run_ts: dt.datetime,
    read_lines: Callable[[DataFrame], DataFrame],
    sizes: DataFrame,
    run_id: str | None = None,
    clock: Callable[[], dt.datetime] = dt.datetime.now,
    attempt: int = 0,
    **options,
) -> None:
    """Collect the due runs and write the results to the store.

    The opening rows are written first, so that a crash leaves failed runs in sight, and the
    closing rows last. Running the same `run_id` again replaces what a crashed job wrote, and
    does nothing for runs that are closed. One job at a time writes to a store: another one is
    refused with StoreBusy (`sources.lease`).
    """
    run_id = run_id or f"{run_ts:%Y%m%dT%H%M%S}"
    create_store(spark, store)
    with writing(spark, store, run_id) as lease, job_folder(spark):
        known = past(spark, store, f"{run_ts:%Y%m%d}")
        events = known.events
        own = F.col("run_id") == run_id
        closed = events.where(own & (F.col("stage") == CLOSE)).select("run_key")
        ids = events.select(F.col("collect_history_id").alias("last_history_id"), "issued_ids")
        ids = known.totals.unionByName(ids)
        top = ids.agg(F.max("last_history_id"), F.sum("issued_ids")).first()
        runs = prepare_runs(due, run_ts, run_id).join(closed, "run_key", "left_anti")
        runs = not_taken(runs, events, run_ts, run_id)
        runs = stage_numbered(runs, "runs", "collect_history_id", top[0] or 0, small=True)
        # Partitions of this job are about to be replaced and must not be read any more.
        done = events.where(~own & (F.col("collect_status") == m.SUCCESS))
        if runs.where("keeps_position").isEmpty():
            done = done.where(F.col("collect_date") == f"{run_ts:%Y%m%d}")
        else:
            done = done.unionByName(known.successes(), allowMissingColumns=True)
        exclude = read_table(spark, store, "collect_exclude").where(~own)

        stamp = F.lit(run_ts).cast("timestamp_ntz")
        opening = opening_events(runs.withColumn("stage", F.lit(OPEN)), stamp)
        lease.make_sure()
        write_table(opening, store, "history_events")
        found = collect_run(
            runs, sizes, read_lines, done, exclude, run_ts, ids_issued=top[1] or 0, **options
        )
        exclusions = exclusion_rows(found.outcomes, stamp).withColumn("run_id", F.lit(run_id))
        lease.make_sure()
        write_table(found.logs, store, "collect_log")
        write_table(found.rejects, store, "collect_reject")
        if not exclusions.isEmpty():
            last = exclude.agg(F.max("collect_exclude_id")).first()[0] or 0
            exclusions = stage_numbered(
                exclusions, "exclusions", "collect_exclude_id", last, small=True
            )
            write_table(exclusions, store, "collect_exclude")
        counted = getattr(read_lines, "counted", None)
        if counted is not None:
            marked_day = F.lit(f"{run_ts:%Y%m%d}").alias("collect_date")
            counted = counted.select("*", marked_day, F.lit(run_id).alias("run_id"))
            write_table(counted, store, "segments")
        lease.make_sure()
        closing = closing_events(found.outcomes, run_ts, clock(), attempt)
        write_table(closing, store, "history_events")


def collect_landed(
    spark: SparkSession,
    store: str,
    landed: str,
    due: DataFrame,
    run_ts: dt.datetime,
    encoding: str = "UTF-8",
    sizes: DataFrame | None = None,
    part_limit: int = m.PART_LIMIT_BYTES,
    drop_unterminated: bool = False,
    **options,
) -> None:
    """Collect due runs from landed files; `sizes` may be given, else the listing is used."""
    create_store(spark, store)
    # Rows of any job will do: the newest of a segment says how far it was read.
    segments = past(spark, store, f"{run_ts:%Y%m%d}").segments
    reader = LandedReader(spark, landed, segments, encoding, part_limit, drop_unterminated)
    sizes = file_sizes(spark, landed) if sizes is None else sizes
    run_job(spark, store, due, run_ts, reader, sizes, part_limit=part_limit, **options)


def collect_history(spark: SparkSession, store: str) -> DataFrame:
    """One row per run, as the last event left it."""
    events = read_table(spark, store, "history_events")
    return fold_history(events.drop("run_id", "stage", "issued_ids", *TAKEN_COLUMNS))
