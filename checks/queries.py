"""The registered queries: each takes (spark, sf_dir) and gives a DataFrame."""

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from checks import inputs
from logweir import model as m
from logweir.functions.paths import keeps_position
from logweir.operators import exclusions as ex
from logweir.operators import history as hist
from logweir.operators import runs as rn
from logweir.operators.lookup import find_logs
from logweir.operators.normalize import accepted, parse_lines, rejected
from logweir.operators.numbering import block_offsets, number_lines, numbered
from logweir.operators.schedules import (
    due_between,
    due_runs,
    missed_runs,
    parse_schedules,
    run_calendar,
    with_rules,
)
from logweir.plans.collect import (
    closing_events,
    collect_history,
    collect_landed,
    collect_run,
    prepare_runs,
)
from logweir.plans.compact import compact
from logweir.sources.lines import BLOCK_COLUMNS, LANDED, file_sizes, scan_landed
from logweir.sources.staging import new_folder, stage, stage_numbered
from logweir.sources.store import read_logs, read_table, write_table
from logweir.streaming.collect_stream import collect_stream

RUN_TS = dt.datetime(2024, 1, 20, 10)
RUN_ID = "20240120T100000"
COLLECT_DATE = "20240120"
DUE_TS = dt.datetime(2024, 1, 17, 10, 30, 1)
# Limits that some of the small derived files reach.
INIT_LIMIT = 1100
PART_LIMIT = 900
FILE_COLUMNS = rn.FILE_COLUMNS
KEY = ["server_id", "source_file_path", "line_number"]
LOG = ["log_type", "log_id", "log_timestamp", "log_content", "log_value", "raw_log"]


# ---- Records ----

def parsed_events(spark, sf_dir) -> DataFrame:
    return parse_lines(inputs.event_lines(spark, sf_dir))


def normalize_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accepted(parsed_events(spark, sf_dir)).select(*KEY, *LOG, "value_overflow")


def normalize_documents(spark, sf_dir):
    return accepted(parse_lines(inputs.document_records(spark, sf_dir))).select(*KEY, *LOG)


def reject_documents(spark, sf_dir):
    rows = rejected(parse_lines(inputs.document_records(spark, sf_dir)))
    return rows.select(*KEY, "reason_code", "raw_log")


def reject_reasons(spark, sf_dir):
    return rejected(parsed_events(spark, sf_dir)).select(*KEY, "reason_code", "detail", "raw_log")


def reject_counts(spark, sf_dir):
    rows = rejected(parsed_events(spark, sf_dir))
    return rows.groupBy("reason_code").agg(F.count(F.lit(1)).alias("rejects"))


def value_tokens(spark, sf_dir):
    """Tokens of all lines, documents included, whole texts."""
    from logweir.functions.text import value_tokens as tokens

    events = inputs.event_lines(spark, sf_dir).select(*KEY, "line")
    lines = events.unionByName(inputs.document_lines(spark, sf_dir).select(*KEY, "line"))
    return lines.select(*KEY, F.posexplode(tokens(F.col("line"))).alias("pos", "token")).select(
        *KEY, F.col("pos").cast("bigint").alias("pos"), "token"
    )


def _of_type(spark, sf_dir, log_type: str, *columns):
    return parsed_events(spark, sf_dir).where(F.col("log_type") == log_type).select(*KEY, *columns)


def numeric_values(spark, sf_dir):
    return _of_type(
        spark, sf_dir, m.NUMERIC, "reason_code", "log_value", "log_value_text",
        (F.col("value_overflow") & F.col("reason_code").isNull()).alias("overflow"),
    )


def compare_checks(spark, sf_dir):
    return _of_type(spark, sf_dir, m.COMPARE, "reason_code", "log_content", "log_value")


def time_minutes(spark, sf_dir):
    return _of_type(spark, sf_dir, m.TIME, "reason_code", "log_content", "log_value")


def content_cleanup(spark, sf_dir):
    """Cleaned content of every event and document line, record or not."""
    from logweir.functions.text import bare_content, single_spaced

    events = inputs.event_lines(spark, sf_dir).select(*KEY, "line")
    lines = events.unionByName(inputs.document_lines(spark, sf_dir).select(*KEY, "line"))
    bare = lines.select(*KEY, bare_content(F.col("line")).alias("bare"))
    return bare.select(*KEY, single_spaced(F.col("bare")).alias("content"))


def timestamp_smart_parse(spark, sf_dir):
    """Well-formed timestamps, possible or not, from day and time fields of the events."""
    from logweir.functions.times import lenient_timestamp

    return inputs.read(spark, sf_dir, "events").selectExpr(
        "event_id", f"{inputs.STAMP_TEXT.format(**inputs.SPARK_FORMATS)} AS stamp_text"
    ).select("event_id", "stamp_text", lenient_timestamp(F.col("stamp_text")).alias("stamp"))


def record_keys(spark, sf_dir):
    """Sequence numbers of all records: as many as rows, without a gap."""
    rows = stage_numbered(parsed_events(spark, sf_dir).select(*KEY), "keys", "collect_log_id", 1000)
    key = F.col("collect_log_id")
    return rows.agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct(key).alias("n_keys"),
        F.min(key).alias("first_key"), F.max(key).alias("last_key"),
    )


# ---- Lines ----

def line_number_explode(spark, sf_dir):
    return inputs.document_lines(spark, sf_dir).select(
        *KEY, F.octet_length("line").cast("bigint").alias("line_bytes")
    )


def _event_blocks(spark, sf_dir) -> DataFrame:
    """Event lines as a scan would give them: cut into blocks, places running within a block.

    A block is a bounded run of event numbers, so the window never sees more rows than that.
    """
    block = F.floor(F.col("event_id") / 65536)
    in_block = W.partitionBy(*FILE_COLUMNS, "block_start").orderBy("event_id")
    rows = inputs.event_lines(spark, sf_dir).drop("line_number").withColumn("block_start", block)
    return rows.withColumn("place", F.row_number().over(in_block).cast("bigint"))


def line_number_blocks(spark, sf_dir):
    lines = stage(_event_blocks(spark, sf_dir), "lines")
    return numbered(lines, FILE_COLUMNS, ["block_start"]).select(*KEY, "event_id", "line")


def _land_events(spark, sf_dir) -> str:
    """Write the event lines as text segments, each log file split over many by event number.

    The segments of a file hold rising ranges, and sort in that order by name.
    """
    folder = new_folder(spark, "landed")
    lines = inputs.event_lines(spark, sf_dir).selectExpr(
        "concat('srv', event_id % 3) AS server_id",
        "concat('/logs/', element_at(split(source_file_path, '[/.]'), 3), '.log') "
        "AS source_file_path",
        "event_id", "line AS value",
    )
    order = [*FILE_COLUMNS, "event_id"]
    (
        lines.repartitionByRange(*order).sortWithinPartitions(*order).drop("event_id")
        .write.partitionBy(*FILE_COLUMNS).text(folder)
    )
    return folder


def line_scan(spark, sf_dir):
    """Write text files, scan them in blocks, number the lines."""
    lines = stage(scan_landed(spark, _land_events(spark, sf_dir)), "scan")
    offsets = stage(block_offsets(lines, FILE_COLUMNS, BLOCK_COLUMNS), "blocks")
    return number_lines(lines, offsets, FILE_COLUMNS, BLOCK_COLUMNS).select(*KEY, "line")


def landed_file_sizes(spark, sf_dir):
    return file_sizes(spark, _land_events(spark, sf_dir))


# ---- Runs ----

def _sizes(spark, sf_dir) -> DataFrame:
    """Bytes of the event files: every line and its line feed."""
    lines = inputs.event_lines(spark, sf_dir)
    return lines.groupBy(*FILE_COLUMNS).agg(
        F.sum(F.octet_length("line") + 1).cast("bigint").alias("file_size_bytes")
    )


def _runs(spark, sf_dir) -> DataFrame:
    return prepare_runs(inputs.due(spark, sf_dir), RUN_TS, RUN_ID)


def _facts(spark, sf_dir) -> DataFrame:
    return rn.settle_runs(
        _runs(spark, sf_dir), _sizes(spark, sf_dir), inputs.history(spark, sf_dir),
        inputs.exclude(spark, sf_dir), COLLECT_DATE, INIT_LIMIT,
    )


def _numbered_events(spark, sf_dir) -> DataFrame:
    lines = stage(_event_blocks(spark, sf_dir).drop("event_id"), "lines")
    return numbered(lines, FILE_COLUMNS, ["block_start"])


def path_resolve(spark, sf_dir):
    lines = parse_schedules(inputs.schedule_lines(spark, sf_dir))
    return rn.resolve_paths(lines, COLLECT_DATE).select(
        "event_id", "path_template", "source_file_path", "keeps_position"
    )


def last_line_top1(spark, sf_dir):
    return hist.last_lines(inputs.history(spark, sf_dir), COLLECT_DATE).select(
        *FILE_COLUMNS, "last_any"
    )


def last_line_date_reset(spark, sf_dir):
    """Start line of the file of every schedule, with and without the plus sign."""
    last = hist.last_lines(inputs.history(spark, sf_dir), COLLECT_DATE)
    runs = _runs(spark, sf_dir).join(last, FILE_COLUMNS, "left")
    line = F.when(F.col("keeps_position"), F.col("last_any")).otherwise(F.col("last_today"))
    return runs.select(
        *FILE_COLUMNS, "schedule_type", "keeps_position",
        keeps_position(F.col("path_template")).alias("plus"), line.alias("last_line"),
    )


def history_open(spark, sf_dir):
    runs = _runs(spark, sf_dir).withColumn("collect_history_id", F.lit(None).cast("bigint"))
    rows = hist.opening_events(runs, F.lit(RUN_TS).cast("timestamp_ntz"))
    return rows.select(
        *FILE_COLUMNS, "server_ip", "schedule_type", "collect_status", "retry_count",
        "fail_reason", "collect_start_at", "collect_date",
    )


def history_fold(spark, sf_dir):
    return hist.fold_history(inputs.updates(spark, sf_dir))


def exclude_anti_join(spark, sf_dir):
    runs = _runs(spark, sf_dir).select(*FILE_COLUMNS, "schedule_type")
    return ex.not_excluded(runs, inputs.exclude(spark, sf_dir))


def exclude_count(spark, sf_dir):
    return ex.active_exclusions(inputs.exclude(spark, sf_dir))


def incremental_tail(spark, sf_dir):
    """Lines that the due runs have to read."""
    lines = _numbered_events(spark, sf_dir)
    tail = rn.tail_lines(lines, stage(_facts(spark, sf_dir), "facts"))
    return tail.select("run_key", *KEY, "line")


def tail_bytes_guard(spark, sf_dir):
    """Periodic runs over documents as files, read from their start; long ones reach the limit."""
    key = F.col("source_file_path").alias("run_key")
    lines = rn.slim_lines(inputs.document_lines(spark, sf_dir))
    totals = stage(rn.read_totals(lines.select("*", key)), "totals")
    facts = totals.select(
        "run_key", F.lit(m.PERIODIC).alias("schedule_type"), F.lit(1).alias("start_line"),
        F.lit(m.READING).alias("collect_status"), F.lit("").alias("fail_reason"),
    )
    ended = rn.run_outcomes(facts, totals, 5000)
    exceeded = (F.col("fail_reason") == m.PART_SIZE_EXCEEDED).alias("exceeded")
    return ended.select("run_key", "line_count", "tail_bytes", exceeded).join(
        totals.select("run_key", "max_line"), "run_key"
    )


def _collected(spark, sf_dir):
    runs = _runs(spark, sf_dir).withColumn("collect_history_id", F.lit(None).cast("bigint"))
    lines = stage(rn.slim_lines(_event_blocks(spark, sf_dir).drop("event_id")), "lines")
    offsets = stage(block_offsets(lines, FILE_COLUMNS, ["block_start"]), "blocks")
    return collect_run(
        runs,
        _sizes(spark, sf_dir),
        lambda facts: number_lines(lines, offsets, FILE_COLUMNS, ["block_start"]),
        inputs.history(spark, sf_dir),
        inputs.exclude(spark, sf_dir),
        RUN_TS,
        init_limit=INIT_LIMIT,
        part_limit=PART_LIMIT,
    )


def collect_end_to_end(spark, sf_dir):
    return _collected(spark, sf_dir).logs.select(
        *KEY, *LOG, "server_ip", "schedule_type", "collect_date", "collect_datetime"
    )


def collect_log_ids(spark, sf_dir):
    """Ids of the records, given out by run and line."""
    return _collected(spark, sf_dir).logs.select(*KEY, "collect_log_id")


def collect_rejects(spark, sf_dir):
    return _collected(spark, sf_dir).rejects.select("run_key", *KEY, "reason_code", "collect_date")


def run_status(spark, sf_dir):
    return _collected(spark, sf_dir).outcomes.select(
        "run_key", *FILE_COLUMNS, "schedule_type", "collect_status", "fail_reason",
        "collected_count", "last_line_number", "file_size_bytes", "start_line",
    )


def run_summary(spark, sf_dir):
    """Lines read, records saved and rejected, per run and in whole."""
    outcomes = _collected(spark, sf_dir).outcomes
    return outcomes.where(F.col("collect_status") == m.SUCCESS).select(
        "run_key", "line_count", "tail_bytes", "last_line_number",
        "collected_count", "reject_count",
    )


def history_close(spark, sf_dir):
    """History as it stands after the job: its closing events folded."""
    events = closing_events(_collected(spark, sf_dir).outcomes, RUN_TS, RUN_TS)
    events = events.drop("collect_history_id", "issued_ids")
    keyed = events.withColumnRenamed("run_key", "collect_history_id")
    return hist.fold_history(keyed).select(
        F.col("collect_history_id").alias("run_key"), "collect_status", "fail_reason",
        "collected_count", "last_line_number", "file_size_bytes", "retry_count",
        "collect_end_at", "collect_date",
    )


def exclude_register(spark, sf_dir):
    outcomes = _collected(spark, sf_dir).outcomes
    return ex.exclusion_rows(outcomes, F.lit(RUN_TS).cast("timestamp_ntz")).select(
        *FILE_COLUMNS, "server_ip", "exclude_reason", "exclude_file_size", "exclude_detail",
        "restore_yn", "exclude_date", "created_at",
    )


# ---- The store ----

LATER_TS = RUN_TS + dt.timedelta(hours=1)
NO_LIMIT = {"part_limit": 1 << 62, "init_limit": 1 << 62}
PLACE = ["server_ip", "schedule_type", "collect_date", "collect_datetime"]


def _files(spark, sf_dir, expression: str, kind: str) -> DataFrame:
    """One schedule for each log file of `_land_events`."""
    files = inputs.read(spark, sf_dir, "events").selectExpr(
        "concat('srv', event_id % 3) AS server_id",
        "concat('/logs/', event_type, '.log+') AS source_file_path",
    )
    return files.distinct().selectExpr(
        "server_id", "'10.0.0.1' AS server_ip", "source_file_path",
        f"'{expression}' AS schedule_expression", f"'{kind}' AS schedule_type",
    )


def _stored(spark, sf_dir) -> str:
    """A store after two jobs over landed files: first those of srv0, then all."""
    landed, store = _land_events(spark, sf_dir), new_folder(spark, "store")
    due = stage(_files(spark, sf_dir, "주기|*|080000|30|235959", m.PERIODIC), "due")
    for rows, run_ts in ((due.where("server_id = 'srv0'"), RUN_TS), (due, LATER_TS)):
        collect_landed(
            spark, store, landed, rows, run_ts, clock=lambda ts=run_ts: ts, **NO_LIMIT
        )
    return store


def collect_store(spark, sf_dir):
    """Logs read back from the store; each line was collected by the first job that read it."""
    logs = read_logs(spark, _stored(spark, sf_dir))
    return logs.select(*KEY, *LOG, *PLACE, "log_value_text", "collect_log_id")


def store_history(spark, sf_dir):
    """The runs of both jobs as the store tells them."""
    return collect_history(spark, _stored(spark, sf_dir)).select(
        *FILE_COLUMNS, "collect_status", "collected_count", "last_line_number",
        "file_size_bytes", "collect_start_at", "collect_end_at",
    )


def collect_taken_once(spark, sf_dir):
    """Batch schedules that stand twice in the file and are due in two polls run once."""
    landed, store = _land_events(spark, sf_dir), new_folder(spark, "store")
    rows = _files(spark, sf_dir, "배치|*|100000", m.BATCH)
    rules = with_rules(rows.drop("schedule_type"))
    rules = stage(rules.unionByName(rules), "rules")
    for second in (0, 1):
        ts = RUN_TS + dt.timedelta(seconds=second)
        collect_landed(spark, store, landed, due_runs(rules, ts), ts, **NO_LIMIT)
    logs = read_logs(spark, store).groupBy(*FILE_COLUMNS).agg(
        F.count(F.lit(1)).alias("n_records"), F.countDistinct("collect_log_id").alias("n_ids")
    )
    runs = collect_history(spark, store).groupBy(*FILE_COLUMNS)
    return logs.join(runs.agg(F.count(F.lit(1)).alias("n_runs")), FILE_COLUMNS)


def stream_collect(spark, sf_dir):
    """Landed segments as a stream: files over a limit are read after they were restored."""
    landed, store = _land_events(spark, sf_dir), new_folder(spark, "store")
    checkpoint = new_folder(spark, "checkpoint")
    periodic = stage(_files(spark, sf_dir, "주기|*|080000|30|235959", m.PERIODIC), "schedules")

    def start(run_ts: dt.datetime, **options) -> None:
        collect_stream(
            spark, landed, store, periodic, checkpoint, clock=lambda: run_ts, options=options
        ).awaitTermination()

    start(RUN_TS, part_limit=10_000)
    excluded = read_table(spark, store, "collect_exclude")
    write_table(
        stage(excluded.withColumn("restore_yn", F.lit(m.YES)), "restored"), store, "collect_exclude"
    )
    # Something has to land for the second start: the same lines for a server without schedules.
    more = spark.read.schema(LANDED).text(landed).where("server_id = 'srv0'")
    more.withColumn("server_id", F.lit("new")).write.mode("append").partitionBy(
        *FILE_COLUMNS
    ).text(landed)
    start(LATER_TS, **NO_LIMIT)
    return read_logs(spark, store).select(*KEY, *LOG)


# Three periodic schedules and a batch schedule for each file, all due at RUN_TS, a Saturday.
SAME_FILE = (
    ("주기|*|080000|30|235959", m.PERIODIC), ("주기|1-5|080000|30|235959", m.PERIODIC),
    ("주기|6|090000|60|235959", m.PERIODIC), ("배치|*|100000", m.BATCH),
)


def _same_file(spark, sf_dir) -> DataFrame:
    schedules = _files(spark, sf_dir, *SAME_FILE[0])
    for expression, kind in SAME_FILE[1:]:
        schedules = schedules.unionByName(_files(spark, sf_dir, expression, kind))
    return stage(schedules, "due")


def _per_file(spark, store) -> DataFrame:
    """Records, their ids, runs and those that read something, per file."""
    logs = read_logs(spark, store).groupBy(*FILE_COLUMNS).agg(
        F.count(F.lit(1)).alias("n_records"), F.countDistinct("collect_log_id").alias("n_ids")
    )
    runs = collect_history(spark, store).groupBy(*FILE_COLUMNS).agg(
        F.count(F.lit(1)).alias("n_runs"), F.count_if(F.col("collected_count") > 0).alias("n_reading"),
        F.max_by(F.split("run_key", "::")[3], "collected_count").alias("reading_schedule"),
    )
    return logs.join(runs, FILE_COLUMNS)


def collect_overlapping_schedules(spark, sf_dir):
    """Four schedules of one file due in one job: one run reads it, the others end behind it."""
    landed, store = _land_events(spark, sf_dir), new_folder(spark, "store")
    collect_landed(spark, store, landed, _same_file(spark, sf_dir), RUN_TS, **NO_LIMIT)
    return _per_file(spark, store)


def stream_overlapping_schedules(spark, sf_dir):
    """The stream gives a file to the schedule whose day and hours hold, and to no other."""
    landed, store = _land_events(spark, sf_dir), new_folder(spark, "store")
    schedules = _same_file(spark, sf_dir).where("schedule_expression <> '주기|*|080000|30|235959'")
    collect_stream(
        spark, landed, store, schedules, new_folder(spark, "checkpoint"), clock=lambda: RUN_TS,
        options=NO_LIMIT,
    ).awaitTermination()
    return _per_file(spark, store)


def _land_growing(spark, sf_dir, landed: str, until: int | None) -> None:
    """Put the event lines as one segment per file, up to an event's number, in place of those
    that stand there; a longer segment begins with the bytes of a shorter one."""
    folder = new_folder(spark, "whole")
    lines = inputs.event_lines(spark, sf_dir).selectExpr(
        "concat('srv', event_id % 3) AS server_id",
        "concat('/logs/', element_at(split(source_file_path, '[/.]'), 3), '.log') "
        "AS source_file_path",
        "event_id", "line AS value",
    )
    if until is not None:
        lines = lines.where(F.col("event_id") < until)
    lines = lines.repartition(*FILE_COLUMNS).sortWithinPartitions(*FILE_COLUMNS, "event_id")
    lines.drop("event_id").write.partitionBy(*FILE_COLUMNS).text(folder)
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    for found in files.globStatus(path(f"{folder}/server_id=*/source_file_path=*/part-*")):
        leaf = found.getPath().getParent()
        target = path(path(path(landed, leaf.getParent().getName()), leaf.getName()), "app.log")
        files.mkdirs(target.getParent())
        files.delete(target, False)
        if not files.rename(found.getPath(), target):
            raise OSError(f"{target} could not be put in place")


def _grown(spark, sf_dir) -> str:
    """A store after two jobs over files of which the second half was appended in between."""
    landed, store = new_folder(spark, "landed"), new_folder(spark, "store")
    due = stage(_files(spark, sf_dir, "주기|*|080000|30|235959", m.PERIODIC), "due")
    last = inputs.read(spark, sf_dir, "events").agg(F.max("event_id")).first()[0]
    for until, run_ts in (((last + 1) // 2, RUN_TS), (None, LATER_TS)):
        _land_growing(spark, sf_dir, landed, until)
        collect_landed(spark, store, landed, due, run_ts, **NO_LIMIT)
    return store


def grown_files(spark, sf_dir):
    """Records of files that grew: the second job reads the appended bytes."""
    return read_logs(spark, _grown(spark, sf_dir)).select(*KEY, *LOG, "collect_datetime")


def grown_after_compaction(spark, sf_dir):
    """The same on two days, the history of the first folded into the store's state."""
    landed, store = new_folder(spark, "landed"), new_folder(spark, "store")
    due = stage(_files(spark, sf_dir, "주기|*|080000|30|235959", m.PERIODIC), "due")
    last = inputs.read(spark, sf_dir, "events").agg(F.max("event_id")).first()[0]
    for until, run_ts in (((last + 1) // 2, RUN_TS), (None, RUN_TS + dt.timedelta(days=1))):
        _land_growing(spark, sf_dir, landed, until)
        collect_landed(spark, store, landed, due, run_ts, **NO_LIMIT)
        compact(spark, store, run_ts.date() + dt.timedelta(days=1))
    return read_logs(spark, store).select(*KEY, *LOG, "collect_date", "collect_datetime")


def grown_segments(spark, sf_dir):
    """How far each job has read the segments of growing files."""
    rows = read_table(spark, _grown(spark, sf_dir), "segments")
    return rows.select(*FILE_COLUMNS, "run_id", "change", "length", "lines")


def stream_growing_files(spark, sf_dir):
    """Files that grow without a new segment, as a stream that is started twice."""
    landed, store = new_folder(spark, "landed"), new_folder(spark, "store")
    checkpoint = new_folder(spark, "checkpoint")
    periodic = stage(_files(spark, sf_dir, "주기|*|080000|30|235959", m.PERIODIC), "schedules")
    last = inputs.read(spark, sf_dir, "events").agg(F.max("event_id")).first()[0]
    for until, run_ts in (((last + 1) // 2, RUN_TS), (None, LATER_TS)):
        _land_growing(spark, sf_dir, landed, until)
        collect_stream(
            spark, landed, store, periodic, checkpoint, clock=lambda ts=run_ts: ts,
            options=NO_LIMIT, growing=True,
        ).awaitTermination()
    return read_logs(spark, store).select(*KEY, *LOG, "collect_datetime")


def analyze_lookup(spark, sf_dir):
    """Numeric logs of one server and day, from the stored table."""
    return find_logs(read_logs(spark, _stored(spark, sf_dir)), COLLECT_DATE, "srv1", m.NUMERIC)


def analyze_lookup_id(spark, sf_dir):
    logs = read_logs(spark, _stored(spark, sf_dir))
    return find_logs(logs, COLLECT_DATE, "srv1", m.NUMERIC, "CLICK_7")


# ---- Schedules ----

def schedule_parse(spark, sf_dir):
    return parse_schedules(inputs.schedule_lines(spark, sf_dir))


def schedule_calendar(spark, sf_dir):
    rows = run_calendar(schedule_parse(spark, sf_dir), dt.date(2024, 1, 19), dt.date(2024, 1, 21))
    return rows.select("event_id", "server_id", "schedule_type", "run_date", "run_index", "run_at")


def due_at(spark, sf_dir):
    """Due now, less the batch runs that the poll one second before has taken."""
    schedules = schedule_parse(spark, sf_dir)
    before = due_runs(schedules, DUE_TS - dt.timedelta(seconds=1))
    taken = before.where(F.col("schedule_type") == m.BATCH).select(
        "schedule_key", "run_date", "run_index"
    )
    return due_runs(schedules, DUE_TS, taken).select(
        "event_id", "schedule_key", "schedule_type", "run_date", "run_index"
    )


def due_since_poll(spark, sf_dir):
    """What came due in the 90 seconds since the last poll."""
    rows = due_between(schedule_parse(spark, sf_dir), DUE_TS - dt.timedelta(seconds=90), DUE_TS)
    return rows.select(
        "event_id", "schedule_key", "schedule_type", "run_date", "run_index", "run_at", "firings"
    )


def calendar_gaps(spark, sf_dir):
    """Runs of two days that are not made good by those due in a late poll and one day's end."""
    schedules = schedule_parse(spark, sf_dir)
    polled = due_between(schedules, DUE_TS - dt.timedelta(seconds=90), DUE_TS)
    closed = stage(polled.select("schedule_key", "run_date", "run_index"), "closed")
    missed = missed_runs(schedules, closed, DUE_TS.date(), DUE_TS.date() + dt.timedelta(days=1))
    return missed.groupBy("event_id", "schedule_key", "run_date").agg(
        F.count(F.lit(1)).alias("n_missed"), F.min("run_at").alias("first_missed")
    )


QUERIES = {
    f.__name__: f
    for f in (
        normalize_lines, normalize_documents, reject_documents, reject_reasons, reject_counts,
        value_tokens, numeric_values, compare_checks, time_minutes, content_cleanup,
        timestamp_smart_parse, line_number_explode, line_number_blocks, line_scan,
        path_resolve, last_line_top1, last_line_date_reset, history_open, history_fold,
        exclude_anti_join, exclude_count, incremental_tail, tail_bytes_guard,
        collect_end_to_end, collect_log_ids, collect_rejects, run_status, run_summary, history_close,
        exclude_register, collect_store, store_history, collect_taken_once, stream_collect,
        analyze_lookup, analyze_lookup_id, schedule_parse,
        schedule_calendar, due_at, due_since_poll, calendar_gaps, collect_overlapping_schedules,
        stream_overlapping_schedules, grown_files, grown_segments,
        grown_after_compaction,
        stream_growing_files,
    )
}
QUERIES["file_sizes"] = landed_file_sizes
QUERIES["surrogate_keys"] = record_keys
