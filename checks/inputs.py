"""Log lines, run histories and schedules made from the test tables.

The expressions are plain SQL that Spark and DuckDB read alike. Only date formats differ, so each
engine brings its own. Nothing is left out: every row of a table becomes one input row.
"""

from pyspark.sql import DataFrame, SparkSession

SPARK_FORMATS = {
    "stamp": "date_format(ts, 'yyyy/MM/dd HH:mm:ss.SSS')",
    "day": "date_format(ts, 'yyyyMMdd')",
    "hhmmss": "date_format(ts, 'HHmmss')",
    "hhmm": "date_format(ts, 'HH:mm')",
    "tab": r"'\t'",
}
DUCKDB_FORMATS = {
    "stamp": "strftime(ts, '%Y/%m/%d %H:%M:%S.%g')",
    "day": "strftime(ts, '%Y%m%d')",
    "hhmmss": "strftime(ts, '%H%M%S')",
    "hhmm": "strftime(ts, '%H:%M')",
    "tab": "chr(9)",
}

SERVER = "'srv' || user_id"
# Files of every fourth user carry the date of the run in their name.
FILE = (
    "CASE WHEN user_id % 4 = 3 THEN '/logs/' || event_type || '.20240120' "
    "ELSE '/logs/' || event_type || '.log' END"
)
TEMPLATE = (
    "CASE user_id % 4 WHEN 3 THEN '/logs/' || event_type || '.yyyymmdd' "
    "WHEN 1 THEN '/logs/' || event_type || '.log+' ELSE '/logs/' || event_type || '.log' END"
)
EXPRESSION = (
    "CASE WHEN user_id % 4 = 2 THEN '배치|*|100000' ELSE '주기|*|080000|30|235959' END"
)
KIND = "CASE WHEN user_id % 4 = 2 THEN '배치' ELSE '주기' END"

# Parts of a line, then one template per shape: 1 to 19 are rejected for that reason, 20 to 31
# are odd but good, the rest is simply good, and every eleventh line is no record at all.
LINE_PARTS = {
    "stamp": "{stamp}",
    "hhmm": "{hhmm}",
    "head": "'@@@[' || {stamp} || ']['",
    "id": "upper(event_type) || '_' || user_id",
    "v": "cast(cast(value AS decimal(18,2)) AS varchar(40))",
}
LAYOUT_FAULTS = """CASE event_id % 40
 WHEN 1 THEN head || '정보][' || id || ']|' || event_type
 WHEN 2 THEN head || '정보][' || id || ']|a|@@@ ' || head || '정보][' || id || ']|b|@@@'
 WHEN 3 THEN '@@@[' || left(stamp, 22) || '][정보][' || id || ']|' || event_type || '|@@@'
 WHEN 4 THEN head || '정보][' || id || ']x|' || event_type || '|@@@'
 WHEN 5 THEN head || '정보][' || id || ']|' || event_type || '@@@'
 WHEN 6 THEN head || '정보][' || id || ']|' || event_type || '|x|@@@'
 WHEN 7 THEN head || '수치][' || id || ']|' || event_type || '|$' || v || '$ 건@@@'
 WHEN 8 THEN head || '기타][' || id || ']|' || event_type || '|@@@'
END"""
OTHER_FAULTS = """CASE event_id % 40
 WHEN 9 THEN head || '수치][' || lower(id) || ']|' || event_type || '|$' || v || '$@@@'
 WHEN 10 THEN '@@@[' || left(stamp, 5) || '13' || substr(stamp, 8) || '][수치][' || id || ']|x|$' || v || '$@@@'
 WHEN 11 THEN head || '수치][' || id || ']|' || event_type || '|@@@'
 WHEN 12 THEN head || '수치][' || id || ']|' || event_type || '|$' || hhmm || '$@@@'
 WHEN 13 THEN head || '수치][' || id || ']|' || event_type || '|$1,' || v || '$@@@'
 WHEN 14 THEN head || '비교][' || id || ']|' || event_type || ' $' || v || '$|@@@'
 WHEN 15 THEN head || '비교][' || id || ']|' || event_type || ' $' || v || '$ $' || hhmm || '$|@@@'
 WHEN 16 THEN head || '시간][' || id || ']|$' || hhmm || '$ $07:36$|@@@'
 WHEN 17 THEN head || '시간][' || id || ']|' || event_type || ' $735$|@@@'
 WHEN 18 THEN head || '시간][' || id || ']|' || event_type || ' $24:00$|@@@'
 WHEN 19 THEN head || '존재][' || id || ']|' || event_type || '|$' || v || '$@@@'
END"""
ODD = """CASE event_id % 40
 WHEN 20 THEN '@@@[' || left(stamp, 5) || '02/30' || substr(stamp, 11) || '][정보][' || id || ']|x|@@@'
 WHEN 21 THEN '@@@[' || left(stamp, 5) || '04/31' || substr(stamp, 11) || '][문구][' || id || ']|x|@@@'
 WHEN 22 THEN '@@@[' || left(stamp, 11) || '24:00:00.000][날짜][' || id || ']|x|@@@'
 WHEN 23 THEN 'noise ' || head || '정보][' || id || ']|' || event_type || '|@@@ more'
 WHEN 24 THEN head || '수치][' || id || ']|' || event_type || '|$ -1.' || user_id || 'e2 $@@@'
 WHEN 25 THEN head || '수치][' || id || ']|  a' || tab || tab || 'b   $' || v || '$   c' || tab || 'd |@@@'
 WHEN 26 THEN head || '수치][' || id || ']|' || event_type || ' $' || v || '$ done|@@@'
 WHEN 27 THEN head || '시간][' || id || ']|$+7:05$|@@@'
 WHEN 28 THEN head || '수치][' || id || ']|$$' || v || '$|@@@'
 WHEN 29 THEN head || '수치][' || id || ']|$' || v || '$2$|@@@'
 WHEN 30 THEN head || '정보][' || id || ']||@@@'
 WHEN 31 THEN head || '수치][' || id || ']|x|$' || repeat('9', 40) || '$@@@'
END"""
GOOD = """CASE event_id % 7
 WHEN 0 THEN head || '문구][' || id || ']|' || event_type || ' ' || user_id || '|@@@'
 WHEN 1 THEN head || '정보][' || id || ']|' || event_type || ' [ ON ]|@@@'
 WHEN 2 THEN head || '날짜][' || id || ']|day=' || stamp || '|@@@'
 WHEN 3 THEN head || '수치][' || id || ']|' || event_type || '|$' || v || '$@@@'
 WHEN 4 THEN head || '존재][' || id || ']|' || event_type || '| @@@'
 WHEN 5 THEN head || '비교][' || id || ']|in$' || v || '$ out$' || user_id || '$|@@@'
 ELSE head || '시간][' || id || ']|' || event_type || '|$' || hhmm || '$@@@'
END"""
PLAIN = "'[' || stamp || '] INFO  ' || event_type || ' ' || user_id"
STEPS = {
    "layout": LAYOUT_FAULTS, "other": OTHER_FAULTS, "odd": ODD, "good": GOOD, "plain": PLAIN,
}
LINE = (
    "CASE WHEN event_id % 11 = 0 THEN {plain} "
    "ELSE coalesce({layout}, {other}, {odd}, {good}) END"
)

# Timestamps with every field driven over its edge now and then.
STAMP_TEXT = (
    "lpad(cast(CASE WHEN event_id % 50 = 0 THEN 0 ELSE 1890 + event_id % 211 END AS string), 4, '0')"
    " || '/' || lpad(cast(event_id % 14 AS string), 2, '0')"
    " || '/' || lpad(cast(user_id % 33 AS string), 2, '0')"
    " || ' ' || CASE WHEN event_id % 23 = 0 THEN '24:00:00.000'"
    " WHEN event_id % 29 = 0 THEN '24:00:00.001'"
    " WHEN event_id % 31 = 0 THEN '25:00:00.000'"
    " WHEN event_id % 37 = 0 THEN '23:60:00.000'"
    " WHEN event_id % 41 = 0 THEN '23:59:60.000'"
    " ELSE substr({stamp}, 12) END"
)

# Run history: any row may be the newest of its file, some without a line.
HISTORY = {
    "collect_history_id": "event_id",
    "server_id": SERVER,
    "source_file_path": FILE,
    "collect_status": "CASE event_id % 4 WHEN 0 THEN 'FAIL' WHEN 3 THEN 'SKIP' ELSE 'SUCCESS' END",
    "last_line_number": "CASE WHEN event_id % 17 = 0 THEN NULL ELSE event_id % 12 END",
    "collect_start_at": "ts",
    "collect_date": "{day}",
}
EXCLUDE = {
    "server_id": SERVER,
    "source_file_path": FILE,
    "restore_yn": "CASE WHEN value > 250 THEN 'N' WHEN value > 100 THEN 'Y' END",
}
# Four updates per run; each sets some columns only.
UPDATES = {
    "collect_history_id": "event_id - event_id % 4",
    "seq": "cast(event_id % 4 AS int)",
    "collect_status": "CASE event_id % 5 WHEN 0 THEN 'SUCCESS' WHEN 1 THEN '' WHEN 3 THEN 'FAIL' "
                      "WHEN 4 THEN 'SKIP' END",
    "collected_count": "CASE WHEN event_id % 3 = 0 THEN user_id END",
    "last_line_number": "CASE WHEN value > 40 THEN event_id END",
    "retry_count": "CASE WHEN event_type = 'error' THEN event_id % 4 END",
    "fail_reason": "CASE WHEN event_type = 'error' THEN 'IN_PROGRESS' "
                   "WHEN event_type = 'view' THEN '' END",
    "collect_end_at": "CASE WHEN value > 60 THEN ts END",
    "updated_at": "CASE WHEN event_id % 9 = 0 THEN NULL ELSE ts END",
}
SCHEDULE_LINE = """
CASE event_id % 12
 WHEN 6 THEN '# ' WHEN 10 THEN '  ' ELSE '' END
|| '[srv' || user_id || '][10.0.' || (user_id % 256) || '.' || (event_id % 256) || '][/logs/'
|| event_type || CASE event_id % 3 WHEN 0 THEN '.log+' WHEN 1 THEN '.yyyymmdd' ELSE '.log' END || ']'
|| CASE WHEN event_id % 12 = 7 THEN '' WHEN event_id % 12 = 11 THEN '[x]' ELSE '' END
|| '[' || CASE event_id % 10
 WHEN 0 THEN '배치|*|' || {hhmmss}
 WHEN 1 THEN '배치|1-5|' || {hhmmss}
 WHEN 2 THEN '주기|*|080000|' || (30 + user_id % 30 * 10) || '|235959'
 WHEN 3 THEN ' 주기 | 0-6 |' || {hhmmss} || '|' || (60 + event_id % 600) || '|235959'
 WHEN 4 THEN '주기|' || (user_id % 8) || '|090000|' || (20 + user_id % 100) || '|180000'
 WHEN 5 THEN '배치|' || (user_id % 7) || '-' || (event_id % 7) || '|' || {hhmmss}
 WHEN 6 THEN '주기|*|000000|10|235959'
 WHEN 7 THEN '주기|*|103000|' || (user_id % 2) || '|103100'
 WHEN 8 THEN '배치|*|103000'
 ELSE '주기|2-4|220000|45|000000' END || ']'
"""


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _named(columns: dict[str, str], formats: dict[str, str]) -> list[str]:
    return [f"{text.format(**formats)} AS {name}" for name, text in columns.items()]


def _spark_select(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    # Spark has no varchar cast outside table schemas.
    return df.selectExpr(
        *[c.replace("varchar(40)", "string") for c in _named(columns, SPARK_FORMATS)]
    )


def _duckdb_select(columns: dict[str, str], source: str = "events") -> str:
    return f"SELECT {', '.join(_named(columns, DUCKDB_FORMATS))} FROM {source}"


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One log line per event, with the event's number as its line number."""
    parts = _spark_select(
        read(spark, sf_dir, "events"),
        {
            "event_id": "event_id", "event_type": "event_type", "user_id": "user_id",
            "tab": "{tab}", **LINE_PARTS,
        },
    )
    # Finished in steps: filters on the line do not repeat its making, and no method of the
    # generated code grows beyond what the JVM compiles.
    for name, text in STEPS.items():
        parts = parts.selectExpr("*", f"inline(array(struct({text} AS {name})))")
    return parts.selectExpr(
        "event_id",
        f"inline(array(struct({SERVER} AS server_id, {FILE} AS source_file_path, "
        f"event_id + 1 AS line_number, {LINE.format(**{n: n for n in STEPS})} AS line)))",
    )


EVENT_LINES_SQL = (
    f"SELECT event_id, {SERVER} AS server_id, {FILE} AS source_file_path, "
    f"event_id + 1 AS line_number, "
    + LINE.format(**STEPS)
    + " AS line, user_id, event_type FROM ("
    + _duckdb_select(
        {
            "event_id": "event_id", "event_type": "event_type", "user_id": "user_id",
            "tab": "{tab}", **LINE_PARTS,
        }
    )
    + ")"
)

DOCUMENT_FILE = {
    "server_id": "'srv' || (doc_id % 10)",
    "source_file_path": "'/docs/' || source || '/' || doc_id || '.log'",
}
# Every document line wrapped as a record, its type by position.
DOCUMENT_RECORD = (
    "'@@@[2024/03/' || lpad(cast(doc_id % 31 + 1 AS varchar(40)), 2, '0') || ' 10:00:00.000][' || "
    "CASE line_number % 7 WHEN 0 THEN '문구' WHEN 1 THEN '정보' WHEN 2 THEN '날짜' WHEN 3 THEN '수치' "
    "WHEN 4 THEN '존재' WHEN 5 THEN '비교' ELSE '시간' END || '][DOC_' || doc_id || ']|' || line || '|@@@'"
)


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files, their lines numbered from 1."""
    rows = read(spark, sf_dir, "documents").selectExpr(
        "doc_id", "source", r"posexplode(split(text, '\n', -1)) AS (pos, line)"
    )
    return _spark_select(
        rows, {"doc_id": "doc_id", **DOCUMENT_FILE, "line_number": "pos + 1L", "line": "line"}
    )


DOCUMENT_LINES_SQL = (
    "SELECT doc_id, server_id, source_file_path, "
    "generate_subscripts(parts, 1) AS line_number, unnest(parts) AS line FROM ("
    "SELECT doc_id, "
    + ", ".join(f"{text} AS {name}" for name, text in DOCUMENT_FILE.items())
    + ", string_split(text, chr(10)) AS parts FROM documents)"
)


def document_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_lines(spark, sf_dir).selectExpr(
        "doc_id", "server_id", "source_file_path", "line_number",
        f"inline(array(struct({DOCUMENT_RECORD.replace('varchar(40)', 'string')} AS line)))",
    )


DOCUMENT_RECORDS_SQL = (
    f"SELECT doc_id, server_id, source_file_path, line_number, {DOCUMENT_RECORD} AS line "
    f"FROM ({DOCUMENT_LINES_SQL})"
)


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spark_select(read(spark, sf_dir, "events"), HISTORY)


HISTORY_SQL = _duckdb_select(HISTORY)


def exclude(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spark_select(read(spark, sf_dir, "events"), EXCLUDE)


EXCLUDE_SQL = _duckdb_select(EXCLUDE)


def updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spark_select(read(spark, sf_dir, "events"), UPDATES)


UPDATES_SQL = _duckdb_select(UPDATES)


def schedule_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = {"event_id": "event_id", "line": SCHEDULE_LINE}
    return _spark_select(read(spark, sf_dir, "events"), columns)


SCHEDULE_LINES_SQL = _duckdb_select({"event_id": "event_id", "line": SCHEDULE_LINE})

# Due schedules: one per file of the events, and one per user for a file that was never landed.
DUE = {
    "server_id": SERVER,
    "server_ip": "'10.0.0.' || (user_id % 256)",
    "source_file_path": TEMPLATE,
    "schedule_expression": EXPRESSION,
    "schedule_type": KIND,
}
ABSENT = {**DUE, "source_file_path": "'/logs/absent.log'"}


def due(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read(spark, sf_dir, "events")
    found = _spark_select(events, DUE).union(_spark_select(events, ABSENT))
    return found.distinct()


DUE_SQL = f"{_duckdb_select(DUE)} UNION {_duckdb_select(ABSENT)}"
