"""The same results in DuckDB SQL, written apart from the Spark operators.

Only the expressions that make the inputs are shared (`checks.inputs`).
"""

from checks import inputs
from checks.queries import (
    COLLECT_DATE,
    INIT_LIMIT,
    PART_LIMIT,
    RUN_ID,
)

EDGES = r"'^[\x00-\x20]+|[\x00-\x20]+$', '', 'g'"
TOKEN = r"'\$[^$]+\$'"
HEADER = (
    r"'^\[(\d{4}/\d{2}/\d{2} \d{2}:\d{2}:\d{2}\.\d{3})\]\[([^\]]+)\]\[([^\]]+)\]'"
)


def _clean(text: str) -> str:
    bare = f"regexp_replace({text}, {TOKEN}, '', 'g')"
    return rf"regexp_replace(regexp_replace({bare}, {EDGES}), '\s{{2,}}', ' ', 'g')"


def _stamp(text: str) -> str:
    """Lenient timestamp of a well-formed text, null when impossible."""
    y, mo, d = (f"cast(substr({text}, {a}, {n}) AS int)" for a, n in ((1, 4), (6, 2), (9, 2)))
    h, mi, s = (f"cast(substr({text}, {a}, 2) AS int)" for a in (12, 15, 18))
    ms = f"cast(substr({text}, 21, 3) AS int)"
    last = f"day(last_day(make_date({y}, {mo}, 1)))"
    midnight = f"{h} = 24 AND {mi} = 0 AND {s} = 0 AND {ms} = 0"
    return f"""CASE WHEN {y} >= 1 AND {mo} BETWEEN 1 AND 12 AND {d} BETWEEN 1 AND 31
        AND {mi} <= 59 AND {s} <= 59 AND ({h} <= 23 OR ({midnight}))
      THEN make_timestamp({y}, {mo}, least({d}, {last}), 0, 0, 0.0)
        + to_milliseconds((({h} * 60 + {mi}) * 60 + {s}) * 1000 + {ms}) END"""


def _parsed(lines_sql: str) -> str:
    """WITH clauses that end in `parsed`: one row per marked line."""
    number = r"'[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?'"
    clock = r"'(\+\d|-0|\d\d):(\+\d|-0|\d\d)'"
    return f"""
lines AS ({lines_sql}),
marked AS (
  SELECT *, len(string_split(line, '@@@')) - 1 AS marks, string_split(line, '@@@')[2] AS body
  FROM lines WHERE position('@@@' IN line) > 0),
headed AS (
  SELECT *, regexp_matches(body, {HEADER}) AS header_ok,
    regexp_extract(body, {HEADER}, 1) AS stamp_text,
    regexp_extract(body, {HEADER}, 2) AS log_type,
    regexp_extract(body, {HEADER}, 3) AS log_id,
    regexp_replace(body, {HEADER}, '') AS rest
  FROM marked),
piped AS (
  SELECT *, len(string_split(rest, '|')) - 1 AS pipes,
    coalesce(string_split(rest, '|')[2], '') AS content,
    coalesce(string_split(rest, '|')[3], '') AS tail
  FROM headed),
tokens AS (
  SELECT *, list_concat(regexp_extract_all(content, {TOKEN}), regexp_extract_all(tail, {TOKEN}))
      AS toks,
    CASE WHEN header_ok THEN {_stamp('stamp_text')} END AS log_timestamp
  FROM piped),
valued AS (
  SELECT *, regexp_replace(trim(toks[1], '$'), {EDGES}) AS value_text FROM tokens),
timed AS (
  SELECT *, regexp_full_match(value_text, {number}) AS is_number,
    CASE WHEN regexp_full_match(value_text, {clock})
        AND cast(substr(value_text, 1, 2) AS int) BETWEEN 0 AND 23
        AND cast(substr(value_text, 4, 2) AS int) BETWEEN 0 AND 59
      THEN cast(substr(value_text, 1, 2) AS int) * 60 + cast(substr(value_text, 4, 2) AS int)
      END AS minutes
  FROM valued),
coded AS (
  SELECT *, CASE
    WHEN marks < 2 THEN 1 WHEN marks > 2 THEN 2
    WHEN NOT header_ok THEN 3
    WHEN NOT starts_with(rest, '|') THEN 4 WHEN pipes < 2 THEN 5 WHEN pipes > 2 THEN 6
    WHEN regexp_replace(regexp_replace(tail, {TOKEN}, '', 'g'), {EDGES}) <> '' THEN 7
    WHEN log_type NOT IN ('문구', '정보', '날짜', '수치', '존재', '비교', '시간') THEN 8
    WHEN NOT regexp_full_match(log_id, '[A-Z0-9_]{{1,30}}') THEN 9
    WHEN log_timestamp IS NULL THEN 10
    WHEN log_type = '수치' AND len(toks) <> 1 THEN 11
    WHEN log_type = '수치' AND contains(toks[1], ':') THEN 12
    WHEN log_type = '수치' AND NOT is_number THEN 13
    WHEN log_type = '비교' AND len(toks) <> 2 THEN 14
    WHEN log_type = '비교' AND (contains(toks[1], ':') OR contains(toks[2], ':')) THEN 15
    WHEN log_type = '시간' AND len(toks) <> 1 THEN 16
    WHEN log_type = '시간' AND NOT contains(toks[1], ':') THEN 17
    WHEN log_type = '시간' AND minutes IS NULL THEN 18
    WHEN log_type NOT IN ('수치', '비교', '시간') AND len(toks) > 0 THEN 19 END AS fault
  FROM timed),
parsed AS (
  SELECT * EXCLUDE (log_type, log_id, log_timestamp),
    CASE WHEN marks >= 2 AND header_ok THEN log_type END AS log_type,
    log_id, log_timestamp,
    CASE WHEN log_type = '수치' THEN {_clean('content')} ELSE content END AS log_content,
    CASE WHEN log_type = '수치' THEN try_cast(value_text AS decimal(38,10))
      WHEN log_type = '시간' THEN cast(minutes AS decimal(38,10)) END AS log_value,
    CASE WHEN marks = 2 THEN '@@@' || body || '@@@' END AS raw_log,
    'R' || fault AS reason_code
  FROM coded)"""


EVENTS = _parsed(inputs.EVENT_LINES_SQL)
DOCUMENTS = _parsed(inputs.DOCUMENT_RECORDS_SQL)
KEY = "server_id, source_file_path, line_number"
LOG = "log_type, log_id, log_timestamp, log_content, log_value, raw_log"
BOTH_LINES = (
    f"SELECT {KEY}, line FROM ({inputs.EVENT_LINES_SQL}) "
    f"UNION ALL SELECT {KEY}, line FROM ({inputs.DOCUMENT_LINES_SQL})"
)

DETAIL = """CASE fault
 WHEN 1 THEN 'end marker missing' WHEN 2 THEN 'more than one record in the line'
 WHEN 3 THEN 'header malformed' WHEN 4 THEN 'no pipe after the header'
 WHEN 5 THEN 'closing pipe missing' WHEN 6 THEN 'too many pipes'
 WHEN 7 THEN 'text outside value tokens after the closing pipe'
 WHEN 8 THEN 'unknown log type: ' || log_type WHEN 9 THEN 'malformed log id: ' || log_id
 WHEN 10 THEN 'impossible timestamp'
 WHEN 11 THEN 'numeric record needs exactly one value token: ' || len(toks)
 WHEN 12 THEN 'numeric record holds a time token: ' || toks[1]
 WHEN 13 THEN 'value token is not a number: ' || toks[1]
 WHEN 14 THEN 'comparison record needs exactly two value tokens: ' || len(toks)
 WHEN 15 THEN 'comparison record holds a time token: ' || toks[1]
 WHEN 16 THEN 'time record needs exactly one value token: ' || len(toks)
 WHEN 17 THEN 'time record holds a plain token: ' || toks[1]
 WHEN 18 THEN 'value token is not a time of day: ' || toks[1]
 WHEN 19 THEN 'value token in a type that takes none: ' || log_type END"""

# ---- Runs ----

LAST_LINES = f"""
ranked AS (
  SELECT *, row_number() OVER (
      PARTITION BY server_id, source_file_path
      ORDER BY collect_start_at DESC, collect_history_id DESC) AS any_rank,
    row_number() OVER (
      PARTITION BY server_id, source_file_path, collect_date
      ORDER BY collect_start_at DESC, collect_history_id DESC) AS day_rank
  FROM ({inputs.HISTORY_SQL}) WHERE collect_status = 'SUCCESS'),
last_lines AS (
  SELECT server_id, source_file_path,
    max(CASE WHEN any_rank = 1 THEN last_line_number END) AS last_any,
    max(CASE WHEN day_rank = 1 AND collect_date = '{COLLECT_DATE}' THEN last_line_number END)
      AS last_today
  FROM ranked GROUP BY ALL)"""

RUNS = f"""
runs AS (
  SELECT server_id, server_ip, schedule_type, source_file_path AS path_template,
    ends_with(source_file_path, '+') AS keeps_position,
    replace(regexp_replace(source_file_path, '\\+$', ''), 'yyyymmdd', '{COLLECT_DATE}')
      AS source_file_path,
    server_id || '::' || server_ip || '::' || source_file_path || '::' || schedule_expression
      || '::{RUN_ID}' AS run_key
  FROM ({inputs.DUE_SQL}))"""

# Lines per file, numbered from 1 in the order of the events.
FILES = f"""
file_lines AS (
  SELECT server_id, source_file_path, line, event_id, row_number() OVER (
    PARTITION BY server_id, source_file_path ORDER BY event_id) AS line_number
  FROM ({inputs.EVENT_LINES_SQL})),
sizes AS (
  SELECT server_id, source_file_path, cast(sum(strlen(line) + 1) AS bigint) AS file_size_bytes
  FROM file_lines GROUP BY ALL)"""

SETTLED = f"""{FILES}, {LAST_LINES}, {RUNS},
blocked AS (
  SELECT DISTINCT server_id, source_file_path FROM ({inputs.EXCLUDE_SQL}) WHERE restore_yn = 'N'),
facts AS (
  SELECT r.*, CASE WHEN b.server_id IS NULL THEN s.file_size_bytes END AS file_size_bytes,
    CASE WHEN r.schedule_type = '배치' THEN 1
      WHEN r.keeps_position THEN coalesce(l.last_any, 0) + 1
      ELSE coalesce(l.last_today, 0) + 1 END AS start_line,
    CASE WHEN b.server_id IS NOT NULL THEN 'EXCLUDED'
      WHEN s.file_size_bytes IS NULL THEN 'file missing: ' || r.source_file_path
      WHEN r.schedule_type = '배치' AND s.file_size_bytes >= {INIT_LIMIT}
        THEN 'INIT_SIZE_EXCEEDED' END AS stop
  FROM runs r
  LEFT JOIN blocked b USING (server_id, source_file_path)
  LEFT JOIN sizes s USING (server_id, source_file_path)
  LEFT JOIN last_lines l USING (server_id, source_file_path)),
tail AS (
  SELECT f.run_key, f.server_ip, f.schedule_type, t.server_id, t.source_file_path, t.line_number,
    t.line
  FROM facts f JOIN file_lines t USING (server_id, source_file_path)
  WHERE f.stop IS NULL AND t.line_number >= f.start_line),
totals AS (
  SELECT run_key, count(*) AS line_count, sum(strlen(line)) AS tail_bytes,
    max(line_number) AS max_line
  FROM tail GROUP BY ALL),
ended AS (
  SELECT f.*, coalesce(line_count, 0) AS line_count,
    cast(coalesce(tail_bytes, 0) AS bigint) AS tail_bytes,
    CASE WHEN stop IS NOT NULL THEN stop
      WHEN schedule_type = '주기' AND coalesce(tail_bytes, 0) >= {PART_LIMIT}
        THEN 'PART_SIZE_EXCEEDED' ELSE '' END AS fail_reason,
    greatest(coalesce(max_line, 0), start_line - 1) AS last_line
  FROM facts f LEFT JOIN totals USING (run_key)),
good_tail AS (
  SELECT t.* FROM tail t JOIN ended e USING (run_key) WHERE e.fail_reason = '')"""

JOB = f"{SETTLED}, {_parsed('SELECT * FROM good_tail')}"
OUTCOMES = f"""{JOB},
counts AS (
  SELECT run_key, count(*) FILTER (WHERE fault IS NULL) AS saved,
    count(*) FILTER (WHERE fault IS NOT NULL) AS rejects
  FROM parsed GROUP BY ALL),
outcomes AS (
  SELECT e.*, CASE WHEN fail_reason = '' THEN 'SUCCESS'
      WHEN fail_reason LIKE 'file missing%' THEN 'FAIL' ELSE 'SKIP' END AS collect_status,
    CASE WHEN fail_reason = '' THEN last_line END AS last_line_number,
    CASE WHEN fail_reason = '' THEN coalesce(saved, 0) END AS collected_count,
    CASE WHEN fail_reason = '' THEN coalesce(rejects, 0) END AS reject_count
  FROM ended e LEFT JOIN counts USING (run_key))"""

# ---- Schedules ----

_PART = "regexp_replace(parts[{}], " + EDGES + ")"
_TIME = "(substr({0}, 1, 2)::int * 3600 + substr({0}, 3, 2)::int * 60 + substr({0}, 5, 2)::int)"
_VALID_TIME = "regexp_full_match({}, '([01][0-9]|2[0-3])[0-5][0-9][0-5][0-9]')"
SCHEDULES = f"""
texts AS (
  SELECT event_id, regexp_replace(line, {EDGES}) AS text FROM ({inputs.SCHEDULE_LINES_SQL})),
brackets AS (
  SELECT event_id,
    [regexp_replace(x, {EDGES}) FOR x IN regexp_extract_all(text, '\\[([^\\]]*)\\]', 1)] AS b
  FROM texts WHERE text <> '' AND NOT starts_with(text, '#')),
named AS (
  SELECT event_id, b[1] AS server_id, b[2] AS server_ip, b[3] AS source_file_path,
    b[4] AS schedule_expression, string_split(b[4], '|') AS parts
  FROM brackets WHERE len(b) = 4 AND b[1] <> '' AND b[2] <> '' AND b[3] <> '' AND b[4] <> ''),
fields AS (
  SELECT * EXCLUDE (parts), len(parts) AS n, {_PART.format(1)} AS kind, {_PART.format(2)} AS days,
    {_PART.format(3)} AS start_text, {_PART.format(4)} AS every, {_PART.format(5)} AS end_text
  FROM named),
checked AS (
  SELECT * FROM fields
  WHERE regexp_full_match(days, '\\*|[0-6]|[0-6]-[0-6]') AND left(days, 1) <= right(days, 1)
    AND {_VALID_TIME.format('start_text')} AND start_text <> '000000'
    AND ((kind = '배치' AND n = 3) OR (kind = '주기' AND n = 5
      AND coalesce(try_cast(every AS int), 0) > 0 AND {_VALID_TIME.format('end_text')}))),
schedules AS (
  SELECT event_id, server_id, server_ip, source_file_path, schedule_expression,
    kind AS schedule_type,
    CASE WHEN days = '*' THEN 0 ELSE left(days, 1)::int END AS day_from,
    CASE WHEN days = '*' THEN 6 ELSE right(days, 1)::int END AS day_to,
    {_TIME.format('start_text')} AS start_sec,
    CASE WHEN kind = '주기' THEN every::int END AS interval_min,
    CASE WHEN kind = '주기' THEN {_TIME.format('end_text')} END AS end_sec
  FROM checked)"""
DUE_SECOND = 10 * 3600 + 30 * 60 + 1


def _due(second: int) -> str:
    return f"""
  SELECT event_id, schedule_type, DATE '2024-01-17' AS run_date,
    server_id || '::' || server_ip || '::' || source_file_path || '::' || schedule_expression
      AS schedule_key,
    CASE WHEN schedule_type = '배치' THEN 0
      ELSE ({second} - start_sec) // (interval_min * 60) END::bigint AS run_index
  FROM schedules
  WHERE 3 BETWEEN day_from AND day_to AND start_sec <= {second}
    AND CASE WHEN schedule_type = '배치' THEN {second} < start_sec + 2
      ELSE {second} <= end_sec AND ({second} - start_sec) % (interval_min * 60) < 2 END"""


def _of_type(log_type: str, columns: str) -> str:
    return f"WITH {EVENTS} SELECT {KEY}, {columns} FROM parsed WHERE log_type = '{log_type}'"


# Log files of `line_scan` and `file_sizes`: three servers, one file per event type.
SCANNED = f"""
scanned AS (
  SELECT 'srv' || (event_id % 3) AS server_id, '/logs/' || event_type || '.log' AS source_file_path,
    event_id, line
  FROM ({inputs.EVENT_LINES_SQL}))"""

STORED = f"""{SCANNED},
numbered AS (
  SELECT server_id, source_file_path, line, row_number() OVER (
    PARTITION BY server_id, source_file_path ORDER BY event_id) AS line_number
  FROM scanned),
runs AS (
  SELECT server_id, source_file_path, count(*) AS n_lines, server_id <> 'srv0' AS later,
    sum(strlen(line) + 1)::bigint AS n_bytes,
    server_id || '::10.0.0.1::' || source_file_path || '+::주기|*|080000|30|235959::'
      || CASE WHEN server_id = 'srv0' THEN '20240120T100000' ELSE '20240120T110000' END AS run_key
  FROM numbered GROUP BY ALL),
ranges AS (
  SELECT *, coalesce(sum(n_lines) OVER (ORDER BY later, left(md5(run_key), 3), run_key
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
    CASE WHEN later THEN TIMESTAMP '2024-01-20 11:00:00' ELSE TIMESTAMP '2024-01-20 10:00:00' END
      AS run_at
  FROM runs),
{_parsed('SELECT server_id, source_file_path, line_number, line FROM numbered')},
stored AS (
  SELECT p.*, '10.0.0.1' AS server_ip, '주기' AS schedule_type, '20240120' AS collect_date,
    r.run_at AS collect_datetime, r.run_at AS created_at,
    (r.before + p.line_number)::bigint AS collect_log_id,
    CASE WHEN log_type IN ('수치', '시간') THEN value_text END AS log_value_text
  FROM parsed p JOIN ranges r USING (server_id, source_file_path) WHERE fault IS NULL)"""
# Seconds of the day between two polls, each looked at on its own.
FIRED = f"""{SCHEDULES},
seconds AS (SELECT unnest(range({DUE_SECOND - 90} + 1, {DUE_SECOND} + 1)) AS second),
fired AS (
  SELECT event_id, schedule_type, DATE '2024-01-17' AS run_date, second,
    server_id || '::' || server_ip || '::' || source_file_path || '::' || schedule_expression
      AS schedule_key,
    CASE WHEN schedule_type = '배치' THEN 0
      ELSE (second - start_sec) // (interval_min * 60) END::bigint AS index
  FROM schedules, seconds
  WHERE 3 BETWEEN day_from AND day_to AND CASE WHEN schedule_type = '배치' THEN second = start_sec
    ELSE second BETWEEN start_sec AND end_sec AND (second - start_sec) % (interval_min * 60) = 0
    END)"""
FIRSTS = """firsts AS (
  SELECT server_id, source_file_path, count(*) AS n_lines,
    sum(strlen(line) + 1)::bigint AS n_bytes,
    count(*) FILTER (WHERE event_id < half) AS n_first,
    (sum(strlen(line) + 1) FILTER (WHERE event_id < half))::bigint AS first_bytes
  FROM scanned, (SELECT (max(event_id) + 1) // 2 AS half FROM events) GROUP BY ALL)"""


def _read_once(n_runs: int, schedule: str) -> str:
    return (
        f"WITH {STORED} SELECT server_id, source_file_path, count(*) AS n_records, "
        f"count(*) AS n_ids, {n_runs}::bigint AS n_runs, 1::bigint AS n_reading, "
        f"'{schedule}' AS reading_schedule FROM stored GROUP BY ALL"
    )


GROWN = f"""WITH {STORED}, {FIRSTS} SELECT {KEY}, {LOG},
  CASE WHEN line_number <= n_first THEN TIMESTAMP '2024-01-20 10:00:00'
    ELSE TIMESTAMP '2024-01-20 11:00:00' END AS collect_datetime
FROM stored JOIN firsts USING (server_id, source_file_path)"""
PLACE = "server_ip, schedule_type, collect_date, collect_datetime"
LOOKUP = f"""
WITH {STORED}
SELECT collect_log_id, {KEY}, {LOG}, {PLACE}, created_at, log_value_text
FROM stored WHERE server_id = 'srv1' AND log_type = """

ORACLE = {
    "normalize_lines": f"WITH {EVENTS} SELECT {KEY}, {LOG}, "
    "log_type = '수치' AND log_value IS NULL AS value_overflow FROM parsed WHERE fault IS NULL",
    "normalize_documents": f"WITH {DOCUMENTS} SELECT {KEY}, {LOG} FROM parsed WHERE fault IS NULL",
    "reject_documents": f"WITH {DOCUMENTS} SELECT {KEY}, reason_code, raw_log FROM parsed "
    "WHERE fault IS NOT NULL",
    "reject_reasons": f"WITH {EVENTS} SELECT {KEY}, reason_code, {DETAIL} AS detail, raw_log "
    "FROM parsed WHERE fault IS NOT NULL",
    "reject_counts": f"WITH {EVENTS} SELECT reason_code, count(*) AS rejects FROM parsed "
    "WHERE fault IS NOT NULL GROUP BY ALL",
    "value_tokens": f"SELECT {KEY}, generate_subscripts(t, 1) - 1 AS pos, unnest(t) AS token "
    f"FROM (SELECT {KEY}, regexp_extract_all(line, {TOKEN}) AS t FROM ({BOTH_LINES}))",
    "numeric_values": _of_type(
        "수치",
        "reason_code, log_value, value_text AS log_value_text, "
        "fault IS NULL AND log_value IS NULL AS overflow",
    ),
    "compare_checks": _of_type("비교", "reason_code, log_content, log_value"),
    "time_minutes": _of_type("시간", "reason_code, log_content, log_value"),
    "content_cleanup": f"SELECT {KEY}, {_clean('line')} AS content FROM ({BOTH_LINES})",
    "timestamp_smart_parse": f"SELECT event_id, stamp_text, {_stamp('stamp_text')} AS stamp FROM "
    f"(SELECT event_id, {inputs.STAMP_TEXT.format(**inputs.DUCKDB_FORMATS)} AS stamp_text "
    "FROM events)",
    "surrogate_keys": f"WITH {EVENTS} SELECT count(*) AS n_rows, count(*) AS n_keys, "
    "1001::bigint AS first_key, 1000 + count(*) AS last_key FROM parsed",
    "line_number_explode": f"SELECT {KEY}, strlen(line) AS line_bytes "
    f"FROM ({inputs.DOCUMENT_LINES_SQL})",
    "line_number_blocks": f"WITH {FILES} SELECT {KEY}, event_id, line FROM file_lines",
    "line_scan": f"WITH {SCANNED} SELECT server_id, source_file_path, row_number() OVER "
    "(PARTITION BY server_id, source_file_path ORDER BY event_id) AS line_number, line "
    "FROM scanned",
    "file_sizes": f"WITH {SCANNED} SELECT server_id, source_file_path, "
    "sum(strlen(line) + 1)::bigint AS file_size_bytes FROM scanned GROUP BY ALL",
    "path_resolve": f"WITH {SCHEDULES} SELECT event_id, source_file_path AS path_template, "
    f"replace(regexp_replace(source_file_path, '\\+$', ''), 'yyyymmdd', '{COLLECT_DATE}') "
    "AS source_file_path, ends_with(source_file_path, '+') AS keeps_position FROM schedules",
    "last_line_top1": f"WITH {LAST_LINES} SELECT server_id, source_file_path, last_any "
    "FROM last_lines",
    "last_line_date_reset": f"WITH {LAST_LINES}, {RUNS} SELECT server_id, source_file_path, "
    "schedule_type, keeps_position, keeps_position AS plus, "
    "CASE WHEN keeps_position THEN last_any ELSE last_today END AS last_line "
    "FROM runs LEFT JOIN last_lines USING (server_id, source_file_path)",
    "history_open": f"WITH {RUNS} SELECT server_id, source_file_path, server_ip, schedule_type, "
    "'FAIL' AS collect_status, 0::bigint AS retry_count, 'IN_PROGRESS' AS fail_reason, "
    f"TIMESTAMP '2024-01-20 10:00:00' AS collect_start_at, '{COLLECT_DATE}' AS collect_date "
    "FROM runs",
    "history_fold": "SELECT collect_history_id, "
    "arg_max(collect_status, seq) FILTER (WHERE collect_status <> '') AS collect_status, "
    + ", ".join(
        f"arg_max({c}, seq) FILTER (WHERE {c} IS NOT NULL) AS {c}"
        for c in ("collected_count", "last_line_number", "retry_count", "fail_reason",
                  "collect_end_at")
    )
    + ", (list(updated_at ORDER BY seq DESC))[1] AS updated_at "
    f"FROM ({inputs.UPDATES_SQL}) GROUP BY ALL",
    "exclude_anti_join": f"WITH {RUNS} SELECT server_id, source_file_path, schedule_type FROM runs r "
    f"WHERE NOT EXISTS (SELECT 1 FROM ({inputs.EXCLUDE_SQL}) e WHERE e.restore_yn = 'N' "
    "AND e.server_id = r.server_id AND e.source_file_path = r.source_file_path)",
    "exclude_count": "SELECT server_id, source_file_path, count(*) AS active_count "
    f"FROM ({inputs.EXCLUDE_SQL}) WHERE restore_yn = 'N' GROUP BY ALL",
    "incremental_tail": f"WITH {SETTLED} SELECT run_key, {KEY}, line FROM tail",
    "tail_bytes_guard": "SELECT source_file_path AS run_key, count(*) AS line_count, "
    "sum(strlen(line))::bigint AS tail_bytes, max(line_number) AS max_line, "
    f"sum(strlen(line)) >= 5000 AS exceeded FROM ({inputs.DOCUMENT_LINES_SQL}) GROUP BY ALL",
    "collect_end_to_end": f"WITH {JOB} SELECT {KEY}, {LOG}, server_ip, schedule_type, "
    f"'{COLLECT_DATE}' AS collect_date, TIMESTAMP '2024-01-20 10:00:00' AS collect_datetime "
    "FROM parsed WHERE fault IS NULL",
    "collect_log_ids": f"""WITH {JOB},
ranges AS (
  SELECT run_key, start_line, coalesce(sum(CASE WHEN fail_reason = '' THEN last_line - start_line + 1
      ELSE 0 END) OVER (ORDER BY left(md5(run_key), 3), run_key
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
    AS before
  FROM ended)
SELECT {KEY}, (before + line_number - start_line + 1)::bigint AS collect_log_id
FROM parsed JOIN ranges USING (run_key) WHERE fault IS NULL""",
    "collect_rejects": f"WITH {JOB} SELECT run_key, {KEY}, reason_code, "
    f"'{COLLECT_DATE}' AS collect_date FROM parsed WHERE fault IS NOT NULL",
    "run_status": f"WITH {OUTCOMES} SELECT run_key, server_id, source_file_path, schedule_type, "
    "collect_status, fail_reason, collected_count, last_line_number, file_size_bytes, "
    "start_line::bigint AS start_line FROM outcomes",
    "run_summary": f"WITH {OUTCOMES} SELECT run_key, line_count, tail_bytes, last_line_number, "
    "collected_count, reject_count FROM outcomes WHERE collect_status = 'SUCCESS'",
    "history_close": f"WITH {OUTCOMES} SELECT run_key, collect_status, fail_reason, "
    "collected_count, last_line_number, CASE WHEN collect_status = 'SUCCESS' "
    "OR fail_reason IN ('INIT_SIZE_EXCEEDED', 'PART_SIZE_EXCEEDED') THEN file_size_bytes END "
    "AS file_size_bytes, 0::bigint AS retry_count, "
    f"TIMESTAMP '2024-01-20 10:00:00' AS collect_end_at, '{COLLECT_DATE}' AS collect_date "
    "FROM outcomes",
    "exclude_register": f"WITH {OUTCOMES} SELECT server_id, source_file_path, server_ip, "
    "replace(fail_reason, '_EXCEEDED', '') AS exclude_reason, "
    "file_size_bytes AS exclude_file_size, CASE WHEN fail_reason = 'INIT_SIZE_EXCEEDED' "
    "THEN '배치 수집 파일 크기 초과' ELSE '주기 수집 증분 크기 초과' END AS exclude_detail, "
    f"'N' AS restore_yn, '{COLLECT_DATE}' AS exclude_date, "
    "TIMESTAMP '2024-01-20 10:00:00' AS created_at "
    "FROM outcomes WHERE fail_reason IN ('INIT_SIZE_EXCEEDED', 'PART_SIZE_EXCEEDED')",
    "analyze_lookup": LOOKUP + "'수치'",
    "analyze_lookup_id": LOOKUP + "'수치' AND log_id = 'CLICK_7'",
    "collect_store": f"WITH {STORED} SELECT {KEY}, {LOG}, {PLACE}, log_value_text, "
    "collect_log_id FROM stored",
    "store_history": f"""WITH {STORED},
counts AS (SELECT server_id, source_file_path, count(*) AS n FROM stored GROUP BY ALL),
jobs AS (
  SELECT r.*, unnest(CASE WHEN later THEN [2] ELSE [1, 2] END) AS job FROM ranges r)
SELECT server_id, source_file_path, 'SUCCESS' AS collect_status,
  CASE WHEN later OR job = 1 THEN coalesce(n, 0) ELSE 0 END AS collected_count,
  n_lines AS last_line_number, n_bytes AS file_size_bytes,
  TIMESTAMP '2024-01-20 09:00:00' + to_hours(job) AS collect_start_at,
  TIMESTAMP '2024-01-20 09:00:00' + to_hours(job) AS collect_end_at
FROM jobs LEFT JOIN counts USING (server_id, source_file_path)""",
    "collect_taken_once": f"WITH {STORED} SELECT server_id, source_file_path, "
    "count(*) AS n_records, count(*) AS n_ids, 1::bigint AS n_runs FROM stored GROUP BY ALL",
    "stream_collect": f"WITH {STORED} SELECT {KEY}, {LOG} FROM stored",
    "collect_overlapping_schedules": _read_once(4, "배치|*|100000"),
    "stream_overlapping_schedules": _read_once(1, "주기|6|090000|60|235959"),
    "grown_files": GROWN,
    "grown_after_compaction": f"""WITH {STORED}, {FIRSTS} SELECT {KEY}, {LOG},
  CASE WHEN line_number <= n_first THEN '20240120' ELSE '20240121' END AS collect_date,
  CASE WHEN line_number <= n_first THEN TIMESTAMP '2024-01-20 10:00:00'
    ELSE TIMESTAMP '2024-01-21 10:00:00' END AS collect_datetime
FROM stored JOIN firsts USING (server_id, source_file_path)""",
    "stream_growing_files": GROWN,
    "grown_segments": f"""WITH {SCANNED}, {FIRSTS}
SELECT server_id, source_file_path, '20240120T100000' AS run_id, 'NEW' AS change,
  first_bytes AS length, n_first AS lines FROM firsts WHERE n_first > 0
UNION ALL
SELECT server_id, source_file_path, '20240120T110000',
  CASE WHEN n_first > 0 THEN 'APPENDED' ELSE 'NEW' END, n_bytes, n_lines
FROM firsts WHERE n_first < n_lines""",
    "due_since_poll": f"""WITH {FIRED}
SELECT event_id, schedule_key, schedule_type, run_date, max(index) AS run_index,
  run_date::timestamp + to_seconds(max(second)) AS run_at, count(*) AS firings
FROM fired GROUP BY event_id, schedule_key, schedule_type, run_date""",
    "calendar_gaps": f"""WITH {FIRED},
closed AS (SELECT schedule_key, run_date, max(index) AS done FROM fired GROUP BY ALL),
days AS (SELECT unnest([DATE '2024-01-17', DATE '2024-01-18']) AS run_date),
firings AS (
  SELECT event_id, start_sec, interval_min, run_date,
    server_id || '::' || server_ip || '::' || source_file_path || '::' || schedule_expression
      AS schedule_key,
    unnest(CASE WHEN schedule_type = '배치' THEN [start_sec]
      ELSE range(start_sec, end_sec + 1, interval_min * 60) END) AS second
  FROM schedules, days WHERE dayofweek(run_date) BETWEEN day_from AND day_to)
SELECT event_id, schedule_key, run_date, count(*) AS n_missed,
  min(run_date::timestamp + to_seconds(second)) AS first_missed
FROM firings LEFT JOIN closed USING (schedule_key, run_date)
WHERE done IS NULL OR coalesce((second - start_sec) // (interval_min * 60), 0) > done
GROUP BY ALL""",
    "schedule_parse": f"WITH {SCHEDULES} SELECT * FROM schedules",
    "schedule_calendar": f"""WITH {SCHEDULES},
days AS (SELECT unnest([DATE '2024-01-19', DATE '2024-01-20', DATE '2024-01-21']) AS run_date),
firings AS (
  SELECT *, unnest(CASE WHEN schedule_type = '배치' THEN [start_sec]
      ELSE range(start_sec, end_sec + 1, interval_min * 60) END) AS second
  FROM schedules, days WHERE dayofweek(run_date) BETWEEN day_from AND day_to)
SELECT event_id, server_id, schedule_type, run_date,
  coalesce((second - start_sec) // (interval_min * 60), 0)::bigint AS run_index,
  run_date::timestamp + to_seconds(second) AS run_at FROM firings""",
    "due_at": f"""WITH {SCHEDULES}, due AS ({_due(DUE_SECOND)}), before AS ({_due(DUE_SECOND - 1)})
SELECT event_id, schedule_key, schedule_type, run_date, run_index FROM due d
WHERE NOT EXISTS (SELECT 1 FROM before b WHERE b.schedule_type = '배치'
  AND b.schedule_key = d.schedule_key AND b.run_index = d.run_index)""",
}
