"""Fixed values of the log format, and the table schemas (DDL text)."""

# ---- Fixed values: they must stay as they are for results to match. ----

MARK = "@@@"

TEXT = "문구"
INFO = "정보"
DATE = "날짜"
NUMERIC = "수치"
EXIST = "존재"
COMPARE = "비교"
TIME = "시간"
LOG_TYPES = (TEXT, INFO, DATE, NUMERIC, EXIST, COMPARE, TIME)

BATCH = "배치"
PERIODIC = "주기"

SUCCESS = "SUCCESS"
FAIL = "FAIL"
SKIP = "SKIP"
READING = "READING"  # ours, never stored: the run goes on to read its file
BEHIND = "BEHIND"  # ours, never stored: another run of the job reads the file

IN_PROGRESS = "IN_PROGRESS"
EXCLUDED = "EXCLUDED"
INIT_SIZE = "INIT_SIZE"
PART_SIZE = "PART_SIZE"
INIT_SIZE_EXCEEDED = "INIT_SIZE_EXCEEDED"
NO_SCHEDULE = "NO_SCHEDULE"
PART_SIZE_EXCEEDED = "PART_SIZE_EXCEEDED"
INIT_SIZE_DETAIL = "배치 수집 파일 크기 초과"
PART_SIZE_DETAIL = "주기 수집 증분 크기 초과"
YES = "Y"
NO = "N"

INIT_LIMIT_BYTES = 300 * 1024 * 1024
PART_LIMIT_BYTES = 50 * 1024 * 1024

DATE_PLACEHOLDER = "yyyymmdd"
NO_RESET_SUFFIX = "+"
DUE_WINDOW_SECONDS = 2

TIMESTAMP_PATTERN = r"\A\[\d{4}/\d{2}/\d{2} \d{2}:\d{2}:\d{2}\.\d{3}\z"
LOG_ID_PATTERN = r"\A[A-Z0-9_]{1,30}\z"
TOKEN_PATTERN = r"\$[^$]+\$"

# Reject codes in the order they are tested; the first that applies is reported.
REJECT_REASONS = {
    "R1": "end marker missing",
    "R2": "more than one record in the line",
    "R3": "header malformed",
    "R4": "no pipe after the header",
    "R5": "closing pipe missing",
    "R6": "too many pipes",
    "R7": "text outside value tokens after the closing pipe",
    "R8": "unknown log type",
    "R9": "malformed log id",
    "R10": "impossible timestamp",
    "R11": "numeric record needs exactly one value token",
    "R12": "numeric record holds a time token",
    "R13": "value token is not a number",
    "R14": "comparison record needs exactly two value tokens",
    "R15": "comparison record holds a time token",
    "R16": "time record needs exactly one value token",
    "R17": "time record holds a plain token",
    "R18": "value token is not a time of day",
    "R19": "value token in a type that takes none",
}

# ---- Schemas ----

COLLECT_LOG = (
    "collect_log_id bigint, server_id string, server_ip string, source_file_path string, "
    "log_type string, log_id string, log_timestamp timestamp_ntz, log_content string, "
    "log_value decimal(38,10), log_value_text string, value_overflow boolean, raw_log string, "
    "collect_date string, collect_datetime timestamp_ntz, schedule_type string, "
    "line_number bigint, created_at timestamp_ntz, run_id string"
)

COLLECT_REJECT = (
    "run_key string, server_id string, source_file_path string, line_number bigint, "
    "reason_code string, detail string, raw_log string, collect_date string, run_id string"
)

COLLECT_HISTORY = (
    "collect_history_id bigint, server_id string, server_ip string, source_file_path string, "
    "schedule_type string, collect_status string, collected_count bigint, "
    "last_line_number bigint, file_size_bytes bigint, retry_count bigint, fail_reason string, "
    "collect_start_at timestamp_ntz, collect_end_at timestamp_ntz, collect_date string, "
    "created_at timestamp_ntz, updated_at timestamp_ntz"
)

# History is kept as events that are folded into one row per run when read.
HISTORY_EVENTS = (
    COLLECT_HISTORY
    + ", path_template string, run_key string, schedule_key string, run_date date, "
    "run_index bigint, issued_ids bigint, seq int, run_id string, stage string"
)

# How far landed segments were read: bytes, the lines in them, digests of the first and the last
# of these bytes, and what had become of the segment when it was opened.
SEGMENTS = (
    "server_id string, source_file_path string, segment string, length bigint, "
    "modified timestamp, lines bigint, head string, tail string, change string, "
    "collect_date string, run_id string"
)
NEW_SEGMENT = "NEW"
APPENDED = "APPENDED"
REWRITTEN = "REWRITTEN"
SHRUNK = "SHRUNK"
REREAD = "REREAD"  # unchanged, opened again for a run that starts before its end

# Which stretch of time a job's poll stands for.
POLLS = (
    "polled_after timestamp_ntz, polled_until timestamp_ntz, collect_date string, run_id string"
)

COLLECT_EXCLUDE = (
    "collect_exclude_id bigint, server_id string, server_ip string, source_file_path string, "
    "exclude_reason string, exclude_file_size bigint, exclude_detail string, restore_yn string, "
    "restore_at timestamp_ntz, restore_memo string, exclude_date string, "
    "created_at timestamp_ntz, updated_at timestamp_ntz, run_id string"
)
