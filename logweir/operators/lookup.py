"""The lookup that analysis jobs run on the log table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COLUMNS = [
    "collect_log_id", "server_id", "server_ip", "source_file_path", "log_type", "log_id",
    "log_timestamp", "log_content", "log_value", "raw_log", "collect_date", "collect_datetime",
    "schedule_type", "line_number", "created_at", "log_value_text",
]


def find_logs(
    logs: DataFrame, collect_date: str, server_id: str, log_type: str, log_id: str | None = None
) -> DataFrame:
    """Logs of one collection date, server and type, of one log id if given, in time order.

    The table is partitioned by date, so only that date is read; within its files rows are ordered
    by server, type and id (`sources.store`), so only the pages that hold them are. Equal times are ordered by path,
    line and the record's own id, so the order is total. `log_value_text` is the value as it was
    written, for those that the decimal type rounds or cannot hold. Raises ValueError if `logs`
    lacks a column.
    """
    missing = [c for c in COLUMNS if c not in logs.columns]
    if missing:
        raise ValueError(f"no log table: {', '.join(missing)} missing")
    wanted = (
        (F.col("collect_date") == collect_date)
        & (F.col("server_id") == server_id)
        & (F.col("log_type") == log_type)
    )
    if log_id:
        wanted = wanted & (F.col("log_id") == log_id)
    return (
        logs.where(wanted)
        .select(*COLUMNS)
        .orderBy("log_timestamp", "source_file_path", "line_number", "collect_log_id")
    )
