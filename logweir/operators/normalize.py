"""Log lines to typed records and rejects.

A pure projection: no shuffle, no Python, one stage of generated code. Each part of a line is a
column of its own. The cut line and the record are finished (see `functions.rows`), so that a
filter on the outcome does not run the whole parse a second time, and so that no generated method
reaches the 8,000 bytes of bytecode beyond which the JVM only interprets it.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweir import model as m
from logweir.functions.rows import finish
from logweir.functions.text import (
    bare_content,
    edge_trim,
    single_spaced,
    token_text,
    value_tokens,
    without_tokens,
)
from logweir.functions.times import lenient_timestamp
from logweir.functions.values import (
    VALUE_TYPE,
    is_exact,
    is_number,
    minutes_of_day,
    number,
)
from logweir.sources.staging import stage

RECORD_COLUMNS = [
    "log_type", "log_id", "log_timestamp", "log_content",
    "log_value", "log_value_text", "value_overflow", "raw_log",
]


def marked(line: Column) -> Column:
    """True for lines that try to be a record; all others are plain lines."""
    return F.contains(line, F.lit(m.MARK))


def parse_lines(lines: DataFrame) -> DataFrame:
    """Parse the marked lines of `lines(..., line)`.

    Gives the other columns of `lines`, RECORD_COLUMNS, `reason_code` and `detail`. A record is
    good when `reason_code` is null. Plain lines give no row.
    """
    carried = [c for c in lines.columns if c != "line"]
    line, body, head, parts = (F.col(c) for c in ("line", "_body", "_head", "_parts"))
    content, tail, tokens = (F.col(c) for c in ("_content", "_tail", "_tokens"))
    log_type, log_id, stamp = (F.col(c) for c in ("log_type", "log_id", "log_timestamp"))
    first, n_tokens, value_text = (F.col(c) for c in ("_first", "_n_tokens", "log_value_text"))
    minutes = F.col("_minutes")

    mark = F.lit(m.MARK)
    opened, end = F.col("_opened"), F.col("_end")
    header_ok = (
        F.get(head, 0).rlike(m.TIMESTAMP_PATTERN)
        & F.get(head, 1).rlike(r"(?s)\A\[.") & F.get(head, 2).rlike(r"(?s)\A\[.")
        & (F.size(head) == 4)
    )
    cut = (
        lines.where(marked(line))
        # Marks are found one after the other: in a run of at signs they do not overlap.
        .select(*carried, F.substr(line, F.position(mark, line) + len(m.MARK)).alias("_opened"))
        .select(*carried, "_opened", F.position(mark, opened).alias("_end"))
        .select(
            *carried, "_end",
            F.left(opened, end - 1).alias("_body"),
            F.contains(F.substr(opened, end + len(m.MARK)), mark).alias("_more"),
        )
        .select(*carried, "_end", "_more", "_body", F.split(body, r"\]", 4).alias("_head"))
        .select(
            *carried, "_end", "_more", "_body",
            F.coalesce(header_ok, F.lit(False)).alias("_header_ok"),
            F.substr(F.get(head, 0), F.lit(2)).alias("_stamp_text"),
            F.substr(F.get(head, 1), F.lit(2)).alias("log_type"),
            F.substr(F.get(head, 2), F.lit(2)).alias("log_id"),
            F.split(F.get(head, 3), r"\|", -1).alias("_parts"),
        )
    )
    cut = finish(
        cut, carried,
        (end > 0).alias("_closed"),
        *map(F.col, ("_more", "_body", "_header_ok", "_stamp_text", "log_type", "log_id")),
        F.get(parts, 0).alias("_lead"),
        F.size(parts).alias("_n_parts"),
        F.get(parts, 1).alias("_content"),
        F.coalesce(F.get(parts, 2), F.lit("")).alias("_tail"),
    )
    given = [c for c in cut.columns if c != "_stamp_text"]
    typed = (
        cut.select(
            *given,
            F.when(F.col("_header_ok"), lenient_timestamp(F.col("_stamp_text")))
            .alias("log_timestamp"),
            F.concat(value_tokens(content), value_tokens(tail)).alias("_tokens"),
        )
        .select(
            *given, "log_timestamp", "_tokens",
            F.size(tokens).alias("_n_tokens"),
            F.get(tokens, 0).alias("_first"),
        )
        .withColumn(
            "log_value_text", F.when(log_type.isin(m.NUMERIC, m.TIME), token_text(first))
        )
        .withColumn("_minutes", F.when(log_type == m.TIME, minutes_of_day(value_text)))
        .withColumn("_bare", F.when(log_type == m.NUMERIC, bare_content(content)))
    )

    colon = F.lit(":")
    layout_fault = (
        F.when(~F.col("_closed"), 1)
        .when(F.col("_more"), 2)
        .when(~F.col("_header_ok"), 3)
        # Text before the first pipe, or no pipe and no text at all.
        .when((F.col("_lead") != "") | (F.col("_n_parts") == 1), 4)
        .when(F.col("_n_parts") == 2, 5)
        .when(F.col("_n_parts") > 3, 6)
        .when(edge_trim(without_tokens(tail)) != "", 7)
        .when(~log_type.isin(*m.LOG_TYPES), 8)
        .when(~log_id.rlike(m.LOG_ID_PATTERN), 9)
        .when(stamp.isNull(), 10)
    )
    value_fault = (
        F.when(
            log_type == m.NUMERIC,
            F.when(n_tokens != 1, 11)
            .when(F.contains(first, colon), 12)
            .when(~is_number(value_text), 13),
        )
        .when(
            log_type == m.COMPARE,
            F.when(n_tokens != 2, 14)
            .when(F.contains(first, colon) | F.contains(F.get(tokens, 1), colon), 15),
        )
        .when(
            log_type == m.TIME,
            F.when(n_tokens != 1, 16)
            .when(~F.contains(first, colon), 17)
            .when(minutes.isNull(), 18),
        )
        .when(n_tokens > 0, 19)
    )
    # Only the fault is finished: the values stay a plain select, so that a caller who wants
    # reasons alone computes no values.
    records = finish(
        typed, typed.columns, F.coalesce(layout_fault, value_fault).alias("_fault")
    )
    return records.select(
        *carried,
        log_type, log_id, stamp,
        F.coalesce(single_spaced(F.col("_bare")), content).alias("log_content"),
        F.when(log_type == m.NUMERIC, number(value_text)).otherwise(minutes.cast(VALUE_TYPE))
        .alias("log_value"),
        value_text,
        # A number that the decimal type cannot hold, or only rounded, is kept as text.
        ((log_type == m.NUMERIC) & F.coalesce(~is_exact(value_text), F.lit(True)))
        .alias("value_overflow"),
        F.when(F.col("_closed") & ~F.col("_more"), F.concat(mark, body, mark)).alias("raw_log"),
        F.concat(F.lit("R"), F.col("_fault").cast("string")).alias("reason_code"),
        _detail().alias("detail"),
    )


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reason_code").isNull()).drop("reason_code", "detail")


def rejected(parsed: DataFrame) -> DataFrame:
    """Rejects with line and reason; the typed columns say nothing there and are left out."""
    typed = [c for c in RECORD_COLUMNS if c != "raw_log"]
    return parsed.where(F.col("reason_code").isNotNull()).drop(*typed)


def normalize(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Logs and rejects of whole files, without any run history; parsed once and staged."""
    parsed = stage(parse_lines(lines), "parsed")
    return accepted(parsed), rejected(parsed)


def _detail() -> Column:
    """Reason in words, with the part of the line it is about."""
    fault = F.col("_fault")
    words = F.get(F.array(*[F.lit(text) for text in m.REJECT_REASONS.values()]), fault - 1)
    about = (
        F.when(fault.isin(8, 19), F.col("log_type"))
        .when(fault == 9, F.col("log_id"))
        .when(fault.isin(11, 14, 16), F.col("_n_tokens").cast("string"))
        .when(fault > 11, F.col("_first"))
    )
    return F.when(fault > 0, F.concat_ws(": ", words, about))
