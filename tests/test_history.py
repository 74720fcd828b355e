import datetime as dt

from pyspark.sql import functions as F

from logweir import model as m
from logweir.operators.exclusions import active_exclusions, not_excluded
from logweir.operators.history import fold_history, last_lines
from logweir.operators.runs import resolve_paths

T = dt.datetime(2026, 6, 12, 9)


def test_fold_keeps_what_an_update_leaves_out(spark):
    events = spark.createDataFrame(
        [
            (1, 0, "FAIL", None, None, 0, "IN_PROGRESS", T),
            (1, 1, None, None, None, 1, None, T + dt.timedelta(seconds=1)),
            (1, 2, "SUCCESS", 7, 80, None, None, T + dt.timedelta(seconds=2)),
            (2, 0, "FAIL", None, None, 0, "IN_PROGRESS", T),
            (2, 1, "", None, None, None, "late", None),
        ],
        "collect_history_id bigint, seq int, collect_status string, collected_count bigint, "
        "last_line_number bigint, retry_count bigint, fail_reason string, updated_at timestamp_ntz",
    )
    got = {r.collect_history_id: r for r in fold_history(events).collect()}
    assert (got[1].collect_status, got[1].collected_count, got[1].last_line_number) == ("SUCCESS", 7, 80)
    assert (got[1].retry_count, got[1].fail_reason) == (1, "IN_PROGRESS")
    assert got[1].updated_at == T + dt.timedelta(seconds=2)
    assert (got[2].collect_status, got[2].fail_reason, got[2].updated_at) == ("FAIL", "late", None)


def _history(spark, rows):
    return spark.createDataFrame(
        [(i, "s", "/a", "SUCCESS" if ok else "FAIL", last, start, f"{start:%Y%m%d}")
         for i, (ok, last, start) in enumerate(rows)],
        "collect_history_id bigint, server_id string, source_file_path string, "
        "collect_status string, last_line_number bigint, collect_start_at timestamp_ntz, "
        "collect_date string",
    )


def test_last_lines(spark):
    day = dt.timedelta(days=1)
    hour = dt.timedelta(hours=1)
    h = _history(spark, [(True, 50, T - day), (True, 10, T), (True, 30, T + hour), (False, 99, T + 2 * hour)])
    (r,) = last_lines(h, "20260612").collect()
    assert (r.last_any, r.last_today) == (30, 30)
    (r,) = last_lines(_history(spark, [(True, 50, T - day)]), "20260612").collect()
    assert (r.last_any, r.last_today) == (50, None)
    # A newest run without a line counts as none, not as the one before.
    (r,) = last_lines(_history(spark, [(True, 50, T), (True, None, T + hour)]), "20260612").collect()
    assert (r.last_any, r.last_today) == (None, None)


def test_paths(spark):
    cases = {
        "/logs/test.yyyymmdd": ("/logs/test.20260612", False),
        "/logs/test.log+": ("/logs/test.log", True),
        "/logs/test.log": ("/logs/test.log", False),
        "/logs/test.yyyymmdd+": ("/logs/test.20260612", True),
        "/logs/a.log++": ("/logs/a.log+", True),
        "/yyyymmdd/a.yyyymmdd": ("/20260612/a.20260612", False),
        "/YYYYMMDD/a": ("/YYYYMMDD/a", False),
    }
    df = spark.createDataFrame([(c,) for c in cases], "source_file_path string")
    got = {r.path_template: (r.source_file_path, r.keeps_position)
           for r in resolve_paths(df, "20260612").collect()}
    assert got == cases


def test_exclusions(spark):
    exclude = spark.createDataFrame(
        [("s", "/a", "N"), ("s", "/a", "N"), ("s", "/b", "Y"), ("t", "/a", "Y")],
        "server_id string, source_file_path string, restore_yn string",
    )
    runs = spark.createDataFrame(
        [("s", "/a"), ("s", "/b"), ("t", "/a")], "server_id string, source_file_path string"
    )
    assert [tuple(r) for r in active_exclusions(exclude).collect()] == [("s", "/a", 2)]
    assert {tuple(r) for r in not_excluded(runs, exclude).collect()} == {("s", "/b"), ("t", "/a")}
