import datetime as dt

from landing import land

from logweir.operators.history import last_lines
from logweir.operators.schedules import parse_schedules
from logweir.plans.collect import collect_landed
from logweir.plans.compact import compact, past
from logweir.sources.store import CLOSE, read_logs, read_table, write_table

RECORD = "@@@[2026/06/12 04:56:07.089][정보][A]|{}|@@@\n"


def _last(spark, store, day):
    known = past(spark, store, day)
    rows = known.events.where("collect_status = 'SUCCESS'").unionByName(
        known.successes(), allowMissingColumns=True
    )
    return sorted(map(tuple, last_lines(rows, day).select("source_file_path", "last_any").collect()))


def test_state_and_days_after_it_tell_the_whole_past(spark, tmp_path):
    landed, store = str(tmp_path / "landed"), str(tmp_path / "store")
    lines = ["[s][ip][/a.log+][주기|*|080000|1|235959]", "[s][ip][/b.log+][주기|*|080000|1|235959]"]
    due = parse_schedules(spark.createDataFrame([(x,) for x in lines], "line string"))
    first = dt.datetime(2026, 6, 12, 9)

    def job(day):
        land(landed, "s", "/a.log", "".join(RECORD.format(i) for i in range(day + 1)).encode())
        land(landed, "s", "/b.log", RECORD.format("b").encode())
        collect_landed(spark, store, landed, due, first + dt.timedelta(days=day))
        rows = [r for r in read_logs(spark, store).collect()]
        assert len(rows) == len({r.collect_log_id for r in rows})
        return sorted((r.source_file_path, r.line_number) for r in rows)

    def day(n):
        return f"{first + dt.timedelta(days=n):%Y%m%d}"

    job(0)
    job(1)
    whole = _last(spark, store, day(2))
    assert compact(spark, store, dt.date(2026, 6, 13)) == "20260613"
    assert _last(spark, store, day(2)) == whole == [("/a.log", 2), ("/b.log", 1)]
    # A second state stands on the first one.
    assert compact(spark, store, dt.date(2026, 6, 14)) == "20260614"
    assert compact(spark, store, dt.date(2026, 6, 13)) == "20260614"
    known = past(spark, store, day(2))
    assert known.events.inputFiles() == [] and known.segments.count() == 2
    assert _last(spark, store, day(2)) == whole
    assert job(2) == [("/a.log", 1), ("/a.log", 2), ("/a.log", 3), ("/b.log", 1)]
    newest = read_table(spark, store, "segments", day(2)).collect()
    assert [(r.source_file_path, r.change) for r in newest if r.source_file_path == "/a.log"] == [
        ("/a.log", "APPENDED")
    ]
    # The files a job has to read do not depend on how many days were folded.
    past_files = past(spark, store, day(3)).events.inputFiles()
    assert all(f"collect_date={day(2)}" in name for name in past_files)
    # A job of a folded day that is run again finds its own rows and does nothing.
    assert job(0) == [("/a.log", 1), ("/a.log", 2), ("/a.log", 3), ("/b.log", 1)]


def test_a_crashed_job_is_not_folded(spark, tmp_path):
    landed, store = str(tmp_path / "landed"), str(tmp_path / "store")
    due = parse_schedules(
        spark.createDataFrame([("[s][ip][/a.log][주기|*|080000|1|235959]",)], "line string")
    )
    land(landed, "s", "/a.log", RECORD.format("x").encode())
    collect_landed(spark, store, landed, due, dt.datetime(2026, 6, 12, 9))
    events = read_table(spark, store, "history_events")
    crashed = events.where(f"stage <> '{CLOSE}'").selectExpr(
        "* EXCEPT (run_key, run_id, collect_date)", "'k' AS run_key", "'crashed' AS run_id",
        "'20260613' AS collect_date",
    )
    write_table(crashed, store, "history_events")
    assert compact(spark, store, dt.date(2026, 6, 20)) == "20260613"
