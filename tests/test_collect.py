import datetime as dt
from decimal import Decimal

from landing import land

from logweir.operators.lookup import find_logs
from logweir.operators.schedules import due_runs, parse_schedules
from logweir.plans.collect import collect_history, collect_landed
from logweir.sources.store import read_logs, read_table, write_table

RECORD = "@@@[2026/06/12 04:56:07.089][{type}][{id}]|{content}|{tail}@@@\n"


def number(i):
    return RECORD.format(type="수치", id="N", content="n", tail=f"${i}$")


def schedules(spark, *lines):
    return parse_schedules(spark.createDataFrame([(x,) for x in lines], "line string"))


def history(spark, store):
    return {
        (r.source_file_path, r.run_key.split("::")[-1]): r
        for r in collect_history(spark, store).collect()
    }


def test_incremental_runs(spark, tmp_path):
    landed, store = tmp_path / "landed", str(tmp_path / "store")
    due = schedules(
        spark,
        "[s1][10.0.0.1][/logs/a.yyyymmdd][주기|*|080000|1|235959]",
        "[s1][10.0.0.1][/logs/b.log+][주기|*|080000|1|235959]",
        "[s2][10.0.0.2][/logs/c.log][배치|*|090000]",
        "[s2][10.0.0.2][/logs/gone.log][배치|*|090000]",
    )
    day1, later, day2 = (
        dt.datetime(2026, 6, 12, 9), dt.datetime(2026, 6, 12, 10), dt.datetime(2026, 6, 13, 9)
    )
    a1 = "".join(number(i) for i in range(3)) + "plain\n"
    land(landed, "s1", "/logs/a.20260612", a1.encode())
    land(landed, "s1", "/logs/b.log", number(7).encode())
    bad = number(1).replace("|n|", "|n")
    land(landed, "s2", "/logs/c.log", (bad + number(2)).encode())

    def run(ts):
        collect_landed(spark, store, str(landed), due, ts)

    run(day1)
    h = history(spark, store)
    key = f"{day1:%Y%m%dT%H%M%S}"
    a = h["/logs/a.20260612", key]
    assert (a.collect_status, a.collected_count, a.last_line_number) == ("SUCCESS", 3, 4)
    assert (a.file_size_bytes, a.retry_count, a.fail_reason) == (len(a1.encode()), 0, "")
    assert a.path_template == "/logs/a.yyyymmdd"
    c = h["/logs/c.log", key]
    assert (c.collect_status, c.collected_count, c.last_line_number) == ("SUCCESS", 1, 2)
    gone = h["/logs/gone.log", key]
    assert (gone.collect_status, gone.fail_reason) == ("FAIL", "file missing: /logs/gone.log")
    rejects = read_table(spark, store, "collect_reject").collect()
    assert [(r.source_file_path, r.line_number, r.reason_code) for r in rejects] == [
        ("/logs/c.log", 1, "R5")
    ]
    logs = read_logs(spark, store).collect()
    assert len(logs) == 5 and len({r.collect_log_id for r in logs}) == 5
    assert {r.schedule_type for r in logs if r.server_id == "s2"} == {"배치"}
    assert {(r.collect_date, r.collect_datetime, r.server_ip) for r in logs if r.server_id == "s1"} == {
        ("20260612", day1, "10.0.0.1")
    }

    # The same run again changes nothing.
    run(day1)
    again = read_logs(spark, store).collect()
    assert sorted(map(tuple, again), key=str) == sorted(map(tuple, logs), key=str)
    assert len(history(spark, store)) == 4

    # Appended lines only; the batch file is read whole again.
    land(landed, "s1", "/logs/a.20260612", (a1 + number(8)).encode())
    run(later)
    h = history(spark, store)
    key = f"{later:%Y%m%dT%H%M%S}"
    assert h["/logs/a.20260612", key].last_line_number == 5
    assert h["/logs/a.20260612", key].collected_count == 1
    assert h["/logs/b.log", key].collected_count == 0
    assert h["/logs/b.log", key].last_line_number == 1
    assert h["/logs/c.log", key].collected_count == 1
    new = [r for r in read_logs(spark, store).collect() if r.collect_datetime == later]
    assert {(r.source_file_path, r.line_number, r.log_value) for r in new} == {
        ("/logs/a.20260612", 5, Decimal(8)), ("/logs/c.log", 2, Decimal(2))
    }
    ids = [r.collect_log_id for r in read_logs(spark, store).collect()]
    assert len(ids) == len(set(ids)) == 7

    # Next day: the plus path goes on, the dated path is a new file.
    land(landed, "s1", "/logs/b.log", (number(7) + number(9)).encode())
    land(landed, "s1", "/logs/a.20260613", number(4).encode())
    run(day2)
    new = [r for r in read_logs(spark, store).collect() if r.collect_datetime == day2]
    assert {(r.source_file_path, r.line_number) for r in new} == {
        ("/logs/a.20260613", 1), ("/logs/b.log", 2), ("/logs/c.log", 2)
    }
    found = find_logs(read_logs(spark, store), "20260613", "s1", "수치").collect()
    assert [(r.source_file_path, r.log_value) for r in found] == [
        ("/logs/a.20260613", Decimal(4)), ("/logs/b.log", Decimal(9))
    ]
    assert find_logs(read_logs(spark, store), "20260613", "s1", "수치", "X").count() == 0


def test_limits_and_exclusions(spark, tmp_path):
    landed, store = tmp_path / "landed", str(tmp_path / "store")
    data = "".join(number(i) for i in range(10)).encode()
    line_bytes = len(data) - 10  # line ends do not count
    for path in ("/batch.log", "/small.log", "/tail.log", "/tail_ok.log"):
        land(landed, "s", path, data if path != "/small.log" else data[:-1])
    due = schedules(
        spark,
        "[s][ip][/batch.log][배치|*|090000]",
        "[s][ip][/small.log][배치|*|090000]",
        "[s][ip][/tail.log][주기|*|080000|1|235959]",
    )
    ts = dt.datetime(2026, 6, 12, 9)
    collect_landed(
        spark, store, str(landed), due, ts, init_limit=len(data), part_limit=line_bytes
    )
    h = {k[0]: v for k, v in history(spark, store).items()}
    assert (h["/batch.log"].collect_status, h["/batch.log"].fail_reason) == (
        "SKIP", "INIT_SIZE_EXCEEDED")
    assert h["/batch.log"].file_size_bytes == len(data)
    assert h["/batch.log"].last_line_number is None
    assert h["/small.log"].collect_status == "SUCCESS"
    assert (h["/tail.log"].collect_status, h["/tail.log"].fail_reason) == (
        "SKIP", "PART_SIZE_EXCEEDED")
    assert {r.source_file_path for r in read_logs(spark, store).collect()} == {"/small.log"}
    excluded = read_table(spark, store, "collect_exclude").collect()
    assert {
        (r.source_file_path, r.exclude_reason, r.exclude_file_size, r.restore_yn, r.exclude_date)
        for r in excluded
    } == {
        ("/batch.log", "INIT_SIZE", len(data), "N", "20260612"),
        ("/tail.log", "PART_SIZE", len(data), "N", "20260612"),
    }
    # Blocked from now on, even with the limits out of reach, until an operator restores it.
    collect_landed(spark, store, str(landed), due, ts + dt.timedelta(hours=1))
    h = {k: v for k, v in history(spark, store).items() if k[1].endswith("T100000")}
    assert {(k[0], v.collect_status, v.fail_reason) for k, v in h.items()} == {
        ("/batch.log", "SKIP", "EXCLUDED"), ("/tail.log", "SKIP", "EXCLUDED"),
        ("/small.log", "SUCCESS", ""),
    }
    restored = spark.createDataFrame(
        [{**r.asDict(), "restore_yn": "Y"} for r in excluded],
        read_table(spark, store, "collect_exclude").schema,
    )
    write_table(restored, store, "collect_exclude")
    collect_landed(spark, store, str(landed), due, ts + dt.timedelta(hours=2))
    h = {k: v for k, v in history(spark, store).items() if k[1].endswith("T110000")}
    assert {v.collect_status for v in h.values()} == {"SUCCESS"}


def test_crashed_job_is_replaced(spark, tmp_path):
    landed, store = tmp_path / "landed", str(tmp_path / "store")
    land(landed, "s", "/a.log", (number(1) + number(2)).encode())
    due = schedules(spark, "[s][ip][/a.log][주기|*|080000|1|235959]")
    ts = dt.datetime(2026, 6, 12, 9)
    collect_landed(spark, store, str(landed), due, ts)
    # Take back the closing rows, as if the job had died before writing them.
    import shutil

    shutil.rmtree(f"{store}/history_events/collect_date=20260612/run_id=20260612T090000/stage=close")
    assert read_logs(spark, store).count() == 0
    (row,) = collect_history(spark, store).collect()
    assert (row.collect_status, row.fail_reason) == ("FAIL", "IN_PROGRESS")
    collect_landed(spark, store, str(landed), due, ts)
    assert read_logs(spark, store).count() == 2
    (row,) = collect_history(spark, store).collect()
    assert (row.collect_status, row.collected_count) == ("SUCCESS", 2)


def test_due_runs_feed_the_job(spark, tmp_path):
    rows = schedules(
        spark,
        "[s][ip][/a.log][배치|*|090000]", "[s][ip][/b.log][주기|*|080000|60|200000]",
        "[s][ip][/c.log][주기|*|081000|60|200000]",
    )
    due = due_runs(rows, dt.datetime(2026, 6, 12, 9, 0, 1))
    assert {r.source_file_path for r in due.collect()} == {"/a.log", "/b.log"}


def test_runs_are_unique_and_taken_once(spark, tmp_path):
    landed, store = tmp_path / "landed", str(tmp_path / "store")
    land(landed, "s", "/a.log", (number(1) + number(2)).encode())
    land(landed, "s", "/b.log", number(3).encode())
    line = "[s][ip][/a.log][배치|*|090000]"
    rows = schedules(spark, line, line, "[s][ip][/b.log][주기|*|080000|60|200000]", line)
    for second in (0, 1):
        ts = dt.datetime(2026, 6, 12, 9, 0, second)
        collect_landed(spark, store, str(landed), due_runs(rows, ts), ts)
    logs = read_logs(spark, store).collect()
    assert sorted((r.source_file_path, r.line_number) for r in logs) == [
        ("/a.log", 1), ("/a.log", 2), ("/b.log", 1)
    ]
    assert len({r.collect_log_id for r in logs}) == 3
    assert sorted(r.collected_count for r in collect_history(spark, store).collect()) == [1, 2]
    # The next index and the next day are other runs.
    for ts in (dt.datetime(2026, 6, 12, 10, 0, 0), dt.datetime(2026, 6, 13, 9, 0, 0)):
        collect_landed(spark, store, str(landed), due_runs(rows, ts), ts)
    assert collect_history(spark, store).count() == 5


def test_segments_read_to_their_end_stay_shut(spark, tmp_path, monkeypatch):
    from logweir.plans import collect as plan

    landed, store = tmp_path / "landed", str(tmp_path / "store")
    opened = []
    scan = plan.scan_landed

    def noting(spark, root, segments=None, encoding="UTF-8"):
        opened.append(sorted(s.rsplit("/", 2)[-1] for s in segments))
        return scan(spark, root, segments, encoding)

    monkeypatch.setattr(plan, "scan_landed", noting)
    due = schedules(spark, "[s][ip][/a.log+][주기|*|080000|1|235959]")
    times = iter(dt.datetime(2026, 6, 12, 9) + dt.timedelta(hours=h) for h in range(9))

    def run(**options):
        collect_landed(spark, store, str(landed), due, next(times), **options)
        return sorted((r.line_number, int(r.log_value)) for r in read_logs(spark, store).collect())

    land(landed, "s", "/a.log", (number(1) + "plain\n").encode(), "1.log")
    land(landed, "s", "/a.log", number(2).encode(), "2.log")
    assert run() == [(1, 1), (3, 2)]
    assert run() == [(1, 1), (3, 2)]  # nothing new
    land(landed, "s", "/a.log", (number(3) + number(4)).encode(), "[3] {x}.log")
    assert run() == [(1, 1), (3, 2), (4, 3), (5, 4)]
    land(landed, "s", "/a.log", (number(3) + number(4) + number(5)).encode(), "[3] {x}.log")
    assert run() == [(1, 1), (3, 2), (4, 3), (5, 4), (6, 5)]  # grown: opened again
    assert opened == [["1.log", "2.log"], [], ["[3] {x}.log"], ["[3] {x}.log"]]


def test_empty_files_and_charsets(spark, tmp_path):
    landed, store = tmp_path / "landed", str(tmp_path / "store")
    land(landed, "s 1", "/a+b%.log", b"")
    text = RECORD.format(type="정보", id="N", content="홈디스크 가나다", tail="")
    land(landed, "s 1", "/k.log", text.encode("euc-kr"))
    due = schedules(
        spark, "[s 1][ip][/a+b%.log][배치|*|090000]", "[s 1][ip][/k.log][배치|*|090000]"
    )
    before = spark.conf.get("spark.sql.legacy.javaCharsets")
    for hour, name in enumerate(("EUC-KR", "MS949")):
        ts = dt.datetime(2026, 6, 12, 9 + hour)
        collect_landed(spark, f"{store}{hour}", str(landed), due, ts, encoding=name)
        found = {r.source_file_path: r for r in collect_history(spark, f"{store}{hour}").collect()}
        empty = found["/a+b%.log"]
        assert (empty.collect_status, empty.collected_count, empty.file_size_bytes) == ("SUCCESS", 0, 0)
        (row,) = read_logs(spark, f"{store}{hour}").collect()
        assert (row.log_type, row.log_content) == ("정보", "홈디스크 가나다")
    assert spark.conf.get("spark.sql.legacy.javaCharsets") == before
    import pytest

    for name in ("no-such-charset", "UTF-16"):
        with pytest.raises(ValueError):
            collect_landed(spark, f"{store}x", str(landed), due, ts, encoding=name)


def test_lookup_is_whole_and_ordered(spark, tmp_path):
    import pytest

    store = str(tmp_path / "store")
    land(tmp_path / "landed", "s", "/a.log", (number(1) + number("1e-20")).encode())
    due = schedules(spark, "[s][ip][/a.log][배치|*|090000]", "[s][ip][/a.log][주기|*|080000|1|235959]")
    # A batch run reads the whole file, also after a periodic one has read it.
    for kind, minute in (("주기", 0), ("배치", 1)):
        collect_landed(
            spark, store, str(tmp_path / "landed"), due.where(f"schedule_type = '{kind}'"),
            dt.datetime(2026, 6, 12, 9, minute),
        )
    logs = read_logs(spark, store)
    found = find_logs(logs, "20260612", "s", "수치")
    assert len(found.columns) == 16
    rows = found.collect()
    assert [r.line_number for r in rows] == [1, 1, 2, 2]
    assert [r.collect_log_id for r in rows[:2]] == sorted(r.collect_log_id for r in rows[:2])
    assert {r.log_value_text for r in rows} == {"1", "1e-20"}
    with pytest.raises(ValueError):
        find_logs(logs.drop("raw_log"), "20260612", "s", "수치")


def test_schedules_of_one_file_that_are_due_together(spark, tmp_path):
    """One run reads the file, the others end behind it; no record is collected twice."""
    landed, store = tmp_path / "landed", str(tmp_path / "store")
    due = schedules(
        spark,
        "[s][ip][/a.log][주기|1-5|080000|1|235959]",
        "[s][ip][/a.log][주기|*|090000|1|235959]",
        "[s][ip][/a.log+][주기|*|090000|1|235959]",
        "[s][ip][/b.log][배치|*|090000]",
        "[s][ip][/b.log][주기|*|080000|1|235959]",
        "[s][ip][/c.log][주기|*|080000|1|235959]",
        "[s][ip][/c.log][주기|*|080000|2|235959]",
    )
    for path in ("/a.log", "/b.log", "/c.log"):
        land(landed, "s", path, (number(1) + "plain\n" + number(2)).encode())

    def run(ts, **options):
        collect_landed(spark, store, str(landed), due, ts, **options)
        logs = read_logs(spark, store).collect()
        assert len(logs) == len({r.collect_log_id for r in logs})
        return sorted((r.source_file_path, r.line_number) for r in logs)

    day1, day2 = dt.datetime(2026, 6, 12, 9), dt.datetime(2026, 6, 13, 9)
    both = [(path, n) for path in ("/a.log", "/b.log", "/c.log") for n in (1, 3)]
    assert run(day1) == both
    runs = collect_history(spark, store).collect()
    assert len(runs) == 7 and {r.collect_status for r in runs} == {"SUCCESS"}
    assert {r.last_line_number for r in runs} == {3}
    for path in ("/a.log", "/b.log", "/c.log"):
        counts = sorted(r.collected_count for r in runs if r.source_file_path == path)
        assert counts[:-1] == [0] * (len(counts) - 1) and counts[-1] == 2
    assert {r.collected_count for r in runs if r.schedule_type == "배치"} == {2}

    # On another day the file without the plus sign is read from its start, once for all three.
    land(landed, "s", "/a.log", (number(1) + "plain\n" + number(2) + number(3)).encode())
    assert [n for path, n in run(day2) if path == "/a.log"] == [1, 1, 3, 3, 4]


def test_runs_behind_a_reader_over_its_limit(spark, tmp_path):
    landed, store = tmp_path / "landed", str(tmp_path / "store")
    due = schedules(
        spark, "[s][ip][/a.log][주기|*|080000|1|235959]", "[s][ip][/a.log][주기|*|080000|2|235959]"
    )
    land(landed, "s", "/a.log", (number(1) * 9).encode())
    collect_landed(spark, store, str(landed), due, dt.datetime(2026, 6, 12, 9), part_limit=100)
    assert read_logs(spark, store).count() == 0
    ended = {(r.collect_status, r.fail_reason) for r in collect_history(spark, store).collect()}
    assert ended == {("SKIP", "PART_SIZE_EXCEEDED"), ("SKIP", "EXCLUDED")}
    assert read_table(spark, store, "collect_exclude").count() == 1
