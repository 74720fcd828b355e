import datetime as dt

from landing import land

from logweir.operators.schedules import due_between, parse_schedules
from logweir.plans.collect import collect_history
from logweir.plans.poll import collect_polled, gaps, open_poll
from logweir.sources.store import read_logs

RECORD = "@@@[2026/06/12 04:56:07.089][정보][A]|{}|@@@\n"
LINES = [
    "[s][ip][/b.log][배치|*|000030]", "[s][ip][/c.log][배치|5|235959]",
    "[s][ip][/d.log][주기|*|235800|1|235959]", "[s][ip][/e.log][주기|*|000001|1|000130]",
    "[s][ip][/f.log][주기|6|000002|7|235959]", "[s][ip][/g.log][주기|*|100000|1|090000]",
    "[s][ip][/h.log][주기|*|000010|2000|235959]",
]


def _schedules(spark, lines):
    return parse_schedules(spark.createDataFrame([(x,) for x in lines], "line string"))


def _expanded(rows, after, until):
    """Every second of the stretch against every schedule, last firing of each date."""
    found, moment = {}, after.replace(microsecond=0)
    while moment <= until:
        second = moment.hour * 3600 + moment.minute * 60 + moment.second
        if moment > after:
            for r in rows:
                if not r.day_from <= (moment.weekday() + 1) % 7 <= r.day_to:
                    continue
                passed = second - r.start_sec
                if r.schedule_type == "배치":
                    fires, index = passed == 0, 0
                else:
                    step = r.interval_min * 60
                    fires = passed >= 0 and second <= r.end_sec and passed % step == 0
                    index = passed // step
                if fires:
                    key = (r.source_file_path, moment.date())
                    n = found.get(key, (0, 0, 0))[2]
                    found[key] = (index, moment, n + 1)
        moment += dt.timedelta(seconds=1)
    return sorted((*key, *value) for key, value in found.items())


def test_due_between_against_every_second(spark):
    schedules = _schedules(spark, LINES)
    rows = schedules.collect()
    friday = dt.datetime(2026, 6, 12, 23, 57)
    stretches = [
        (friday, friday + dt.timedelta(minutes=7)),
        (friday, friday), (friday, friday + dt.timedelta(seconds=90)),
        (friday.replace(second=59), friday + dt.timedelta(seconds=60)),
        (friday + dt.timedelta(seconds=59.5), friday + dt.timedelta(seconds=60.2)),
        (friday, friday + dt.timedelta(days=2, seconds=5)),
    ]
    for after, until in stretches:
        got = due_between(schedules, after, until).collect()
        got = sorted((r.source_file_path, r.run_date, r.run_index, r.run_at, r.firings) for r in got)
        assert got == _expanded(rows, after, until), (after, until)


def test_a_late_poll_loses_no_run(spark, tmp_path):
    landed, store = str(tmp_path / "landed"), str(tmp_path / "store")
    schedules = _schedules(
        spark, ["[s][ip][/a.yyyymmdd][배치|*|235958]", "[s][ip][/p.log][주기|*|000001|1|235959]"]
    )
    start = dt.datetime(2026, 6, 12, 23, 59, 50)
    land(landed, "s", "/a.20260612", RECORD.format("yesterday").encode())
    land(landed, "s", "/a.20260613", RECORD.format("today").encode())
    land(landed, "s", "/p.log", RECORD.format("p").encode())

    def poll(at, run_id=None):
        collect_polled(spark, store, landed, schedules, at, run_id)
        rows = read_logs(spark, store).collect()
        return sorted((r.source_file_path, r.line_number, r.log_content) for r in rows)

    assert poll(start) == []
    # 90 seconds late and past midnight: the batch run of yesterday reads yesterday's file.
    late = start + dt.timedelta(seconds=90)
    want = [("/a.20260612", 1, "yesterday"), ("/p.log", 1, "p")]
    assert poll(late) == want
    # The same job again stands for the same stretch, and an early poll takes nothing twice.
    assert open_poll(spark, store, late + dt.timedelta(hours=1), f"{late:%Y%m%dT%H%M%S}") == (
        start, late,
    )
    assert poll(late + dt.timedelta(seconds=1)) == want
    runs = collect_history(spark, store).collect()
    assert sorted(r.source_file_path for r in runs) == ["/a.20260612", "/p.log"]
    assert {r.collect_status for r in runs} == {"SUCCESS"}
    # What no poll stood for is found by the calendar.
    missed = gaps(spark, store, schedules, dt.date(2026, 6, 12), dt.date(2026, 6, 13)).collect()
    batch = [(r.run_date.day) for r in missed if r.schedule_type == "배치"]
    assert batch == [13]
    periodic = {(r.run_date.day, r.run_index) for r in missed if r.schedule_type == "주기"}
    assert (13, 0) not in periodic and (13, 1) not in periodic and (13, 2) in periodic
    assert (12, 0) in periodic
