import datetime as dt

import pytest

from logweir.operators.schedules import due_runs, parse_schedules, run_calendar
from logweir.sources.schedule_files import read_schedules

VALID = [
    "[s][1.2.3.4][/a.log][배치|1-5|080000]",
    "[s][1.2.3.4][/a.log][주기|*|080000|1|235959]",
    " \t[ s ][1.2.3.4] text [/a b.log][ 주기 | 0 | 000001 | 15 | 000000 ] # x",
    "[a[b][1.2.3.4][/a.log][배치|6|235959]",
    "[s][1.2.3.4][/a.log][배치|3-3|120000]",
]
INVALID = [
    "# [s][1.2.3.4][/a.log][배치|1-5|080000]", "", "   ",
    "[s][1.2.3.4][/a.log]", "[s][1.2.3.4][/a.log][배치|1-5|080000][x]",
    "[s][ ][/a.log][배치|1-5|080000]", "[s][1.2.3.4][/a.log][]",
    "[s][1.2.3.4][/a.log][배치|1-7|080000]", "[s][1.2.3.4][/a.log][배치|5-1|080000]",
    "[s][1.2.3.4][/a.log][배치|1,2|080000]", "[s][1.2.3.4][/a.log][배치|7|080000]",
    "[s][1.2.3.4][/a.log][배치|1 - 2|080000]", "[s][1.2.3.4][/a.log][배치||080000]",
    "[s][1.2.3.4][/a.log][배치|*|000000]", "[s][1.2.3.4][/a.log][배치|*|240000]",
    "[s][1.2.3.4][/a.log][배치|*|086000]", "[s][1.2.3.4][/a.log][배치|*|80000]",
    "[s][1.2.3.4][/a.log][주기|*|080000|0|235959]", "[s][1.2.3.4][/a.log][주기|*|080000|-1|235959]",
    "[s][1.2.3.4][/a.log][주기|*|080000|x|235959]", "[s][1.2.3.4][/a.log][주기|*|080000|1|236000]",
    "[s][1.2.3.4][/a.log][주기|*|080000]", "[s][1.2.3.4][/a.log][배치|*|080000|1|235959]",
    "[s][1.2.3.4][/a.log][매일|*|080000]", "[s][1.2.3.4][/a.log][주기|*|080000|99999999999|235959]",
]


def lines(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "n int, line string")


def test_parse(spark):
    got = {r.n: r for r in parse_schedules(lines(spark, VALID + INVALID)).collect()}
    assert sorted(got) == list(range(len(VALID)))
    r = got[2]
    assert (r.server_id, r.source_file_path, r.schedule_type) == ("s", "/a b.log", "주기")
    assert (r.day_from, r.day_to, r.start_sec, r.interval_min, r.end_sec) == (0, 0, 1, 15, 0)
    assert got[3].server_id == "a[b"
    assert (got[0].day_from, got[0].day_to, got[0].interval_min) == (1, 5, None)


def test_schedule_file(spark, tmp_path):
    path = tmp_path / "schedule.conf"
    path.write_text("\n".join(["# head", *VALID, *INVALID]), encoding="utf-8")
    assert read_schedules(spark, str(path)).count() == len(VALID)


def _due(spark, line, *times):
    rules = parse_schedules(lines(spark, [line]))
    return [
        due_runs(rules, dt.datetime.combine(dt.date(2026, 6, 12), dt.time(*t))).count() == 1
        for t in times
    ]


def test_due_window(spark):
    assert _due(
        spark, "[s][i][/a][배치|*|080000]", (7, 59, 59), (8, 0, 0), (8, 0, 1), (8, 0, 2)
    ) == [False, True, True, False]
    assert _due(
        spark, "[s][i][/a][주기|*|080000|10|090000]",
        (8, 10, 0), (8, 10, 1), (8, 10, 2), (9, 0, 0), (9, 0, 1), (7, 50, 0),
    ) == [True, True, False, True, False, False]


def test_taken_runs_are_not_due_again(spark):
    rules = parse_schedules(lines(spark, ["[s][i][/a][주기|*|080000|10|090000]"]))
    now = dt.datetime(2026, 6, 12, 8, 10, 0)
    first = due_runs(rules, now)
    taken = first.select("schedule_key", "run_date", "run_index")
    assert first.first().run_index == 1
    assert due_runs(rules, now + dt.timedelta(seconds=1), taken).count() == 0
    assert due_runs(rules, now + dt.timedelta(minutes=10), taken).count() == 1
    assert due_runs(rules, now + dt.timedelta(days=1), taken).count() == 1


@pytest.mark.parametrize(
    "line",
    [
        "[s][i][/a][배치|1-5|235959]", "[s][i][/a][주기|0|075959|7|081500]",
        "[s][i][/a][주기|5-6|230000|1|235959]", "[s][i][/a][주기|*|080000|10|090000]",
        "[s][i][/a][주기|*|080000|2000|235959]", "[s][i][/a][주기|*|080000|10|000000]",
        "[s][i][/a][주기|*|080000|40000000|235959]",
    ],
)
def test_calendar_against_every_second(spark, line):
    """A run fires in the first second of each two-second window that the due test opens."""
    rules = parse_schedules(lines(spark, [line]))
    rule = rules.first()
    first, last = dt.date(2026, 6, 11), dt.date(2026, 6, 14)
    expected = set()
    for day in range((last - first).days + 1):
        date = first + dt.timedelta(days=day)
        if not rule.day_from <= date.isoweekday() % 7 <= rule.day_to:
            continue
        seen = set()
        for second in range(86400):
            passed = second - rule.start_sec
            if rule.schedule_type == "배치":
                index, due = 0, 0 <= passed < 2
            else:
                step = rule.interval_min * 60
                index, due = passed // step, 0 <= passed and second <= rule.end_sec and passed % step < 2
            if due and index not in seen:
                seen.add(index)
                at = dt.datetime.combine(date, dt.time()) + dt.timedelta(seconds=second)
                expected.add((index, at))
    got = run_calendar(rules, first, last).collect()
    assert len(got) == len(expected)
    assert {(r.run_index, r.run_at) for r in got} == expected
