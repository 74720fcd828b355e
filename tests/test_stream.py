import datetime as dt
import os

from landing import land

from logweir.operators.schedules import parse_schedules
from logweir.plans.collect import collect_history
from logweir.sources.store import read_logs, read_table, write_table
from logweir.streaming.collect_stream import collect_stream

RECORD = "@@@[2026/06/12 04:56:07.089][정보][A]|{}|@@@\n"


def test_segments_continue_where_the_file_was_left(spark, tmp_path):
    landed, store, checkpoint = (str(tmp_path / n) for n in ("landed", "store", "checkpoint"))
    schedules = parse_schedules(
        spark.createDataFrame(
            [("[s][ip][/a.log][주기|*|080000|1|235959]",),
             ("[s][ip][/b.log+][주기|*|080000|1|235959]",),
             ("[s][ip][/batch.log][배치|*|080000]",)],
            "line string",
        )
    )
    times = iter(dt.datetime(2026, 6, 12, 22) + dt.timedelta(hours=h) for h in range(100))

    def run():
        query = collect_stream(
            spark, landed, store, schedules, checkpoint, clock=lambda: next(times)
        )
        query.awaitTermination()

    def lines(path):
        rows = read_logs(spark, store).where(f"source_file_path = '{path}'").collect()
        return sorted((r.line_number, r.log_content) for r in rows)

    a = [RECORD.format(x) for x in "pqrst"]
    land(landed, "s", "/a.log", (a[0] + "plain\n" + a[1]).encode(), "0001.log")
    land(landed, "s", "/b.log", a[0].encode(), "0001.log")
    land(landed, "s", "/batch.log", a[0].encode(), "0001.log")
    land(landed, "s", "/other.log", a[0].encode(), "0001.log")
    run()
    assert lines("/a.log") == [(1, "p"), (3, "q")]
    assert lines("/batch.log") == lines("/other.log") == []
    unnamed = [r for r in collect_history(spark, store).collect() if r.collect_status == "FAIL"]
    assert {(r.source_file_path, r.fail_reason) for r in unnamed} == {
        ("/batch.log", "NO_SCHEDULE"), ("/other.log", "NO_SCHEDULE"),
    }

    # Two more segments in one batch, on the next day.
    land(landed, "s", "/a.log", a[2].encode(), "0002.log")
    land(landed, "s", "/a.log", (a[3] + a[4]).encode(), "0003.log")
    run()
    assert lines("/a.log") == [(1, "p"), (3, "q"), (4, "r"), (5, "s"), (6, "t")]
    assert lines("/b.log") == [(1, "p")]
    run()
    assert len(lines("/a.log")) == 5
    # A batch whose end was not noted is replayed under its old id, and changes nothing.
    before = sorted(map(str, read_logs(spark, store).collect()))
    last = max(int(f) for f in os.listdir(f"{checkpoint}/commits") if f.isdigit())
    for name in (str(last), f".{last}.crc"):
        if os.path.exists(f"{checkpoint}/commits/{name}"):
            os.remove(f"{checkpoint}/commits/{name}")
    run()
    assert sorted(map(str, read_logs(spark, store).collect())) == before
    states = {r.collect_status for r in collect_history(spark, store).collect() if r.server_ip}
    assert states == {"SUCCESS"}
    ids = [r.collect_log_id for r in read_logs(spark, store).collect()]
    assert len(ids) == len(set(ids)) == 6


def _periodic(spark, *paths):
    lines = [(f"[s][ip][{p}][주기|*|080000|1|235959]",) for p in paths]
    return parse_schedules(spark.createDataFrame(lines, "line string"))


def _staged_folders(spark):
    root = f"{spark.conf.get('spark.checkpoint.dir')}/logweir"
    return sorted(os.listdir(root)) if os.path.isdir(root) else []


def test_limited_and_excluded_files_are_read_after_their_restore(spark, tmp_path):
    landed, store = str(tmp_path / "landed"), str(tmp_path / "store")
    schedules = _periodic(spark, "/a.log")
    times = iter(dt.datetime(2026, 6, 12, 9) + dt.timedelta(hours=h) for h in range(100))
    staged = _staged_folders(spark)

    def run(part_limit=None):
        options = {} if part_limit is None else {"part_limit": part_limit}
        collect_stream(
            spark, landed, store, schedules, str(tmp_path / "checkpoint"),
            clock=lambda: next(times), options=options,
        ).awaitTermination()
        return sorted((r.line_number, r.log_content) for r in read_logs(spark, store).collect())

    records = [RECORD.format(x) for x in "pqrstu"]
    land(landed, "s", "/a.log", (records[0] + records[1]).encode(), "0001.log")
    assert run() == [(1, "p"), (2, "q")]
    land(landed, "s", "/a.log", (records[2] + records[3]).encode(), "0002.log")
    assert run(part_limit=10) == [(1, "p"), (2, "q")]  # over the limit: skipped and excluded
    land(landed, "s", "/a.log", records[4].encode(), "0003.log")
    assert run() == [(1, "p"), (2, "q")]  # excluded
    excluded = read_table(spark, store, "collect_exclude")
    restored = spark.createDataFrame(
        [{**r.asDict(), "restore_yn": "Y"} for r in excluded.collect()], excluded.schema
    )
    write_table(restored, store, "collect_exclude")
    # A segment of another file is enough for the restored one to be read.
    land(landed, "s", "/other.log", records[5].encode(), "0001.log")
    assert run() == [(1, "p"), (2, "q"), (3, "r"), (4, "s"), (5, "t")]
    assert _staged_folders(spark) == staged


def test_late_segments_and_new_checkpoints(spark, tmp_path):
    landed, store = str(tmp_path / "landed"), str(tmp_path / "store")
    schedules = _periodic(spark, "/d1/yyyymmdd/x12yyyymmdd.log", "/d1/yyyymmdd/x12yyyymmdd.log")
    times = iter(dt.datetime(2026, 6, 13, 0, 5) + dt.timedelta(minutes=h) for h in range(100))

    def run(checkpoint):
        collect_stream(
            spark, landed, store, schedules, str(tmp_path / checkpoint), clock=lambda: next(times)
        ).awaitTermination()
        return sorted(
            (r.source_file_path, r.line_number, r.log_content)
            for r in read_logs(spark, store).collect()
        )

    late, today = "/d1/20260612/x1220260612.log", "/d1/20260613/x1220260613.log"
    mixed = "/d1/20260612/x1220260613.log"  # no single date gives this path
    for path in (late, today, mixed):
        land(landed, "s", path, RECORD.format("p").encode(), "0001.log")
    assert run("one") == [(late, 1, "p"), (today, 1, "p")]
    land(landed, "s", late, RECORD.format("q").encode(), "0002.log")
    assert run("two") == [(late, 1, "p"), (late, 2, "q"), (today, 1, "p")]
    land(landed, "s", today, RECORD.format("r").encode(), "0002.log")
    assert len(run("three")) == 4
    ids = [r.collect_log_id for r in read_logs(spark, store).collect()]
    assert len(ids) == len(set(ids)) == 4


def test_a_batch_has_one_run_per_file(spark, tmp_path):
    """Of the schedules that name a file, that whose day and hours hold stands for it."""
    landed, store = str(tmp_path / "landed"), str(tmp_path / "store")
    lines = [
        "[s][ip][/a.log][주기|1-5|080000|1|235959]", "[s][ip][/a.log][주기|6|080000|1|235959]",
        "[s][ip][/a.yyyymmdd][주기|0|080000|1|120000]", "[s][ip][/a.yyyymmdd][주기|0|120001|1|235959]",
    ]
    schedules = parse_schedules(spark.createDataFrame([(x,) for x in lines], "line string"))

    def run(day):
        now = dt.datetime(2026, 6, day, 9)
        collect_stream(
            spark, landed, store, schedules, str(tmp_path / "checkpoint"), clock=lambda: now
        ).awaitTermination()

    land(landed, "s", "/a.log", (RECORD.format("p") * 3).encode(), "0001.log")
    land(landed, "s", "/a.20260614", RECORD.format("q").encode(), "0001.log")
    run(12)  # a Friday
    land(landed, "s", "/a.log", RECORD.format("r").encode(), "0002.log")
    run(13)
    rows = read_logs(spark, store).collect()
    assert len(rows) == len({r.collect_log_id for r in rows}) == 5
    runs = collect_history(spark, store).collect()
    used = sorted((r.source_file_path, r.collect_start_at.day, r.run_key.split("::")[3]) for r in runs)
    assert used == [
        ("/a.20260614", 12, "주기|0|080000|1|120000"),
        ("/a.log", 12, "주기|1-5|080000|1|235959"), ("/a.log", 13, "주기|6|080000|1|235959"),
    ]
