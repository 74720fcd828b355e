import datetime as dt
import os

from landing import land

from logweir.operators.schedules import parse_schedules
from logweir.sources.store import read_logs
from logweir.streaming.collect_stream import collect_stream
from logweir.streaming.growth import GrowthReader

RECORD = "@@@[2026/06/12 04:56:07.089][정보][A]|{}|@@@\n"


def _names(reader, start, end):
    parts = reader.partitions(start, end)
    return [name for part in parts for name in reader.read(part)]


def test_offsets_are_numbered_listings(tmp_path):
    landed, state = str(tmp_path / "landed"), str(tmp_path / "state")

    def reader():  # a restart has no memory but its state folder
        return GrowthReader(f"file:{landed}", state)

    first = reader().initialOffset()
    assert reader().latestOffset() == first  # nothing has landed
    land(landed, "s", "/a b+%.log", b"x\n")
    land(landed, "s", "/b.log", b"x\n")
    one = reader().latestOffset()
    assert _names(reader(), first, one) == [("s", "/a b+%.log"), ("s", "/b.log")]
    assert reader().latestOffset() == one
    land(landed, "s", "/b.log", b"x\ny\n")
    land(landed, "s", "/c.log", b"")  # no bytes yet
    open(f"{landed}/server_id=s/_hidden", "w").write("x")
    two = reader().latestOffset()
    land(landed, "s", "/b.log", b"z\n", "0002.log")
    three = reader().latestOffset()
    assert _names(reader(), one, two) == _names(reader(), one, three) == [("s", "/b.log")]
    assert _names(reader(), three, three) == []
    reader().commit(two)
    assert sorted(os.listdir(state)) == ["2.parquet", "3.parquet"]
    assert _names(reader(), two, three) == [("s", "/b.log")]


def test_appended_lines_are_collected_once(spark, tmp_path):
    landed, store, checkpoint = (str(tmp_path / n) for n in ("landed", "store", "checkpoint"))
    line = "[s][ip][/a.log][주기|*|080000|1|235959]"
    schedules = parse_schedules(spark.createDataFrame([(line,)], "line string"))
    times = iter(dt.datetime(2026, 6, 12, 9) + dt.timedelta(minutes=i) for i in range(99))

    def run():
        collect_stream(
            spark, landed, store, schedules, checkpoint, clock=lambda: next(times), growing=True
        ).awaitTermination()
        rows = read_logs(spark, store).collect()
        assert len(rows) == len({r.collect_log_id for r in rows})
        return sorted((r.line_number, r.log_content) for r in rows)

    land(landed, "s", "/a.log", RECORD.format("p").encode())
    assert run() == [(1, "p")]
    land(landed, "s", "/a.log", "".join(RECORD.format(x) for x in "pqr").encode())
    assert run() == [(1, "p"), (2, "q"), (3, "r")]
    # A batch whose end was not noted is replayed and changes nothing.
    last = max(int(f) for f in os.listdir(f"{checkpoint}/commits") if f.isdigit())
    for name in (str(last), f".{last}.crc"):
        if os.path.exists(f"{checkpoint}/commits/{name}"):
            os.remove(f"{checkpoint}/commits/{name}")
    assert run() == [(1, "p"), (2, "q"), (3, "r")]
