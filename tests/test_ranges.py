"""Byte ranges: the same lines for every split, charset and place of resumption."""

import datetime as dt
import io
import os
import random
import re
from urllib.parse import quote

import pytest
from landing import land

from logweir.operators.schedules import parse_schedules
from logweir.plans.collect import LandedReader, collect_history, collect_landed
from logweir.sources.ranges import block_lines
from logweir.sources.store import read_logs, read_table

RECORD = "@@@[2026/06/12 04:56:07.089][정보][A]|{}|@@@\n"
CHARSETS = ["UTF-8", "EUC-KR", "UTF-16", "UTF-16LE", "UTF-16BE", "UTF-32", "UTF-32LE", "UTF-32BE"]


def _lines(data: bytes, cuts: list[int], encoding: str, resume: int = 0, length=None):
    length = len(data) if length is None else length
    out = []
    for start, stop in zip([resume, *cuts], [*cuts, length]):
        for lines, _ in block_lines(io.BytesIO(data), start, stop, length, encoding):
            out += lines
    wide = encoding.startswith(("UTF-16", "UTF-32"))
    return [line.decode("utf-8" if wide else encoding) for line in out]


def _text(rng, n):
    ends = ["\n", "\r\n", "\r", "\n\n", "\r\r\n", "\n\r"]
    return "".join(
        rng.choice(["", "a", "가나", "ਊ਍", "longer text "]) + rng.choice(ends) for _ in range(n)
    )


def _split(text):
    lines = re.split("\r\n|\r|\n", text)
    return lines[:-1] if lines[-1] == "" else lines


@pytest.mark.parametrize("encoding", CHARSETS)
@pytest.mark.parametrize("last", ["", "open end", "\r"])
def test_every_split_gives_the_same_lines(encoding, last):
    rng = random.Random(5)
    text = _text(rng, 12) + last
    if encoding == "EUC-KR":
        text = re.sub("[^\x00-\x7f가나]", "x", text)
    data = text.encode(encoding)
    width = 4 if "32" in encoding else 2 if "16" in encoding else 1
    mark = len("".encode(encoding))
    want = _split(text)
    for cut in range(mark + width, len(data), width):
        assert _lines(data, [cut], encoding) == want, cut
    for _ in range(60):
        cuts = sorted({width * rng.randrange(1, len(data) // width) for _ in range(rng.randrange(1, 9))})
        assert _lines(data, cuts, encoding) == want, cuts


def test_byte_order_marks():
    assert _lines("a\nb".encode("utf-8-sig"), [], "UTF-8") == ["a", "b"]
    assert _lines(b"\xfe\xff" + "a\nb".encode("utf-16-be"), [6], "UTF-16") == ["a", "b"]
    assert _lines("a\nb".encode("utf-16-be"), [2], "UTF-16") == ["a", "b"]


@pytest.mark.parametrize("encoding", ["UTF-8", "UTF-16LE"])
def test_resumed_reads_go_on_where_they_were_left(encoding):
    """A file that grows byte by byte, read after each growth: lines that were whole come once."""
    text = "one\r\ntwo\rthree\n\nfive\r\n"
    data = text.encode(encoding)
    width = 2 if "16" in encoding else 1
    for middle in range(width, len(data), width):
        first = _lines(data, [], encoding, 0, middle)
        rest = _lines(data, [], encoding, middle)
        # A line that was cut counts as complete; the rest of it is lost.
        cut = _split(data[:middle].decode(encoding))
        assert first == cut
        assert rest == _split(text)[len(cut) :], middle


def _schedules(spark, *lines):
    return parse_schedules(spark.createDataFrame([(x,) for x in lines], "line string"))


def _append(root, server, path, data: bytes, segment="0001.log"):
    leaf = os.path.join(str(root), f"server_id={server}", "source_file_path=" + quote(path, safe=""))
    with open(os.path.join(leaf, segment), "ab") as f:
        f.write(data)


class _Jobs:
    def __init__(self, spark, tmp_path, *schedules, **options):
        self.spark, self.landed, self.store = spark, str(tmp_path / "landed"), str(tmp_path / "store")
        self.due, self.options = _schedules(spark, *schedules), options
        self.ts = dt.datetime(2026, 6, 12, 9)

    def run(self, **options):
        self.ts += dt.timedelta(minutes=1)
        collect_landed(
            self.spark, self.store, self.landed, self.due, self.ts, **(self.options | options)
        )
        rows = read_logs(self.spark, self.store).collect()
        assert len(rows) == len({r.collect_log_id for r in rows})
        return sorted((r.source_file_path, r.line_number, r.log_content) for r in rows)

    def changes(self):
        rows = read_table(self.spark, self.store, "segments").orderBy("modified", "run_id").collect()
        return [(r.source_file_path, r.change, r.length, r.lines) for r in rows]


def test_only_the_tail_of_a_grown_file_is_opened(spark, tmp_path):
    """1 GB of zeros stands before the appended lines, as a hole in the file."""
    landed = tmp_path / "landed"
    land(landed, "s 1", "/a b+c%.log", b"x\n")
    leaf = os.path.join(
        str(landed), "server_id=s 1", "source_file_path=" + quote("/a b+c%.log", safe="")
    )
    path = os.path.join(leaf, "0001.log")
    with open(path, "r+b") as f:
        f.truncate(1 << 30)
        f.seek((1 << 30) - 1)
        f.write(b"\n")
    facts = spark.createDataFrame(
        [("s 1", "/a b+c%.log", "READING", "주기", 3, "k")],
        "server_id string, source_file_path string, collect_status string, schedule_type string, "
        "start_line bigint, run_key string",
    )
    first = LandedReader(spark, str(landed))
    assert first._listed(facts).count() == 1
    from logweir import model as m
    from logweir.sources.ranges import with_edges

    known = spark.createDataFrame(
        [("s 1", "/a b+c%.log", "0001.log", 1 << 30, dt.datetime(2020, 1, 1), 2, "file:" + path)],
        "server_id string, source_file_path string, segment string, length bigint, "
        "modified timestamp, lines bigint, path string",
    )
    known = spark.createDataFrame(
        [{**r.asDict(), "change": "NEW", "collect_date": "d", "run_id": "r"}
         for r in with_edges(known, "length").drop("path").collect()],
        m.SEGMENTS,
    )
    with open(path, "ab") as f:
        f.write(("tail 1\ntail 2\n" + RECORD.format("p")).encode())
    reader = LandedReader(spark, str(landed), known)
    rows = sorted((r.line_number, r.line, r.line_bytes) for r in reader(facts).collect())
    assert [r[0] for r in rows] == [3, 4, 5] and rows[0][2] == 6 and "p" in rows[2][1]
    (block,) = reader.opened.collect()
    assert block.start == 1 << 30 and block.stop - block.start < 100
    (row,) = reader.counted.collect()
    assert (row.lines, row.change, row.length) == (5, "APPENDED", block.stop)


def test_appended_rewritten_and_rotated_files_are_told_apart(spark, tmp_path):
    jobs = _Jobs(spark, tmp_path, *(f"[s][ip][/{n}.log][주기|*|080000|1|235959]" for n in "abc"))
    records = [RECORD.format(x) for x in "pqrstu"]
    for n in "abc":
        land(jobs.landed, "s", f"/{n}.log", "".join(records[:2]).encode())
    assert len(jobs.run()) == 6
    _append(jobs.landed, "s", "/a.log", (records[2] + "plain\n").encode())
    land(jobs.landed, "s", "/b.log", "".join(records[3:6] + records[:1]).encode())  # other bytes
    land(jobs.landed, "s", "/c.log", records[5].encode())  # rotated: shorter than before
    rows = jobs.run()
    assert [r for r in rows if r[0] == "/a.log"] == [("/a.log", i + 1, x) for i, x in enumerate("pqr")]
    # Lines are known by their number alone: the third and fourth of /b.log are new.
    assert [r[1:] for r in rows if r[0] == "/b.log"] == [(1, "p"), (2, "q"), (3, "u"), (4, "p")]
    assert [r[1:] for r in rows if r[0] == "/c.log"] == [(1, "p"), (2, "q")]
    changes = {(p, c) for p, c, *_ in jobs.changes()}
    assert changes == {
        ("/a.log", "NEW"), ("/b.log", "NEW"), ("/c.log", "NEW"),
        ("/a.log", "APPENDED"), ("/b.log", "REWRITTEN"), ("/c.log", "SHRUNK"),
    }
    before = len(jobs.changes())
    jobs.run()  # nothing new: nothing is opened but the file that was cut, which is behind
    assert {c[:2] for c in jobs.changes()[before:]} <= {("/c.log", "REREAD")}


def test_unterminated_lines_wait_if_asked_to(spark, tmp_path):
    jobs = _Jobs(spark, tmp_path, "[s][ip][/a.log][주기|*|080000|1|235959]", drop_unterminated=True)
    one, two = RECORD.format("one"), RECORD.format("two")
    land(jobs.landed, "s", "/a.log", (one + two[:20]).encode())
    assert jobs.run() == [("/a.log", 1, "one")]
    assert jobs.run() == [("/a.log", 1, "one")]
    _append(jobs.landed, "s", "/a.log", two[20:].encode())
    assert jobs.run() == [("/a.log", 1, "one"), ("/a.log", 2, "two")]
    runs = sorted(collect_history(spark, jobs.store).collect(), key=lambda r: r.collect_start_at)
    assert [r.last_line_number for r in runs] == [1, 1, 2]
    assert {r.fail_reason for r in runs} == {""}


def test_unterminated_lines_count_as_complete_by_default(spark, tmp_path):
    jobs = _Jobs(spark, tmp_path, "[s][ip][/a.log][주기|*|080000|1|235959]")
    one, two, three = (RECORD.format(x) for x in ("one", "two", "three"))
    land(jobs.landed, "s", "/a.log", (one + two[:20]).encode())
    assert jobs.run() == [("/a.log", 1, "one")]
    _append(jobs.landed, "s", "/a.log", (two[20:] + three).encode())
    assert jobs.run() == [("/a.log", 1, "one"), ("/a.log", 3, "three")]


def test_a_tail_over_the_limit_is_not_opened_beyond_it(spark, tmp_path):
    landed = tmp_path / "landed"
    facts = spark.createDataFrame(
        [("s", path, "READING", kind, 1, path) for path, kind in
         (("/big.log", "주기"), ("/empty lines.log", "주기"), ("/batch.log", "배치"))],
        "server_id string, source_file_path string, collect_status string, schedule_type string, "
        "start_line bigint, run_key string",
    )
    big = b"0123456789\n" * 10_000
    land(landed, "s", "/big.log", big)
    land(landed, "s", "/batch.log", big)
    land(landed, "s", "/empty lines.log", b"\n" * 110_000 + b"last\n")
    reader = LandedReader(spark, str(landed), part_limit=5000, block_bytes=1000)
    rows = reader(facts)
    sums = {
        r.source_file_path: (r[1], r[2])
        for r in rows.groupBy("source_file_path").agg({"line_bytes": "sum", "*": "count"})
        .select("source_file_path", "sum(line_bytes)", "count(1)").collect()
    }
    assert 5000 <= sums["/big.log"][0] < 7000
    assert sums["/empty lines.log"] == (4, 110_001)
    assert sums["/batch.log"] == (100_000, 10_000)
    opened = {
        r.source_file_path: r["sum(bytes)"]
        for r in reader.opened.selectExpr("source_file_path", "stop - start AS bytes")
        .groupBy("source_file_path").sum("bytes").collect()
    }
    assert opened["/big.log"] <= 7250 and opened["/batch.log"] == len(big)
    assert {r.source_file_path for r in reader.counted.collect()} == {"/empty lines.log", "/batch.log"}


@pytest.mark.parametrize("encoding", ["UTF-16", "UTF-32LE", "EUC-KR"])
def test_jobs_in_other_charsets(spark, tmp_path, encoding):
    jobs = _Jobs(spark, tmp_path, "[s][ip][/a.log][주기|*|080000|1|235959]", encoding=encoding)
    land(jobs.landed, "s", "/a.log", (RECORD.format("가나") + "plain\r\n").encode(encoding))
    assert jobs.run() == [("/a.log", 1, "가나")]
    more = RECORD.format("다").encode("utf-16-le" if encoding == "UTF-16" else encoding)
    _append(jobs.landed, "s", "/a.log", more)
    assert jobs.run() == [("/a.log", 1, "가나"), ("/a.log", 3, "다")]
