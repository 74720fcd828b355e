import random

import pytest
from landing import land, split_lines

from logweir.operators.numbering import block_offsets, number_lines, numbered
from logweir.operators.runs import slim_lines
from logweir.sources.lines import (
    BLOCK_COLUMNS,
    FILE_COLUMNS,
    file_sizes,
    scan_files,
    scan_landed,
)
from logweir.sources.staging import stage, stage_numbered


def _random_file(seed: int, n: int) -> bytes:
    rng = random.Random(seed)
    out = []
    for i in range(n):
        out.append(("가" * rng.randint(0, 9) + f" line {i}").encode())
        out.append(rng.choice([b"\n", b"\r\n", b"\n", b"\r"]) if i < n - 1 else b"")
    return b"".join(out)


@pytest.mark.parametrize("split", ["1k", "128m"])
def test_numbers_do_not_depend_on_the_split(spark, tmp_path, split):
    files = {("s1", "/a b+c%.log"): _random_file(1, 5000), ("007", "/x.log"): _random_file(2, 40)}
    files["007", "/big.log"] = _random_file(3, 20000)
    for (server, path), data in files.items():
        land(tmp_path, server, path, data)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        scanned = stage(scan_landed(spark, str(tmp_path)), "test")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    if split == "1k":
        assert scanned.select(*FILE_COLUMNS, *BLOCK_COLUMNS).distinct().count() > 50
    rows = numbered(scanned, FILE_COLUMNS, BLOCK_COLUMNS).collect()
    got = {}
    for r in rows:
        got.setdefault((r.server_id, r.source_file_path), {})[r.line_number] = r.line
    for key, data in files.items():
        assert got[key] == dict(enumerate(split_lines(data), 1)), key


def test_segments_follow_each_other(spark, tmp_path):
    land(tmp_path, "s", "/a.log", b"one\ntwo\n", "0001.log")
    land(tmp_path, "s", "/a.log", b"three\nfour", "0002.log")
    rows = numbered(stage(scan_landed(spark, str(tmp_path)), "t"), FILE_COLUMNS, BLOCK_COLUMNS)
    assert {(r.line_number, r.line) for r in rows.collect()} == {
        (1, "one"), (2, "two"), (3, "three"), (4, "four"),
    }


def test_bad_bytes_and_named_files(spark, tmp_path):
    path = tmp_path / "a +b%20.log"
    path.write_bytes(b"ok\n\xff\xfe x\n\nlast")
    rows = numbered(scan_files(spark, str(path)), ["source_file_path"], BLOCK_COLUMNS).collect()
    assert {r.line_number: r.line for r in rows} == {1: "ok", 2: "�� x", 3: "", 4: "last"}
    assert rows[0].source_file_path.endswith("/a +b%20.log")
    latin = scan_files(spark, str(path), "ISO-8859-1").collect()
    assert "ÿþ x" in {r.line for r in latin}


def test_file_sizes(spark, tmp_path):
    land(tmp_path, "007", "/a.log", b"one\ntwo\n", "0001.log")
    land(tmp_path, "007", "/a.log", b"three", "0002.log")
    land(tmp_path, "8", "/b.log", "가\n".encode())
    got = {tuple(r) for r in file_sizes(spark, str(tmp_path)).collect()}
    assert got == {("007", "/a.log", 13), ("8", "/b.log", 4)}


def test_only_block_counts_are_shuffled(spark, tmp_path):
    land(tmp_path, "s", "/a.log", b"one\ntwo\n")
    lines = stage(slim_lines(scan_landed(spark, str(tmp_path))), "t")
    offsets = stage(block_offsets(lines, FILE_COLUMNS, BLOCK_COLUMNS), "o")
    plan = number_lines(lines, offsets, FILE_COLUMNS, BLOCK_COLUMNS)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_sequence_is_dense_and_stable(spark):
    df = stage_numbered(spark.range(0, 5000, 1, 7).selectExpr("id as x"), "t", "n", after=100)
    rows = df.collect()
    assert sorted(r.n for r in rows) == list(range(101, 5101))
    assert {r.x: r.n for r in rows} == {r.x: r.n for r in df.repartition(3).collect()}
