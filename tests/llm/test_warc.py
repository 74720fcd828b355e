import gzip
import hashlib
import os

import pytest
from pyspark.errors import PythonException

from logweir.llm import warc
from logweir.llm.warc import archived, folder_uri, parse, read_archive, records, write_archive

PAGES = "page_id bigint, url string, html string, record_type string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], PAGES)


def some(count=60):
    big = "<p>é" + "x" * 1200
    rows = [(i, f"http://e.org/{i}", f"<html>{i}" + "y" * (40 * i)) for i in range(count)]
    rows += [(100, None, big), (103, "", big), (101, "http://a b\r\nc/\x7f", big)]
    rows += [(110, "u", "short"), (111, "u", "short"), (112, "u", None), (113, "u", "")]
    rows += [(120, "u", "z" * 1000), (120, "u", "z" * 1000), (121, "v", "w" * 999)]
    rows += [(122, "v", "w" * 999), (None, "n", "q" * 1500), (None, "n", "q" * 1500)]
    rows += [(None, "n", big)]
    return rows


def by_definition(rows):
    payloads = [(r[0], (r[2] or "").encode()) for r in rows]
    result = []
    for i, p in payloads:
        ids = [j for j, q in payloads if q == p and j is not None]
        keeper = max(ids) if ids and len(p) >= 1000 else None
        revisit = keeper is not None and i != keeper
        result.append(
            (i, len(p), hashlib.sha1(p).hexdigest(), "revisit" if revisit else "response",
             keeper if revisit else None)
        )
    return sorted(result, key=repr)


@pytest.mark.parametrize("roll_bytes", [1, 3000, 1 << 20])
def test_round_trip(spark, roll_bytes):
    rows = some()
    found = archived(spark, pages(spark, rows), roll_bytes).collect()
    assert sorted(map(tuple, found), key=repr) == by_definition(rows)


def test_files_roll_sort_and_repeat_byte_by_byte(spark, tmp_path):
    rows = some(300)
    made = []
    for name in ("a", "b"):
        folder = f"file://{tmp_path}/{name}"
        manifest = write_archive(records(pages(spark, rows)), folder, roll_bytes=20_000)
        files = sorted(manifest.collect(), key=lambda r: r.final)
        made.append([(r.final, r.records, r.bytes, r.sha256) for r in files])
        assert os.listdir(f"{tmp_path}/{name}/tmp") == []
        assert sum(r.records for r in files) == len(rows)
        for r in files:
            data = open(f"{tmp_path}/{name}/{r.final}", "rb").read()
            assert hashlib.sha256(data).hexdigest() == r.sha256
            assert gzip.decompress(data).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
        ids = [(r.first_id, r.last_id) for r in files if r.first_id is not None]
        assert ids == sorted(ids)
        kept = read_archive(manifest, folder).collect()
        for r in kept:
            if r.record_type == "response":
                assert hashlib.sha1(r.payload).hexdigest() == r.payload_digest
                assert len(r.payload) == r.payload_bytes
        found = [
            (r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in kept
        ]
        assert sorted(found, key=repr) == by_definition(rows)
    assert made[0] == made[1]
    assert len(made[0]) > 3


def test_bytes_do_not_depend_on_partitions(spark, tmp_path, monkeypatch):
    """10,000 pages, written with 4 and with 8 partitions and from other input partitions."""
    monkeypatch.setattr(warc, "_LEAST", 100_000)
    rows = [(i * 7 % 10_000, f"u{i % 3}", f"{i % 4000} " * (1 + i % 50)) for i in range(10_000)]
    rows += [(None, None, "n" * 2000), (None, "x", "n"), (5, None, "a"), (5, None, "a")]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    made = []
    try:
        for partitions, parts in ((4, 3), (8, 11), (8, 11)):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            folder = f"file://{tmp_path}/{len(made)}"
            table = records(pages(spark, rows).repartition(parts))
            manifest = write_archive(table, folder, roll_bytes=30_000)
            made.append(sorted((r.final, r.records, r.bytes, r.sha256) for r in manifest.collect()))
            read = read_archive(manifest, folder, payloads=False)
            assert read.rdd.getNumPartitions() == len(made[-1])
            assert read.count() == len(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert made[0] == made[1] == made[2]
    assert len({final.split("-")[1] for final, *_ in made[0]}) > 20
    assert sum(r[1] for r in made[0]) == len(rows)


def test_folders_keep_the_scheme_of_their_file_system(spark):
    assert folder_uri(spark, "/a/b") == "file:///a/b"
    assert folder_uri(spark, "file:/a/b") == "file:///a/b"
    assert folder_uri(spark, "file:///a/b") == "file:///a/b"
    conf = spark._jsc.hadoopConfiguration()
    before = conf.get("fs.defaultFS")
    try:
        conf.set("fs.defaultFS", "viewfs://cluster/")
        conf.set("fs.viewfs.mounttable.cluster.link./a", "file:///a")
        assert folder_uri(spark, "/a/b") == "viewfs://cluster/a/b"
    finally:
        conf.set("fs.defaultFS", before or "file:///")


def test_damage_is_found(spark, tmp_path):
    folder = f"file://{tmp_path}"
    manifest = write_archive(records(pages(spark, [(1, "u", "hello" * 300)])), folder)
    (row,) = manifest.collect()
    path = f"{tmp_path}/{row.final}"
    data = bytearray(gzip.decompress(open(path, "rb").read()))
    at = data.index(b"hellohello")
    data[at] = ord("j")
    open(path, "wb").write(gzip.compress(bytes(data[data.index(b"WARC/1.1", 9) :])))
    with pytest.raises(PythonException):
        read_archive(manifest, folder).collect()
    with pytest.raises(ValueError):
        parse(bytes(data[data.index(b"WARC/1.1", 9) :]))


def test_empty_table(spark):
    assert archived(spark, pages(spark, [])).collect() == []
