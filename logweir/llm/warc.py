"""A deterministic sharded WARC writer, and the reader of what it wrote.

`records` decides which record answers for equal payloads. `write_archive` sorts the records by
id, url and digest and cuts that order into shards by exact running totals of their bytes. A shard
is written as gzip members, one per record, beginning a new file when the compressed size of the
last has reached `roll_bytes`. Shard limits come from the data alone, and so do all headers, ids and
digests beside the given date: the same input gives the same files, byte by byte, whatever the
number of partitions. The limits, one key for each shard, pass the driver.

Commit: a task writes each file under a temporary name that no other attempt has, and gives back
a manifest row. The manifest is a table that Spark commits, with the rows of exactly one attempt
per task. A second job renames the files it lists, which can be repeated at any point. Files of
lost attempts are in no manifest and stay under temporary names. Readers go by the manifest.

Files are written by pyarrow's file systems, so the folder must be one that executors reach by
such (a shared mount, HDFS, an object store).

Defined results: a null html is an empty payload. Rows of equal payload and equal id, and rows of
a null id without any other, are all responses. A null id sorts first and is left out of the
header; a null url gives a urn, and control characters in a url are percent-encoded. Columns
other than id, url and html are not read; an empty table gives an empty manifest.
"""

import base64
import bisect
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logweir.sources.staging import new_folder, stage

_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_MANIFEST = (
    "temporary string, final string, records bigint, bytes bigint, sha256 string,"
    " first_id bigint, last_id bigint"
)
KEY = ("page_id", "url", "payload_digest")
_HEADERS = 600  # bytes, about
_LEAST = 16 << 20
_READ = (
    "page_id bigint, url string, record_type string, payload binary, payload_bytes bigint,"
    " payload_digest string, refers_to bigint"
)


def records(pages: DataFrame, min_bytes: int = 1000) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to.

    Of equal payloads of at least `min_bytes`, that of the largest id is the response.
    """
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        payload.alias("payload"),
    ).select(
        "*", F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"),
    )
    large = rows.where(F.col("payload_bytes") >= min_bytes)
    keeper = large.groupBy("payload_digest").agg(
        F.max("page_id").alias("keeper"), F.count("*").alias("n")
    )
    # Written, so that its true size decides whether the payloads are shuffled for the join.
    keeper = stage(keeper.where("n > 1 and keeper is not null").drop("n"), "keepers")
    is_revisit = F.col("keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper"))
    # Only large payloads can equal one that has a keeper.
    return (
        rows.join(keeper, "payload_digest", "left")
        .withColumn("record_type", F.when(is_revisit, "revisit").otherwise("response"))
        .withColumn("payload", F.when(~is_revisit, F.col("payload")))
        .select(
            "page_id", "url", "payload", "payload_bytes", "payload_digest", "record_type",
            F.when(is_revisit, F.col("keeper")).alias("refers_to"),
        )
    )


def record_id(page_id: int | None, digest: str) -> str:
    name = f"{page_id}:{digest}"
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"


def _uri(url: str | None, page_id: int | None) -> str:
    if not url:
        return f"urn:page:{page_id}"
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)


def _member(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{name}: {value}\r\n" for name, value in fields)
    head = f"WARC/1.1\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode()
    return gzip.compress(head + block + b"\r\n\r\n", compresslevel=6, mtime=0)


def _base32(hex_digest: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(hex_digest)).decode()


def member(row: dict, date: str) -> bytes:
    """The gzip member of one record."""
    size, digest = row["payload_bytes"], row["payload_digest"]
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {size}\r\n\r\n"
    ).encode()
    block = http + (row["payload"] or b"")
    fields = [
        ("WARC-Type", row["record_type"]),
        ("WARC-Record-ID", record_id(row["page_id"], digest)),
        ("WARC-Date", date),
        ("WARC-Target-URI", _uri(row["url"], row["page_id"])),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Block-Digest", _base32(hashlib.sha1(block).hexdigest())),
        ("WARC-Payload-Digest", _base32(digest)),
        ("X-Payload-Length", str(size)),
    ]
    if row["page_id"] is not None:
        fields.append(("X-Page-Id", str(row["page_id"])))
    if row["record_type"] == "revisit":
        fields += [
            ("WARC-Profile", _PROFILE),
            ("WARC-Refers-To", record_id(row["refers_to"], digest)),
            ("X-Refers-To-Page-Id", str(row["refers_to"])),
        ]
    return _member(fields, block)


def _info(name: str, date: str) -> bytes:
    fields = [
        ("WARC-Type", "warcinfo"),
        ("WARC-Record-ID", record_id(None, name)),
        ("WARC-Date", date),
        ("WARC-Filename", name),
        ("Content-Type", "application/warc-fields"),
    ]
    return _member(fields, b"format: WARC File Format 1.1\r\n")


class _RollingFile:
    """Files of one shard, one after the other, each under a temporary name."""

    def __init__(self, folder: str, shard: int, date: str, roll_bytes: int) -> None:
        self.files, self.root = pafs.FileSystem.from_uri(folder)
        self.shard, self.date, self.roll_bytes = shard, date, roll_bytes
        self.number, self.out = 0, None
        self.files.create_dir(f"{self.root}/tmp", recursive=True)

    def add(self, row: dict) -> dict | None:
        """Write one record; the manifest row of the file if that filled it."""
        if self.out is None:
            name = f"part-{self.shard:05d}-{self.number:05d}.warc.gz"
            self.row = {
                "temporary": f"tmp/{uuid.uuid4().hex}-{name}", "final": name, "records": 0,
                "bytes": 0, "first_id": row["page_id"],
            }
            self.sha = hashlib.sha256()
            self.out = self.files.open_output_stream(f"{self.root}/{self.row['temporary']}", compression=None)
            self._write(_info(name, self.date))
        self._write(member(row, self.date))
        self.row["records"] += 1
        self.row["last_id"] = row["page_id"]
        return self.close() if self.row["bytes"] >= self.roll_bytes else None

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.sha.update(data)
        self.row["bytes"] += len(data)

    def close(self) -> dict | None:
        if self.out is None:
            return None
        self.out.close()
        self.out, self.number = None, self.number + 1
        return self.row | {"sha256": self.sha.hexdigest()}


def write_archive(
    rows: DataFrame,
    folder: str,
    roll_bytes: int = 256 << 20,
    date: str = "2000-01-01T00:00:00Z",
) -> DataFrame:
    """Write `records` rows under `folder` (a URI); the manifest of the committed files."""
    kind = pa.schema(
        [(n, pa.string()) for n in ("temporary", "final")]
        + [(n, pa.int64()) for n in ("records", "bytes")]
        + [("sha256", pa.string()), ("first_id", pa.int64()), ("last_id", pa.int64())]
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = None
        for batch in batches:
            names = batch.schema.names
            for values in zip(*batch.columns):  # one record at a time in memory
                row = {n: v.as_py() for n, v in zip(names, values)}
                done = None
                if target is None or target.shard != row["shard"]:
                    done = target and target.close()
                    target = _RollingFile(folder, row["shard"], date, roll_bytes)
                for row_ in filter(None, (done, target.add(row))):
                    yield pa.RecordBatch.from_pylist([row_], kind)
        done = target and target.close()
        if done:
            yield pa.RecordBatch.from_pylist([done], kind)

    def commit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                source, target = f"{root}/{row['temporary']}", f"{root}/{row['final']}"
                if files.get_file_info(source).type == pafs.FileType.File:
                    files.move(source, target)
                size = files.get_file_info(target).size
                if size != row["bytes"]:
                    raise OSError(f"{target} has {size} bytes, its manifest says {row['bytes']}")
            yield batch

    limits = shard_limits(rows, roll_bytes)
    order = ["shard", *[F.col(c).asc_nulls_first() for c in KEY]]
    manifest = (
        rows.withColumn("shard", shard_of(limits))
        .repartitionById(len(limits) + 1, F.col("shard"))
        .sortWithinPartitions(*order)
        .mapInArrow(write, _MANIFEST)
    )
    manifest = stage(manifest, "manifest")
    return stage(manifest.mapInArrow(commit, _MANIFEST), "committed")


def shard_limits(rows: DataFrame, roll_bytes: int) -> list[tuple]:
    """The smallest key of each shard but the first, in order.

    A shard holds 1/64 of all bytes, but 16 MiB at least and four files at the most.
    """
    size = F.coalesce(F.octet_length("payload"), F.lit(0)) + _HEADERS
    keys = rows.groupBy(*KEY).agg(F.sum(size.cast("bigint")).alias("size"))
    order = [F.col(c).asc_nulls_first() for c in KEY]
    keys = stage(keys.repartitionByRange(*order).sortWithinPartitions(*order), "keys")
    keys = keys.select(
        "*",
        F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).cast("bigint").alias("part"),
        F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("place"),
    )
    files = keys.groupBy("part", "file").agg(F.sum("size").alias("size"))
    total = files.agg(F.sum("size")).first()[0]
    if total is None:
        return []
    shard_bytes = min(max(total // 64, _LEAST), max(4 * roll_bytes, _HEADERS))
    # One row per written file, then the rows of one file at a time.
    earlier = W.orderBy("part", "file").rowsBetween(W.unboundedPreceding, -1)
    files = files.select("file", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before"))
    within = W.partitionBy("file").orderBy("place").rowsBetween(W.unboundedPreceding, -1)
    running = F.col("before") + F.coalesce(F.sum("size").over(within), F.lit(0))
    cut = keys.join(files, "file").select(*KEY, F.floor(running / shard_bytes).alias("shard"))
    firsts = cut.groupBy("shard").agg(F.min(F.struct(*KEY)).alias("first"))
    return [tuple(r.first) for r in firsts.orderBy("shard").collect()][1:]


def shard_of(limits: list[tuple]) -> Column:
    """The shard of a record by its key."""
    ordered = [_comparable(limit) for limit in limits]

    def find(page_id: pd.Series, url: pd.Series, digest: pd.Series) -> pd.Series:
        # Ids travel as text: a null among them would turn all into floats.
        keys = (
            (None if i is None else int(i), u, d) for i, u, d in zip(page_id, url, digest)
        )
        return pd.Series([bisect.bisect_right(ordered, _comparable(key)) for key in keys])

    return F.pandas_udf(find, "int")(F.col("page_id").cast("string"), "url", "payload_digest")


def _comparable(key: tuple) -> tuple:
    """A key whose nulls sort first."""
    return tuple((False,) if value is None else (True, value) for value in key)


def _members(stream) -> Iterator[bytes]:
    """The gzip members of a stream, each unpacked."""
    unpack, parts = zlib.decompressobj(31), []
    while chunk := stream.read(1 << 20):
        while chunk:
            parts.append(unpack.decompress(chunk))
            chunk = b""
            if unpack.eof:
                yield b"".join(parts)
                chunk, unpack, parts = unpack.unused_data, zlib.decompressobj(31), []
    if any(parts):
        raise ValueError("the file ends within a record")


def parse(data: bytes) -> dict | None:
    """A record as a row of `read_archive`; None if it holds no page. Digests are verified."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    if fields["WARC-Type"] not in ("response", "revisit"):
        return None
    block = rest[: int(fields["Content-Length"])]
    if _base32(hashlib.sha1(block).hexdigest()) != fields["WARC-Block-Digest"]:
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    payload = block.partition(b"\r\n\r\n")[2]
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    is_response = fields["WARC-Type"] == "response"
    if is_response and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"damaged payload {fields['WARC-Record-ID']}")
    number = lambda name: int(fields[name]) if name in fields else None
    return {
        "page_id": number("X-Page-Id"),
        "url": fields["WARC-Target-URI"],
        "record_type": fields["WARC-Type"],
        "payload": payload if is_response else None,
        "payload_bytes": number("X-Payload-Length"),
        "payload_digest": digest,
        "refers_to": number("X-Refers-To-Page-Id"),
    }


def read_archive(manifest: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records of the files a manifest lists; without `payloads` these are null."""
    kind = pa.schema(
        [
            ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
            ("payload", pa.binary()), ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()), ("refers_to", pa.int64()),
        ]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column("final").to_pylist():
                rows, size = [], 0
                with files.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for data in _members(stream):
                        row = parse(data)
                        if row is None:
                            continue
                        if not payloads:
                            row["payload"] = None
                        rows.append(row)
                        size += len(row["payload"] or b"") + 200
                        if size > 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, kind)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, kind)

    # One task per file; AQE would merge them, as their names are few bytes.
    files = manifest.select("final", F.row_number().over(W.orderBy("final")).alias("place"))
    tasks = max(1, manifest.count())
    return (
        files.repartitionById(tasks, F.col("place") - 1).select("final").mapInArrow(read, _READ)
    )


def folder_uri(spark: SparkSession, folder: str) -> str:
    """`folder` with the scheme of the file system that Spark takes it to be on."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    uri = files.makeQualified(path).toString()
    return f"file://{uri[5:]}" if uri.startswith("file:/") and uri[5:7] != "//" else uri


def archived(spark: SparkSession, pages: DataFrame, roll_bytes: int = 256 << 20) -> DataFrame:
    """`pages` written to a new archive in the shared folder and read back."""
    folder = folder_uri(spark, new_folder(spark, "warc"))
    manifest = write_archive(records(pages), folder, roll_bytes)
    return read_archive(manifest, folder, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


ORACLE_SQL = """
WITH r AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
         sha1(coalesce(html, '')) AS payload_digest
  FROM pages
), k AS (
  SELECT payload_digest, max(page_id) AS keeper FROM r WHERE payload_bytes >= 1000 GROUP BY ALL
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id < keeper THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < keeper THEN keeper END AS refers_to
FROM r LEFT JOIN k USING (payload_digest)
"""
