"""Landed segments read by byte ranges, from where an earlier run left them.

Spark's text source opens a file from its first byte. Log files grow at their end, so a run that
goes on behind a known line needs the bytes behind it only. Here a table of blocks (segment, first
byte, last byte) is dealt to tasks, and each task opens its blocks at their first byte. Names and
offsets stay in that table; nothing of it passes the driver but two totals.

A line belongs to the block in which it begins. A block that does not begin at a line start leaves
the rest of that line to the block before, which reads on past its end. The same rule holds at the
place where an earlier run stopped, so a last line that had no line end and was taken as complete
is not read again, and its rest is not a line of its own.

Line ends are LF, CR LF and CR, in the charset's own width: UTF-16 and UTF-32 are searched by code
unit. A segment counts as it was listed; what is written to it meanwhile is for the next run.
"""

import codecs
import hashlib
import re
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweir.functions.text import charset, decoded

# Executors need no copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FILE_COLUMNS = ["server_id", "source_file_path"]
#: Bytes of a block; blocks of one task, on average.
BLOCK_BYTES = 16 << 20
TASK_BYTES = 64 << 20
TASK_BLOCKS = 1000
#: Bytes at the head of a segment and before the place where a run stopped, by which a later run
#: tells an appended file from another one.
EDGE_BYTES = 4096
_CHUNK = 4 << 20
_WIDE = {"UTF-16": 2, "UTF-16LE": 2, "UTF-16BE": 2, "UTF-32": 4, "UTF-32LE": 4, "UTF-32BE": 4}
_LINE_END = re.compile("\r\n|\r|\n")


def open_path(path: str):
    """A path as Spark lists it, opened for reading at any place."""
    if path.startswith("file:"):
        return open("/" + path[5:].lstrip("/"), "rb")
    import pyarrow.fs as pafs

    scheme, _, rest = path.partition("://")
    if not rest:
        return open(path, "rb")
    authority, _, name = rest.partition("/")
    files, _ = pafs.FileSystem.from_uri(f"{scheme}://{authority}/")
    return files.open_input_file(f"/{name}" if scheme in ("hdfs", "viewfs") else f"{authority}/{name}")


class LineEnds:
    """Finds line ends of a charset in bytes that begin at a code unit."""

    def __init__(self, encoding: str, head: bytes) -> None:
        name = encoding.upper()
        self.width = _WIDE.get(name, 1)
        self.mark = 0  # bytes of a byte order mark that is no text
        if name == "UTF-8" or name == "UTF8":
            self.mark = 3 if head.startswith(codecs.BOM_UTF8) else 0
        elif name in ("UTF-16", "UTF-32"):
            marks = {
                "UTF-16": (codecs.BOM_UTF16_LE, codecs.BOM_UTF16_BE),
                "UTF-32": (codecs.BOM_UTF32_LE, codecs.BOM_UTF32_BE),
            }[name]
            self.mark = self.width if head.startswith(marks) else 0
            name += "LE" if head.startswith(marks[0]) else "BE"
        self.codec = name
        if self.width > 1:
            self.feed, self.back = ("\n".encode(name), "\r".encode(name))

    def _aligned(self, data: bytes, unit: bytes, last: bool) -> int:
        """Place of the first or last code unit `unit`, or -1."""
        at = data.rfind(unit) if last else data.find(unit)
        while at >= 0 and at % self.width:
            at = data.rfind(unit, 0, at + self.width - 1) if last else data.find(unit, at + 1)
        return at

    def ends(self, data: bytes, last: bool) -> int:
        """Place of the first or last line feed or carriage return, or -1."""
        if self.width == 1:
            places = [data.rfind(c) if last else data.find(c) for c in (b"\n", b"\r")]
        else:
            places = [self._aligned(data, unit, last) for unit in (self.feed, self.back)]
        places = [place for place in places if place >= 0]
        return (max if last else min)(places) if places else -1

    def is_feed(self, unit: bytes) -> bool:
        return unit == (b"\n" if self.width == 1 else self.feed)

    def is_back(self, unit: bytes) -> bool:
        return unit == (b"\r" if self.width == 1 else self.back)

    def split(self, data: bytes) -> list[bytes]:
        """Lines of `data`; wide charsets as UTF-8."""
        if self.width == 1:
            return data.splitlines()
        lines = _LINE_END.split(data.decode(self.codec, "replace"))
        if lines and not lines[-1]:
            lines.pop()
        return [line.encode("utf-8", "replace") for line in lines]


def block_lines(
    stream, start: int, stop: int, length: int, encoding: str
) -> Iterator[tuple[list[bytes], int | None]]:
    """Lines that begin in [start, stop) of a segment of `length` bytes, some at a time.

    The number beside them is None, or the bytes of the last of them if it has no line end.
    """
    def read(place: int, count: int) -> bytes:
        stream.seek(place)
        return stream.read(max(0, min(count, length - place)))

    ends = LineEnds(encoding, read(0, 4))
    width, place = ends.width, start
    if start <= ends.mark:
        place = ends.mark
    else:
        before = read(start - width, width)
        if ends.is_back(before):
            place += width if ends.is_feed(read(start, width)) else 0
        elif not ends.is_feed(before):
            # Within a line of an earlier block: go on behind its end.
            while place < stop:
                data = read(place, min(_CHUNK, stop - place))
                if not data:
                    return
                at = ends.ends(data, last=False)
                if at >= 0:
                    place += at + width
                    if ends.is_back(data[at : at + width]) and ends.is_feed(read(place, width)):
                        place += width
                    break
                place += len(data)
    held = b""
    while place < stop:
        data = read(place, min(_CHUNK, stop - place))
        if not data:
            break
        place += len(data)
        held += data
        # A carriage return at the end may be the first half of a line end.
        at = ends.ends(held[: len(held) - width] if ends.is_back(held[-width:]) else held, last=True)
        if at >= 0:
            yield ends.split(held[: at + width]), None
            held = held[at + width :]
    if not held:
        return
    if ends.is_back(held[-width:]):
        yield ends.split(held), None
        return
    parts = [held]
    while place < length:
        data = read(place, _CHUNK)
        if not data:
            break
        at = ends.ends(data, last=False)
        if at >= 0:
            yield ends.split(b"".join([*parts, data[: at + width]])), None
            return
        parts.append(data)
        place += len(data)
    held = b"".join(parts)
    yield ends.split(held), len(held)


def blocks_of(segments: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """`segments` rows cut into blocks: `start` and `stop` beside their columns.

    Segments have `path`, `length` and `resume_at`, the byte to go on from.
    """
    block_bytes -= block_bytes % 4  # a code unit stays whole
    first = F.explode(F.sequence("resume_at", F.col("length") - 1, F.lit(block_bytes))).alias("start")
    return segments.where(F.col("resume_at") < F.col("length")).select(
        "*", first
    ).withColumn("stop", F.least(F.col("start") + block_bytes, F.col("length")))


def block_totals() -> list[Column]:
    """Aggregates of a table of blocks: their number and bytes."""
    size = F.sum(F.col("stop") - F.col("start"))
    return [F.count(F.lit(1)).alias("n"), F.coalesce(size, F.lit(0)).alias("bytes")]


def read_blocks(blocks: DataFrame, n: int, size: int, encoding: str = "UTF-8") -> DataFrame:
    """Lines of the blocks: FILE_COLUMNS, segment, block_start, place, line, open_bytes.

    `open_bytes` is null but for a last line without line end, of which it has the bytes; where
    `hold` is true that line is null. `n` and `size` are the number of blocks and their bytes.
    """
    spark = blocks.sparkSession
    least = min(n, spark.sparkContext.defaultParallelism)
    tasks = max(1, least, size // TASK_BYTES, n // TASK_BLOCKS)
    columns = [*FILE_COLUMNS, "segment", "path", "start", "stop", "length", "hold"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                place = 0
                with open_path(row["path"]) as stream:
                    found = block_lines(stream, row["start"], row["stop"], row["length"], encoding)
                    for lines, open_bytes in found:
                        n = len(lines)
                        if not n:
                            continue
                        if open_bytes is not None and row["hold"]:
                            lines = [*lines[:-1], None]
                        yield pa.RecordBatch.from_arrays(
                            [
                                *(pa.repeat(pa.scalar(row[c], pa.string()), n) for c in columns[:3]),
                                pa.repeat(pa.scalar(row["start"], pa.int64()), n),
                                pa.array(range(place, place + n), pa.int64()),
                                pa.array(lines, pa.binary()),
                                pa.array([None] * (n - 1) + [open_bytes], pa.int64()),
                            ],
                            names,
                        )
                        place += n

    names = [*columns[:3], "block_start", "place", "value", "open_bytes"]
    raw = blocks.select(*columns).repartition(tasks, "path", "start").mapInArrow(
        run,
        "server_id string, source_file_path string, segment string, block_start bigint, "
        "place bigint, value binary, open_bytes bigint",
    )
    # What the tasks have decoded already is UTF-8.
    encoding = "UTF-8" if encoding.upper() in _WIDE else encoding
    with charset(spark, encoding):
        line = decoded(F.col("value").cast("string"), encoding).alias("line")
        return raw.select(*names[:5], line, "open_bytes")


def with_edges(segments: DataFrame, at: str) -> DataFrame:
    """Add `head` and `tail`: digests of the first bytes and of those before the byte `at`.

    Segments of which `at` is null are not opened and have none.
    """
    columns = segments.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heads, tails = [], []
            for path, end in zip(batch.column("path").to_pylist(), batch.column(at).to_pylist()):
                if end is None:
                    heads.append(None)
                    tails.append(None)
                    continue
                with open_path(path) as stream:
                    heads.append(_digest(stream.read(min(EDGE_BYTES, end))))
                    stream.seek(max(0, end - EDGE_BYTES))
                    tails.append(_digest(stream.read(end - max(0, end - EDGE_BYTES))))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(heads, pa.string()), pa.array(tails, pa.string())],
                [*columns, "head", "tail"],
            )

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in segments.schema.fields)
    return segments.mapInArrow(run, f"{kinds}, head string, tail string")


def _digest(data: bytes) -> str:
    return hashlib.blake2b(data, digest_size=16).hexdigest()


def same_edges(head: Column, tail: Column, known_head: Column, known_tail: Column) -> Column:
    """Whether a segment still has the bytes by which it was left; unknown digests do not count."""
    return F.coalesce((head == known_head) & (tail == known_tail), F.lit(False))
