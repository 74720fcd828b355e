"""A streaming source of landed files that have grown, whether by new segments or by new bytes.

Spark's file source takes a file once, by its name, and never sees what is appended to it. This
source keeps an offset map of its own: the length and time of every segment, written as numbered
listings in a state folder. A batch has the files whose segments differ between two listings; the
job that follows reads their new bytes by the history. The offset itself is the listing's number,
so the checkpoint stays small. A batch that is replayed compares the same two listings again, and
listings older than the last finished batch are deleted.

The listing is made and compared by the one process that Spark runs for the source, as Spark's own
file source does it on the driver; rows are names, dealt in parts of `PART` names.
"""

import os
import sys
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

# The source's process needs no copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PART = 10_000
_ROWS = "server_id string, source_file_path string"


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder, named by URI or by local path, and the folder's path on it."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    scheme, _, rest = uri.partition("://")
    authority, _, path = rest.partition("/")
    files, _ = pafs.FileSystem.from_uri(f"{scheme}://{authority}/")
    return files, f"/{path}" if scheme in ("hdfs", "viewfs") else f"{authority}/{path}"


class Files(InputPartition):
    """Some files that have grown."""

    def __init__(self, names: list[tuple[str, str]]) -> None:
        self.names = names


class GrowthReader(DataSourceStreamReader):
    def __init__(self, landed: str, state: str) -> None:
        self.landed, self.state = landed, state

    def initialOffset(self) -> dict:
        return {"listing": 0}

    def latestOffset(self) -> dict:
        """The number of the listing that shows the folder as it is now."""
        files, folder = filesystem(self.state)
        files.create_dir(folder, recursive=True)
        last = max(self._numbers(files, folder), default=0)
        now = self._listing()
        if now != self._read(last):
            last += 1
            table = pa.table(
                {
                    "segment": pa.array(list(now), pa.string()),
                    "length": pa.array([v[0] for v in now.values()], pa.int64()),
                    "modified": pa.array([v[1] for v in now.values()], pa.int64()),
                }
            )
            # Under another name until it is whole: a listing that can be read is complete.
            pq.write_table(table, f"{folder}/new", filesystem=files)
            files.move(f"{folder}/new", f"{folder}/{last}.parquet")
        return {"listing": last}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        before, after = self._read(start["listing"]), self._read(end["listing"])
        grown = sorted({leaf(s) for s, v in after.items() if before.get(s) != v} - {None})
        return [Files(grown[i : i + PART]) for i in range(0, len(grown), PART)]

    def read(self, partition: Files) -> Iterator[tuple[str, str]]:
        yield from partition.names

    def commit(self, end: dict) -> None:
        files, folder = filesystem(self.state)
        for number in self._numbers(files, folder):
            if number < end["listing"]:
                files.delete_file(f"{folder}/{number}.parquet")

    def _numbers(self, files: pafs.FileSystem, folder: str) -> list[int]:
        found = files.get_file_info(pafs.FileSelector(folder, allow_not_found=True))
        return [int(f.base_name[:-8]) for f in found if f.base_name.endswith(".parquet")]

    def _read(self, number: int) -> dict[str, tuple[int, int]]:
        if number == 0:
            return {}
        files, folder = filesystem(self.state)
        rows = pq.read_table(f"{folder}/{number}.parquet", filesystem=files).to_pydict()
        return dict(zip(rows["segment"], zip(rows["length"], rows["modified"])))

    def _listing(self) -> dict[str, tuple[int, int]]:
        """Length and time of the segments that hold bytes, by their path below the root."""
        files, root = filesystem(self.landed)
        root = root.rstrip("/")
        found = files.get_file_info(
            pafs.FileSelector(root, allow_not_found=True, recursive=True)
        )
        return {
            f.path[len(root) + 1 :]: (f.size, f.mtime_ns)
            for f in sorted(found, key=lambda f: f.path)
            if f.type == pafs.FileType.File and f.size and f.base_name[0] not in "._"
        }


def leaf(segment: str) -> tuple[str, str] | None:
    """Server and file of a segment's path; None for what is no landed file."""
    parts = segment.split("/")
    if len(parts) != 3:
        return None
    values = [part.partition("=") for part in parts[:2]]
    if [v[0] for v in values] != ["server_id", "source_file_path"]:
        return None
    return unquote(values[0][2]), unquote(values[1][2])


class GrowthSource(DataSource):
    """`landed_growth`: files under `path` that have grown; `state` is the folder of listings."""

    @classmethod
    def name(cls) -> str:
        return "landed_growth"

    def schema(self) -> str:
        return _ROWS

    def streamReader(self, schema) -> GrowthReader:
        return GrowthReader(self.options["path"], self.options["state"])


def growth_stream(spark: SparkSession, landed: str, checkpoint: str) -> DataFrame:
    """FILE_COLUMNS of every landed file that has grown; the listings lie beside the checkpoint."""
    spark.dataSource.register(GrowthSource)
    state = os.path.join(checkpoint.rstrip("/"), "growth")
    return spark.readStream.format("landed_growth").option("state", state).load(landed)
