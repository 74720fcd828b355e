"""One writer at a time: a lease on a store, kept as numbered files beside its tables.

The file of the highest number is the lease in force, unless it is released or expired. A writer
takes the next number by creating its file where none may exist yet, which one writer alone can
do, and then looks again: a higher number means that it had gone by an old listing. So an expired
lease is taken over by one writer, without a moment in which two hold it. The holder renews its
file from a thread of its own while it works, and makes sure of it before each write; a writer
that was stopped for longer than its lease lasts finds that out before it writes again.
"""

import contextlib
import json
import threading
import time
import uuid
from collections.abc import Callable, Iterator

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

LASTS_SECONDS = 3600.0


class StoreBusy(RuntimeError):
    """Another writer holds the store, or has taken it over."""


class Lease:
    """The lease of one writer; `make_sure` raises StoreBusy when it is lost."""

    def __init__(
        self, spark: SparkSession, store: str, owner: str, lasts: float, clock: Callable[[], float]
    ) -> None:
        self.jvm, self.owner, self.lasts, self.clock = spark._jvm, owner, lasts, clock
        self.token, self.lock = uuid.uuid4().hex, threading.Lock()
        self.folder = self.jvm.org.apache.hadoop.fs.Path(f"{store}/_lease")
        self.files = self.folder.getFileSystem(spark._jsc.hadoopConfiguration())
        self.number = 0

    def _path(self, number: int):
        return self.jvm.org.apache.hadoop.fs.Path(self.folder, f"{number:012d}")

    def _numbers(self) -> list[int]:
        if not self.files.exists(self.folder):
            return []
        names = [status.getPath().getName() for status in self.files.listStatus(self.folder)]
        return sorted(int(name) for name in names if name.isdigit())

    def _read(self, number: int) -> dict:
        """A lease's content; one that is being written, or cannot be read now, counts as held."""
        path = self._path(number)
        try:
            stream = self.files.open(path)
            try:
                return json.loads(bytes(stream.readAllBytes()))
            finally:
                stream.close()
        except (ValueError, Py4JJavaError):
            held = {"owner": "another writer", "token": None, "until": float("inf")}
            if self.files.exists(path):
                made = self.files.getFileStatus(path).getModificationTime() / 1000
                held["until"] = made + self.lasts
            return held

    def _write(self, number: int, overwrite: bool, until: float) -> None:
        content = json.dumps({"owner": self.owner, "token": self.token, "until": until})
        stream = self.files.create(self._path(number), overwrite)
        stream.write(content.encode())
        stream.close()

    def take(self) -> None:
        numbers = self._numbers()
        last = numbers[-1] if numbers else 0
        if last:
            held = self._read(last)
            if held["until"] > self.clock():
                raise StoreBusy(f"{self.folder} is held by {held['owner']}")
        try:
            self._write(last + 1, False, self.clock() + self.lasts)
        except Py4JJavaError as error:  # the file system's own: somebody may have been first
            if last + 1 in self._numbers():
                raise StoreBusy(f"{self.folder} was taken by another writer") from error
            raise
        self.number = last + 1
        numbers = self._numbers()
        if numbers[-1] != self.number:
            self.files.delete(self._path(self.number), False)
            raise StoreBusy(f"{self.folder} was taken by another writer")
        for number in numbers[:-1]:
            self.files.delete(self._path(number), False)

    def make_sure(self) -> None:
        """Renew the lease, if it is still this writer's."""
        with self.lock:
            numbers = self._numbers()
            own = numbers and numbers[-1] == self.number and self._read(self.number)
            if not own or own["token"] != self.token or own["until"] <= self.clock():
                raise StoreBusy(f"{self.owner} has lost {self.folder}")
            self._write(self.number, True, self.clock() + self.lasts)

    def release(self) -> None:
        """Let the next writer in; the number stays, so that numbers only grow."""
        with self.lock:
            numbers = self._numbers()
            if numbers and numbers[-1] == self.number:
                if self._read(self.number)["token"] == self.token:
                    self._write(self.number, True, 0.0)


@contextlib.contextmanager
def writing(
    spark: SparkSession,
    store: str,
    owner: str,
    lasts: float = LASTS_SECONDS,
    clock: Callable[[], float] = time.time,
) -> Iterator[Lease]:
    """Hold the store inside the block; StoreBusy if another writer does."""
    lease = Lease(spark, store, owner, lasts, clock)
    lease.take()
    done = threading.Event()

    def renew() -> None:
        with contextlib.suppress(StoreBusy):
            while not done.wait(lasts / 3):
                lease.make_sure()

    renewal = threading.Thread(target=renew, daemon=True)
    renewal.start()
    try:
        yield lease
    finally:
        done.set()
        renewal.join()
        lease.release()
