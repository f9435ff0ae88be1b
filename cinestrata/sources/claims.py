"""Claims on a piece of work: of several runs that want it, one does it.

A claim is a file that is created if it does not exist, which the file system decides. Its
holder touches it while it works. A claim that was not touched for a while belongs to a run
that died; the next claim is a file with the next number, and again one run gets it.
"""

from __future__ import annotations

import os
import time
from collections.abc import Iterator
from contextlib import contextmanager
from threading import Event, Thread

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class LostClaim(RuntimeError):
    """Another run took the work over."""


class Claim:
    """A held claim; :meth:`check` before results become visible."""

    def __init__(self, folder: _Folder, number: int):
        self.folder, self.number = folder, number

    def touch(self) -> None:
        self.folder.touch(self.number)

    def check(self) -> None:
        if self.folder.latest() != self.number:
            raise LostClaim(f"{self.folder.path}: claim {self.number} was taken over")

    def release(self) -> None:
        self.folder.drop(self.number)


class _Folder:
    """Numbered claim files below a path of the shared file system."""

    def __init__(self, spark: SparkSession, path: str):
        self.path, self._jvm = path, spark.sparkContext._jvm
        self._root = self._jvm.org.apache.hadoop.fs.Path(path)
        self._fs = self._root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _file(self, number: int):
        return self._jvm.org.apache.hadoop.fs.Path(self._root, f"claim-{number:06d}")

    def latest(self) -> int | None:
        if not self._fs.exists(self._root):
            return None
        names = [s.getPath().getName() for s in self._fs.listStatus(self._root)]
        return max((int(n[6:]) for n in names if n.startswith("claim-")), default=None)

    def create(self, number: int) -> bool:
        """Whether this call made the file."""
        if self._fs.getScheme() == "file":
            # Hadoop's local file system looks first and creates then, which is two steps.
            folder = self._fs.makeQualified(self._root).toUri().getPath()
            os.makedirs(folder, exist_ok=True)
            try:
                open(f"{folder}/{self._file(number).getName()}", "x").close()
                return True
            except FileExistsError:
                return False
        try:
            self._fs.create(self._file(number), False).close()
            return True
        except Py4JJavaError as err:
            if "FileAlreadyExists" not in err.java_exception.getClass().getName():
                raise
            return False

    def age(self, number: int) -> float:
        """Seconds since the claim was touched; 0 if it is gone."""
        if not self._fs.exists(self._file(number)):
            return 0.0
        return time.time() - self._fs.getFileStatus(self._file(number)).getModificationTime() / 1000

    def touch(self, number: int) -> None:
        # Written anew: a store may not let times be set.
        self._fs.create(self._file(number), True).close()

    def drop(self, number: int) -> None:
        self._fs.delete(self._file(number), False)


@contextmanager
def claimed(spark: SparkSession, path: str, stale_seconds: float) -> Iterator[Claim | None]:
    """Hold the claim on ``path`` for the block; None if another run holds it.

    A claim counts as abandoned after ``stale_seconds`` without a touch, four of which fit in
    that time; clocks of the machines must agree to a fraction of it. It is dropped at the end,
    by error too, so the work may be done again at once.
    """
    folder = _Folder(spark, path)
    last = folder.latest()
    if last is not None and folder.age(last) < stale_seconds:
        yield None
        return
    number = 0 if last is None else last + 1
    if not folder.create(number):
        yield None
        return
    claim, ended = Claim(folder, number), Event()

    def keep() -> None:
        while not ended.wait(stale_seconds / 4):
            claim.touch()

    keeper = Thread(target=keep, daemon=True)
    keeper.start()
    try:
        yield claim
    finally:
        ended.set()
        keeper.join()
        # A successor's claim is left alone; older ones of dead runs go.
        for n in range(number + 1):
            folder.drop(n)
