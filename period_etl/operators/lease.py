"""Single-writer guard: a numbered lease file that one run at a time can hold.

A run that wants the lease looks at the file of the highest number. If its holder
has given it back or it has run out, the run creates the file of the next
number, which the file system lets only one of several do; the others raise
``LeaseHeld``. A run that died leaves a lease that the next one may pass after
its time. A holder that works longer renews it, and learns there if it was passed.
On object stores without an exclusive create, use the store's own locking instead.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

NAME = "_lease."


class LeaseHeld(RuntimeError):
    """Another run holds the lease."""


class Lease:
    """A held lease; use ``single_writer`` to get one."""

    def __init__(self, spark: SparkSession, folder: str, seconds: float):
        jvm = spark.sparkContext._jvm
        self._folder = jvm.org.apache.hadoop.fs.Path(folder)
        self._fs = self._folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._path = lambda name: jvm.org.apache.hadoop.fs.Path(self._folder, name)
        self.holder, self.seconds, self.number = uuid.uuid4().hex, seconds, -1

    def _name(self, number: int) -> str:
        return f"{NAME}{number:012d}"

    def _content(self) -> str:
        return json.dumps({"holder": self.holder, "until": time.time() + self.seconds})

    def _create(self, number: int) -> bool:
        """Create the file of a number; False if there is one."""
        path = self._path(self._name(number))
        if self._fs.getUri().getScheme() == "file":   # Hadoop's local file system looks first and creates then
            try:
                with open(path.toUri().getPath(), "x") as out:
                    out.write(self._content())
            except FileExistsError:
                return False
            return True
        try:
            out = self._fs.create(path, False)
        except Exception as error:
            if "AlreadyExists" in str(getattr(error, "java_exception", error)):
                return False
            raise
        try:
            out.writeBytes(self._content())
        finally:
            out.close()
        return True

    def _numbers(self) -> list[int]:
        names = (s.getPath().getName() for s in self._fs.listStatus(self._folder))
        return sorted(int(n.removeprefix(NAME)) for n in names if n.startswith(NAME) and n.removeprefix(NAME).isdigit())

    def _held(self, number: int) -> str | None:
        """Who holds the lease of a number now, if anyone does."""
        path = self._path(self._name(number))
        try:
            source = self._fs.open(path)
            try:
                known = json.loads(bytes(source.readAllBytes()))
            except ValueError:   # its writer is at it, or died there: its time counts from then
                known = {"holder": "a run that is starting", "until": self._fs.getFileStatus(path).getModificationTime() / 1000 + self.seconds}
            finally:
                source.close()
        except Exception as error:
            if "FileNotFound" in str(getattr(error, "java_exception", error)):
                return None
            raise
        return known["holder"] if known["until"] > time.time() else None

    def take(self) -> None:
        self._fs.mkdirs(self._folder)
        last = max(self._numbers(), default=-1)
        if last >= 0 and (holder := self._held(last)):
            raise LeaseHeld(f"{self._folder} is held by {holder}")
        if not self._create(last + 1):
            raise LeaseHeld(f"{self._folder} was taken by another run just now")
        self.number = last + 1
        numbers = self._numbers()
        if numbers[-1] != self.number:   # others came and went since it looked
            self._fs.delete(self._path(self._name(self.number)), False)
            raise LeaseHeld(f"{self._folder} was taken by another run just now")
        for old in numbers[:-1]:
            self._fs.delete(self._path(self._name(old)), False)

    def _own(self) -> bool:
        return bool(numbers := self._numbers()) and numbers[-1] == self.number

    def _rewrite(self, content: str) -> None:
        out = self._fs.create(self._path(self._name(self.number)), True)
        try:
            out.writeBytes(content)
        finally:
            out.close()

    def renew(self) -> None:
        """Hold it for the whole span again; raises ``LeaseHeld`` if another run has passed it."""
        if not self._own():
            raise LeaseHeld(f"{self._folder} was taken over")
        self._rewrite(self._content())

    def give_back(self) -> None:
        """The file stays, run out, so that numbers go on."""
        if self._own():
            self._rewrite(json.dumps({"holder": self.holder, "until": 0}))


@contextmanager
def single_writer(spark: SparkSession, folder: str, seconds: float) -> Iterator[Lease]:
    """Hold the lease of a folder for a block of work that takes ``seconds`` at most, or renews it in time."""
    lease = Lease(spark, folder, seconds)
    lease.take()
    try:
        yield lease
    finally:
        lease.give_back()
