"""A version log: the one place that says what an index is made of.

An entry is a small JSON file ``log/<number>.json``.  It is written under another name and
renamed, and the rename fails if the number is taken, so there is no moment without a latest
entry, no half-written one, and of two writers that publish at once one has to look again.  An
entry is never changed; what it names is immutable too and stays until the entry has been
followed by ``RETAIN`` others.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

RETAIN = 3


class VersionLog:
    """The entries under ``root``, in the file system that the path names."""

    def __init__(self, spark: SparkSession, root: str):
        self.root = root.rstrip("/")
        self._fs_package = spark._jvm.org.apache.hadoop.fs
        self._gateway = spark.sparkContext._gateway
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self._path("").getFileSystem(self._conf)

    def _path(self, name: str):
        return self._fs_package.Path(f"{self.root}/{name}" if name else self.root)

    def numbers(self) -> list[int]:
        """Numbers of all entries, rising."""
        folder = self._path("log")
        if not self._fs.exists(folder):
            return []
        names = [f.getPath().getName() for f in self._fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def read(self, number: int) -> dict:
        stream = self._fs.open(self._entry(number))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode("utf-8")) | {"number": number}
        finally:
            stream.close()

    def latest(self) -> dict | None:
        numbers = self.numbers()
        return self.read(numbers[-1]) if numbers else None

    def _entry(self, number: int):
        return self._path(f"log/{number:012d}.json")

    def append(self, number: int, entry: dict) -> bool:
        """Publish ``entry`` as ``number``.  False if that number is taken."""
        draft = self._path(f"drafts/{uuid.uuid4().hex}")
        out = self._fs.create(draft, False)
        out.write(bytearray(json.dumps(entry).encode("utf-8")))
        out.close()
        self._fs.mkdirs(self._path("log"))
        option = getattr(self._fs_package, "Options$Rename")
        context = self._fs_package.FileContext.getFileContext(self._fs.getUri(), self._conf)
        try:
            context.rename(draft, self._entry(number), self._gateway.new_array(option, 0))
        except Py4JJavaError as error:
            self._fs.delete(draft, False)
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise
        return True

    def publish(self, make: Callable[[dict | None], dict]) -> dict:
        """Append ``make(latest entry)``; made again if another writer came first."""
        while True:
            before = self.latest()
            number = before["number"] + 1 if before else 1
            entry = make(before)
            if self.append(number, entry):
                return entry | {"number": number}

    def take_number(self) -> int:
        """A number that no other writer gets."""
        number = 0
        while not self._fs.createNewFile(self._path(f"numbers/{number:06d}")):
            number += 1
        return number

    def trim(self, folders: Callable[[dict], list[str]], retain: int = RETAIN) -> list[str]:
        """Delete the entries before the latest ``retain``, then the folders that only they
        name.  A reader of a deleted entry has had ``retain`` publications of time."""
        numbers = self.numbers()
        old, kept = numbers[:-retain], numbers[-retain:]
        used = {f for n in kept for f in folders(self.read(n))}
        gone = sorted({f for n in old for f in folders(self.read(n))} - used)
        for number in old:
            self._fs.delete(self._entry(number), False)
        for folder in gone:
            self._fs.delete(self._path(folder), True)
        return gone
