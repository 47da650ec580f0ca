"""A linear log of small JSON entries on a shared file system: numbered files, each of which appears once and whole.

A number is created exclusively: of two writers that want it, one gets it and the other learns so, looks at what has been
committed and decides anew.  An entry is written aside and renamed without overwriting, so nobody reads half of one, and
a writer that dies leaves a draft which nobody reads.  Renaming without overwriting is atomic on file systems that rename
atomically (HDFS and its like); a local folder is guarded within one process only.
"""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

_LOCAL = threading.Lock()


class CommitLog:
    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        context = spark.sparkContext
        self._jvm, self._conf = context._jvm, context._jsc.hadoopConfiguration()
        self._new_array = context._gateway.new_array
        self._hadoop = self._jvm.org.apache.hadoop.fs
        self._folder = self._hadoop.Path(self.path)
        self._fs = self._folder.getFileSystem(self._conf)

    def _file(self, name: str):
        return self._hadoop.Path(f"{self.path}/{name}")

    def numbers(self) -> list[int]:
        found = self._fs.globStatus(self._file("*.json")) or []
        return sorted(int(f.getPath().getName().split(".")[0]) for f in found)

    def last(self) -> int:
        """The newest number; -1 if there is none."""
        return max(self.numbers(), default=-1)

    def get(self, number: int) -> dict:
        stream = self._fs.open(self._file(f"{number:012d}.json"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def put(self, number: int, entry: dict) -> bool:
        """Create one number; False if somebody else did."""
        draft, final = self._file(f"_drafts/{uuid.uuid4().hex}"), self._file(f"{number:012d}.json")
        stream = self._fs.create(draft, False)
        stream.write(bytearray(json.dumps(entry, sort_keys=True).encode()))
        stream.close()
        kinds = getattr(self._hadoop, "Options$Rename")
        options = self._new_array(kinds, 1)
        options[0] = kinds.NONE
        with _LOCAL:
            try:
                self._hadoop.FileContext.getFileContext(self._folder.toUri(), self._conf).rename(draft, final, options)
                return True
            except Exception:
                self._fs.delete(draft, False)
                if self._fs.exists(final):
                    return False
                raise

    def append(self, decide: Callable[[], dict | None]) -> int | None:
        """Commit what ``decide`` gives, anew each time another writer was faster; None if it gives nothing.  The number."""
        while True:
            number = self.last() + 1
            entry = decide()
            if entry is None:
                return None
            if self.put(number, entry):
                return number

    def remove(self, path: str) -> bool:
        """Remove a folder that entries name; whether it was there."""
        return bool(self._fs.delete(self._hadoop.Path(path), True))
