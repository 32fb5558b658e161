"""Published states of a folder of tables.

A state is one small JSON file that names the version of every part of every table. Files of data are
written under fresh names and never changed, so a state becomes visible, whole, when its manifest is put in place, and
readers of an older one are not disturbed. Manifests are numbered; putting number n + 1 in place fails if another
writer was faster, and nothing is lost then but that writer's turn.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Conflict(RuntimeError):
    """Another writer has published in the meantime."""


class Manifests:
    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()
        self.root = root
        self.folder = f"{root}/manifests"

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def _files(self):
        return self._path(self.root).getFileSystem(self._conf)

    def list(self, folder: str) -> list[tuple[str, int]]:
        """Name and time of change (milliseconds) of what lies directly in a folder; nothing if it is not there."""
        fs, path = self._files(), self._path(folder)
        if not fs.exists(path):
            return []
        return [(s.getPath().getName(), s.getModificationTime()) for s in fs.listStatus(path)]

    def delete(self, path: str) -> None:
        self._files().delete(self._path(path), True)

    def numbers(self) -> list[int]:
        return sorted(int(n[: -len(".json")]) for n, _ in self.list(self.folder) if n.endswith(".json") and n[0] != ".")

    def read(self, number: int) -> dict:
        stream = self._files().open(self._path(f"{self.folder}/{number:010d}.json"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def latest(self) -> tuple[int, dict]:
        """Number and tables of the newest state; 0 and none before the first."""
        found = self.numbers()
        return (found[-1], self.read(found[-1])) if found else (0, {})

    def publish(self, number: int, tables: dict) -> None:
        """Put a state in place in one step, or raise ``Conflict``."""
        fs = self._files()
        draft = self._path(f"{self.folder}/.draft-{uuid.uuid4().hex}")
        out = fs.create(draft, False)
        out.write(json.dumps(tables, sort_keys=True).encode())
        out.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self._conf)
        rename = self._jvm.org.apache.hadoop.fs.Options.Rename
        never_replace = self._jvm.java.lang.reflect.Array.newInstance(rename.NONE.getClass(), 1)
        self._jvm.java.lang.reflect.Array.set(never_replace, 0, rename.NONE)
        try:
            context.rename(draft, self._path(f"{self.folder}/{number:010d}.json"), never_replace)
        except Py4JJavaError as e:
            fs.delete(draft, False)
            if "FileAlreadyExists" in e.java_exception.getClass().getName():
                raise Conflict(f"state {number} of {self.root} has been published by another writer") from None
            raise
