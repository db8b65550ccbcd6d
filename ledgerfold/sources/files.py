"""Small files and folders beside the data, through the file system Spark itself uses."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


class Folder:
    """A folder on any storage Spark can reach; names below it may hold slashes."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.path = path.rstrip("/")
        self._jvm, self._named = spark._jvm, spark._jvm.org.apache.hadoop.fs.Path
        hadoop = spark._jsc.hadoopConfiguration()
        self._fs = self._at("").getFileSystem(hadoop)

    def _at(self, name: str):
        return self._named(f"{self.path}/{name}" if name else self.path)

    def exists(self, name: str = "") -> bool:
        return self._fs.exists(self._at(name))

    def names(self, name: str = "") -> list[str]:
        """What lies directly in a folder; nothing where there is none."""
        if not self.exists(name):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._at(name)))

    def is_empty(self, name: str = "") -> bool:
        return not self.exists(name) or len(self._fs.listStatus(self._at(name))) == 0

    def delete(self, name: str = "") -> None:
        self._fs.delete(self._at(name), True)

    def size(self, name: str = "") -> int:
        """Bytes of all files below a folder."""
        return self._fs.getContentSummary(self._at(name)).getLength()

    def files(self, pattern: str) -> list[str]:
        """Full names of the files that a pattern meets; hidden ones are left out."""
        return list(self.sizes(pattern))

    def sizes(self, pattern: str) -> dict[str, int]:
        """The same files with their bytes."""
        found = self._fs.globStatus(self._at(pattern)) or []
        sizes = {status.getPath().toString(): status.getLen() for status in found}
        return {n: size for n, size in sizes.items() if n.rsplit("/", 1)[1][:1] not in "._"}

    def move_all(self, names: list[str], back: str, to: str) -> None:
        """Rename files from one folder to another; those moved before are passed by."""
        for parent in sorted({n.rsplit("/", 1)[0] for n in names}):
            self._fs.mkdirs(self._at(f"{to}{parent}"))
        for name in names:
            if self.exists(f"{back}{name}") and not self._fs.rename(
                self._at(f"{back}{name}"), self._at(f"{to}{name}")
            ):
                raise RuntimeError(f"cannot move {self.path}/{back}{name}")

    def move(self, name: str, to: str) -> None:
        """Rename a folder; nothing happens where it has been moved before."""
        if not self.exists(name):
            return
        self._fs.mkdirs(self._at(to).getParent())
        if not self._fs.rename(self._at(name), self._at(to)):
            raise RuntimeError(f"cannot move {self.path}/{name} to {to}")

    def put(self, name: str, content: dict) -> None:
        """Write a file in the place of any earlier one."""
        self.delete(name)
        self.create(name, content)

    def create(self, name: str, content: dict) -> None:
        """Write a file that must not exist yet."""
        stream = self._fs.create(self._at(name), False)
        try:
            stream.write(bytearray(json.dumps(content).encode()))
        finally:
            stream.close()

    def read(self, name: str) -> dict | None:
        if not self.exists(name):
            return None
        stream = self._fs.open(self._at(name))
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text) if text else {}
