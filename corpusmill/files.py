"""Small files in folders on any file system that the session knows: a local disk, a cluster's or an object store's.

Everything goes through the session's Hadoop file systems, so a root may be a plain path or a URI.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Folder:
    """A folder by its path or URI."""

    def __init__(self, spark: SparkSession, root: str):
        self.root = str(root).rstrip("/") or "/"
        self._jvm = spark.sparkContext._jvm
        base = self._jvm.org.apache.hadoop.fs.Path(self.root)
        fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._local = fs.getScheme() == "file"
        # without check-sum files beside every small one
        self._fs = fs.getRawFileSystem() if self._local else fs

    def path(self, name: str) -> str:
        return f"{self.root}/{name}" if name else self.root

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(self.path(name))

    def exists(self, name: str = "") -> bool:
        return self._fs.exists(self._path(name))

    def names(self, name: str = "") -> list[str]:
        """Names of what is in the folder or in one of its folders, sorted; none if it isn't there."""
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(name))) if self.exists(name) else []

    def read(self, name: str) -> bytes:
        stream = self._fs.open(self._path(name))
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()

    def write(self, name: str, content: bytes) -> None:
        stream = self._fs.create(self._path(name), True)
        try:
            stream.write(bytearray(content))
        finally:
            stream.close()

    def publish(self, name: str, content: bytes) -> bool:
        """Makes a file appear as a whole under a name that no other has taken; False if one has."""
        part = f"_{uuid.uuid4().hex}.part"
        self.write(part, content)
        try:
            if self._local:  # a rename would replace a file that is there, a link doesn't
                link = lambda n: self._jvm.java.io.File(self._path(n).toUri().getPath()).toPath()
                try:
                    self._jvm.java.nio.file.Files.createLink(link(name), link(part))
                except Exception:
                    if self.exists(name):
                        return False
                    raise
                return True
            return self._fs.rename(self._path(part), self._path(name))
        finally:
            self.delete(part)

    def delete(self, name: str = "") -> None:
        self._fs.delete(self._path(name), True)
