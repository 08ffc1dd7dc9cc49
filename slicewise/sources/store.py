"""File systems as Spark sees them: listing, heads of files, and renames, for any URI that Spark can read."""

from __future__ import annotations

import os
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from uuid import uuid4

from pyspark.sql import SparkSession

#: Driver threads for small calls such as opens and renames, and bytes of a file that are read at a time for its head.
THREADS, HEAD = 16, 4096


class Store:
    """The file system of a path, through the session's configuration; used by the driver for names, never for data."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.jvm, self.conf = spark, spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self.path(path).getFileSystem(self.conf)

    def path(self, text: str):
        return self.jvm.org.apache.hadoop.fs.Path(text)

    def exists(self, path: str) -> bool:
        return self.fs.exists(self.path(path))

    def found(self, pattern: str) -> list[str]:
        """Files that a pattern names, or that lie in the folders it names; hidden ones are left out."""
        out = []
        for status in self.fs.globStatus(self.path(pattern)) or []:
            inner = list(self.files(status.getPath().toString())) if status.isDirectory() else [status.getPath().toString()]
            out += inner
        return sorted(p for p in out if not p.rpartition("/")[2].startswith(("_", ".")))

    def files(self, folder: str) -> Iterator[str]:
        """The files below a folder, one after another however many there are."""
        found = self.fs.listFiles(self.path(folder), True)
        while found.hasNext():
            yield found.next().getPath().toString()

    def names(self, folder: str) -> list[str]:
        return [s.getPath().getName() for s in self.fs.listStatus(self.path(folder))] if self.exists(folder) else []

    def head(self, path: str) -> bytes:
        """The file's first line, or all of it if it has one line only."""
        stream, out = self.fs.open(self.path(path)), b""
        try:
            while b"\n" not in out:
                part = bytes(stream.readNBytes(HEAD))
                out += part
                if len(part) < HEAD:
                    break
        finally:
            stream.close()
        return out.partition(b"\n")[0].rstrip(b"\r")

    def text(self, path: str) -> str:
        stream = self.fs.open(self.path(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, path: str, content: bytes = b"") -> None:
        stream = self.fs.create(self.path(path), True)
        try:
            stream.write(bytearray(content))
        finally:
            stream.close()

    def move(self, source: str, target: str) -> None:
        """Rename a file; one of the target's name is replaced."""
        to = self.path(target)
        self.fs.mkdirs(to.getParent())
        if not self.fs.rename(self.path(source), to):
            self.fs.delete(to, False)
            if not self.fs.rename(self.path(source), to):
                raise OSError(f"{source} can't be renamed to {target}")

    def put_new(self, path: str, content: bytes) -> bool:
        """A file with its whole content, if none of that name exists: of two at once, one wins. A rename that doesn't replace."""
        part = f"{path.rpartition('/')[0]}/.{uuid4().hex}"
        self.write(part, content)
        if self.fs.getScheme() == "file":  # here a rename may replace, a link never does
            local = [self.fs.makeQualified(self.path(p)).toUri().getPath() for p in (part, path)]
            try:
                os.link(*local)
            except FileExistsError:
                return False
            finally:
                self.fs.delete(self.path(part), False)
            return True
        none = self.spark.sparkContext._gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.conf).rename(self.path(part), self.path(path), none)
        except Exception as error:
            self.fs.delete(self.path(part), False)
            if "FileAlreadyExistsException" in str(error):
                return False
            raise
        return True

    def delete(self, path: str) -> None:
        self.fs.delete(self.path(path), True)

    def delete_at_end(self, folder: str) -> bool:
        """Make a folder, if it isn't there, that is deleted with all in it when Spark's driver ends."""
        return self.fs.mkdirs(self.path(folder)) and self.fs.deleteOnExit(self.path(folder))


def in_threads(work, items) -> None:
    """Small calls to a file system, many at a time; ``items`` may be a long iterator."""
    with ThreadPoolExecutor(THREADS) as pool:
        waiting = []
        for item in items:
            waiting.append(pool.submit(work, item))
            if len(waiting) >= 8 * THREADS:
                waiting.pop(0).result()
        for one in waiting:
            one.result()
