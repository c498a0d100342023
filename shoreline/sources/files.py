"""Small files and folders on the file system of the shared folder, whatever it is."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Files:
    """The few file operations a table's bookkeeping needs, on whatever file system holds
    the shared folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.gateway = spark.sparkContext._gateway
        self.jvm = self.gateway.jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.root = root.rstrip("/")
        self.fs = self.path("").getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def ensure(self, name: str = "") -> None:
        self.fs.mkdirs(self.path(name))

    def exists(self, name: str) -> bool:
        return self.fs.exists(self.path(name))

    def names(self, name: str) -> list[str]:
        """Names in a folder; none where it does not exist."""
        path = self.path(name)
        if not self.fs.exists(path):
            return []
        return [s.getPath().getName() for s in self.fs.listStatus(path)]

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def write(self, name: str, text: str, replace: bool = False) -> bool:
        """The text as a file, whole or not at all; False where it exists and may not be
        replaced."""
        folder, _, leaf = name.rpartition("/")
        self.ensure(folder)
        part = f"{folder}/.{leaf}.{uuid.uuid4().hex}"
        stream = self.fs.create(self.path(part))
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if replace:
            self.delete(name)
        elif self.exists(name):
            self.delete(part)
            return False
        if self.rename(part, name):
            return True
        self.delete(part)
        return False

    def rename(self, old: str, new: str) -> bool:
        """Move a file or folder to a name that must not exist; False where it does."""
        fs = self.jvm.org.apache.hadoop.fs
        none = self.gateway.new_array(getattr(fs, "Options$Rename"), 0)
        try:
            fs.FileContext.getFileContext(self.fs.getUri(), self.conf).rename(self.path(old), self.path(new), none)
            return True
        except Py4JJavaError as err:
            if not self.exists(new):
                raise RuntimeError(f"cannot move {old} to {new} in {self.root}") from err
            return False

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)
